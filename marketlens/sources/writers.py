"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.joins import new_tickers
from marketlens.operators.projections import conform_bars, stringify_temporal
from marketlens.operators.sets import merge_history, union_bars
from marketlens.schemas import BAR_COLUMNS
from marketlens.session import remove_path, scratch_path
from marketlens.sources.readers import read_bars, read_layouts


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite", temporal_as_text: bool = False) -> None:
    (stringify_temporal(df) if temporal_as_text else df).write.mode(mode).parquet(path)


def write_bars(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bars in folders by year, sorted by ticker inside them.

    Ranges over (year, ticker, date) give files of even size even if one ticker
    makes up much of the table, and let a ticker filter skip most row groups.
    With ``overwrite`` only the years at hand are replaced.
    """
    dated = bars.select(*BAR_COLUMNS).withColumn("year", F.year("Date"))
    (
        dated.repartitionByRange("year", "Ticker", "Date")
        .sortWithinPartitions("year", "Ticker", "Date")
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("year").parquet(path)
    )


def store_new_tickers(bars: DataFrame, path: str) -> None:
    """Append the bars of tickers the table does not hold yet."""
    write_bars(new_tickers(bars, read_bars(bars.sparkSession, path, ["Ticker"])), path, "append")


def update_history(new: DataFrame, path: str, staged: str | None = None) -> str | None:
    """Merge new bars into the stored table; only the years they touch are rewritten.

    The merged years are written to ``staged`` first.  Lost executors only repeat tasks.  Should the driver end
    while folders are being replaced, ``publish_staged`` finishes the work from there.  A folder given by the
    caller stays and is returned; one of the scratch folder is removed once it is published.
    """
    spark = new.sparkSession
    scans = read_layouts(spark, path)
    if scans:
        years = [r[0] for r in new.select(F.year("Date")).distinct().collect()]  # as many as calendar years
        # Bars without a date share a folder, which is rewritten like that of a year.
        touched = F.col("year").isin([y for y in years if y is not None]) | (F.col("year").isNull() & F.lit(None in years))
        merged = merge_history(union_bars([conform_bars(s.filter(touched), False) for s in scans]), new)
    else:
        merged = merge_history(new.limit(0), new)
    place = staged or scratch_path(spark, "history")
    merged.write.parquet(place)
    publish_staged(spark, place, path)
    if staged is None:
        remove_path(spark, place)
    return staged


def publish_staged(spark: SparkSession, staged: str, path: str) -> None:
    """Replace the years of a table by merged ones; doing it twice changes nothing."""
    write_bars(spark.read.parquet(staged), path)


def write_replacing(df: DataFrame, path: str, key: str) -> None:
    """Replace the stored rows of the key values at hand and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "overwrite", properties: dict[str, str] | None = None,
    connections: int = 16, batch_rows: int = 10_000,
) -> None:
    """Write to a database table.  At most ``connections`` tasks write at a time."""
    if mode not in ("overwrite", "append", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown save mode {mode!r}")
    options = {"numPartitions": str(connections), "batchsize": str(batch_rows), **(properties or {})}
    df.write.jdbc(url=url, table=table, mode=mode, properties=options)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    split_on: str | None = None, bounds: tuple[int, int] | None = None, connections: int = 16,
) -> DataFrame:
    """Read a database table, in parallel ranges of ``split_on`` where given."""
    if split_on and bounds:
        return spark.read.jdbc(
            url, table, column=split_on, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=connections, properties=properties or {},
        )
    return spark.read.jdbc(url, table, properties=properties or {})


def store_raw_and_cleaned(
    raw: DataFrame, cleaned: DataFrame, url: str, raw_table: str, cleaned_table: str,
    properties: dict[str, str] | None = None,
) -> None:
    write_jdbc(raw, url, raw_table, "overwrite", properties)
    write_jdbc(cleaned, url, cleaned_table, "overwrite", properties)


