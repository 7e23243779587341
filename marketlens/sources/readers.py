"""Scans.  Schemas are given wherever the layout is known, so no scan infers one."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions import DATE_FORMAT, as_date, as_double
from marketlens.operators.filters import clean_and_validate
from marketlens.operators.projections import conform_bars, standardize_records
from marketlens.schemas import (
    BAR_SCHEMA, INTRADAY_LOOKBACK_DAYS, MEASURES, TICK_TEXT_SCHEMA, quoted, wide_close_schema,
)

CORRUPT = "_corrupt_record"


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon CSV with a header; every column is text."""
    return spark.read.option("header", True).option("sep", ";").csv(path)


def read_declared_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The same file with a declared schema: a ``dd/MM/yyyy`` date and text measures."""
    return (
        spark.read.schema(schema or wide_close_schema())
        .option("header", True).option("sep", ";").option("dateFormat", DATE_FORMAT)
        .csv(path)
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = TICK_TEXT_SCHEMA) -> DataFrame:
    """JSON lines; blank and malformed ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_malformed_lines(spark: SparkSession, path: str, schema: T.StructType = TICK_TEXT_SCHEMA) -> DataFrame:
    """The lines ``read_json_lines`` skips, blank ones aside."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json("value", checked, {"columnNameOfCorruptRecord": CORRUPT})
    return lines.filter(parsed[CORRUPT].isNotNull()).select(F.col("value").alias("line"))


def empty_bars(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BAR_SCHEMA)


def read_parquet_or_none(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """The table as stored, or ``None`` where nothing is stored."""
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


#: Files of one write job carry its id in their names and share their layout.
_WRITE_JOB = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def read_layouts(spark: SparkSession, path: str) -> list[DataFrame]:
    """A stored table as one scan per layout, so that column types may differ between write jobs.

    One file of each write job is asked for its layout, a file of unknown origin for its own.  Columns of folder
    names are part of every scan.  A table of a single layout is one plain scan; nothing stored is an empty list.
    """
    whole = read_parquet_or_none(spark, path)
    if whole is None:
        return []
    jobs: dict[str, list[str]] = {}
    for file in sorted(map(unquote, whole.inputFiles())):
        job = _WRITE_JOB.search(file)
        jobs.setdefault(job[1] if job else file, []).append(file)
    layouts: dict[str, tuple[T.StructType, list[str]]] = {}
    for files in jobs.values():
        layout = spark.read.parquet(files[0]).schema if len(jobs) > 1 else whole.schema
        layouts.setdefault(layout.json(), (layout, []))[1].extend(files)
    if len(layouts) == 1:
        return [whole]
    stored = {f.name for layout, _ in layouts.values() for f in layout}
    folders = [f for f in whole.schema if f.name not in stored]
    return [
        spark.read.schema(T.StructType([*layout, *folders])).option("basePath", path).parquet(*files)
        for layout, files in layouts.values()
    ]


def read_bars(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Stored bars with their declared types, or an empty table of that layout.

    Only the columns asked for are read from the files; unknown names are ignored.
    Given a first and last day, only the folders of their years are read.  Files
    may hold a column in different types, or not at all; a value that is no number is null.
    """
    scans = read_layouts(spark, path) or [empty_bars(spark)]
    parts = [_declared(scan, columns, start, end) for scan in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _declared(stored: DataFrame, columns: Sequence[str] | None, start: str | None, end: str | None) -> DataFrame:
    typed = {"Date": as_date, "Ticker": lambda df, c: F.col(c).cast("string"), **{m: as_double for m in MEASURES}}
    for day, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if day:
            bound = F.lit(day).cast("date")
            stored = stored.filter(keep(_typed_column(stored, "Date", typed), bound))
            if "year" in stored.columns:
                stored = stored.filter(keep(F.col("year"), F.year(bound)))
    wanted = [f.name for f in BAR_SCHEMA if f.name in stored.columns]
    wanted = [c for c in columns or [] if c in wanted] or wanted
    return stored.select(*[_typed_column(stored, c, typed).alias(c) for c in wanted])


def _typed_column(df: DataFrame, name: str, typed: dict) -> Column:
    return F.col(quoted(name)) if df.schema[name].dataType == BAR_SCHEMA[name].dataType else typed[name](df, name)


def range_slice(bars: DataFrame, start: str, end: str) -> DataFrame:
    """Bars from ``start`` up to but not including ``end``."""
    day = F.col("Date")
    return bars.filter((day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date")))


def interval_lookback(df: DataFrame, interval: str, ts: str = "ts") -> DataFrame:
    """Rows within the reach of an intraday interval, counted back from the newest row."""
    if interval not in INTRADAY_LOOKBACK_DAYS:
        return df
    newest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= newest - F.make_dt_interval(F.lit(INTRADAY_LOOKBACK_DAYS[interval])))


def load_tickers(bars: DataFrame, tickers: Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """The bars of several tickers in one scan; the filters reach the files."""
    out = bars.filter(F.col("Ticker").isin(list(tickers)))
    return range_slice(out, start, end) if start and end else out


def missing_tickers(bars: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Which of the requested tickers have no bars."""
    asked = bars.sparkSession.createDataFrame([(t,) for t in tickers], "Ticker string")
    found = bars.filter(F.col("Ticker").isin(list(tickers))).select("Ticker").distinct()
    return asked.join(found, "Ticker", "left_anti")


def read_source(spark: SparkSession, source: str, **options) -> DataFrame:
    """Bars by source name; an unknown name gives an empty table.

    ``ticks``: JSON lines at ``path``, dated ``as_of``.  ``table``: stored OHLCV at
    ``path``, optionally ``ticker``, ``start``, ``end``, ``interval``.
    """
    if source == "ticks":
        records = standardize_records(read_json_lines(spark, options["path"]), options.get("as_of"))
        return conform_bars(records)
    if source == "table":
        stored = read_parquet_or_none(spark, options["path"])
        if stored is None:
            return empty_bars(spark)
        interval = options.get("interval", "1d")
        if interval in INTRADAY_LOOKBACK_DAYS:
            stamp = next(c for c in ("Datetime", "EventTS", "Date") if c in stored.columns)
            stored = interval_lookback(stored, interval, stamp)
        bars = conform_bars(stored)
        if options.get("ticker"):
            bars = load_tickers(bars, [options["ticker"]])
        if interval not in INTRADAY_LOOKBACK_DAYS and options.get("start") and options.get("end"):
            bars = range_slice(bars, options["start"], options["end"])
        return bars
    return empty_bars(spark)


def read_validated(spark: SparkSession, source: str, **options) -> DataFrame:
    return clean_and_validate(read_source(spark, source, **options))
