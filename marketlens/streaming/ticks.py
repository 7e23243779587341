"""The live tick pipeline on Structured Streaming.

Stored ticks lie in three folders below the sink.  ``live`` has a folder per day and micro-batch; ``packed`` has one
per pack number and day, with the batches that were put together; ``lists`` tells for each pack number the days and
batches it holds.  A day is read from its last listed pack, and from those live batches that the list doesn't name.
So a pack counts from the moment its list is written, and files left by a crash before or after are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlens.operators.joins import latest_quote
from marketlens.operators.projections import map_ticks
from marketlens.schemas import TICK_BAR_SCHEMA, TICK_TEXT_SCHEMA
from marketlens.session import remove_path
from marketlens.sources.readers import read_parquet_or_none

_FOLDERS = T.StructType([T.StructField("day", T.DateType()), T.StructField("batch_id", T.LongType())])
_PACK = T.StructField("pack", T.LongType())
#: What Spark calls the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_tick_stream(
    spark: SparkSession, path: str, schema: T.StructType = TICK_TEXT_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    """JSON lines from files that arrive in a folder; malformed lines are skipped."""
    reader = spark.readStream.schema(schema).option("mode", "DROPMALFORMED")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def tick_batch_writer(
    sink: str, metrics: str, quotes: Callable[[], DataFrame] | None = None, clock: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """The step for one micro-batch: map, attach the exchange rate, store, count.

    A batch is stored in the folders of its days under its own number.  Running it
    again after a failure replaces those folders, so no row is stored twice: without a
    ``clock`` the time of receipt is noted before the first row is stored, and a
    repeated batch takes the noted one, so it falls on the same day.  ``quotes`` gives
    the current quote table; it is read once per batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rate = latest_quote(quotes()).scalar() if quotes else F.lit(float("nan"))
        now = clock if clock is not None else F.lit(_received(batch.sparkSession, f"{sink}/received/batch_id={batch_id}"))
        seen = Observation()
        rows = map_ticks(batch, rate, now).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.max("EURUSD").alias("eurusd"), F.max("EventTS").alias("last_ts")
        )
        (
            rows.select("*", F.col("Date").alias("day"), F.lit(batch_id).cast("bigint").alias("batch_id"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id").parquet(f"{sink}/live")
        )
        counted = batch.sparkSession.range(1, numPartitions=1).select(
            F.lit(seen.get["rows"]).cast("bigint").alias("rows"),
            F.lit(seen.get["eurusd"]).cast("double").alias("eurusd"),
            F.lit(seen.get["last_ts"]).cast("timestamp").alias("last_ts"),
        )
        counted.write.mode("overwrite").parquet(f"{metrics}/batch_id={batch_id}")

    return write


def _received(spark: SparkSession, path: str) -> datetime:
    """The noted time of receipt of a batch; the current one is noted if there is none yet."""
    noted = read_parquet_or_none(spark, path)
    if noted is None:
        spark.range(1, numPartitions=1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(path)
        noted = spark.read.parquet(path)
    return noted.first()["at"]


def start_ticks(
    ticks: DataFrame,
    sink: str,
    metrics: str,
    checkpoint: str,
    quotes: Callable[[], DataFrame] | None = None,
    clock: Column | None = None,
    seconds: int | None = 5,
) -> StreamingQuery:
    """Start the pipeline, a batch every ``seconds``; ``None`` works off what is there and ends."""
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return (
        ticks.writeStream.foreachBatch(tick_batch_writer(sink, metrics, quotes, clock))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_ticks(query: StreamingQuery, timeout_seconds: float | None = None) -> None:
    """Wait for the end of the query, or stop it after a time; the session stays up."""
    ended = query.awaitTermination(timeout_seconds) if timeout_seconds else query.awaitTermination()
    if not ended:
        query.stop()


def _stored(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """A table of a known layout, as no file has to be opened for it; empty where there is none."""
    found = read_parquet_or_none(spark, path)
    if found is None:
        return spark.createDataFrame([], layout)
    # Folder names alone tell too little of a type: one folder of rows without a day looks like text.
    folders = {f.name: f.dataType for f in (*_FOLDERS, _PACK)}
    return found.select(*[F.col(c).cast(folders[c]).alias(c) if c in folders else F.col(c) for c in layout.names])


def _live(spark: SparkSession, sink: str) -> DataFrame:
    return _stored(spark, f"{sink}/live", T.StructType([*TICK_BAR_SCHEMA, *_FOLDERS]))


def _packs(spark: SparkSession, sink: str) -> DataFrame:
    return _stored(spark, f"{sink}/packed", T.StructType([*TICK_BAR_SCHEMA, _FOLDERS["batch_id"], _PACK, _FOLDERS["day"]]))


def _listed(spark: SparkSession, sink: str) -> DataFrame:
    """``day, batch_id, pack``: what the last pack of each day holds; as many rows as packed batches."""
    lists = _stored(spark, f"{sink}/lists", T.StructType([*_FOLDERS, _PACK]))
    last = lists.groupBy("day").agg(F.max("pack").alias("last")).withColumnRenamed("day", "last_day")
    same = F.col("day").eqNullSafe(F.col("last_day")) & (F.col("pack") == F.col("last"))
    return lists.join(last, same, "left_semi")


def _visible(spark: SparkSession, sink: str, keep: Column) -> DataFrame:
    """Each stored row of the days at hand once, with its day and batch."""
    if read_parquet_or_none(spark, f"{sink}/lists") is None:
        return _live(spark, sink).filter(keep)
    listed = _listed(spark, sink).filter(keep).select(*[F.col(c).alias(f"__{c}") for c in ("day", "batch_id", "pack")])
    same_day = F.col("day").eqNullSafe(F.col("__day"))
    packed = _packs(spark, sink).filter(keep).join(
        listed.select("__day", "__pack").distinct(), same_day & (F.col("pack") == F.col("__pack")), "left_semi"
    )
    # Times are with or without a zone, as the clock was; where all is packed, the empty rest has to follow.
    kind = packed.schema["EventTS"].dataType
    live = _live(spark, sink).withColumn("EventTS", F.col("EventTS").cast(kind)).filter(keep).join(listed, same_day & (F.col("batch_id") == F.col("__batch_id")), "left_anti")
    return live.unionByName(packed.drop("pack"))


def read_tick_bars(spark: SparkSession, sink: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored ticks from the first to the last day given, whose folders alone are read; an empty table if there are none.

    Ticks without a date are among them only where no bound is given.
    """
    keep = F.lit(True)
    if start:
        keep = keep & (F.col("day") >= F.lit(start).cast("date"))
    if end:
        keep = keep & (F.col("day") <= F.lit(end).cast("date"))
    return _visible(spark, sink, keep).select(*TICK_BAR_SCHEMA.names)


def compact_ticks(spark: SparkSession, sink: str, before: str | None = None) -> int:
    """Put the live batches of the days before a day, of all without it, together; how many day folders were packed.

    Call it from one place at a time, beside a running stream for days that are over.  Each day is packed in ranges of
    ticker and time.  With a day given, the newest batch is left alone, as it may still be written; without one, call it
    only after the stream ended in good order.  It may be repeated after a crash at any point: rows count where the last list says, and folders
    that nothing reads any more are removed at the end, or by the next call.  Batches of a day that come later, or are
    replayed after they were packed, do no harm: the former are read beside the pack, the latter are named in its list.
    """
    keep = F.lit(True) if before is None else F.coalesce(F.col("day") < F.lit(before).cast("date"), F.lit(False))
    live, listed = _live(spark, sink).filter(keep), _listed(spark, sink).filter(keep)
    if before is not None:
        newest = _live(spark, sink).agg(F.max("batch_id")).first()[0]
        live = live.filter(F.col("batch_id") < F.lit(newest))
    # Folder names only, as many as there are live batches: a few thousand a day.
    pending = live.select("day", "batch_id").distinct().exceptAll(listed.select("day", "batch_id"))
    days = [r["day"] for r in pending.select("day").distinct().collect()]
    if days:
        here = F.col("day").isin([d for d in days if d is not None]) | (F.col("day").isNull() & F.lit(None in days))
        held = spark.createDataFrame(pending.unionByName(listed.filter(here).select("day", "batch_id")).collect(), _FOLDERS)
        named = held.select(F.col("day").alias("__of"), F.col("batch_id").alias("__batch"))
        same = F.col("day").eqNullSafe(F.col("__of")) & (F.col("batch_id") == F.col("__batch"))
        last = _stored(spark, f"{sink}/lists", T.StructType([*_FOLDERS, _PACK])).agg(F.max("pack")).first()[0]
        pack = 1 + (last or 0)
        (
            _visible(spark, sink, here).join(named, same, "left_semi")
            .repartitionByRange("day", "Ticker", "EventTS").sortWithinPartitions("day", "Ticker", "EventTS")
            .write.mode("overwrite").partitionBy("day").parquet(f"{sink}/packed/pack={pack}")
        )
        _list(held, f"{sink}/lists/pack={pack}")
    _sweep(spark, sink)
    return len(days)


def _list(held: DataFrame, path: str) -> None:
    held.coalesce(1).write.mode("overwrite").parquet(path)


def _sweep(spark: SparkSession, sink: str) -> None:
    """Remove live batches that a pack holds, and days of packs that a later pack holds too."""
    for day, batch_id, _ in _listed(spark, sink).join(
        _live(spark, sink).select(F.col("day").alias("d"), F.col("batch_id").alias("b")).distinct(),
        F.col("day").eqNullSafe(F.col("d")) & (F.col("batch_id") == F.col("b")), "left_semi",
    ).select("day", "batch_id", "pack").collect():
        remove_path(spark, f"{sink}/live/day={day or _NO_DAY}/batch_id={batch_id}")
    used = _listed(spark, sink).select(F.col("day").alias("d"), F.col("pack").alias("p")).distinct()
    old = _packs(spark, sink).select("day", "pack").distinct().join(
        used, F.col("day").eqNullSafe(F.col("d")) & (F.col("pack") == F.col("p")), "left_anti"
    )
    for day, pack in old.collect():
        remove_path(spark, f"{sink}/packed/pack={pack}/day={day or _NO_DAY}")


def read_batch_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    return spark.read.parquet(metrics)
