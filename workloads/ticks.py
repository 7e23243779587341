"""Queries over live ticks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators import joins, projections
from marketlens.plans.ticks import report_on
from marketlens.plans.ticks import tick_report as report
from marketlens.schemas import TICK_TEXT_SCHEMA
from marketlens.session import scratch_path
from marketlens.streaming import ticks as stream
from workloads.adapters import fx_quotes, tick_fields, tick_lines, with_sql
from workloads.ingest import DOUBLE
from workloads.registry import query

# The line carries its own time, which stands in for the clock.
TIMED_SCHEMA = T.StructType([*TICK_TEXT_SCHEMA.fields, T.StructField("ts", T.StringType())])


def _clock():
    return F.col("ts").try_cast("timestamp_ntz")


def bars_sql(source: str, rate: str) -> str:
    raw = """'{"ticker":"' || ticker || '","price":"' || price || '","high":"' || high || '","low":"' || low || '","volume":"' || volume
        || '","ts":"' || strftime(tick_ts, '%Y-%m-%d %H:%M:%S.%f') || '"}'"""
    return f"""
SELECT tick_ts AS "EventTS", CAST(tick_ts AS DATE) AS "Date", CAST(hour(tick_ts) AS INTEGER) AS "Hour",
       CAST(minute(tick_ts) AS INTEGER) AS "Minute", dayname(tick_ts) AS "DayOfWeek", ticker AS "Ticker",
       {DOUBLE.format(c='price')} AS "Open", {DOUBLE.format(c='high')} AS "High", {DOUBLE.format(c='low')} AS "Low",
       {DOUBLE.format(c='price')} AS "Close", {DOUBLE.format(c='volume')} AS "Volume", {rate} AS "EURUSD", {raw} AS "RawJSON"
FROM {source}"""


@query("fx_latest", with_sql('SELECT eurusd AS "EURUSD" FROM last_fx'))
def fx_latest(spark, sf):
    return joins.latest_quote(fx_quotes(spark, sf))


@query("tick_fx", with_sql('SELECT event_id, ticker, price, (SELECT eurusd FROM last_fx) AS "EURUSD" FROM tick_fields'))
def tick_fx(spark, sf):
    ticks = tick_fields(spark, sf).select("event_id", "ticker", "price")
    return joins.attach_quote(ticks, joins.latest_quote(fx_quotes(spark, sf)))


@query("map_ticks", with_sql(bars_sql("tick_fields", "CAST(1.08 AS DOUBLE)")))
def map_ticks(spark, sf):
    return projections.map_ticks(tick_fields(spark, sf).drop("event_id"), 1.08, _clock())


def _stream(spark, sf, files: int = 4) -> tuple[str, str]:
    """Ticks in files, run through the stream in several batches; sink and metrics folders."""
    source, sink, metrics, checkpoint = (scratch_path(spark, f"ticks-{n}") for n in ("source", "sink", "metrics", "checkpoint"))
    tick_lines(spark, sf).repartition(files).write.text(source)
    ticks = stream.read_tick_stream(spark, source, TIMED_SCHEMA, files_per_batch=max(1, files // 2))
    stream.run_ticks(stream.start_ticks(
        ticks, sink, metrics, checkpoint, quotes=lambda: fx_quotes(spark, sf), clock=_clock(), seconds=None
    ))
    return sink, metrics


@query("stream_ticks", with_sql(bars_sql("good_ticks", "(SELECT eurusd FROM last_fx)")))
def stream_ticks(spark, sf):
    sink, _ = _stream(spark, sf)
    return stream.read_tick_bars(spark, sink)


@query("batch_sink", with_sql('SELECT CAST(count(*) AS BIGINT) AS rows, (SELECT eurusd FROM last_fx) AS eurusd FROM good_ticks'))
def batch_sink(spark, sf):
    """What the batches of a stream counted, added up."""
    _, metrics = _stream(spark, sf, files=2)
    return stream.read_batch_metrics(spark, metrics).agg(F.sum("rows").alias("rows"), F.max("eurusd").alias("eurusd"))


def report_sql(time: str, where: str = "true") -> str:
    return f"""
WITH n AS (SELECT *, {time} AS stamp FROM good_ticks),
t AS (SELECT stamp AS "EventTS", ticker AS "Ticker", {DOUBLE.format(c='price')} AS "Close", {DOUBLE.format(c='high')} AS "High",
  {DOUBLE.format(c='low')} AS "Low", {DOUBLE.format(c='volume')} AS "Volume" FROM n WHERE price <> 'null' AND {where})
SELECT "EventTS", "Ticker", "Close", "Low", "High", coalesce("Volume", 0) AS "Volume",
  round(avg("Close") OVER (PARTITION BY "Ticker" ORDER BY "EventTS" ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS "SMA" FROM t"""


@query("tick_report", with_sql(report_sql("tick_ts")))
def tick_report(spark, sf):
    sink, _ = _stream(spark, sf)
    return report(spark, sink).withColumn("SMA", F.round("SMA", 6))


#: Rows of a slice, so short that every ticker is cut into many.
TICK_SLICE = 100


@query("tick_report_untimed", with_sql(report_sql("make_timestamp((row_number() OVER (ORDER BY event_id) - 1) * 1000000)")))
def tick_report_untimed(spark, sf):
    """Ticks stored without any time: one second per row in the order of their columns."""
    path = scratch_path(spark, "untimed-ticks")
    tick_fields(spark, sf).filter("event_id % 103 <> 0").withColumn("Datetime", F.lit(None).cast("timestamp_ntz")).drop("ts").write.parquet(path)
    return report_on(spark.read.parquet(path), rows_per_slice=TICK_SLICE).withColumn("SMA", F.round("SMA", 6))


@query("tick_report_days", with_sql(report_sql("tick_ts", "CAST(tick_ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")))
def tick_report_days(spark, sf):
    """The days of a range, from a store that was compacted up to a day within it."""
    sink, _ = _stream(spark, sf)
    stream.compact_ticks(spark, sink, "2024-01-12")
    found = report(spark, sink, start="2024-01-05", end="2024-01-20", rows_per_slice=TICK_SLICE)
    return found.withColumn("SMA", F.round("SMA", 6))


@query("compact_ticks", with_sql(bars_sql("good_ticks", "(SELECT eurusd FROM last_fx)")))
def compact_ticks(spark, sf):
    """A store that was compacted to the end, and got the first batch once more."""
    sink, _ = _stream(spark, sf)
    again = stream.read_tick_bars(spark, sink)
    first = spark.read.parquet(f"{sink}/live").filter("batch_id = 0")
    path = scratch_path(spark, "first-batch")
    first.write.parquet(path)
    stream.compact_ticks(spark, sink)
    spark.read.parquet(path).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(
        f"{sink}/live"
    )
    return stream.read_tick_bars(spark, sink).select(*again.columns)
