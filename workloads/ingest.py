"""Queries over raw feeds: lines, records and tables of unknown layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens import functions as fn
from marketlens.operators import projections
from marketlens.session import scratch_path
from marketlens.sources import readers, writers
from workloads.adapters import (
    bars_supplier, raw_bars, table, tick_fields, tick_lines, with_sql,
)
from workloads.registry import query

DOUBLE = """CASE WHEN {c} <> 'null' THEN CAST(CASE WHEN {c} <> 'null' THEN {c} END AS DOUBLE) END"""


def _tick_folder(spark, sf) -> str:
    path = scratch_path(spark, "tick-lines")
    tick_lines(spark, sf).write.text(path)
    return path


# --- scans ----------------------------------------------------------------------

@query("json_ingest", with_sql("SELECT ticker, price, high, low, volume FROM good_ticks"))
def json_ingest(spark, sf):
    return readers.read_json_lines(spark, _tick_folder(spark, sf))


@query("json_quarantine", with_sql("""
SELECT '{"ticker":"' || ticker || '","price":"' || price || '","high":"' || high || '","low":"' || low || '","volume":"' || volume
  || '","ts":"' || strftime(tick_ts, '%Y-%m-%d %H:%M:%S.%f') || '"' AS line FROM tick_fields WHERE event_id % 103 = 0"""))
def json_quarantine(spark, sf):
    return readers.read_malformed_lines(spark, _tick_folder(spark, sf))


@query("source_dispatch", with_sql(f"""
SELECT DATE '2024-02-01' AS "Date", {DOUBLE.format(c='price')} AS "Open", {DOUBLE.format(c='high')} AS "High",
       {DOUBLE.format(c='low')} AS "Low", {DOUBLE.format(c='price')} AS "Close", {DOUBLE.format(c='volume')} AS "Volume", ticker AS "Ticker"
FROM good_ticks WHERE price <> 'null'"""))
def source_dispatch(spark, sf):
    """Ticks by source name, together with an unknown source, which adds nothing."""
    ticks = readers.read_source(spark, "ticks", path=_tick_folder(spark, sf), as_of="2024-02-01")
    return ticks.unionByName(readers.read_source(spark, "elsewhere"))


def _bar_table(spark, sf) -> str:
    path = scratch_path(spark, "bars")
    writers.write_bars(bars_supplier(spark, sf), path)
    return path


@query("parquet_scan", with_sql('SELECT "Ticker", "Date", "Close" FROM bars_supplier'))
def parquet_scan(spark, sf):
    return readers.read_bars(spark, _bar_table(spark, sf), ["Ticker", "Date", "Close", "NoSuchColumn"])


@query("parquet_scan_drift", with_sql("SELECT * FROM bars_supplier"))
def parquet_scan_drift(spark, sf):
    """Years written with volumes as whole numbers, as text and as doubles, among them a year of several kinds."""
    path = scratch_path(spark, "drifting-bars")
    bars, year = bars_supplier(spark, sf).withColumn("year", F.year("Date")), F.col("year")
    rest = [F.col(c) for c in ("Date", "Open", "High", "Low", "Close", "Ticker", "year")]
    even = F.crc32("Ticker") % 2 == 0

    def add(rows, *volume):
        rows.select(*rest, *volume).write.mode("append").partitionBy("year").parquet(path)

    add(bars.filter(year < 1997), F.col("Volume").cast("bigint").alias("Volume"))
    add(bars.filter((year == 1997) & even), F.col("Volume").cast("string").alias("Volume"))
    add(bars.filter((year == 1997) & ~even), F.col("Volume").cast("bigint").alias("Volume"))
    add(bars.filter(year > 1997), F.col("Volume"))
    return readers.read_bars(spark, path)


@query("parquet_raw", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def parquet_raw(spark, sf):
    return readers.read_parquet_or_none(spark, f"{sf}/events.parquet")


@query("parquet_sink", with_sql('SELECT *, year("Date")::INTEGER AS year FROM bars_supplier'))
def parquet_sink(spark, sf):
    return spark.read.parquet(_bar_table(spark, sf))


@query("stringify_temporal", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events""")
def stringify_temporal(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"))
    path = scratch_path(spark, "text-times")
    writers.save_parquet(events, path, temporal_as_text=True)
    return spark.read.parquet(path)


@query("multi_ticker_load", with_sql("""
SELECT * FROM bars_supplier WHERE "Ticker" IN ('S1', 'S4', 'S9') AND "Date" >= DATE '1996-01-01' AND "Date" < DATE '1997-01-01'"""))
def multi_ticker_load(spark, sf):
    stored = readers.read_bars(spark, _bar_table(spark, sf))
    return readers.load_tickers(stored, ["S1", "S4", "S9", "NONE"], "1996-01-01", "1997-01-01")


@query("missing_tickers", with_sql("""
SELECT t AS "Ticker" FROM (VALUES ('S1'), ('S2'), ('NONE')) v(t) WHERE t NOT IN (SELECT "Ticker" FROM bars_supplier)"""))
def missing_tickers(spark, sf):
    return readers.missing_tickers(bars_supplier(spark, sf), ["S1", "S2", "NONE"])


@query("range_slice", with_sql("""
SELECT * FROM bars_supplier WHERE "Date" >= DATE '1997-01-01' AND "Date" < DATE '1998-01-01'"""))
def range_slice(spark, sf):
    stored = readers.read_bars(spark, _bar_table(spark, sf), start="1997-01-01", end="1998-01-01")
    return readers.range_slice(stored, "1997-01-01", "1998-01-01")


@query("interval_lookback", """
SELECT event_id, ts, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def interval_lookback(spark, sf):
    return readers.interval_lookback(table(spark, sf, "events").select("event_id", "ts", "value"), "1m")


# --- records to bars --------------------------------------------------------------

@query("standardize_records", with_sql(f"""
SELECT DATE '2024-02-01' AS "Date", {DOUBLE.format(c='price')} AS "Open", {DOUBLE.format(c='high')} AS "High",
       {DOUBLE.format(c='low')} AS "Low", {DOUBLE.format(c='price')} AS "Close", {DOUBLE.format(c='volume')} AS "Volume",
       'DESCONOCIDO' AS "Ticker"
FROM tick_fields"""))
def standardize_records(spark, sf):
    return projections.standardize_records(tick_fields(spark, sf).drop("ticker", "event_id", "ts"), as_of="2024-02-01")


def _foreign_bars(spark, sf):
    """Bars as another feed names and types them, with gaps."""
    return raw_bars(spark, sf).select(
        F.col("Date").cast("string").alias("Datetime"),
        "Open", "High", "Low", F.col("Close").alias("Adj Close"),
        F.when(F.col("Volume").isNull(), " NULL ").otherwise(F.col("Volume").cast("string")).alias("Volume"), "Ticker",
    )


@query("conform_bars", with_sql('SELECT * FROM raw_bars WHERE "Close" IS NOT NULL'))
def conform_bars(spark, sf):
    return projections.conform_bars(_foreign_bars(spark, sf))


@query("conform_bars_lenient", with_sql("SELECT * FROM raw_bars"))
def conform_bars_lenient(spark, sf):
    return projections.conform_bars(_foreign_bars(spark, sf), drop_incomplete=False)


def _messy(spark, sf):
    """Numbers as text, some of them blank, padded or no numbers."""
    n = F.col("event_id") % 10
    x = F.col("value").cast("decimal(12,2)").cast("string")
    half = F.concat((F.col("event_id") % 50).cast("string"), F.lit(".5"))
    text = (
        F.when(n == 0, " NULL ").when(n == 1, "").when(n == 2, "12,3").when(n == 3, F.concat(F.lit("-"), half))
        .when(n == 4, F.concat(F.lit("  "), half, F.lit(" "))).when(n == 5, "1e3").when(n == 6, "NaN").when(n == 7, "1.5d").otherwise(x)
    )
    return table(spark, sf, "events").select("event_id", text.alias("text"))


MESSY_SQL = """messy AS (SELECT event_id, CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
  WHEN 3 THEN -(event_id % 50 + 0.5) WHEN 4 THEN event_id % 50 + 0.5 WHEN 5 THEN 1000 WHEN 6 THEN NULL WHEN 7 THEN NULL
  ELSE value END AS x FROM events)"""


@query("lenient_double", f"WITH {MESSY_SQL} SELECT event_id, CAST(x AS DOUBLE) AS x FROM messy")
def lenient_double(spark, sf):
    return _messy(spark, sf).select("event_id", fn.lenient_double(F.col("text")).alias("x"))


@query("lenient_int", f"WITH {MESSY_SQL} SELECT event_id, CAST(round_even(CAST(x AS DOUBLE), 0) AS BIGINT) AS x FROM messy")
def lenient_int(spark, sf):
    return _messy(spark, sf).select("event_id", fn.lenient_int(F.col("text")).alias("x"))


@query("casts", """
SELECT event_id, CAST(value AS DOUBLE) AS d, CAST(trunc(value) AS BIGINT) AS whole, CAST(event_type AS VARCHAR) AS s,
       TRY_CAST(event_type AS DOUBLE) AS bad FROM events""")
def casts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("value").try_cast("double").alias("d"), F.col("value").try_cast("bigint").alias("whole"),
        F.col("event_type").try_cast("string").alias("s"), F.col("event_type").try_cast("double").alias("bad"),
    )


@query("text_ops", with_sql("""
SELECT event_id, upper(event_type) = upper(trim('  ' || event_type || ' ')) AS same, trim('_' FROM '_' || event_type || '_Close_') AS joined,
       replace(event_type || '.MC', '.MC', '') AS bare, lower(upper(event_type)) AS low FROM events"""))
def text_ops(spark, sf):
    t = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        (F.upper(t) == F.upper(F.trim(F.concat(F.lit("  "), t, F.lit(" "))))).alias("same"),
        fn.join_name(F.lit(""), t, F.lit("Close"), F.lit("")).alias("joined"),
        fn.strip_suffix(F.concat(t, F.lit(".MC")), ".MC").alias("bare"),
        F.lower(F.upper(t)).alias("low"),
    )


# --- event time -------------------------------------------------------------------

#: Rows of a slice, so short that the table is cut into many.
EVENT_SLICE = 500


@query("derive_event_ts", """
SELECT event_id, make_timestamp((row_number() OVER (ORDER BY event_id) - 1) * 1000000) AS "EventTS" FROM events""")
def derive_event_ts(spark, sf):
    """No time anywhere: one second per row, numbered across slices of the table."""
    rows = table(spark, sf, "events").select("event_id", F.lit(None).cast("string").alias("Datetime"))
    return projections.derive_event_ts(rows, ["event_id"], rows_per_slice=EVENT_SLICE).select("event_id", "EventTS")


@query("normalize_any", with_sql(f"""
SELECT ts AS "EventTS", event_type AS "Ticker", value AS "Close", CAST(NULL AS DOUBLE) AS "High",
       CAST(NULL AS DOUBLE) AS "Low", CAST(NULL AS DOUBLE) AS "Volume" FROM events
UNION ALL
SELECT CAST("Date" AS TIMESTAMP), "Ticker", "Close", "High", "Low", "Volume" FROM raw_bars WHERE "Close" IS NOT NULL
UNION ALL
SELECT tick_ts, ticker, {DOUBLE.format(c='price')}, {DOUBLE.format(c='high')}, {DOUBLE.format(c='low')}, {DOUBLE.format(c='volume')}
FROM tick_fields WHERE price <> 'null'"""))
def normalize_any(spark, sf):
    """Three layouts in one: priced events, dated bars, text ticks."""
    events = table(spark, sf, "events").select(F.col("ts").alias("EventTS"), F.col("event_type").alias("ticker"), F.col("value").alias("price"))
    ticks = tick_fields(spark, sf).withColumnRenamed("ts", "Datetime")
    parts = [projections.normalize_any(p) for p in (events, raw_bars(spark, sf), ticks)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- JSON ---------------------------------------------------------------------------

@query("row_json", """
SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS json FROM events""")
def row_json(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    return rows.select("event_id", projections.row_json(rows).alias("json"))


@query("json_struct", """
SELECT o_orderkey, '{"status":"' || o_orderstatus || '","who":{"key":' || o_custkey || '}}' AS json FROM orders""")
def json_struct(spark, sf):
    who = F.struct(F.col("o_custkey").alias("key"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), who.alias("who"))).alias("json")
    )
