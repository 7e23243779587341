"""Bars, closes, ticks and quotes derived from the given tables, in Spark and in SQL.

Each adapter is a Spark function and an entry of ``SQL`` under the same name.
``with_sql`` puts the entries a query needs in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = [f"P{i}.MC" for i in range(1, 6)]
NAMES = {"P1.MC": "Alpha", "P2.MC": "Beta", "P3.MC": "Beta", "P4.MC": "Gamma"}
THRESHOLD = 450_000.0

SQL: dict[str, str] = {}


def with_sql(body: str) -> str:
    """``body`` with the adapters it names, and those they name, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SQL:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in needed)
    if not ctes:
        return body
    stripped = body.lstrip()
    return f"WITH {ctes}, {stripped[5:]}" if stripped.upper().startswith("WITH ") else f"WITH {ctes} {stripped}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _event_bars(events: DataFrame, ticker: Column) -> DataFrame:
    return events.groupBy(ticker.alias("Ticker"), F.to_date("ts").alias("Date")).agg(
        F.min_by("value", "ts").alias("Open"),
        F.max("value").alias("High"),
        F.min("value").alias("Low"),
        F.max_by("value", "ts").alias("Close"),
        F.count(F.lit(1)).cast("double").alias("Volume"),
    ).select("Date", "Open", "High", "Low", "Close", "Volume", "Ticker")


_EVENT_SQL = """
SELECT CAST(ts AS DATE) AS "Date", first(value ORDER BY ts) AS "Open", max(value) AS "High",
       min(value) AS "Low", last(value ORDER BY ts) AS "Close", CAST(count(*) AS DOUBLE) AS "Volume",
       {ticker} AS "Ticker"
FROM events GROUP BY {ticker}, CAST(ts AS DATE)"""


def bars_type(spark: SparkSession, sf: str) -> DataFrame:
    return _event_bars(table(spark, sf, "events"), F.col("event_type"))


SQL["bars_type"] = _EVENT_SQL.format(ticker="event_type")


def bars_user(spark: SparkSession, sf: str) -> DataFrame:
    return _event_bars(table(spark, sf, "events"), F.concat(F.lit("U"), F.col("user_id")))


SQL["bars_user"] = _EVENT_SQL.format(ticker="('U' || user_id)")


def line_number() -> Column:
    """Order of the lines as one number; order and line number alone repeat."""
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 2**24 + F.col("l_partkey")


def bars_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars per supplier, from the first to the last line of the day."""
    lines = table(spark, sf, "lineitem").withColumn("line", line_number())
    return (
        lines.groupBy(F.concat(F.lit("S"), F.col("l_suppkey")).alias("Ticker"), F.to_date("l_shipdate").alias("Date"))
        .agg(
            F.min_by("l_extendedprice", "line").alias("Open"),
            F.max("l_extendedprice").alias("High"),
            F.min("l_extendedprice").alias("Low"),
            F.max_by("l_extendedprice", "line").alias("Close"),
            F.sum("l_quantity").alias("Volume"),
        )
        .select("Date", "Open", "High", "Low", "Close", "Volume", "Ticker")
    )


SQL["bars_supplier"] = """
SELECT CAST(l_shipdate AS DATE) AS "Date",
       first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey) AS "Open",
       max(l_extendedprice) AS "High", min(l_extendedprice) AS "Low",
       last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey) AS "Close",
       sum(l_quantity) AS "Volume", 'S' || l_suppkey AS "Ticker"
FROM lineitem GROUP BY 'S' || l_suppkey, CAST(l_shipdate AS DATE)"""


def stored_bars(spark: SparkSession, sf: str) -> DataFrame:
    """A stored history: the suppliers with a balance below 5000, at prices one higher."""
    small = table(spark, sf, "supplier").filter(F.col("s_acctbal") < 5000)
    known = small.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("Ticker"))
    bars = bars_supplier(spark, sf).join(known, "Ticker", "left_semi")
    return bars.select(
        "Date", *[(F.col(c) + 1).alias(c) for c in ("Open", "High", "Low", "Close")], "Volume", "Ticker"
    )


SQL["stored_bars"] = """
SELECT "Date", "Open" + 1 AS "Open", "High" + 1 AS "High", "Low" + 1 AS "Low", "Close" + 1 AS "Close",
       "Volume", "Ticker"
FROM bars_supplier WHERE "Ticker" IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal < 5000)"""


def closes_long(spark: SparkSession, sf: str) -> DataFrame:
    """Daily closes of five tickers over several years."""
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1), F.lit(".MC")).alias("Ticker"),
            F.to_date("o_orderdate").alias("Date"),
        )
        .agg(F.max_by("o_totalprice", "o_orderkey").alias("Close"))
    )


SQL["closes_long"] = """
SELECT 'P' || substr(o_orderpriority, 1, 1) || '.MC' AS "Ticker", CAST(o_orderdate AS DATE) AS "Date",
       arg_max(o_totalprice, o_orderkey) AS "Close"
FROM orders GROUP BY 1, 2"""


def closes_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The closes with a column per ticker; dates and prices as text, as in the CSV."""
    wide = closes_long(spark, sf).groupBy(F.date_format("Date", "dd/MM/yyyy").alias("Fecha"))
    return wide.pivot("Ticker", PRIORITIES).agg(F.max(F.col("Close").cast("decimal(18,2)").cast("string")))


SQL["closes_wide"] = """
SELECT strftime("Date", '%d/%m/%Y') AS "Fecha", """ + ", ".join(
    f"""max(CASE WHEN "Ticker" = '{t}' THEN CAST(CAST("Close" AS DECIMAL(18,2)) AS VARCHAR) END) AS "{t}\"""" for t in PRIORITIES
) + """
FROM closes_long GROUP BY 1"""


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One bar per order line, numbered, with negative, missing and incoherent values among them."""
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("Date"),
        F.when(F.col("l_partkey") % 83 == 0, -price).otherwise(price).alias("Open"),
        (price * (1 + F.col("l_tax"))).alias("High"),
        (price * (1 - F.col("l_discount"))).alias("Low"),
        F.when(F.col("l_partkey") % 97 != 0, price * (1 + 2 * F.col("l_tax") - F.col("l_discount"))).alias("Close"),
        F.when(F.col("l_partkey") % 89 != 0, F.col("l_quantity")).alias("Volume"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("Ticker"),
        line_number().alias("Line"),
    )


def raw_bars(spark: SparkSession, sf: str) -> DataFrame:
    return raw_lines(spark, sf).drop("Line")


SQL["raw_lines"] = """
SELECT CAST(l_shipdate AS DATE) AS "Date",
       CASE WHEN l_partkey % 83 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS "Open",
       l_extendedprice * (1 + l_tax) AS "High", l_extendedprice * (1 - l_discount) AS "Low",
       CASE WHEN l_partkey % 97 <> 0 THEN l_extendedprice * (1 + 2 * l_tax - l_discount) END AS "Close",
       CASE WHEN l_partkey % 89 <> 0 THEN l_quantity END AS "Volume", 'S' || l_suppkey AS "Ticker",
       (l_orderkey * 8 + l_linenumber) * 16777216 + l_partkey AS "Line"
FROM lineitem"""

SQL["raw_bars"] = 'SELECT * EXCLUDE "Line" FROM raw_lines'

SQL["valid_bars"] = 'SELECT * EXCLUDE "Line" FROM valid_lines'

SQL["valid_lines"] = """
SELECT * FROM raw_lines
WHERE "Date" IS NOT NULL AND "Ticker" IS NOT NULL AND "Open" >= 0 AND "High" >= 0 AND "Low" >= 0 AND "Close" >= 0
  AND ("Volume" >= 0 OR "Volume" IS NULL) AND "High" >= "Low" AND "Close" BETWEEN "Low" AND "High\""""


def tick_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks as text fields; some carry the word null in every measure, some break off."""
    value = F.col("value").cast("decimal(12,2)")
    gap = F.col("event_id") % 101 == 0

    def text(x: Column) -> Column:
        return F.when(gap, "null").otherwise(x.cast("string"))

    return table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("ticker"),
        text(value).alias("price"),
        text((value * F.lit("1.01").cast("decimal(3,2)")).cast("decimal(16,4)")).alias("high"),
        text((value * F.lit("0.99").cast("decimal(3,2)")).cast("decimal(16,4)")).alias("low"),
        text(F.col("event_id") % 1000).alias("volume"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
    )


SQL["tick_fields"] = """
SELECT event_id, event_type AS ticker, ts AS tick_ts,
       CASE WHEN event_id % 101 = 0 THEN 'null' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS price,
       CASE WHEN event_id % 101 = 0 THEN 'null' ELSE CAST(CAST(CAST(value AS DECIMAL(12,2)) * CAST(1.01 AS DECIMAL(3,2)) AS DECIMAL(16,4)) AS VARCHAR) END AS high,
       CASE WHEN event_id % 101 = 0 THEN 'null' ELSE CAST(CAST(CAST(value AS DECIMAL(12,2)) * CAST(0.99 AS DECIMAL(3,2)) AS DECIMAL(16,4)) AS VARCHAR) END AS low,
       CASE WHEN event_id % 101 = 0 THEN 'null' ELSE CAST(event_id % 1000 AS VARCHAR) END AS volume
FROM events"""


def tick_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON line per tick; the broken ones lack the closing brace."""
    fields = tick_fields(spark, sf)
    line = F.to_json(F.struct("ticker", "price", "high", "low", "volume", "ts"))
    broken = F.col("event_id") % 103 == 0
    return fields.select(F.when(broken, F.rtrim(line, F.lit("}"))).otherwise(line).alias("value"))


SQL["good_ticks"] = "SELECT * FROM tick_fields WHERE event_id % 103 <> 0"


def fx_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(F.col("event_type").isin("view", "error")).select(
        F.lit("EURUSD").alias("pair"),
        "ts",
        F.when(F.col("event_id") % 7 != 0, 1 + F.col("value") / 1000).alias("close"),
        F.when(F.col("event_type") == "view", "1m").otherwise("1d").alias("interval"),
    )


SQL["fx_quotes"] = """
SELECT 'EURUSD' AS pair, ts, CASE WHEN event_id % 7 <> 0 THEN 1 + value / 1000 END AS "close",
       CASE WHEN event_type = 'view' THEN '1m' ELSE '1d' END AS "interval"
FROM events WHERE event_type IN ('view', 'error')"""

SQL["last_fx"] = """
SELECT coalesce((SELECT "close" FROM fx_quotes WHERE "interval" = '1m' AND "close" IS NOT NULL ORDER BY ts DESC, "close" DESC LIMIT 1),
                (SELECT "close" FROM fx_quotes WHERE "interval" = '1d' AND "close" IS NOT NULL ORDER BY ts DESC, "close" DESC LIMIT 1),
                CAST('NaN' AS DOUBLE)) AS eurusd"""


def label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Two labels per document, which stand for the clusters two models assign."""
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return joined.select(
        F.col("lang").alias("Ticker"), "doc_id",
        F.col("quality").alias("kmeans_cluster"), F.col("toxic").alias("gmm_cluster"),
    )


SQL["label_pairs"] = """
SELECT lang AS "Ticker", doc_id, quality AS kmeans_cluster, toxic AS gmm_cluster FROM labels JOIN documents USING (doc_id)"""


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with a parameter and two metrics, many of them tied, from the orders."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        F.create_map(F.lit("k"), (2 + F.col("o_custkey") % 5).cast("string")).alias("params"),
        F.create_map(
            F.lit("silhouette"), F.floor(F.col("o_totalprice") / 50000) / 16.0,
            F.lit("cost"), F.floor(F.col("o_totalprice")).cast("double"),
        ).alias("metrics"),
    )


SQL["run_records"] = """
SELECT 'run-' || o_orderkey AS run_id, CAST(2 + o_custkey % 5 AS INTEGER) AS k,
       floor(o_totalprice / 50000) / 16.0 AS silhouette, floor(o_totalprice) AS cost
FROM orders"""

# Returns over supplier bars, used by several queries.
SQL["user_returns"] = """
SELECT * FROM (
  SELECT "Date", "Ticker", "Close", "Close" / nullif(lag("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date"), 0) - 1 AS "Return",
         CASE WHEN dayname("Date") = 'Friday' THEN 'Friday' ELSE 'Weekday' END AS "IsFriday"
  FROM bars_user) WHERE "Return" IS NOT NULL"""
