"""Queries over closes: the wide table as it comes from CSV, and its long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import aggregates as agg
from marketlens.operators import filters, projections
from marketlens.schemas import wide_close_schema
from marketlens.session import scratch_path
from marketlens.sources import readers
from workloads.adapters import PRIORITIES, bars_supplier, closes_long, closes_wide, table, with_sql
from workloads.registry import query

COLUMNS = ", ".join(f'"{t}"' for t in PRIORITIES)
SHORT = {t: t.removesuffix(".MC") for t in PRIORITIES}


def _csv(spark, sf) -> str:
    path = scratch_path(spark, "closes-csv")
    closes_wide(spark, sf).write.option("sep", ";").option("header", True).csv(path)
    return path


# --- scans ----------------------------------------------------------------------

@query("csv_scan", with_sql("SELECT * FROM closes_wide"))
def csv_scan(spark, sf):
    return readers.read_wide_csv(spark, _csv(spark, sf))


@query("csv_declared", with_sql(f"""SELECT strptime("Fecha", '%d/%m/%Y')::DATE AS "Fecha", {COLUMNS} FROM closes_wide"""))
def csv_declared(spark, sf):
    return readers.read_declared_csv(spark, _csv(spark, sf), wide_close_schema(PRIORITIES))


# --- projections ----------------------------------------------------------------

@query("parse_date", with_sql(f"""SELECT strptime("Fecha", '%d/%m/%Y')::DATE AS "Fecha", {COLUMNS} FROM closes_wide"""))
def parse_date(spark, sf):
    return projections.parse_date(projections.parse_date(closes_wide(spark, sf)))


@query("strip_suffix", with_sql('SELECT "Fecha", ' + ", ".join(f'"{t}" AS "{s}"' for t, s in SHORT.items()) + " FROM closes_wide"))
def strip_suffix(spark, sf):
    return projections.remove_suffix(closes_wide(spark, sf))


@query("strip_suffix_long", with_sql("""SELECT replace("Ticker", '.MC', '') AS "Ticker", "Date", "Close" FROM closes_long"""))
def strip_suffix_long(spark, sf):
    return projections.remove_ticker_suffix(closes_long(spark, sf))


WIDE_NAMES = {"P1.MC": "Alpha", "P2.MC": "Beta", "P3.MC": "Gamma", "P4.MC": "Delta"}


@query("name_tickers_wide", with_sql(
    'SELECT "Fecha", ' + ", ".join(f'"{t}" AS "{WIDE_NAMES.get(t, t)}"' for t in PRIORITIES) + " FROM closes_wide"))
def name_tickers_wide(spark, sf):
    return projections.rename_tickers(closes_wide(spark, sf), WIDE_NAMES)


@query("rename_column", with_sql(f'SELECT "Fecha" AS "Dia", {COLUMNS} FROM closes_wide'))
def rename_column(spark, sf):
    return projections.rename_column(closes_wide(spark, sf), "Fecha", "Dia")


@query("cast_measures", with_sql(
    'SELECT "Fecha", ' + ", ".join(f'CAST("{t}" AS DOUBLE) AS "{t}"' for t in PRIORITIES) + " FROM closes_wide"))
def cast_measures(spark, sf):
    return projections.cast_measures(closes_wide(spark, sf))


@query("drop_empty_columns", with_sql(f'SELECT "Fecha", {COLUMNS} FROM closes_wide'))
def drop_empty_columns(spark, sf):
    wide = closes_wide(spark, sf).withColumn("EMPTY.MC", F.lit(None).cast("string"))
    return projections.drop_empty_columns(wide)


@query("wide_to_long", with_sql("""
SELECT d AS "Date", t AS "Ticker", (SELECT max(c."Close") FROM closes_long c WHERE c."Date" = d AND c."Ticker" = t) AS "Close"
FROM (SELECT DISTINCT "Date" AS d FROM closes_long) CROSS JOIN (SELECT unnest(['P1.MC', 'P2.MC', 'P3.MC', 'P4.MC', 'P5.MC']) AS t)"""))
def wide_to_long(spark, sf):
    return projections.wide_to_long(projections.parse_date(closes_wide(spark, sf)))


@query("long_to_wide", with_sql('SELECT strptime("Fecha", \'%d/%m/%Y\')::DATE AS "Fecha", ' + ", ".join(
    f'CAST("{t}" AS DOUBLE) AS "{t}"' for t in PRIORITIES) + " FROM closes_wide"))
def long_to_wide(spark, sf):
    return projections.long_to_wide(closes_long(spark, sf), PRIORITIES)


# --- coverage and profile ---------------------------------------------------------

@query("dated_rows", with_sql(f"""SELECT "Fecha", {COLUMNS} FROM closes_wide WHERE "Fecha" IS NOT NULL"""))
def dated_rows(spark, sf):
    return filters.not_null(closes_wide(spark, sf), "Fecha")


@query("date_span", with_sql('SELECT min("Date") AS first_date, max("Date") AS last_date FROM closes_long'))
def date_span(spark, sf):
    return agg.date_span(projections.parse_date(closes_wide(spark, sf)))


@query("days_with_data", with_sql("""
SELECT count("Date") AS rows_with_date, count(DISTINCT "Date") AS distinct_dates FROM closes_long"""))
def days_with_data(spark, sf):
    return agg.days_with_data(closes_long(spark, sf), "Date")


@query("company_count", with_sql('SELECT count(DISTINCT "Ticker") AS companies FROM closes_long'))
def company_count(spark, sf):
    return agg.company_count(closes_long(spark, sf))


@query("null_profile", with_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls, count(*) AS rows FROM closes_wide""" for c in ["Fecha", *PRIORITIES])))
def null_profile(spark, sf):
    return agg.null_profile(closes_wide(spark, sf))


def _twice(spark, sf):
    """The rows of two shorter columns of the lines, where many repeat."""
    return table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")


@query("dedup_rows", "SELECT DISTINCT l_suppkey, l_quantity, l_returnflag FROM lineitem")
def dedup_rows(spark, sf):
    return agg.dedup_rows(_twice(spark, sf))


@query("rows_removed", """
SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed
FROM (SELECT count(*) AS b FROM lineitem), (SELECT count(*) AS a FROM (SELECT DISTINCT l_suppkey, l_quantity, l_returnflag FROM lineitem))""")
def rows_removed(spark, sf):
    return agg.rows_removed(_twice(spark, sf))


@query("wide_quality", with_sql(f"""
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM closes_wide)) AS rows_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM closes_wide)) AS rows_removed, CAST({len(PRIORITIES)} AS INTEGER) AS companies
FROM closes_wide"""))
def wide_quality(spark, sf):
    wide = closes_wide(spark, sf).withColumn("EMPTY.MC", F.lit(None).cast("string"))
    kept = projections.drop_empty_columns(wide)
    return agg.rows_removed(wide).withColumn("companies", F.lit(len(kept.columns) - 1))


# --- statistics -------------------------------------------------------------------

@query("annual_stats", with_sql("""
SELECT "Ticker", CAST(year("Date") AS INTEGER) AS "Year",
       (2 * sum(CAST(round("Close" * 100) AS BIGINT)) + count(*)) // (2 * count(*)) / 100.0 AS mean_close,
       max("Close") AS max_close, min("Close") AS min_close
FROM closes_long GROUP BY 1, 2"""))
def annual_stats(spark, sf):
    return agg.annual_stats(closes_long(spark, sf))


@query("annual_stats_wide", with_sql('SELECT CAST(year("Date") AS INTEGER) AS "Year", ' + ", ".join(
    f"""(2 * sum(CAST(round("Close" * 100) AS BIGINT)) FILTER ("Ticker" = '{t}') + count(*) FILTER ("Ticker" = '{t}'))
        // (2 * count(*) FILTER ("Ticker" = '{t}')) / 100.0 AS "Anual mean {s}",
        max("Close") FILTER ("Ticker" = '{t}') AS "Max anual {s}", min("Close") FILTER ("Ticker" = '{t}') AS "Min anual {s}\""""
    for t, s in SHORT.items()) + " FROM closes_long GROUP BY 1"))
def annual_stats_wide(spark, sf):
    wide = projections.remove_suffix(projections.parse_date(closes_wide(spark, sf)))
    return agg.annual_stats_wide(projections.rename_column(wide, "Fecha", "Dia"))


@query("year_of", with_sql('SELECT "Ticker", "Date", CAST(year("Date") AS INTEGER) AS "Year" FROM closes_long'))
def year_of(spark, sf):
    return closes_long(spark, sf).select("Ticker", "Date", F.year("Date").alias("Year"))


@query("variation_class", with_sql("""
WITH ends AS (SELECT "Ticker", first("Close" ORDER BY "Date") AS a, last("Close" ORDER BY "Date") AS b FROM bars_supplier GROUP BY 1),
v AS (SELECT "Ticker", (b - a) / a * 100.0 AS pct FROM ends WHERE a IS NOT NULL AND b IS NOT NULL AND a <> 0)
SELECT "Ticker", round(pct, 2) AS variation,
       CASE WHEN pct <= -15 THEN 'Bajada Fuerte' WHEN pct < -1 THEN 'Bajada' WHEN pct <= 1 THEN 'Neutra'
            WHEN pct < 15 THEN 'Subida' ELSE 'Subida Fuerte' END AS category
FROM v"""))
def variation_class(spark, sf):
    return agg.variation(bars_supplier(spark, sf))


@query("quartile_cuts", with_sql("""
SELECT "Ticker", quantile_disc("Close", 0.25) AS q1, quantile_disc("Close", 0.5) AS q2, quantile_disc("Close", 0.75) AS q3
FROM closes_long GROUP BY 1"""))
def quartile_cuts(spark, sf):
    return agg.quartile_cuts(closes_long(spark, sf))


QUARTILE_SQL = """CASE WHEN {x} <= {q}[1] THEN 'q1' WHEN {x} <= {q}[2] THEN 'q2' WHEN {x} <= {q}[3] THEN 'q3' ELSE 'q4' END"""


#: Coarse enough that every series below is far longer, as a heavy ticker is at the default.
COARSE = 200


@query("quartile_rank_error", """
SELECT l_returnflag AS "Ticker", count(*) AS n, TRUE AS e1, TRUE AS e2, TRUE AS e3 FROM lineitem GROUP BY 1""")
def quartile_rank_error(spark, sf):
    """Cuts of series longer than the sketch is exact for: each lies within rows / accuracy of its rank."""
    lines = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("Ticker"), F.col("l_extendedprice").alias("Close"))
    errors = agg.quartile_rank_error(lines, COARSE)
    return errors.select("Ticker", "n", *[(F.col(e) <= 1 / COARSE).alias(e) for e in ("e1", "e2", "e3")])


@query("quartile_labels", with_sql("""
WITH q AS (SELECT "Ticker", quantile_disc("Close", [0.25, 0.5, 0.75]) AS c FROM closes_long GROUP BY 1)
SELECT "Ticker", "Date", "Close", """ + QUARTILE_SQL.format(x='"Close"', q="c") + """ AS "Quartile" FROM closes_long JOIN q USING ("Ticker")"""))
def quartile_labels(spark, sf):
    return agg.assign_quartiles(closes_long(spark, sf))


@query("quartile_labels_wide", with_sql(
    'WITH w AS (SELECT strptime("Fecha", \'%d/%m/%Y\')::DATE AS "Dia", '
    + ", ".join(f'CAST("{t}" AS DOUBLE) AS "{s}"' for t, s in SHORT.items()) + " FROM closes_wide), q AS (SELECT "
    + ", ".join(f'quantile_disc("{s}", [0.25, 0.5, 0.75]) AS c_{s}' for s in SHORT.values()) + " FROM w) SELECT w.*, "
    + ", ".join(QUARTILE_SQL.format(x=f'"{s}"', q=f"c_{s}") + f' AS "{s}_cuartil"' for s in SHORT.values()) + " FROM w, q"))
def quartile_labels_wide(spark, sf):
    wide = projections.remove_suffix(projections.parse_date(closes_wide(spark, sf)))
    return agg.assign_quartiles_wide(projections.rename_column(wide, "Fecha", "Dia"))
