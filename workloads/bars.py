"""Queries over long OHLCV bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens import functions as fn
from marketlens.operators import aggregates as agg
from marketlens.operators import filters, joins, ordering, projections, sets, windows
from workloads.adapters import (
    NAMES, THRESHOLD, bars_supplier, bars_type, bars_user, closes_long, closes_wide, raw_bars, raw_lines, stored_bars, table, with_sql,
)
from workloads.registry import ORACLES, query

#: Rows of a slice, so short that every key of some size is cut into many.
SLICE = 100

# --- flagship -------------------------------------------------------------------

FRIDAY_SQL = with_sql("""
WITH kept AS (
  SELECT "Ticker", "Date", "Close" FROM valid_lines
  QUALIFY row_number() OVER (PARTITION BY "Ticker", "Date" ORDER BY "Line" DESC) = 1),
r AS (SELECT *, lag("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date") AS prev FROM kept)
SELECT "Date", "Ticker", "Close", ("Close" - prev) / nullif(prev, 0) * 100.0 AS "Return", dayname("Date") AS "DayOfWeek",
       CASE WHEN dayname("Date") = 'Friday' THEN 'Friday' ELSE 'Weekday' END AS "IsFriday"
FROM r WHERE prev IS NOT NULL AND prev <> 0""")


@query("friday_effect", FRIDAY_SQL)
def friday_effect(spark, sf):
    """Raw bars, validated and made unique per day, to returns with the day of the week."""
    clean = sets.dedup_bars(filters.clean_and_validate(raw_lines(spark, sf)), rank=F.col("Line"))
    return windows.friday_effect(clean, daily=True)


# --- windows --------------------------------------------------------------------

@query("daily_return_pct", with_sql("""
SELECT * FROM (SELECT *, ("Close" - lag("Close") OVER w) / nullif(lag("Close") OVER w, 0) * 100.0 AS "Return"
  FROM bars_supplier WINDOW w AS (PARTITION BY "Ticker" ORDER BY "Date")) WHERE "Return" IS NOT NULL"""))
def daily_return_pct(spark, sf):
    return windows.add_daily_returns(bars_supplier(spark, sf), daily=True)


@query("simple_return", with_sql("""
SELECT *, "Close" / nullif(lag("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date"), 0) - 1 AS "Return" FROM bars_supplier"""))
def simple_return(spark, sf):
    return windows.add_simple_return(bars_supplier(spark, sf), daily=True)


@query("non_null_returns", with_sql('SELECT "Date", "Ticker", "Return" FROM user_returns'))
def non_null_returns(spark, sf):
    returns = windows.add_simple_return(bars_user(spark, sf), daily=True)
    return filters.not_null(returns, "Return").select("Date", "Ticker", "Return")


@query("deficiency_notice", with_sql(f"""
SELECT *, sum(CASE WHEN "Close" < {THRESHOLD} THEN 1 ELSE 0 END)
  OVER (PARTITION BY "Ticker" ORDER BY "Date" ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) >= 30 AS "DeficiencyNotice"
FROM closes_long"""))
def deficiency_notice(spark, sf):
    return windows.deficiency_notice(closes_long(spark, sf), THRESHOLD, daily=True)


@query("sma", with_sql("""
SELECT ts AS "EventTS", event_type AS "Ticker", value AS "Close",
       round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS "SMA"
FROM events"""))
def sma(spark, sf):
    """Five tickers share all events, so the heavy ones are cut into slices."""
    ticks = table(spark, sf, "events").select(
        F.col("ts").alias("EventTS"), "event_id", F.col("event_type").alias("Ticker"), F.col("value").alias("Close")
    )
    out = windows.add_sma(ticks, ["EventTS", "event_id"], rows_per_slice=200_000)
    return out.select("EventTS", "Ticker", "Close", F.round("SMA", 6).alias("SMA"))


@query("sma_sliced", ORACLES["sma"])
def sma_sliced(spark, sf):
    """The same in short slices, at least eight a ticker."""
    ticks = table(spark, sf, "events").select(
        F.col("ts").alias("EventTS"), "event_id", F.col("event_type").alias("Ticker"), F.col("value").alias("Close")
    )
    out = windows.add_sma(ticks, ["EventTS", "event_id"], rows_per_slice=SLICE)
    return out.select("EventTS", "Ticker", "Close", F.round("SMA", 6).alias("SMA"))


@query("deficiency_notice_wide", with_sql(f"""
SELECT *, sum(CASE WHEN "P1" < {THRESHOLD} THEN 1 ELSE 0 END) OVER (ORDER BY "Dia" ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) >= 30
  AS "Deficiency Notice P1"
FROM (SELECT strptime("Fecha", '%d/%m/%Y')::DATE AS "Dia", TRY_CAST("P1.MC" AS DOUBLE) AS "P1" FROM closes_wide)"""))
def deficiency_notice_wide(spark, sf):
    """One column of a wide table without any key: the table itself is cut into slices."""
    wide = closes_wide(spark, sf).select(
        F.to_date("Fecha", "dd/MM/yyyy").alias("Dia"), F.col("`P1.MC`").try_cast("double").alias("P1")
    )
    return windows.deficiency_notice_wide(wide, "P1", threshold=THRESHOLD, rows_per_slice=SLICE)


@query("chart_series", with_sql("""
SELECT "Date", "Ticker", "Close", "Low", "High", coalesce("Volume", 0) AS "Volume",
       round(avg("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date" ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS "SMA"
FROM bars_supplier"""))
def chart_series(spark, sf):
    series = windows.chart_series(bars_supplier(spark, sf), ["Date"], daily=True)
    return series.withColumn("SMA", F.round("SMA", 6))


# --- filters --------------------------------------------------------------------

@query("clean_validate", with_sql("SELECT * FROM valid_bars"))
def clean_validate(spark, sf):
    return filters.clean_and_validate(raw_bars(spark, sf))


@query("reject_reasons", with_sql("""
SELECT * FROM (SELECT *,
  concat_ws(',', CASE WHEN "Close" IS NULL THEN 'missing' END,
    CASE WHEN "Open" < 0 OR "High" < 0 OR "Low" < 0 OR "Close" < 0 OR "Volume" < 0 THEN 'negative' END,
    CASE WHEN NOT ("High" >= "Low" AND "Close" BETWEEN "Low" AND "High") THEN 'incoherent' END) AS reasons
  FROM raw_bars) WHERE reasons <> ''"""))
def reject_reasons(spark, sf):
    rejected = filters.reject_reasons(raw_bars(spark, sf))
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


@query("non_negative", with_sql("""
SELECT * FROM raw_bars WHERE "Open" >= 0 AND "High" >= 0 AND "Low" >= 0 AND "Close" >= 0 AND ("Volume" >= 0 OR "Volume" IS NULL)"""))
def non_negative(spark, sf):
    return filters.non_negative(raw_bars(spark, sf))


@query("coherent_bars", with_sql("""
SELECT * FROM raw_bars WHERE "High" >= "Low" AND "Close" BETWEEN "Low" AND "High\""""))
def coherent_bars(spark, sf):
    return filters.coherent(raw_bars(spark, sf))


@query("history_slice", with_sql("""
SELECT * FROM bars_supplier WHERE "Date" BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND "Ticker" IN ('S1', 'S2', 'S3', 'S5', 'S8')"""))
def history_slice(spark, sf):
    return filters.history_slice(bars_supplier(spark, sf), "1996-01-01", "1998-12-31", ["S1", "S2", "S3", "S5", "S8"])


@query("ticker_slice", with_sql("""SELECT * FROM bars_supplier WHERE "Ticker" = 'S7'"""))
def ticker_slice(spark, sf):
    return filters.ticker_slice(bars_supplier(spark, sf), "S7")


# --- joins ----------------------------------------------------------------------

@query("new_tickers", with_sql("""
SELECT * FROM bars_supplier WHERE "Ticker" IS NOT NULL AND "Ticker" NOT IN (SELECT "Ticker" FROM stored_bars)"""))
def new_tickers(spark, sf):
    return joins.new_tickers(bars_supplier(spark, sf), stored_bars(spark, sf))


@query("name_tickers", with_sql("""
SELECT "Ticker", "Date", "Close", CASE "Ticker" """ + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in NAMES.items())
    + """ END AS "Company" FROM closes_long"""))
def name_tickers(spark, sf):
    return joins.name_tickers(closes_long(spark, sf), NAMES)


# --- projections ----------------------------------------------------------------

@query("day_of_week", with_sql("""SELECT *, dayname("Date") AS "DayOfWeek" FROM bars_supplier"""))
def day_of_week(spark, sf):
    return windows.add_day_of_week(bars_supplier(spark, sf))


@query("is_friday", with_sql("""
SELECT *, CASE WHEN dayname("Date") = 'Friday' THEN 'Friday' ELSE 'Weekday' END AS "IsFriday" FROM bars_supplier"""))
def is_friday(spark, sf):
    return windows.add_is_friday(bars_supplier(spark, sf))


@query("range_features", with_sql("""
SELECT *, ("High" - "Low") / nullif("Open", 0) AS "RangeOpen", ("High" - "Low") / nullif("Low", 0) AS "RangeLow" FROM bars_type"""))
def range_features(spark, sf):
    return projections.range_features(bars_type(spark, sf))


@query("open_close", with_sql("""SELECT "Date", "Open", "Close" FROM raw_bars WHERE "Open" IS NOT NULL AND "Close" IS NOT NULL"""))
def open_close(spark, sf):
    return projections.open_close(raw_bars(spark, sf))


@query("date_parts", """
SELECT event_id, CAST(ts AS DATE) AS d, CAST(year(ts) AS INTEGER) AS y, CAST(hour(ts) AS INTEGER) AS h,
       CAST(minute(ts) AS INTEGER) AS m, dayname(ts) AS day, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow,
       strftime(ts, '%d/%m/%Y') AS text, CAST(ts AS DATE) AS back FROM events""")
def date_parts(spark, sf):
    text = F.date_format("ts", "dd/MM/yyyy")
    return table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("d"), F.year("ts").alias("y"), F.hour("ts").alias("h"),
        F.minute("ts").alias("m"), fn.day_name(F.col("ts")).alias("day"), F.dayofweek("ts").alias("dow"),
        text.alias("text"), F.try_to_date(text, fn.DATE_FORMAT).alias("back"),
    )


@query("pct_change", with_sql("""
SELECT "Ticker", "Date", ("Close" - "Open") / nullif("Open", 0) * 100.0 AS pct, "Close" / nullif("Open", 0) - 1 AS ratio,
       (2 * CAST(round("Close" * 100) AS BIGINT) + 8) // 16 / 100.0 AS rounded FROM bars_supplier"""))
def pct_change(spark, sf):
    return bars_supplier(spark, sf).select(
        "Ticker", "Date",
        fn.percent_change(F.col("Close"), F.col("Open")).alias("pct"),
        fn.ratio_return(F.col("Close"), F.col("Open")).alias("ratio"),
        fn.round_half_up(F.col("Close") / 8, 2).alias("rounded"),
    )


@query("predicates", with_sql("""
SELECT "Ticker", "Date", "Close" IS NULL AS no_close, "Volume" IS NOT NULL AS has_volume, "Ticker" IN ('S1', 'S2') AS chosen,
       CASE WHEN "Open" < 0 THEN 'neg' WHEN "Open" < 10000 THEN 'low' ELSE 'high' END AS band, 'EUR' AS currency FROM raw_bars"""))
def predicates(spark, sf):
    return raw_bars(spark, sf).select(
        "Ticker", "Date", F.col("Close").isNull().alias("no_close"), F.col("Volume").isNotNull().alias("has_volume"),
        F.col("Ticker").isin("S1", "S2").alias("chosen"),
        F.when(F.col("Open") < 0, "neg").when(F.col("Open") < 10000, "low").otherwise("high").alias("band"),
        F.lit("EUR").alias("currency"),
    )


# --- aggregates -----------------------------------------------------------------

@query("price_volume_corr", with_sql("""
SELECT "Ticker", round(coalesce(CASE WHEN isnan(c) THEN NULL ELSE c END, CAST('NaN' AS DOUBLE)), 6) AS corr
FROM (SELECT "Ticker", corr("Close", "Volume") AS c FROM bars_supplier GROUP BY "Ticker")"""))
def price_volume_corr(spark, sf):
    return agg.price_volume_corr(bars_supplier(spark, sf)).withColumn("corr", F.round("corr", 6))


@query("corr_bar", with_sql("""
SELECT "Ticker", round(coalesce(CASE WHEN isnan(c) THEN NULL ELSE c END, CAST('NaN' AS DOUBLE)), 6) AS corr
FROM (SELECT "Ticker", corr("Close", "Volume") AS c FROM bars_type GROUP BY "Ticker") ORDER BY "Ticker\""""))
def corr_bar(spark, sf):
    return agg.corr_bar(bars_type(spark, sf)).withColumn("corr", F.round("corr", 6))


@query("tickers", with_sql('SELECT DISTINCT "Ticker" FROM raw_bars'))
def tickers(spark, sf):
    return agg.tickers(raw_bars(spark, sf))


@query("row_count", with_sql("SELECT count(*) AS row_count FROM valid_bars"))
def row_count(spark, sf):
    return agg.row_count(filters.clean_and_validate(raw_bars(spark, sf)))


def _user_returns(spark, sf):
    returns = windows.add_simple_return(bars_user(spark, sf).select("Date", "Ticker", "Close"), daily=True)
    return filters.not_null(windows.add_is_friday(returns), "Return")


@query("return_histogram", with_sql("""
WITH span AS (
  SELECT "Ticker", "IsFriday", CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi
  FROM (SELECT "Ticker", "IsFriday", min("Return") AS a, max("Return") AS b FROM user_returns GROUP BY 1, 2)),
counts AS (
  SELECT "Ticker", "IsFriday", least(CAST(floor(("Return" - lo) * 40 / (hi - lo)) AS INTEGER), 39) AS bin, count(*) AS n
  FROM user_returns JOIN span USING ("Ticker", "IsFriday") GROUP BY 1, 2, 3)
SELECT s."Ticker", s."IsFriday", CAST(b.bin AS INTEGER) AS bin, lo + (hi - lo) / 40 * b.bin AS bin_start,
       lo + (hi - lo) / 40 * (b.bin + 1) AS bin_end, coalesce(n, 0) AS n
FROM span s CROSS JOIN range(40) b(bin) LEFT JOIN counts c ON s."Ticker" = c."Ticker" AND s."IsFriday" = c."IsFriday" AND b.bin = c.bin"""))
def return_histogram(spark, sf):
    return agg.return_histogram(_user_returns(spark, sf))


BOX_BODY = """
WITH q AS (
  SELECT "Ticker", "IsFriday", quantile_cont("Return", 0.25) AS q1, quantile_cont("Return", 0.5) AS median,
         quantile_cont("Return", 0.75) AS q3
  FROM user_returns GROUP BY 1, 2),
f AS (SELECT *, q1 - (q3 - q1) * 1.5 AS low_fence, q3 + (q3 - q1) * 1.5 AS high_fence FROM q)
SELECT "Ticker", "IsFriday", count(*) AS n, round(avg("Return"), 6) AS mean, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(least(min("Return") FILTER ("Return" >= low_fence), q1), 6) AS whisker_low,
       round(greatest(max("Return") FILTER ("Return" <= high_fence), q3), 6) AS whisker_high,
       count(*) FILTER ("Return" < low_fence OR "Return" > high_fence) AS outliers
FROM user_returns JOIN f USING ("Ticker", "IsFriday") GROUP BY "Ticker", "IsFriday", q1, median, q3"""
BOX_SQL = with_sql(BOX_BODY)

BOX_ROUNDED = ("mean", "q1", "median", "q3", "whisker_low", "whisker_high")


@query("return_box", BOX_SQL)
def return_box(spark, sf):
    out = agg.return_box(_user_returns(spark, sf), daily=True)
    return out.withColumns({c: F.round(c, 6) for c in BOX_ROUNDED})


SQL_TYPE_RETURNS = """type_returns AS (
  SELECT * FROM (SELECT "Date", "Ticker", "Close" / nullif(lag("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date"), 0) - 1 AS "Return",
    CASE WHEN dayname("Date") = 'Friday' THEN 'Friday' ELSE 'Weekday' END AS "IsFriday" FROM bars_type) WHERE "Return" IS NOT NULL)"""


def _type_returns(spark, sf):
    """Few tickers with long series."""
    returns = windows.add_simple_return(bars_type(spark, sf).select("Date", "Ticker", "Close"), daily=True)
    return filters.not_null(windows.add_is_friday(returns), "Return")


@query("return_box_sliced", BOX_SQL)
def return_box_sliced(spark, sf):
    """The same without relying on one return per day."""
    out = agg.return_box(_user_returns(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in BOX_ROUNDED})


@query("return_box_overall", with_sql(BOX_BODY.replace('"Ticker", ', "").replace("GROUP BY 1, 2", "GROUP BY 1")))
def return_box_overall(spark, sf):
    """Two groups that hold all returns, each ranked in many slices."""
    out = agg.return_box(_user_returns(spark, sf), ["IsFriday"], rows_per_slice=SLICE)
    return out.withColumns({c: F.round(c, 6) for c in BOX_ROUNDED})


@query("box_outliers", BOX_SQL.replace(BOX_SQL[BOX_SQL.index('SELECT "Ticker", "IsFriday", count(*) AS n'):], """
SELECT "Ticker", "Date", "IsFriday", "Return" FROM user_returns JOIN f USING ("Ticker", "IsFriday")
WHERE "Return" < low_fence OR "Return" > high_fence"""))
def box_outliers(spark, sf):
    returns = _user_returns(spark, sf).select("Ticker", "Date", "IsFriday", "Return")
    return agg.box_outliers(returns, daily=True)


VIOLIN_ROUNDED = ("mean", "median", "lo", "hi", "value", "density")


def _violin_sql(returns: str, first: str = "") -> str:
    return with_sql(f"""
WITH {first} s AS (SELECT "Ticker", "IsFriday", count(*) AS n, avg("Return") AS mean, median("Return") AS median, min("Return") AS lo, max("Return") AS hi,
        stddev_samp("Return") * pow(count(*), -0.2) AS h FROM {returns} GROUP BY 1, 2),
g AS (SELECT s.*, CAST(p AS INTEGER) AS point, lo + (hi - lo) / 99 * p AS value FROM s CROSS JOIN range(100) t(p)),
k AS (SELECT g."Ticker", g."IsFriday", point, sum(exp(-0.5 * ((value - "Return") / h) ** 2)) AS total
      FROM g JOIN {returns} r ON g."Ticker" = r."Ticker" AND g."IsFriday" = r."IsFriday" AND hi > lo GROUP BY 1, 2, 3)
SELECT g."Ticker", g."IsFriday", n, round(mean, 6) AS mean, round(median, 6) AS median, round(lo, 6) AS lo, round(hi, 6) AS hi, point,
       round(value, 6) AS value, round(CASE WHEN hi > lo THEN total / (n * h * sqrt(2 * pi())) ELSE 1 END, 6) AS density
FROM g LEFT JOIN k USING ("Ticker", "IsFriday", point)""")


@query("return_violin", _violin_sql("type_returns", SQL_TYPE_RETURNS + ","))
def return_violin(spark, sf):
    out = agg.return_violin(_type_returns(spark, sf), daily=True)
    return out.withColumns({c: F.round(c, 6) for c in VIOLIN_ROUNDED})


@query("return_violin_user", _violin_sql("user_returns"))
def return_violin_user(spark, sf):
    """Many tickers, whose medians do not rely on one return per day."""
    out = agg.return_violin(_user_returns(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in VIOLIN_ROUNDED})


# --- order, heads, samples --------------------------------------------------------

@query("ordered_history", with_sql('SELECT * FROM bars_supplier ORDER BY "Ticker", "Date"'))
def ordered_history(spark, sf):
    return ordering.ordered_history(bars_supplier(spark, sf))


@query("head_history", with_sql('SELECT * FROM bars_supplier ORDER BY "Ticker", "Date" LIMIT 10'))
def head_history(spark, sf):
    return ordering.head(bars_supplier(spark, sf), 10)


@query("head_per_ticker", with_sql("""
SELECT * FROM bars_supplier QUALIFY row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date") <= 5"""))
def head_per_ticker(spark, sf):
    return ordering.head_per_ticker(bars_supplier(spark, sf), 5)


@query("last_row", with_sql("""
SELECT "Ticker", first("Close" ORDER BY "Date") AS first_close, last("Close" ORDER BY "Date") AS last_close, max("Date") AS last_date
FROM bars_supplier GROUP BY "Ticker\""""))
def last_row(spark, sf):
    return agg.first_and_last(bars_supplier(spark, sf))


@query("scatter_sample", with_sql("""
SELECT "Date", "Ticker", "Close", "Volume" FROM raw_bars WHERE "Close" IS NOT NULL AND "Volume" IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "Ticker"
  ORDER BY md5('42|' || strftime("Date", '%Y-%m-%d') || '|' || "Ticker" || '|' || CAST("Close" AS DECIMAL(38,6))
    || '|' || CAST("Volume" AS DECIMAL(38,6))), "Date", "Close", "Volume") <= 20"""))
def scatter_sample(spark, sf):
    return ordering.scatter_sample(raw_bars(spark, sf), 20)


@query("scatter_sample_large", ORACLES["scatter_sample"].replace("<= 20", "<= 5000"))
def scatter_sample_large(spark, sf):
    return ordering.scatter_sample(raw_bars(spark, sf), 5000)


# --- set operations ---------------------------------------------------------------

@query("union_bars", with_sql("SELECT * FROM bars_user UNION ALL SELECT * FROM bars_type"))
def union_bars(spark, sf):
    return sets.union_bars([bars_user(spark, sf), bars_type(spark, sf)])


@query("concat_bars", with_sql("""
SELECT * FROM bars_type UNION ALL SELECT * FROM bars_user UNION ALL SELECT * FROM bars_supplier"""))
def concat_bars(spark, sf):
    return sets.union_bars([bars_type(spark, sf), bars_user(spark, sf), bars_supplier(spark, sf)])


@query("dedup_bars", with_sql("""
SELECT * FROM raw_lines QUALIFY row_number() OVER (PARTITION BY "Ticker", "Date" ORDER BY "Line" DESC) = 1"""))
def dedup_bars(spark, sf):
    return sets.dedup_bars(raw_lines(spark, sf), rank=F.col("Line"))
