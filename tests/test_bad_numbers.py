"""Values that are no numbers, or beyond a decimal's range."""

from pyspark.sql import functions as F

from marketlens.functions.scalars import round_half_up
from marketlens.operators.aggregates import assign_quartiles_wide, null_profile, quartile_cuts
from marketlens.operators.filters import clean_and_validate, reject_reasons
from marketlens.operators.joins import label_difference_counts, latest_quote
from marketlens.operators.ordering import scatter_sample
from marketlens.operators.projections import derive_event_ts, drop_empty_columns
from marketlens.operators.quality import BETWEEN, NOT_NULL, PAIR, UNIQUE, Rule, validate
from marketlens.plans.ticks import tick_report
from marketlens.session import scratch_path
from marketlens.sources.readers import read_bars
from marketlens.sources.writers import update_history

NAN = float("nan")


def test_rounding_beyond_decimals(spark):
    rows = spark.createDataFrame([(1e27,), (1.005,), (None,)], "x double").select(round_half_up(F.col("x"), 2).alias("x")).collect()
    assert [r.x for r in rows] == [1e27, 1.01, None]


def test_nan_quote_is_no_quote(spark):
    quotes = spark.createDataFrame([(1, "1m", 1.5), (2, "1m", float("nan"))], "ts long, interval string, close double")
    assert latest_quote(quotes).first()[0] == 1.5


def test_kept_and_rejected_rows_add_up(spark):
    columns = "Date string, Ticker string, Open string, High string, Low string, Close string, Volume string"
    bars = spark.createDataFrame([
        ("2024-01-01", "A", "1", "2", "1", "2", "5"), ("2024-01-02", "A", "1", "2", "1", "2", "-0.5"),
        ("2024-01-03", "A", "1", "2", "1", "null", "5"), ("2024-01-04", "A", "-1", "2", "1", "2", "5"),
    ], columns)
    assert clean_and_validate(bars).count() + reject_reasons(bars).count() == 4


def test_nan_is_missing_in_rules_and_profiles(spark):
    df = spark.createDataFrame([(1.0, 2.0, NAN), (NAN, 1.0, NAN), (NAN, 3.0, NAN), (-1.0, NAN, NAN)], "a double, b double, c double")
    rules = [
        Rule(NOT_NULL, column="a"), Rule(BETWEEN, column="a", min_value=0.0), Rule(PAIR, column_A="b", column_B="a"), Rule(UNIQUE, column="a"),
    ]
    found = validate(df, {"s": rules}).orderBy("rule_no").collect()
    assert [(r.evaluated, r.unexpected) for r in found] == [(4, 2), (2, 1), (1, 0), (2, 0)]
    assert [r.nulls for r in null_profile(df).collect()] == [2, 1, 4]
    assert drop_empty_columns(df).columns == ["a", "b"]


def test_nan_moves_no_quartile(spark):
    values = [1.0, 2.0, 3.0, 4.0, NAN, NAN, NAN, NAN]
    long = spark.createDataFrame([("T", v) for v in values], "Ticker string, Close double")
    assert quartile_cuts(long).first()[1:] == (1.0, 2.0, 3.0)
    wide = spark.createDataFrame([("d", str(v)) for v in values], "Dia string, X string")
    assert [r.X_cuartil for r in assign_quartiles_wide(wide).collect()] == ["q1", "q2", "q3", *["q4"] * 5]


def test_pair_counts_beyond_a_long(spark):
    """4e9 rows a label: counted as decimals, so the product is one too."""
    df = spark.createDataFrame([("T", 0, 1)], "Ticker string, kmeans_cluster int, gmm_cluster int")
    assert dict(label_difference_counts(df, df).dtypes)["pairs"] == "decimal(38,0)"


def test_sample_takes_points_not_days(spark):
    df = spark.range(1000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("Date"), F.lit("T").alias("Ticker"),
        F.col("id").cast("double").alias("Close"), F.lit(1.0).alias("Volume"),
    )
    got = scatter_sample(df, 100)
    assert got.count() == 100 and got.select("Date").distinct().count() == 10


def test_rows_without_time_are_numbered_by_seconds(spark):
    df = spark.range(3).select(F.col("id").alias("n"))
    got = derive_event_ts(df, ["n"]).orderBy("n").collect()
    assert [str(r.EventTS) for r in got] == ["1970-01-01 00:00:00", "1970-01-01 00:00:01", "1970-01-01 00:00:02"]


def test_report_on_an_empty_store(spark):
    got = tick_report(spark, scratch_path(spark, "no-ticks"))
    assert got.count() == 0 and got.columns == ["EventTS", "Ticker", "Close", "Low", "High", "SMA", "Volume"]


def test_stored_bars_without_a_date_stay(spark):
    path = scratch_path(spark, "undated")
    layout = "Date date, Open double, High double, Low double, Close double, Volume double, Ticker string"
    for ticker in "AB":
        update_history(spark.createDataFrame([(None, 1.0, 2.0, 1.0, 2.0, 5.0, ticker)], layout), path)
    assert sorted(r.Ticker for r in read_bars(spark, path).collect()) == ["A", "B"]
