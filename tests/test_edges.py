"""Boundary cases on small literal tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketlens import functions as fn
from marketlens.operators import aggregates as agg
from marketlens.operators import filters, joins, ordering, projections, quality, sets, windows
from marketlens.schemas import BAR_SCHEMA, TICKER_NAMES, wide_close_schema

DAY = dt.date(2024, 1, 1)


def days(n):
    return [DAY + dt.timedelta(days=i) for i in range(n)]


def closes(spark, values, ticker="T"):
    rows = [(ticker, d, v) for d, v in zip(days(len(values)), values)]
    return spark.createDataFrame(rows, "Ticker string, Date date, Close double")


def column(df, name, order=None):
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]


@pytest.mark.parametrize("last, change, category", [
    (85.0, -15.0, "Bajada Fuerte"), (85.01, -14.99, "Bajada"), (98.99, -1.01, "Bajada"), (99.0, -1.0, "Neutra"),
    (100.0, 0.0, "Neutra"), (101.0, 1.0, "Neutra"), (101.01, 1.01, "Subida"), (114.99, 14.99, "Subida"), (115.0, 15.0, "Subida Fuerte"),
])
def test_variation_bounds(spark, last, change, category):
    row = agg.variation(closes(spark, [100.0, 50.0, last])).first()
    assert (row["variation"], row["category"]) == (pytest.approx(change), category)


@pytest.mark.parametrize("values", [[None, 5.0], [5.0, None], [0.0, 5.0]])
def test_variation_without_usable_ends_has_no_row(spark, values):
    assert agg.variation(closes(spark, values)).count() == 0


def test_variation_of_a_single_date_is_neutral(spark):
    assert agg.variation(closes(spark, [7.0])).first()["category"] == "Neutra"


def test_deficiency_needs_thirty_hits_in_thirty_one_rows(spark):
    values = [0.5] * 29 + [2.0, 0.5, 0.5, 2.0, 2.0]
    flags = column(windows.deficiency_notice(closes(spark, values), daily=True), "DeficiencyNotice", "Date")
    # Row 31 is the first whose frame holds 30 hits; row 33 still has 29 + 1 of them minus those that left.
    hits = [sum(v < 1 for v in values[max(0, i - 30):i + 1]) for i in range(len(values))]
    assert flags == [h >= 30 for h in hits] and any(flags) and not flags[28]


def test_deficiency_treats_gaps_as_not_below_and_reads_text(spark):
    df = closes(spark, [0.5] * 29 + [None]).select(F.col("Date").alias("Dia"), F.col("Close").cast("string").alias("UNI"))
    assert not any(column(windows.deficiency_notice_wide(df), "Deficiency Notice UNI"))
    full = closes(spark, [0.95] * 30).select(F.col("Date").alias("Dia"), F.col("Close").cast("string").alias("UNI"))
    assert column(windows.deficiency_notice_wide(full), "Deficiency Notice UNI", "Dia") == [False] * 29 + [True]


def test_quartile_labels_for_gaps_and_empty_series(spark):
    df = closes(spark, [1.0, 2.0, 3.0, 4.0, None]).unionByName(closes(spark, [None, None], "E")).unionByName(closes(spark, [9.0], "ONE"))
    out = agg.assign_quartiles(df)
    assert column(out.filter("Ticker = 'T'"), "Quartile", "Date") == ["q1", "q2", "q3", "q4", "q4"]
    assert column(out.filter("Ticker = 'E'"), "Quartile") == [None, None]
    assert column(out.filter("Ticker = 'ONE'"), "Quartile") == ["q1"]


def test_wide_quartiles_skip_columns_without_data(spark):
    df = spark.createDataFrame([(DAY, "1", None), (DAY, "2", None)], "Dia date, `A.B` string, E string")
    row = agg.assign_quartiles_wide(df).orderBy(F.col("`A.B`")).first()
    assert row["A.B_cuartil"] == "q1" and row["E_cuartil"] is None


def test_annual_extremes_are_numeric(spark):
    df = spark.createDataFrame([(DAY, "9.5"), (DAY, "10.2")], "Dia date, X string")
    row = agg.annual_stats_wide(df).first()
    assert (row["Max anual X"], row["Min anual X"], row["Anual mean X"]) == (10.2, 9.5, 9.85)


def test_lenient_scalars(spark):
    texts = ["null", " NULL ", "", "12,3", "1e3", "NaN", "2.5", "3.5", "-0.5", "1d", "0x1p3", None, " 7 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", fn.lenient_double(F.col("t")).alias("d"), fn.lenient_int(F.col("t")).alias("n"))
    assert column(out, "d", "i") == [None, None, None, None, 1000.0, None, 2.5, 3.5, -0.5, None, None, None, 7.0]
    assert column(out, "n", "i") == [None, None, None, None, 1000, None, 2, 4, 0, None, None, None, 7]


def bar(o=10.0, h=12.0, lo=9.0, c=11.0, v=5.0, t="T", d=DAY):
    return (d, o, h, lo, c, v, t)


BARS = "Date date, Open double, High double, Low double, Close double, Volume double, Ticker string"


def test_validation_edges(spark):
    kept = [bar(c=9.0), bar(c=12.0), bar(v=None), bar(v=float("nan")), bar(o=99.0), bar(0.0, 0.0, 0.0, 0.0, 0.0)]
    gone = [bar(h=8.0), bar(c=8.9), bar(c=12.1), bar(o=-1.0), bar(v=-1.0), bar(t=None), bar(d=None), bar(c=None), bar(h=float("nan"))]
    assert filters.clean_and_validate(spark.createDataFrame(kept, BARS)).count() == len(kept)
    rejected = spark.createDataFrame(gone, BARS)
    assert filters.clean_and_validate(rejected).count() == 0
    assert filters.reject_reasons(rejected).count() == len(gone)
    assert filters.reject_reasons(spark.createDataFrame(kept, BARS)).count() == 0


def test_returns_edges(spark):
    one = closes(spark, [5.0])
    assert windows.add_daily_returns(one, daily=True).count() == 0
    assert column(windows.add_simple_return(one, daily=True), "Return") == [None]
    zero = closes(spark, [0.0, 5.0, 10.0]).orderBy(F.desc("Date"))
    assert column(windows.add_simple_return(zero, daily=True), "Return", "Date") == [None, None, 1.0]
    assert column(windows.add_daily_returns(zero, daily=True), "Return") == [100.0]


def test_sma_starts_with_shorter_frames(spark):
    assert column(windows.add_sma(closes(spark, [1.0, 2.0, 6.0]), ["Date"], 2, daily=True), "SMA", "Date") == [1.0, 1.5, 4.0]


def test_dedup_prefers_as_told_and_does_not_depend_on_the_split(spark):
    df = spark.createDataFrame([bar(c=9.5), bar(c=11.5), bar(c=10.0, v=None)], BARS)
    chosen = {sets.dedup_bars(df.repartition(n)).first() for n in (1, 2, 3)}
    assert len(chosen) == 1 and chosen.pop() in df.collect()
    assert sets.dedup_bars(df, rank=F.col("Close")).first()["Close"] == 11.5
    assert sets.dedup_bars(df, rank=-F.col("Close")).first()["Close"] == 9.5
    # Of rows with the same rank one is kept, and never a mixture.
    assert sets.dedup_bars(df, rank=F.lit(1)).first() in df.collect()


def test_merge_is_idempotent(spark):
    stored = spark.createDataFrame([bar(c=9.0), bar(c=9.0, t="OLD")], BARS)
    new = spark.createDataFrame([bar(c=11.0), bar(c=11.0, d=DAY + dt.timedelta(days=1))], BARS)
    once = sets.merge_history(stored, new)
    twice = sets.merge_history(once, new)
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 3
    assert once.filter("Ticker = 'T' and Date = '2024-01-01'").first()["Close"] == 11.0


def test_new_tickers_ignores_null_on_both_sides(spark):
    current = spark.createDataFrame([bar(t="A"), bar(t="B"), bar(t=None)], BARS)
    stored = spark.createDataFrame([bar(t="A"), bar(t=None)], BARS)
    assert column(joins.new_tickers(current, stored), "Ticker") == ["B"]
    empty = spark.createDataFrame([], BAR_SCHEMA)
    assert joins.new_tickers(current, empty).count() == 2


def test_names_collide_only_in_the_wide_form(spark):
    assert len(TICKER_NAMES) == 36 and len(wide_close_schema().fields) == 37
    wide = spark.createDataFrame([(1, 2)], "`ANA.MC` int, `AENA.MC` int")
    with pytest.raises(ValueError, match="Aena"):
        projections.rename_tickers(wide)
    long = spark.createDataFrame([("ANA.MC",), ("AENA.MC",), ("X",)], "Ticker string")
    assert column(joins.name_tickers(long), "Company", "Ticker") == ["Aena", "Aena", None]


def test_empty_columns(spark):
    df = spark.createDataFrame([("a", None, 1)], "`x.y` string, gone string, n int")
    assert projections.drop_empty_columns(df).columns == ["x.y", "n"]
    assert projections.drop_empty_columns(df.limit(0)).columns == ["x.y", "gone", "n"]


def test_standardize_and_conform(spark):
    only_price = spark.createDataFrame([("1.5",), ("null",)], "price string")
    rows = projections.standardize_records(only_price, as_of="2024-05-06").orderBy(F.col("Open").asc_nulls_last()).collect()
    assert rows[0].asDict() == {
        "Date": dt.date(2024, 5, 6), "Open": 1.5, "High": None, "Low": None, "Close": 1.5, "Volume": None, "Ticker": "DESCONOCIDO"
    }
    assert rows[1]["Open"] is None
    foreign = spark.createDataFrame([("2024-01-01", "1", "2", "1", "x", "T")], "Datetime string, Open string, High string, Low string, AdjClose string, Ticker string")
    assert projections.conform_bars(foreign).count() == 0
    assert projections.conform_bars(foreign, drop_incomplete=False).first()["Close"] is None
    no_close = spark.createDataFrame([("2024-01-01", 1.0, 2.0, 1.0, "T")], "Date string, Open double, High double, Low double, Ticker string")
    assert projections.conform_bars(no_close).first()["Close"] == 1.0


def test_normalize_any_layouts(spark):
    assert projections.normalize_any(spark.createDataFrame([(1.0,)], "price double")).first()["Ticker"] == "UNKNOWN"
    dated = spark.createDataFrame([("2024-01-02", 1.0, "T"), ("bad", 2.0, "T")], "Date string, Close double, Ticker string")
    out = projections.normalize_any(dated).orderBy("Close").collect()
    assert out[0]["EventTS"] == dt.datetime(2024, 1, 2) and out[1]["EventTS"] is None
    lost = spark.createDataFrame([(i, "bad", float(i), "T") for i in range(5)], "i int, Datetime string, Close double, Ticker string")
    stamps = column(projections.normalize_any(lost, order=["i"], rows_per_slice=2), "EventTS", "Close")
    assert stamps == [dt.datetime(1970, 1, 1, 0, 0, i) for i in range(5)]


def test_latest_quote_falls_back(spark):
    def rate(rows):
        df = spark.createDataFrame(rows, "ts timestamp_ntz, close double, interval string")
        return joins.latest_quote(df).first()["EURUSD"]

    t = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    assert rate([(t[0], 1.1, "1m"), (t[1], 1.2, "1m"), (t[2], None, "1m"), (t[3], 9.0, "1d")]) == 1.2
    assert rate([(t[2], None, "1m"), (t[3], 9.0, "1d")]) == 9.0
    assert math.isnan(rate([]))


def test_correlation_without_variance_is_nan(spark):
    df = closes(spark, [1.0, 2.0]).withColumn("Volume", F.lit(3.0))
    assert math.isnan(agg.price_volume_corr(df).first()["corr"])
    assert agg.price_volume_corr(df.limit(0)).count() == 0


def returns(spark, values):
    return spark.createDataFrame([("T", "Friday", v) for v in values], "Ticker string, IsFriday string, Return double")


def test_histogram_edges(spark):
    out = agg.return_histogram(returns(spark, [0.0, 1.0, 1.0, 0.5])).orderBy("bin").collect()
    assert len(out) == 40 and out[39]["n"] == 2 and out[0]["n"] == 1 and out[20]["n"] == 1
    flat = agg.return_histogram(returns(spark, [2.0, 2.0])).filter("n > 0").collect()
    assert [(r["bin"], r["n"], r["bin_start"]) for r in flat] == [(20, 2, 2.0)]


def test_box_whiskers_and_outliers(spark):
    df = returns(spark, [1.0, 2.0, 3.0, 4.0, 100.0])
    row = agg.return_box(df).first()
    assert row == agg.return_box(df, daily=True).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.0, 3.0, 4.0)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["n"]) == (1.0, 4.0, 1, 5)
    assert column(agg.box_outliers(df), "Return") == [100.0]


def test_violin_integrates_to_less_than_one_and_handles_one_value(spark):
    rows = agg.return_violin(returns(spark, [0.0, 1.0, 2.0, 4.0])).orderBy("point").collect()
    width = rows[1]["value"] - rows[0]["value"]
    assert len(rows) == 100 and 0.5 < sum(r["density"] for r in rows) * width < 1.0
    single = agg.return_violin(returns(spark, [3.0])).collect()
    assert {(r["value"], r["density"]) for r in single} == {(3.0, 1.0)}


def test_best_run_takes_the_smaller_k_on_a_tie(spark):
    runs = spark.createDataFrame(
        [("a", {"k": "4"}, {"s": 0.9}), ("b", {"k": "3"}, {"s": 0.9}), ("c", {"k": "2"}, {"s": 0.1}), ("d", {"k": "1"}, {})],
        "run_id string, params map<string,string>, metrics map<string,double>")
    assert ordering.best_run(runs, "s").first()["run_id"] == "b"


def test_label_alignment_and_counted_pairs(spark):
    df = spark.createDataFrame([("A", 0, 1), ("A", 0, 1), ("A", 1, 0), ("B", 1, 1)], "Ticker string, kmeans_cluster int, gmm_cluster int")
    aligned = joins.align_labels(df, "gmm_cluster", "kmeans_cluster")
    assert column(aligned.filter("kmeans_cluster = gmm_cluster"), "Ticker").count("A") == 3
    listed = df.select("Ticker", "kmeans_cluster").join(df.select("Ticker", "gmm_cluster"), "Ticker").filter("kmeans_cluster != gmm_cluster")
    assert joins.label_difference_counts(df, df).agg(F.sum("pairs")).first()[0] == listed.count()


RULES = quality.business_rules()


@pytest.mark.parametrize("broken, bad_rows", [
    (dict(o=-1.0, lo=-2.0), {0, 2}), (dict(h=8.0, lo=7.0, c=8.0, o=8.5), {6}), (dict(c=8.0), {7}), (dict(c=13.0), {8}),
    (dict(o=8.0), {5}), (dict(v=-1.0), {9}),
])
def test_each_business_rule_fails_alone(spark, broken, bad_rows):
    df = spark.createDataFrame([bar(), bar(**broken)], BARS)
    results = quality.validate(df, {"b": RULES})
    assert {r["rule_no"] for r in quality.failures(results).collect()} == bad_rows


def test_format_rules_on_repeats_gaps_and_nothing(spark):
    rules = {"f": quality.format_rules()}
    repeated = spark.createDataFrame([bar(), bar(c=None), bar(d=DAY + dt.timedelta(days=1))], BARS)
    found = {r["rule_no"]: r["unexpected"] for r in quality.validate(repeated, rules).collect()}
    assert found == {0: 0, 1: 0, 2: 1, 3: 0, 4: 2}
    empty = quality.summary(quality.validate(repeated.limit(0), rules)).first()
    assert not empty["success"] and empty["failed"] == 1 and quality.ROW_COUNT in empty["details"]
    report = quality.failure_report(quality.validate(repeated, rules)).first()
    assert [f["rule_no"] for f in report["failed_expectations"]] == [2, 4]


def test_pair_rule_without_equality(spark):
    strict = quality.Rule(quality.PAIR, column_A="Open", column_B="Close", or_equal=False)
    same = spark.createDataFrame([bar(o=11.0), bar(o=None)], BARS)
    row = quality.validate(same, {"s": [strict]}).first()
    assert (row["evaluated"], row["unexpected"]) == (1, 1)


def test_temporal_text_covers_all_kinds(spark):
    df = spark.sql("select date'2024-01-02' d, timestamp_ntz'2024-01-02 03:04:05' n, timestamp'2024-01-02 03:04:05' t, 1 x")
    assert list(projections.stringify_temporal(df).first()) == ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02 03:04:05", 1]


def test_wide_table_with_nothing_in_it(spark):
    empty = spark.createDataFrame([], wide_close_schema(["A.MC"]))
    assert projections.wide_to_long(empty).count() == 0
    assert agg.rows_removed(empty).first()["rows_removed"] == 0
    assert agg.null_profile(empty).count() == 2
