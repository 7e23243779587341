"""Sliced work equals the plain window, also where one key holds most rows."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import aggregates, ordering, skew, windows
from workloads import bars, ingest


def series(spark, rows=3000, hot=2000):
    """One heavy ticker, many light ones, a few null times and repeated values."""
    return spark.range(rows).select(
        F.when(F.col("id") < hot, "HOT").when(F.col("id") % 37 != 0, F.concat(F.lit("T"), F.col("id") % 37)).alias("Ticker"),
        F.when(F.col("id") % 211 != 0, F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(900))).cast("timestamp_ntz")).alias("EventTS"),
        "id",
        F.when(F.col("id") % 53 != 0, (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(500)) / 4.0)).alias("Close"),
    )


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


@pytest.mark.parametrize("rows_per_slice", [40, 150, 10_000])
def test_window_in_slices(spark, rows_per_slice):
    df = series(spark)
    w = Window.partitionBy("Ticker").orderBy("EventTS", "id")

    def build(win):
        return {
            "prev": F.lag("Close").over(win),
            "mean": F.avg("Close").over(win.rowsBetween(-9, 0)),
            "hits": F.sum(F.when(F.col("Close") < 60, 1).otherwise(0)).over(win.rowsBetween(-9, 0)),
        }

    sliced = skew.ordered_window(df, ["Ticker"], ["EventTS", "id"], 9, build, rows_per_slice)
    same(sliced, df.withColumns(build(w)))


def test_only_heavy_keys_are_cut_and_into_many_slices(spark):
    df = series(spark)
    cuts = skew.cut_points(df, ["Ticker"], ["EventTS", "id"], 200)
    rows = cuts.collect()
    assert {r["Ticker"] for r in rows} == {"HOT"} and len(rows) >= 5
    assert sorted(r["__slice"] for r in rows) == list(range(1, len(rows) + 1))
    largest = skew.with_slices(df, cuts, ["Ticker"], ["EventTS", "id"]).groupBy("Ticker", "__slice").count().agg(F.max("count")).first()[0]
    assert largest < 3 * 200


def test_rows_without_a_key_are_cut_too(spark):
    df = series(spark).withColumn("Ticker", F.when(F.col("Ticker") != "HOT", F.col("Ticker")))
    cuts = skew.cut_points(df, ["Ticker"], ["EventTS", "id"], 200).collect()
    assert {r["Ticker"] for r in cuts} == {None} and len(cuts) >= 5
    w = Window.partitionBy("Ticker").orderBy("EventTS", "id")
    sliced = skew.ordered_window(df, ["Ticker"], ["EventTS", "id"], 3, lambda w: {"prev": F.lag("Close", 3).over(w)}, 200)
    same(sliced, df.withColumn("prev", F.lag("Close", 3).over(w)))
    counted = skew.ranked(df, ["Ticker"], ["EventTS", "id"], 200)
    same(counted.drop("__size"), df.withColumn("__rank", F.row_number().over(w).cast("bigint")))


def test_row_index_is_consecutive(spark):
    df = series(spark).select("id", "Close")
    got = skew.row_index(df, ["id"], "n", 100).orderBy("id").collect()
    assert [r["n"] for r in got] == list(range(3000))


@pytest.mark.parametrize("rows_per_slice", [30, 10_000])
def test_quantiles_equal_percentile(spark, rows_per_slice):
    df = series(spark)
    got = skew.interpolated_quantiles(df, ["Ticker"], "Close", {"a": 0.25, "b": 0.5, "c": 0.9}, rows_per_slice)
    want = df.groupBy("Ticker").agg(F.expr("percentile(Close, array(0.25, 0.5, 0.9))").alias("p"))
    wanted = {r["Ticker"]: r["p"] for r in want.collect()}
    for r in got.collect():
        assert [r["a"], r["b"], r["c"]] == pytest.approx(wanted[r["Ticker"]], abs=1e-9)
    assert got.count() == want.count()


def test_first_per_key_beyond_the_group_limit(spark):
    df = series(spark)
    rank = F.row_number().over(Window.partitionBy("Ticker").orderBy("Close", "id"))
    want = df.withColumn("r", rank).filter("r <= 1500").drop("r")
    same(skew.first_per_key(df, ["Ticker"], [F.col("Close"), F.col("id")], 1500, salts=8), want)


def test_returns_without_the_daily_promise(spark):
    df = series(spark).filter("Close is not null").withColumnRenamed("id", "Date")
    a = windows.add_simple_return(df, ["Date"], rows_per_slice=100)
    same(a, windows.add_simple_return(df, ["Date"], daily=True))


def test_approximate_quartiles_stay_within_their_rank_error(spark):
    df = series(spark, 30_000, 20_000).filter("Close is not null")
    cuts = {r["Ticker"]: r for r in aggregates.quartile_cuts(df, accuracy=200).collect()}
    sizes = {r["Ticker"]: r["count"] for r in df.groupBy("Ticker").count().collect()}
    for q, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
        for t in ("HOT", "T1"):
            rows = df.filter(F.col("Ticker") == t)
            below = rows.filter(F.col("Close") < cuts[t][q]).count() / sizes[t]
            upto = rows.filter(F.col("Close") <= cuts[t][q]).count() / sizes[t]
            assert below - 0.01 <= p <= upto + 0.01


def test_sample_is_complete_below_its_size_and_repeatable(spark):
    bars = series(spark).select(F.date_from_unix_date(F.col("id").cast("int")).alias("Date"), "Ticker", "Close", F.col("Close").alias("Volume"))
    small = ordering.scatter_sample(bars, 1200)
    assert small.filter("Ticker = 'HOT'").count() == 1200
    assert small.filter("Ticker = 'T1'").count() == bars.filter("Ticker = 'T1' and Close is not null").count()
    same(small, ordering.scatter_sample(bars.repartition(5), 1200))


def test_search_among_many_cuts(spark):
    df = series(spark)
    for key in (["Ticker"], []):
        cuts = skew.cut_points(df, key, ["EventTS", "id"], 20)
        points = [(r["Ticker"] if key else None, tuple(r["__point"])) for r in cuts.collect()]
        assert len(points) > 30
        last = dt.datetime(1, 1, 1)
        place = lambda ts, i: (ts is not None, ts or last, i)  # noqa: E731  nulls come first
        for r in skew.with_slices(df, cuts, key, ["EventTS", "id"]).collect():
            here = place(r["EventTS"], r["id"])
            assert r["__slice"] == sum(place(*p) <= here for k, p in points if not key or k == r["Ticker"])
    w = Window.orderBy("EventTS", "id")
    sliced = skew.ordered_window(df, [], ["EventTS", "id"], 9, lambda w: {"n": F.count("id").over(w.rowsBetween(-9, 0)), "p": F.lag("Close", 9).over(w)}, 20)
    same(sliced, df.withColumns({"n": F.count("id").over(w.rowsBetween(-9, 0)), "p": F.lag("Close", 9).over(w)}))


def test_frames_longer_than_slices(spark):
    df = series(spark)
    w = Window.partitionBy("Ticker").orderBy("EventTS", "id")
    build = lambda w: {"sum": F.sum("Close").over(w.rowsBetween(-90, 0)), "far": F.lag("id", 90).over(w)}
    same(skew.ordered_window(df, ["Ticker"], ["EventTS", "id"], 90, build, 16), df.withColumns(build(w)))
    alone = lambda w: {"own": F.sum("Close").over(w.rowsBetween(0, 0))}
    same(skew.ordered_window(df, ["Ticker"], ["EventTS", "id"], 0, alone, 40), df.withColumns(alone(w)))


def test_copies_are_sampled_as_one_row_with_a_count(spark):
    copies = spark.range(1_000_000).select(
        F.lit(dt.date(2024, 1, 1)).alias("Date"), F.lit("HOT").alias("Ticker"), F.lit(1.0).alias("Close"), F.lit(2.0).alias("Volume")
    )
    others = series(spark).select(F.date_from_unix_date(F.col("id").cast("int")).alias("Date"), "Ticker", "Close", F.col("Close").alias("Volume"))
    df = others.unionByName(copies)
    digest = F.md5(F.concat_ws("|", F.lit("42"), F.date_format("Date", "yyyy-MM-dd"), F.col("Ticker"),
                               *[F.col(c).try_cast("decimal(38,6)").cast("string") for c in ("Close", "Volume")]))
    rank = F.row_number().over(Window.partitionBy("Ticker").orderBy(digest, "Date", "Close", "Volume"))
    for n in (20, 5000):
        want = df.na.drop(subset=["Close", "Volume"]).withColumn("r", rank).filter(F.col("r") <= n).drop("r")
        got = ordering.scatter_sample(df, n)
        same(got.groupBy(*got.columns).count(), want.groupBy(*got.columns).count())


def test_violin_multiplies_no_row(spark):
    rows = series(spark).select("Ticker", F.lit("Weekday").alias("IsFriday"), F.col("Close").alias("Return"))
    plan = aggregates.return_violin(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # the grid of a finished group


def test_registered_queries_meet_many_slices(spark):
    """At least eight slices of the heaviest key in each query that is there to cross slices."""
    sf = "/root/testdata/sf0.01"
    events = bars.table(spark, sf, "events")
    returns = bars._user_returns(spark, sf).groupBy("IsFriday", "Return").count()
    wide = bars.closes_wide(spark, sf).select(F.to_date("Fecha", "dd/MM/yyyy").alias("Dia"))
    for df, key, order, rows in (
        (events, ["event_type"], ["ts", "event_id"], bars.SLICE),
        (wide, [], ["Dia"], bars.SLICE),
        (events, [], ["event_id"], ingest.EVENT_SLICE),
        (returns, ["IsFriday"], ["Return"], bars.SLICE),
    ):
        assert skew.cut_points(df, key, order, rows).agg(F.max("__slice")).first()[0] >= 7


def test_no_row_carries_a_list_of_cuts(spark):
    df = series(spark)
    for key in (["Ticker"], []):
        cuts = skew.cut_points(df, key, ["EventTS", "id"], 20)
        plan = skew.with_slices(df, cuts, key, ["EventTS", "id"])._jdf.queryExecution().optimizedPlan().toString()
        assert "__cuts" not in plan  # folded into the search, which reads one shared list
