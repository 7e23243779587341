"""The tick store, tables whose types drift, rows without a time, and staged copies."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlens.operators.aggregates import quartile_rank_error
from marketlens.operators.projections import derive_event_ts
from marketlens.session import scratch_path
from marketlens.sources import readers, writers
from marketlens.streaming import ticks as stream

TICKS = "ticker string, price string, high string, low string, volume string, ts timestamp_ntz"


def put(spark, sink, batch_id, *times):
    rows = [(f"T{i}", str(i + batch_id), "9", "1", "5", t) for i, t in enumerate(times)]
    write = stream.tick_batch_writer(sink, f"{sink}-metrics", clock=F.col("ts"))
    write(spark.createDataFrame(rows, TICKS), batch_id)


def seen(spark, sink, **bounds):
    got = stream.read_tick_bars(spark, sink, **bounds).collect()
    return sorted((r["Ticker"], r["Close"], str(r["EventTS"])) for r in got)


def at(day, hour=0):
    return dt.datetime(2024, 3, day, hour)


@pytest.fixture
def sink(spark):
    path = scratch_path(spark, "store")
    put(spark, path, 0, at(1, 1), at(2, 1), None)
    put(spark, path, 1, at(1, 2), at(3, 1))
    put(spark, path, 2, at(3, 2), at(3, 3))
    return path


def live(sink):
    return sorted(f"{d}/{b}" for d in os.listdir(f"{sink}/live") if d.startswith("day=") for b in os.listdir(f"{sink}/live/{d}") if b.startswith("batch_id="))


def test_bounds_read_only_their_days(spark, sink):
    some = stream.read_tick_bars(spark, sink, "2024-03-02", "2024-03-03")
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()
    assert len(seen(spark, sink)) == 7 and some.count() == 4
    assert len(seen(spark, sink, end="2024-03-01")) == 2


def test_packing_keeps_every_row_once(spark, sink):
    before = seen(spark, sink)
    assert stream.compact_ticks(spark, sink, "2024-03-03") == 2
    assert live(sink) == ["day=2024-03-03/batch_id=1", "day=2024-03-03/batch_id=2", "day=__HIVE_DEFAULT_PARTITION__/batch_id=0"]
    assert seen(spark, sink) == before
    assert stream.compact_ticks(spark, sink, "2024-03-03") == 0 and seen(spark, sink) == before
    assert stream.compact_ticks(spark, sink) == 2 and live(sink) == [] and seen(spark, sink) == before
    # A late tick of a packed day is read beside the pack, then packed with it.
    put(spark, sink, 3, at(1, 9))
    later = seen(spark, sink)
    assert len(later) == len(before) + 1
    assert stream.compact_ticks(spark, sink) == 1 and seen(spark, sink) == later
    assert seen(spark, sink, start="2024-03-01", end="2024-03-01")[0] in later


def test_the_newest_batch_waits(spark, sink):
    stream.compact_ticks(spark, sink, "2024-04-01")
    assert [x for x in live(sink) if "batch_id=2" in x] == ["day=2024-03-03/batch_id=2"]
    assert len(seen(spark, sink)) == 7
    put(spark, sink, 2, at(3, 2), at(3, 3))
    assert len(seen(spark, sink)) == 7


def test_a_replayed_batch_changes_nothing_packed_or_not(spark, sink):
    before = seen(spark, sink)
    put(spark, sink, 1, at(1, 2), at(3, 1))
    assert seen(spark, sink) == before
    stream.compact_ticks(spark, sink)
    put(spark, sink, 1, at(1, 2), at(3, 1))
    assert seen(spark, sink) == before
    stream.compact_ticks(spark, sink, "2024-03-02")
    assert seen(spark, sink) == before and stream.compact_ticks(spark, sink) == 0 and live(sink) == []


@pytest.mark.parametrize("dies_in", ["_list", "_sweep"])
def test_a_crash_while_packing_loses_and_doubles_nothing(spark, sink, monkeypatch, dies_in):
    before = seen(spark, sink)

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(stream, dies_in, crash)
        with pytest.raises(RuntimeError):
            stream.compact_ticks(spark, sink)
    assert os.path.exists(f"{sink}/packed/pack=1") and seen(spark, sink) == before
    stream.compact_ticks(spark, sink)
    assert seen(spark, sink) == before and live(sink) == []


def test_without_a_clock_a_repeated_batch_keeps_its_time(spark):
    path = scratch_path(spark, "clocked")
    rows = spark.createDataFrame([("A", "1", "2", "1", "5", None)], TICKS).drop("ts")
    write = stream.tick_batch_writer(path, f"{path}-metrics")
    write(rows, 7)
    before = seen(spark, path)
    write(rows, 7)
    assert seen(spark, path) == before and len(before) == 1


def test_drifting_types_are_read_and_merged(spark):
    path = scratch_path(spark, "drift")
    day = F.lit("2020-01-02").cast("date")

    def add(ticker, volume, price="double", close=True):
        cols = [day.alias("Date"), *[F.lit("1.5").cast(price).alias(c) for c in ("Open", "High", "Low")]]
        if close:
            cols.append(F.lit("1.5").cast("float").alias("Close"))
        out = spark.range(2).select(*cols, volume.alias("Volume"), F.concat(F.lit(ticker), "id").alias("Ticker"), F.lit(2020).alias("year"))
        out.write.mode("append").partitionBy("year").parquet(path)

    add("I", F.lit(7).cast("bigint"))
    add("D", F.lit(7.25))
    add("S", F.lit("7.5"), price="string")
    add("B", F.lit("no number"), close=False)
    got = {r["Ticker"]: (r["Volume"], r["Close"], r["Open"]) for r in readers.read_bars(spark, path).collect()}
    assert got == {f"{t}{i}": v for i in (0, 1) for t, v in {
        "I": (7.0, 1.5, 1.5), "D": (7.25, 1.5, 1.5), "S": (7.5, 1.5, 1.5), "B": (None, None, 1.5)}.items()}
    assert readers.read_bars(spark, path, ["Ticker"], start="2021-01-01").count() == 0
    new = spark.createDataFrame([(dt.date(2020, 1, 2), 2.0, 2.0, 2.0, 2.0, 1.0, "I0")], readers.BAR_SCHEMA)
    writers.update_history(new, path)
    merged = {r["Ticker"]: r["Volume"] for r in readers.read_bars(spark, path).collect()}
    assert merged == {**{t: v[0] for t, v in got.items()}, "I0": 1.0}


def test_merges_leave_no_staged_copy(spark):
    root = scratch_path(spark, "x").rsplit("/", 1)[0]
    staged = lambda: {d for d in os.listdir(root) if d.startswith("history-")}
    path, before = scratch_path(spark, "table"), staged()
    new = spark.createDataFrame([(dt.date(2020, 1, 2), 2.0, 2.0, 2.0, 2.0, 1.0, "A")], readers.BAR_SCHEMA)
    for _ in range(3):
        assert writers.update_history(new, path) is None
    assert staged() == before and readers.read_bars(spark, path).count() == 1


def test_untimed_rows_are_numbered_without_a_job_or_an_order(spark):
    rows = [(i, None, {"k": "v"}, [i]) for i in range(40)]
    df = spark.createDataFrame(rows, "n int, Datetime string, m map<string,string>, a array<int>").repartition(3)
    got = derive_event_ts(df, rows_per_slice=5).collect()
    assert sorted((r["n"], r["EventTS"].second) for r in got) == [(i, i) for i in range(40)]
    # One known time is enough for the others to stay unknown.
    some = df.withColumn("Datetime", F.when(F.col("n") == 3, "2024-01-01 10:00:00"))
    assert [r["n"] for r in derive_event_ts(some).collect() if r["EventTS"]] == [3] and derive_event_ts(some).count() == 40
    assert derive_event_ts(df.drop("Datetime"), rows_per_slice=5).select("EventTS").distinct().count() == 40
    assert derive_event_ts(df.limit(0)).count() == 0
    only = spark.createDataFrame([(None,), (None,)], "EventTS string")
    assert sorted(r["EventTS"].second for r in derive_event_ts(only).collect()) == [0, 1]


def test_rank_error_is_worked_out_exactly(spark):
    df = spark.createDataFrame([("A", float(x)) for x in range(1, 101)] + [("B", 3.0)] * 9 + [("B", None)], "Ticker string, Close double")
    got = {r["Ticker"]: r for r in quartile_rank_error(df).collect()}
    assert [got["A"][e] for e in ("e1", "e2", "e3")] == [0, 0, 0] and (got["B"]["n"], got["B"]["e2"]) == (9, 0)
    coarse = quartile_rank_error(df.filter("Ticker = 'A'"), 4).first()
    assert all(0 <= coarse[e] <= 0.25 for e in ("e1", "e2", "e3"))
