"""Whole programs: CSV, stored history, stream, clusters, quality run."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from marketlens.operators import clustering, projections
from marketlens.plans import bars as bar_plan
from marketlens.plans import clusters as cluster_plan
from marketlens.plans import quality as quality_plan
from marketlens.plans import ticks as tick_plan
from marketlens.plans import wide as wide_plan
from marketlens.session import scratch_path
from marketlens.sources import readers, writers
from marketlens.streaming import ticks as stream
from workloads import adapters
from workloads.ticks import TIMED_SCHEMA, _clock


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


# --- wide -----------------------------------------------------------------------

def test_wide_program(spark, sf):
    path = scratch_path(spark, "wide")
    csv = adapters.closes_wide(spark, sf).withColumn("UNI.MC", F.lit("0.5"))
    csv.write.option("sep", ";").option("header", True).csv(path)
    tables = wide_plan.load(spark, path)
    assert tables["short"].columns[-1] == "UNI" and dict(tables["dated"].dtypes)["Fecha"] == "date"
    found = wide_plan.quality(tables["short"])
    assert found["companies"] == 6 and found["removed"].first()["rows_removed"] == 0
    assert wide_plan.coverage(tables["dated"])["days"].first()["rows_with_date"] == csv.count()
    stats = wide_plan.statistics(tables["short"])
    # A ticker whose first or last cell is empty has no variation.
    ends = tables["short"].orderBy("Fecha").collect()
    whole = [c for c in tables["short"].columns[1:] if ends[0][c] is not None and ends[-1][c] is not None]
    assert sorted(r["Ticker"] for r in stats["variation"].collect()) == sorted(whole) and "UNI" in whole
    assert stats["deficiency"].filter("`Deficiency Notice UNI`").count() == csv.count() - 29
    assert {"P1_cuartil", "UNI_cuartil"} <= set(stats["quartiles_wide"].columns)


def test_declared_scan_reads_all_36_tickers(spark):
    path = scratch_path(spark, "declared")
    header = ";".join(["Fecha", *readers.wide_close_schema().names[1:]])
    line = ";".join(["02/01/2024", *(str(i) for i in range(36))])
    spark.createDataFrame([(header + "\n" + line,)], "value string").coalesce(1).write.text(path)
    got = wide_plan.load_named(spark, path)
    assert got.count() == 36 and got.filter("Company = 'Aena'").count() == 3
    assert got.first()["Date"].isoformat() == "2024-01-02"


def test_jdbc_sink_passes_the_connection_on(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: calls.append((url, table, mode, properties)))
    df = spark.range(3)
    wide_plan.store(df, df, "jdbc:x:y", {"user": "u"})
    assert [c[1:3] for c in calls] == [("Datos2024", "overwrite"), ("Datos2024_Tratados", "overwrite")]
    assert calls[0][0] == "jdbc:x:y" and calls[0][3]["user"] == "u" and "batchsize" in calls[0][3]
    with pytest.raises(ValueError):
        writers.write_jdbc(df, "jdbc:x:y", "t", "replace")


# --- bars -----------------------------------------------------------------------

def test_missing_table_is_an_empty_one(spark):
    got = readers.read_bars(spark, scratch_path(spark, "nothing"))
    assert got.count() == 0 and got.columns == readers.BAR_SCHEMA.names
    assert readers.read_source(spark, "unknown").columns == readers.BAR_SCHEMA.names


def test_history_program(spark, sf):
    feed, table = scratch_path(spark, "feed"), scratch_path(spark, "table")
    writers.write_bars(adapters.bars_supplier(spark, sf), feed)
    wanted = ["S1", "S2", "S3", "GONE"]
    out = bar_plan.update(spark, feed, table, wanted, "1995-01-01", "1999-01-01")
    assert [r["Ticker"] for r in out["missing"].collect()] == ["GONE"]
    assert out["head"].count() == 5 and out["head_per_ticker"].count() == 15
    before = rows(out["history"])
    staged = writers.update_history(out["history"], table, scratch_path(spark, "staged"))
    writers.publish_staged(spark, staged, table)
    assert rows(readers.read_bars(spark, table)) == before
    again = bar_plan.update(spark, feed, table, wanted, "1995-01-01", "1999-01-01")
    assert rows(again["history"]) == before
    later = bar_plan.update(spark, feed, table, wanted, "1999-01-01", "2003-01-01")
    assert readers.read_bars(spark, table).count() == len(before) + later["history"].count()
    studies = bar_plan.friday_returns(spark, table)
    assert studies["histogram"].agg(F.sum("n")).first()[0] == studies["returns"].count()
    assert studies["box"].count() == 6 and studies["violin"].count() == 600
    found = bar_plan.price_volume(spark, table, points=7)
    assert found["corr"].count() == 3 and found["points"].count() == 21


def test_storing_only_new_tickers_keeps_the_old_ones(spark, sf):
    feed, table = scratch_path(spark, "feed"), scratch_path(spark, "table")
    bars = adapters.bars_supplier(spark, sf)
    writers.write_bars(bars, feed)
    writers.write_bars(bars.filter("Ticker = 'S1'"), table)
    enriched = bar_plan.enrich_stored(spark, "table", table, path=feed)
    assert rows(enriched.drop("DayOfWeek")) == rows(bars.select(*enriched.drop("DayOfWeek").columns))
    bar_plan.store_new(spark, "table", table, path=feed)
    assert readers.read_bars(spark, table).count() == bars.count()


def test_bar_scan_prunes_columns_and_years(spark, sf):
    path = scratch_path(spark, "pruned")
    writers.write_bars(adapters.bars_supplier(spark, sf), path)
    stored = readers.read_bars(spark, path, ["Ticker", "Close"])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Close:double,Ticker:string>" in plan
    some = readers.read_bars(spark, path, start="1996-05-01", end="1997-02-01")
    assert "PartitionFilters: [isnotnull(year" in some._jdf.queryExecution().executedPlan().toString()
    assert some.agg(F.min("Date"), F.max("Date")).first()[0].isoformat() >= "1996-05-01"
    picked = readers.load_tickers(readers.read_bars(spark, path), ["S1"])
    assert "PushedFilters: [IsNotNull(Ticker), EqualTo(Ticker,S1)]" in picked._jdf.queryExecution().executedPlan().toString().replace("In(Ticker, [S1])", "EqualTo(Ticker,S1)")


# --- stream ---------------------------------------------------------------------

def folders(spark):
    return [scratch_path(spark, f"stream-{n}") for n in ("source", "sink", "metrics", "checkpoint")]


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf):
    source, sink, metrics, checkpoint = folders(spark)
    adapters.tick_lines(spark, sf).repartition(5).write.text(source)

    def run():
        ticks = stream.read_tick_stream(spark, source, TIMED_SCHEMA, files_per_batch=2)
        query = stream.start_ticks(ticks, sink, metrics, checkpoint, clock=_clock(), seconds=None)
        stream.run_ticks(query)

    run()
    lines = readers.read_json_lines(spark, source, TIMED_SCHEMA)
    want = rows(projections.map_ticks(lines, float("nan"), _clock()))
    assert rows(stream.read_tick_bars(spark, sink)) == want
    counted = stream.read_batch_metrics(spark, metrics)
    assert counted.count() == 3 and counted.agg(F.sum("rows")).first()[0] == len(want)
    run()
    assert rows(stream.read_tick_bars(spark, sink)) == want
    adapters.tick_lines(spark, sf).limit(20).write.mode("append").text(source)
    run()
    assert len(rows(stream.read_tick_bars(spark, sink))) > len(want)


def test_writing_a_batch_twice_keeps_one_copy(spark, sf):
    source, sink, metrics, _ = folders(spark)
    adapters.tick_lines(spark, sf).write.text(source)
    batch = readers.read_json_lines(spark, source, TIMED_SCHEMA)
    write = stream.tick_batch_writer(sink, metrics, lambda: adapters.fx_quotes(spark, sf), _clock())
    write(batch, 0)
    once = rows(stream.read_tick_bars(spark, sink))
    write(batch, 0)
    write(batch.limit(0), 1)
    assert rows(stream.read_tick_bars(spark, sink)) == once


def test_a_bounded_run_stops_and_the_session_goes_on(spark, sf):
    source, table = scratch_path(spark, "ticks"), scratch_path(spark, "live")
    adapters.tick_lines(spark, sf).coalesce(1).write.text(source)
    tick_plan.collect_ticks(spark, source, table, seconds=1, timeout_seconds=8)
    assert not spark.streams.active
    got = stream.read_tick_bars(spark, f"{table}/ticks")
    # Without a clock all rows of a batch share the time of receipt.
    assert got.select("EventTS").distinct().count() == 1
    assert tick_plan.tick_report(spark, f"{table}/ticks").count() == got.filter("Close is not null").count()


def test_malformed_and_blank_lines(spark):
    path = scratch_path(spark, "lines")
    lines = ['{"ticker":"A","price":"1"}', "", '{"ticker":"B","pri', '{"ticker":"C","price":"null"}', "   "]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    assert sorted(r["ticker"] for r in readers.read_json_lines(spark, path).collect()) == ["A", "C"]
    assert [r["line"] for r in readers.read_malformed_lines(spark, path).collect()] == ['{"ticker":"B","pri']


# --- clusters -------------------------------------------------------------------

@pytest.fixture(scope="module")
def bars(spark, sf):
    return adapters.bars_type(spark, sf).cache()


def test_every_row_goes_to_its_nearest_centre(spark, bars):
    model = clustering.kmeans_pipeline(3).fit(bars)
    centres = [tuple(map(float, c)) for c in model.stages[-1].clusterCenters()]
    for r in model.transform(bars).select("Open", "Close", "prediction").collect():
        gaps = [(r["Open"] - a) ** 2 + (r["Close"] - b) ** 2 for a, b in centres]
        assert gaps[r["prediction"]] <= min(gaps) + 1e-9


def test_silhouette_recomputed_from_all_distances(spark, bars):
    placed = clustering.kmeans_pipeline(3).fit(bars).transform(bars)
    points = [(r["Open"], r["Close"], r["prediction"]) for r in placed.select("Open", "Close", "prediction").collect()]
    clusters = sorted({p for *_, p in points})

    def mean(i, cluster):
        gaps = [(points[i][0] - a) ** 2 + (points[i][1] - b) ** 2 for j, (a, b, c) in enumerate(points) if c == cluster and j != i]
        return sum(gaps) / len(gaps) if gaps else None

    scores = []
    for i, (*_, own) in enumerate(points):
        inside, outside = mean(i, own), min(mean(i, c) for c in clusters if c != own)
        scores.append(0.0 if inside is None else (outside - inside) / max(inside, outside))
    assert clustering.silhouette(placed) == pytest.approx(sum(scores) / len(scores), abs=1e-6)


def test_saved_model_places_rows_alike(spark, bars):
    model = clustering.kmeans_pipeline(2).fit(bars)
    path = scratch_path(spark, "model")
    clustering.save_model(model, path)
    assert rows(clustering.load_model(path).transform(bars).select("Date", "Ticker", "prediction")) == rows(
        model.transform(bars).select("Date", "Ticker", "prediction"))


def test_choosing_k(spark, bars):
    path = scratch_path(spark, "runs")
    out = cluster_plan.choose_k(bars, "silhouette", path)
    metrics = {r["name"]: r for r in out["runs"].collect()}
    best = out["best"].first()
    assert 2 <= best["k"] <= 5 and -1 <= best["silhouette"] <= 1 and "silhouette" in metrics
    cost = cluster_plan.choose_k(bars, "cost", path)
    assert cost["best"].first()["k"] in range(2, 7)
    # Recorded runs of both studies are listed together.
    assert clustering.read_runs(spark, path).count() == 9


def test_repeated_fits_and_comparison(spark, bars):
    repeat = cluster_plan.repeat_mixture(bars, repetitions=3)
    placed = repeat["assignments"]
    assert placed.count() == 3 * bars.count() and placed.select("rep").distinct().count() == 3
    assert repeat["crosstab"].agg(F.sum("count")).first()[0] == placed.count()
    compared = cluster_plan.compare_models(bars)
    assert compared["sizes"].agg(F.sum("n")).first()[0] == bars.count()
    assert compared["differences"].count() <= bars.count() / 2


def test_same_seed_same_fit(spark, bars):
    data = projections.range_features(bars)
    a, b = (clustering.gmm_repeat(data, 1).select("Ticker", "Date", "prediction") for _ in range(2))
    assert rows(a) == rows(b)


# --- quality --------------------------------------------------------------------

def test_quality_program(spark, sf):
    bars = adapters.bars_type(spark, sf).withColumn("Ticker", F.concat("Ticker", F.lit(".MC")))
    out = quality_plan.validate_wide(bars, [f"{t}.MC" for t in adapters.TYPES], "view.MC")
    assert out["results"].count() == 15
    assert {r["suite_name"] for r in out["report"].collect()} == {quality_plan.FORMAT_SUITE, quality_plan.BUSINESS_SUITE}


def test_suite_files_may_be_laid_out_over_lines(spark):
    from marketlens.operators import quality

    path = scratch_path(spark, "suite-file")
    text = """{
  "expectation_suite_name": "s",
  "expectations": [
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "A.B_Close"}, "meta": {}},
    {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "A.B_Close", "min_value": 0}, "meta": {}}
  ],
  "meta": {"version": "1"}
}"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rules = quality.rules_of(quality.read_suites(spark, path), "s")
    assert [r.column for r in rules] == ["A.B_Close"] * 2 and rules[1].min_value == 0.0
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "`A.B_Close` double")
    assert [r["unexpected"] for r in quality.validate(df, {"s": rules}).orderBy("rule_no").collect()] == [1, 1]


# --- plans ----------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_window_or_cartesian_product(spark, sf):
    import __spark_entry__ as entry

    for name, q in entry.queries().items():
        # Fits and streams run jobs when they are built; their plans hold nothing else of interest.
        if name.startswith(("k_by", "kmeans", "gmm", "stream", "batch", "update_", "store_")):
            continue
        plan = plan_of(q(spark, sf))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "PythonUDF" not in plan, name


def test_flagship_shuffles_twice(spark, sf):
    """Once to make bars unique, once to line up each ticker."""
    import __spark_entry__ as entry

    assert plan_of(entry.queries()["friday_effect"](spark, sf)).count("Exchange hashpartitioning") == 2


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    if root:
        assert scratch_path(spark, "a").startswith(os.path.join(root, ""))
