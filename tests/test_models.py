"""Figures of clusters against plain versions, and runs by experiment."""

import itertools
import math
import uuid

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from marketlens.operators import clustering, joins
from marketlens.session import scratch_path

FEATURES = ("Open", "Close")


def points(spark, seed=1, n=120):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 1 + c / 20, (n // 3, 2)) for c in (0, 9, 40)])
    return spark.createDataFrame([(float(a), float(b)) for a, b in x], "Open double, Close double"), x


def brute_silhouette(x, label):
    out = []
    for i in range(len(x)):
        mean = {k: ((x[label == k] - x[i]) ** 2).sum(axis=1).sum() for k in set(label)}
        n = {k: (label == k).sum() for k in set(label)}
        if n[label[i]] == 1:
            out.append(0.0)
            continue
        a = mean[label[i]] / (n[label[i]] - 1)
        b = min(mean[k] / n[k] for k in n if k != label[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize("labels", [3, 7, 60])
def test_silhouette(spark, labels):
    _, x = points(spark)
    label = np.random.default_rng(labels).integers(0, labels, len(x))
    label[0] = labels  # alone
    df = spark.createDataFrame([(float(a), float(b), int(k)) for (a, b), k in zip(x + 1e6, label)], "Open double, Close double, prediction int")
    df = df.unionByName(spark.createDataFrame([(None, 1.0, 0), (1.0, 1.0, None)], df.schema))
    assert clustering.silhouette_by_sums(df, FEATURES) == pytest.approx(brute_silhouette(x, label), abs=1e-6)


def test_silhouette_without_clusters(spark):
    df = spark.createDataFrame([], "Open double, Close double, prediction int")
    assert clustering.silhouette_by_sums(df, FEATURES) is None
    same = spark.createDataFrame([(1.0, 1.0, 0), (1.0, 1.0, 0), (1.0, 1.0, 1)], df.schema)
    assert clustering.silhouette_by_sums(same, FEATURES) == 0.0


def test_mixture_densities(spark):
    df, x = points(spark)
    model = clustering.gmm_pipeline(3, features=FEATURES).fit(df).stages[-1]
    logs = np.array(df.select(clustering.mixture_log_densities(model, FEATURES).alias("l")).toPandas().l.tolist())
    expected = []
    for w, g in zip(model.weights, model.gaussians):
        d = x - g.mean.toArray()
        cov = g.cov.toArray()
        expected.append(math.log(w) - 0.5 * (2 * math.log(2 * math.pi) + math.log(np.linalg.det(cov)) + (d @ np.linalg.inv(cov) * d).sum(axis=1)))
    expected = np.array(expected).T
    rows = lambda a: sorted(map(tuple, np.round(a, 6)))
    assert np.allclose(rows(logs), rows(expected), rtol=1e-6)
    total = np.logaddexp.reduce(expected, axis=1).sum()
    assert clustering.mixture_log_likelihood(df, model, FEATURES) == pytest.approx(total, rel=1e-9)
    far = spark.createDataFrame([(1e9, -1e9), (None, 1.0)], "Open double, Close double")
    assert math.isfinite(clustering.mixture_log_likelihood(far, model, FEATURES))


def test_flat_direction(spark):
    """Features that always move together leave a covariance without an inverse."""
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(50)], "Open double, Close double")
    model = clustering.gmm_pipeline(2, features=FEATURES).fit(df)
    assert math.isfinite(clustering.mixture_log_likelihood(df, model.stages[-1], FEATURES))


def test_cost(spark):
    df, x = points(spark)
    model = clustering.kmeans_pipeline(3).fit(df).stages[-1]
    centres = np.array(model.clusterCenters())
    expected = ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert clustering.kmeans_cost(df, model, FEATURES) == pytest.approx(expected)
    assert clustering.kmeans_cost(df.limit(0), model, FEATURES) == 0.0


def test_runs_by_experiment(spark):
    df, _ = points(spark)
    path, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    assert clustering.read_runs(spark, path).count() == 0
    for name in ("a", "b", None):
        clustering.record_runs(clustering.k_by_cost(df, (2, 3), models=models if name else None, experiment=name), path)
    assert clustering.read_runs(spark, path).count() == 6
    stored = clustering.read_runs(spark, path, "a").collect()
    assert sorted(r["params"]["k"] for r in stored) == ["2", "3"] and {r["experiment"] for r in stored} == {"a"}
    assert clustering.read_runs(spark, path, "none such").count() == 0
    for r in stored:
        model = clustering.load_run(models, r["run_id"])
        assert isinstance(model, PipelineModel) and len(model.stages[-1].clusterCenters()) == int(r["params"]["k"])
        assert model.transform(df).where(F.col("prediction") >= int(r["params"]["k"])).isEmpty()
    with pytest.raises(Exception):
        clustering.load_run(models, uuid.uuid4().hex)


@pytest.mark.parametrize("seed", range(40))
def test_best_matching(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 6))
    m = n + int(rng.integers(0, 3))
    weights = [[int(x) for x in row] for row in rng.integers(0, rng.choice([2, 50]), (n, m))]
    chosen = joins.best_matching(weights)
    assert len(set(chosen)) == n
    best = max(sum(weights[i][c] for i, c in enumerate(p)) for p in itertools.permutations(range(m), n))
    assert sum(weights[i][c] for i, c in enumerate(chosen)) == best


def test_aligned_where_the_largest_overlap_misleads(spark):
    """Taking 10 first leaves 0 + 10; 9 and 9 agree more often."""
    rows = [(0, 0)] * 10 + [(0, 1)] * 9 + [(1, 0)] * 9 + [(None, 0), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    out = joins.align_labels(df, "a", "b")
    assert out.where("a = b").count() == 18 and out.where("a IS NULL").count() == 1
    assert out.select("a").distinct().count() == 4


def test_mixtures_step_together_as_the_library_steps_alone(spark):
    rows = spark.createDataFrame([(float(i % 7) + i / 1000, float(i % 5) * (1 + i % 2)) for i in range(400)] + [(None, 1.0)], "Open double, Close double")
    rows = rows.coalesce(2)
    vectors = clustering.assembler().transform(rows).select("features")
    found = clustering.fit_mixtures(rows, clustering.PRICE_FEATURES, [(2, 123), (3, 5)])
    for (model, likely), (k, seed) in zip(found, [(2, 123), (3, 5)]):
        want = clustering.gaussian_mixture(k, seed).fit(vectors)
        assert likely == pytest.approx(want.summary.logLikelihood, rel=1e-9)
        assert list(model.weights) == pytest.approx(list(want.weights), rel=1e-6)
        for a, b in zip(model.gaussians, want.gaussians):
            assert a.mean.toArray() == pytest.approx(b.mean.toArray(), rel=1e-6) and a.cov.toArray() == pytest.approx(b.cov.toArray(), rel=1e-5, abs=1e-9)
        assert model.transform(vectors).select("prediction").collect() == want.transform(vectors).select("prediction").collect()


def test_a_stored_table_is_not_stored_twice(spark):
    rows = spark.createDataFrame([(1.0, 2.0)], "Open double, Close double")
    with clustering.kept(rows, ["Open"]) as once:
        assert once.storageLevel.useMemory
        with clustering.kept(once, ["Open"]):
            pass
        assert once.storageLevel.useMemory
    assert not once.storageLevel.useMemory


def test_sweep_of_kmeans_as_the_library_fits_alone(spark, monkeypatch):
    """Groups far apart have one best fit; no model is fitted by itself."""
    df, x = points(spark, n=150)
    df = df.unionByName(spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], df.schema)).repartition(3)
    want = clustering.kmeans_pipeline(3).fit(df)
    expected = clustering.silhouette(want.transform(df))
    models = scratch_path(spark, "models")

    def alone(*_):
        raise AssertionError("a model was fitted by itself")

    monkeypatch.setattr(clustering.KMeans, "fit", alone)
    runs = {r["params"]["k"]: r for r in clustering.k_by_silhouette(df, (2, 3), models=models).collect()}
    assert set(runs) == {"2", "3"} and runs["3"]["metrics"]["silhouette"] == pytest.approx(expected, abs=1e-9)
    for k, r in runs.items():
        stored = clustering.load_run(models, r["run_id"])
        assert clustering.silhouette(stored.transform(df)) == pytest.approx(r["metrics"]["silhouette"], abs=1e-9)
        if k == "3":
            ours, theirs = (np.array(sorted(map(tuple, m.stages[-1].clusterCenters()))) for m in (stored, want))
            assert np.allclose(ours, theirs)


def test_sweep_of_kmeans_without_clusters(spark):
    """As the library and its evaluator have it."""
    df = spark.createDataFrame([(1.0, 1.0)] * 5, "Open double, Close double")
    for rows in (df, df.limit(0)):
        with pytest.raises(Exception):
            clustering.k_by_silhouette(rows, (2,))
    two = df.unionByName(spark.createDataFrame([(5.0, 1.0)], df.schema))
    assert clustering.k_by_silhouette(two, (2, 4)).select("metrics.silhouette").distinct().first()[0] == pytest.approx(5 / 6)


def test_labels_are_worked_out_once(spark):
    """A label may be a model's prediction; the rows are read three times."""
    _, x = points(spark)
    asked = spark.sparkContext.accumulator(0)

    def label(a):
        asked.add(1)
        return int(a > 5)

    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "Open double, Close double")
    placed = df.withColumn("prediction", F.udf(label, "int")("Open"))
    assert clustering.silhouette_by_sums(placed, FEATURES) == pytest.approx(brute_silhouette(x, (x[:, 0] > 5).astype(int)), abs=1e-6)
    assert asked.value == len(x)
