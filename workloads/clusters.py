"""Queries over clusters of bars and over runs."""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

from marketlens.operators import aggregates as agg
from marketlens.operators import clustering, filters, joins, ordering, projections
from marketlens.session import scratch_path
from workloads.adapters import bars_supplier, bars_user, label_pairs, run_records, with_sql
from workloads.registry import query

# --- labels of two models -----------------------------------------------------------


def _sides(spark, sf):
    pairs = label_pairs(spark, sf)
    return pairs.select("Ticker", "doc_id", "kmeans_cluster"), pairs.select("Ticker", "doc_id", "gmm_cluster")


@query("cluster_disagreement", with_sql("SELECT * FROM label_pairs WHERE kmeans_cluster <> gmm_cluster"))
def cluster_disagreement(spark, sf):
    left, right = _sides(spark, sf)
    return joins.label_differences(left, right, ["Ticker", "doc_id"])


@query("cluster_disagreement_by_ticker", with_sql("""
SELECT a."Ticker", a.kmeans_cluster, b.gmm_cluster, CAST(count(*) AS DECIMAL(38,0)) AS pairs
FROM label_pairs a JOIN label_pairs b ON a."Ticker" = b."Ticker" AND a.kmeans_cluster <> b.gmm_cluster GROUP BY 1, 2, 3"""))
def cluster_disagreement_by_ticker(spark, sf):
    """Joined on the ticker alone; the pairs are counted, not listed."""
    left, right = _sides(spark, sf)
    return joins.label_difference_counts(left, right)


@query("cluster_sizes", with_sql("SELECT kmeans_cluster, count(*) AS n FROM label_pairs GROUP BY 1"))
def cluster_sizes(spark, sf):
    return agg.cluster_sizes(label_pairs(spark, sf), "kmeans_cluster")


@query("cluster_crosstab", with_sql("""
SELECT "Ticker", count(*) FILTER (gmm_cluster = 0) AS cluster_0, count(*) FILTER (gmm_cluster = 1) AS cluster_1,
       count(*) FILTER (gmm_cluster = 2) AS cluster_2 FROM label_pairs GROUP BY 1"""))
def cluster_crosstab(spark, sf):
    return agg.cluster_crosstab(label_pairs(spark, sf), [0, 1, 2], label="gmm_cluster")


@query("align_labels", with_sql("""
SELECT max(matched) AS matched, max(rows) AS rows, (SELECT count(DISTINCT gmm_cluster) FROM label_pairs) AS labels FROM (
  SELECT p.a, p.b, p.c, count(*) FILTER ((gmm_cluster = 0 AND kmeans_cluster = p.a) OR (gmm_cluster = 1 AND kmeans_cluster = p.b)
         OR (gmm_cluster = 2 AND kmeans_cluster = p.c)) AS matched, count(*) AS rows
  FROM label_pairs, (SELECT x.i AS a, y.i AS b, z.i AS c FROM range(3) x(i), range(3) y(i), range(3) z(i)
                     WHERE x.i <> y.i AND x.i <> z.i AND y.i <> z.i) p GROUP BY 1, 2, 3)"""))
def align_labels(spark, sf):
    """No other renaming of the labels lets more rows agree."""
    aligned = joins.align_labels(label_pairs(spark, sf), "gmm_cluster", "kmeans_cluster")
    return aligned.agg(
        F.count_if(F.col("gmm_cluster") == F.col("kmeans_cluster")).alias("matched"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("gmm_cluster").alias("labels"),
    )


# --- runs -----------------------------------------------------------------------------

@query("best_run", with_sql("SELECT run_id, k, silhouette FROM run_records ORDER BY silhouette DESC, k, run_id LIMIT 1"))
def best_run(spark, sf):
    return ordering.best_run(run_records(spark, sf), "silhouette")


@query("run_listing", with_sql("""
SELECT run_id, 'param' AS kind, 'k' AS name, CAST(k AS DOUBLE) AS value FROM run_records
UNION ALL SELECT run_id, 'metric', 'silhouette', silhouette FROM run_records
UNION ALL SELECT run_id, 'metric', 'cost', cost FROM run_records"""))
def run_listing(spark, sf):
    path = scratch_path(spark, "runs")
    clustering.record_runs(run_records(spark, sf), path)
    listed = clustering.run_listing(clustering.read_runs(spark, path))
    return listed.withColumn("value", F.col("value").cast("double"))


# --- fits: no SQL ---------------------------------------------------------------------

def _features(spark, sf):
    return projections.range_features(bars_supplier(spark, sf))


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    bars = bars_supplier(spark, sf)
    return clustering.kmeans_pipeline(3).fit(bars).transform(bars).select("Ticker", "Date", "Open", "Close", "prediction")


@query("kmeans_nearest", with_sql("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced, CAST(3 AS BIGINT) AS clusters FROM bars_supplier"))
def kmeans_nearest(spark, sf):
    """Every row is measured against all centres; none may lie nearer than its own."""
    bars = bars_supplier(spark, sf)
    model = clustering.kmeans_pipeline(3).fit(bars)
    gaps = F.array(*[
        F.pow(F.col("Open") - float(a), F.lit(2.0)) + F.pow(F.col("Close") - float(b), F.lit(2.0))
        for a, b in model.stages[-1].clusterCenters()
    ])
    placed = model.transform(bars).select(F.get(gaps, F.col("prediction")).alias("own"), F.array_min(gaps).alias("least"), "prediction")
    return placed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("own") > F.col("least") * (1 + 1e-9)).alias("misplaced"),
        F.count_distinct("prediction").alias("clusters"),
    )


@query("gmm_assign", with_sql("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced, CAST(2 AS BIGINT) AS clusters FROM bars_supplier"))
def gmm_assign(spark, sf):
    """Every row's densities are worked out from the fitted weights, means and covariances; none may beat its own.

    A fitted mixture places rows by weight times density plus the machine's epsilon, so that rows far from all components tie.
    """
    bars = _features(spark, sf)
    model = clustering.fit_mixture(bars, 2)
    logs = clustering.mixture_log_densities(model.stages[-1], clustering.RANGE_FEATURES)
    shares = F.transform(logs, lambda x: F.exp(x) + F.lit(sys.float_info.epsilon))
    placed = model.transform(bars).select("prediction", shares.alias("shares"))
    own, most = F.get("shares", F.col("prediction")), F.array_max("shares")
    return placed.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(own < most * (1 - 1e-6)).alias("misplaced"),
        F.count_distinct("prediction").alias("clusters"),
    )


def _sweep_agrees(spark, bars, sweep, metric, again, tolerance, lowers=False):
    """A row per run: its metric is worked out anew, from the model that the run stored; ``lowers`` if it must not be more."""
    runs_path, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    told = []
    with clustering.kept(bars, clustering.PRICE_FEATURES) as prices:
        clustering.record_runs(sweep(prices, models=models, experiment=metric), runs_path)
        for run in clustering.read_runs(spark, runs_path, metric).collect():
            value = again(prices, clustering.load_run(models, run["run_id"]))
            recorded = run["metrics"][metric]
            close = abs(value - recorded) <= tolerance * abs(value) and not (lowers and value > recorded * (1 + 1e-9))
            told.append((int(run["params"]["k"]), close))
    return spark.createDataFrame(told, "k int, agrees boolean")


def _ks(last):
    return f"SELECT CAST(k AS INTEGER) AS k, TRUE AS agrees FROM range(2, {last + 1}) t(k)"


@query("silhouette_check", with_sql("SELECT count(*) AS rows, TRUE AS agrees, CAST(3 AS BIGINT) AS clusters FROM bars_supplier"))
def silhouette_check(spark, sf):
    """The silhouette from sums of each cluster against the evaluator's."""
    with clustering.kept(bars_supplier(spark, sf), clustering.PRICE_FEATURES) as prices:
        placed = clustering.fit_kmeans(prices, 3).transform(prices)
        ours, theirs = clustering.silhouette_by_sums(placed, clustering.PRICE_FEATURES), clustering.silhouette(placed)
    return placed.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(abs(ours - theirs) < 1e-6).alias("agrees"), F.count_distinct("prediction").alias("clusters")
    )


@query("k_by_silhouette", _ks(5))
def k_by_silhouette(spark, sf):
    def again(bars, model):
        return clustering.silhouette_by_sums(model.transform(bars), clustering.PRICE_FEATURES)

    return _sweep_agrees(spark, projections.open_close(bars_supplier(spark, sf)), clustering.k_by_silhouette, "silhouette", again, 1e-6)


@query("k_by_cost", _ks(6))
def k_by_cost(spark, sf):
    """A fit records the cost before its last step, which only lowers it, by little when the fit has settled."""
    def again(bars, model):
        return clustering.kmeans_cost(bars, model.stages[-1], clustering.PRICE_FEATURES)

    return _sweep_agrees(spark, projections.open_close(bars_supplier(spark, sf)), clustering.k_by_cost, "cost", again, 0.05, lowers=True)


@query("k_by_loglik", _ks(6))
def k_by_loglik(spark, sf):
    """A fit records the likelihood before its last step, which gains less than its tolerance unless it ran out of steps."""
    def again(bars, model):
        return clustering.mixture_log_likelihood(bars, model.stages[-1], clustering.PRICE_FEATURES)

    return _sweep_agrees(spark, projections.open_close(bars_supplier(spark, sf)), clustering.k_by_loglik, "log_likelihood", again, 1e-4)


@query("model_roundtrip", with_sql("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS farther FROM bars_user"))
def model_roundtrip(spark, sf):
    """The best run of a stored sweep is loaded back and places every row at its nearest centre, and where its copy does."""
    bars = projections.open_close(bars_user(spark, sf))
    runs_path, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    clustering.record_runs(clustering.k_by_cost(bars, (2, 3), models=models, experiment="cost"), runs_path)
    best = ordering.best_run(clustering.read_runs(spark, runs_path, "cost"), "score").first()
    stored = clustering.load_run(models, best["run_id"])
    gaps = clustering.centre_distances(stored.stages[-1], clustering.PRICE_FEATURES)
    again = f"{models}/again"
    clustering.save_model(stored, again)
    copy = clustering.load_model(again).stages[-1].setPredictionCol("again")
    placed = copy.transform(stored.transform(bars)).withColumn("gaps", gaps)
    return placed.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction") != F.col("again")).alias("changed"),
        F.count_if(F.get("gaps", F.col("prediction")) > F.array_min("gaps") * (1 + 1e-9)).alias("farther"),
    )


@query("gmm_repeat", with_sql("""
SELECT CAST(rep AS INTEGER) AS rep, count(*) AS rows, count(DISTINCT ("Ticker", "Date")) AS keys, CAST(0 AS BIGINT) AS outside
FROM bars_user, range(1, 6) t(rep) GROUP BY rep"""))
def gmm_repeat(spark, sf):
    """Every row once for each repetition, in one of its two clusters."""
    placed = clustering.gmm_repeat(projections.range_features(bars_user(spark, sf)))
    return placed.groupBy("rep").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("Ticker", "Date").alias("keys"),
        F.count_if(~F.col("prediction").isin(0, 1)).alias("outside"),
    )


@query("gmm_kmeans_differences")
def gmm_kmeans_differences(spark, sf):
    """Both models on the same bars, labels aligned, rows they place differently."""
    both = clustering.label_with_both(_features(spark, sf)).select("Ticker", "Date", "kmeans_cluster", "gmm_cluster")
    aligned = joins.align_labels(both, "gmm_cluster", "kmeans_cluster")
    return filters.distinct_labels(aligned, "kmeans_cluster", "gmm_cluster")
