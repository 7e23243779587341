"""Cluster studies: choose k, repeat fits, compare models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketlens.operators import aggregates as agg
from marketlens.operators import clustering, filters, joins
from marketlens.operators.ordering import best_run
from marketlens.operators.projections import open_close, range_features

STUDIES = {
    "silhouette": (clustering.k_by_silhouette, "silhouette"),
    "cost": (clustering.k_by_cost, "score"),
    "loglik": (clustering.k_by_loglik, "log_likelihood"),
}


def choose_k(bars: DataFrame, study: str = "silhouette", runs_path: str | None = None) -> dict[str, DataFrame]:
    """Fit every candidate, record the runs, pick the best and list them all."""
    fit, metric = STUDIES[study]
    runs = fit(open_close(bars))
    if runs_path:
        clustering.record_runs(runs, runs_path)
        runs_listed = clustering.read_runs(bars.sparkSession, runs_path)
    else:
        runs_listed = runs
    return {"best": best_run(runs, metric), "runs": clustering.run_listing(runs_listed)}


def repeat_mixture(bars: DataFrame, repetitions: int = 5, k: int = 2) -> dict[str, DataFrame]:
    placed = clustering.gmm_repeat(range_features(bars), repetitions, k)
    counted = placed.groupBy("rep", "Ticker", "prediction").count()
    return {"assignments": placed, "crosstab": counted}


def compare_models(bars: DataFrame, k: int = 2) -> dict[str, DataFrame]:
    """Sizes of the k-means clusters and the rows that the mixture places elsewhere.

    Label numbers are matched before rows are compared.  ``pairs`` counts the
    differences of the join on the ticker alone, with labels as the models gave them.
    """
    both = clustering.label_with_both(range_features(bars), k)
    aligned = joins.align_labels(both, "gmm_cluster", "kmeans_cluster")
    return {
        "sizes": agg.cluster_sizes(both, "kmeans_cluster"),
        "differences": filters.distinct_labels(aligned, "kmeans_cluster", "gmm_cluster"),
        "pairs": joins.label_difference_counts(both, both),
    }
