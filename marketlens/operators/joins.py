"""Lookups, anti-joins and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.filters import distinct_labels
from marketlens.schemas import TICKER_NAMES


def name_tickers(df: DataFrame, names: dict[str, str] | DataFrame = TICKER_NAMES) -> DataFrame:
    """Add ``Company``; the ticker stays, since several tickers may share a name.

    A dict is broadcast: it came from the driver and fits there.  A table of names
    has no known size, so Spark picks the join from what it measures.
    """
    if isinstance(names, DataFrame):
        return df.join(names, "Ticker", "left")
    table = df.sparkSession.createDataFrame(list(names.items()), "Ticker string, Company string")
    return df.join(F.broadcast(table), "Ticker", "left")


def new_tickers(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of tickers that are not stored yet.  A row without ticker is not new."""
    known = stored.select("Ticker").filter(F.col("Ticker").isNotNull()).distinct()
    return current.filter(F.col("Ticker").isNotNull()).join(known, "Ticker", "left_anti").select(*current.columns)


def latest_quote(quotes: DataFrame, fine: str = "1m", coarse: str = "1d") -> DataFrame:
    """One row: the last close of the fine series, else of the coarse one, else NaN."""
    def last(interval: str) -> Column:
        live = (F.col("interval") == interval) & F.col("close").isNotNull() & ~F.isnan("close")
        newest = F.max(F.when(live, F.struct("ts", "close")))
        return newest["close"]

    return quotes.agg(F.coalesce(last(fine), last(coarse), F.lit(float("nan"))).alias("EURUSD"))


def attach_quote(ticks: DataFrame, quote: DataFrame) -> DataFrame:
    """Put the one value of ``quote`` on every row, as a scalar subquery."""
    return ticks.withColumn("EURUSD", quote.scalar())


def label_differences(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Rows that two models label differently, paired by a row key."""
    return distinct_labels(left.join(right, key), "kmeans_cluster", "gmm_cluster")


def label_difference_counts(left: DataFrame, right: DataFrame, key: str = "Ticker") -> DataFrame:
    """How many pairs of rows of the same ticker carry different labels.

    Every row of a ticker on one side meets every row on the other.  The pairs
    are counted from the label sizes of both sides and never written out, as decimals,
    since two counts of some billions have a product beyond a long.
    """
    size = F.count(F.lit(1)).cast("decimal(19,0)")
    a = left.groupBy(key, "kmeans_cluster").agg(size.alias("__a"))
    b = right.groupBy(key, "gmm_cluster").agg(size.alias("__b"))
    return distinct_labels(a.join(b, key), "kmeans_cluster", "gmm_cluster").select(
        key, "kmeans_cluster", "gmm_cluster", (F.col("__a") * F.col("__b")).cast("decimal(38,0)").alias("pairs")
    )


def best_matching(weights: list[list[int]]) -> list[int]:
    """For each row of a table with no more rows than columns, its column in the matching with the largest sum.

    Shortest augmenting paths: rows come one by one, and prices of rows and columns keep every reduced cost from
    falling below zero.
    """
    n, m = len(weights), len(weights[0]) if weights else 0
    row_price, column_price, holder = [0] * n, [0] * m, [-1] * m
    for new in range(n):
        least, before, done = [float("inf")] * m, [-1] * m, [False] * m
        row, column = new, -1
        while True:
            for c in range(m):
                cost = -weights[row][c] - row_price[row] - column_price[c]
                if not done[c] and cost < least[c]:
                    least[c], before[c] = cost, column
            step, column = min((least[c], c) for c in range(m) if not done[c])
            row_price[new] += step
            for c in range(m):
                if done[c]:
                    row_price[holder[c]] += step
                    column_price[c] -= step
                else:
                    least[c] -= step
            done[column] = True
            if holder[column] < 0:
                break
            row = holder[column]
        while column >= 0:  # hand columns on along the path
            holder[column] = holder[before[column]] if before[column] >= 0 else new
            column = before[column]
    out = [-1] * n
    for c, r in enumerate(holder):
        if r >= 0:
            out[r] = c
    return out


def align_labels(df: DataFrame, label: str, reference: str) -> DataFrame:
    """Rename the labels of one model to those of another so that as many rows as possible agree.

    Label numbers of two fits are arbitrary.  The matching is exact, on a table of at most k times k counts; a label
    without a partner takes a number that no other has.  Rows without a label keep none.
    """
    overlap = df.groupBy(label, reference).agg(F.count(F.lit(1)).alias("n")).collect()
    ours = sorted({r[label] for r in overlap if r[label] is not None})
    theirs = sorted({r[reference] for r in overlap if r[reference] is not None})
    counts = {(r[label], r[reference]): r["n"] for r in overlap}
    spare = [None] * max(0, len(ours) - len(theirs))
    columns = [*theirs, *spare]
    chosen = best_matching([[counts.get((a, b), 0) if b is not None else 0 for b in columns] for a in ours])
    mapping: dict[int, int] = {a: columns[c] for a, c in zip(ours, chosen) if columns[c] is not None}
    # A label left without a partner takes a reference number nobody holds, or a new one.
    for own in sorted(set(ours) - mapping.keys()):
        mapping[own] = next(n for n in range(2 * len(overlap) + 1) if n not in mapping.values())
    renamed = F.lit(None).cast("int")
    for own, other in mapping.items():
        renamed = F.when(F.col(label) == own, other).otherwise(renamed)
    return df.withColumn(label, renamed)
