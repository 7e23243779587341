"""Sorting, heads and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.skew import first_per_key, smallest_digests


def ordered_history(df: DataFrame, by: Sequence[str] = ("Ticker", "Date")) -> DataFrame:
    """A total sort for presentation; writers sort within files instead."""
    return df.orderBy(*by)


def head(df: DataFrame, n: int, by: Sequence[str] = ("Ticker", "Date")) -> DataFrame:
    return df.orderBy(*by).limit(n)


def head_per_ticker(df: DataFrame, n: int = 5, order: Sequence[str] = ("Date",)) -> DataFrame:
    return first_per_key(df, ["Ticker"], [F.col(c) for c in order], n)


def scatter_sample(
    df: DataFrame, n: int = 5000, seed: int = 42, key: Sequence[Column] | None = None
) -> DataFrame:
    """At most ``n`` complete price/volume points per ticker, the same ones in every run.

    Rows are taken in the order of a digest of ``key`` (by default the whole point) and
    the seed, which is a random order that does not depend on how the rows are spread
    over tasks.
    """
    parts = key or [
        F.date_format("Date", "yyyy-MM-dd"), F.col("Ticker"),
        *[F.col(c).try_cast("decimal(38,6)").cast("string") for c in ("Close", "Volume")],
    ]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    points = df.select("Date", "Ticker", "Close", "Volume", digest.alias("__pick")).na.drop(subset=["Close", "Volume"])
    return smallest_digests(points, ["Ticker"], "__pick", n).drop("__pick")


def best_run(runs: DataFrame, metric: str) -> DataFrame:
    """The run with the highest metric; on a tie the smaller ``k``, then the smaller id."""
    return (
        runs.select(
            "run_id",
            F.col("params")["k"].try_cast("int").alias("k"),
            F.col("metrics")[metric].alias(metric),
        )
        .filter(F.col(metric).isNotNull())
        .orderBy(F.desc(metric), "k", "run_id")
        .limit(1)
    )
