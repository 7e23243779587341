"""Union, keyed deduplication and the history merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.schemas import BAR_COLUMNS, quoted


def union_bars(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedup_bars(df: DataFrame, key: Sequence[str] = ("Ticker", "Date"), rank: Column | None = None) -> DataFrame:
    """One whole row per key: the one with the largest ``rank``, a number that is never null.

    Without a rank a digest of the row decides, so the choice does not depend on how
    the rows are split.  All columns follow the same maximum and hence come from the
    same row.  Number-valued columns are combined in hash tables before the shuffle:
    any number of copies of one key leaves a task as a single row.
    """
    order = rank if rank is not None else F.xxhash64(*map(quoted, df.columns))
    rest = [c for c in df.columns if c not in key]
    best = [F.max_by(quoted(c), "__rank").alias(c) for c in rest]
    return df.withColumn("__rank", order).groupBy(*key).agg(*best).select(*map(quoted, df.columns))


def merge_history(stored: DataFrame, new: DataFrame, prefer_new: bool = True) -> DataFrame:
    """Stored and new bars, one per ``(Ticker, Date)``; new ones win unless told otherwise."""
    columns = [c for c in BAR_COLUMNS if c in stored.columns]

    def ranked(df: DataFrame, first: bool) -> DataFrame:
        dated = df.select(*columns).withColumn("Date", F.col("Date").cast("date"))
        # The preferred side ranks above the other; within a side the digest decides.
        digest = F.shiftrightunsigned(F.xxhash64(*columns), 2)
        return dated.withColumn("__side", digest + F.lit(2**62) if first else digest)

    both = ranked(stored, not prefer_new).unionByName(ranked(new, prefer_new))
    return dedup_bars(both, rank=F.col("__side")).select(*columns)
