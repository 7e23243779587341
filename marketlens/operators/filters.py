"""Row filters over bars and wide tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions import nan_to_null
from marketlens.schemas import BAR_ESSENTIALS, MEASURES, PRICES, quoted


def drop_missing_essentials(df: DataFrame, columns: Sequence[str] = tuple(BAR_ESSENTIALS)) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with any null or NaN go; names may hold dots."""
    present = []
    for f in df.schema:
        c = F.col(quoted(f.name))
        present.append(c.isNotNull())
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            present.append(~F.isnan(c))
    return df.filter(reduce(and_, present))


def non_negative(df: DataFrame) -> DataFrame:
    return df.filter(_non_negative())


def coherent(df: DataFrame) -> DataFrame:
    return df.filter(_coherent())


def _non_negative() -> Column:
    prices = reduce(and_, [F.col(c) >= 0 for c in PRICES])
    return prices & (F.col("Volume").isNull() | (F.col("Volume") >= 0))


def _coherent() -> Column:
    return (F.col("High") >= F.col("Low")) & F.col("Close").between(F.col("Low"), F.col("High"))


def _typed(df: DataFrame) -> DataFrame:
    """Measures as doubles, a bad value as null, and whole units of volume; the same for kept and rejected rows."""
    typed = df.withColumns({c: nan_to_null(F.col(c).try_cast("double")) for c in MEASURES})
    return typed.withColumn("Volume", F.col("Volume").try_cast("bigint").cast("double"))


def clean_and_validate(df: DataFrame) -> DataFrame:
    """Essential fields present, nothing negative, ``Low <= Close <= High``.

    Measures come out as doubles with NaN turned into null; a NaN would pass
    every comparison.  Volume is cut to whole units and kept as a double.
    """
    typed = _typed(df)
    return drop_missing_essentials(typed).filter(_non_negative() & _coherent())


def reject_reasons(df: DataFrame) -> DataFrame:
    """The complement of ``clean_and_validate``: rejected rows with an array of reasons."""
    typed = _typed(df)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in BAR_ESSENTIALS])
    reasons = F.array_compact(F.array(
        F.when(missing, "missing"),
        F.when(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in MEASURES]), "negative"),
        F.when(~_coherent(), "incoherent"),
    ))
    return typed.withColumn("reasons", reasons).filter(F.size("reasons") > 0)


def history_slice(df: DataFrame, start: str, end: str, tickers: Sequence[str] | None = None) -> DataFrame:
    """Both ends of the date range belong to it."""
    out = df.filter(F.col("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return out.filter(F.col("Ticker").isin(list(tickers))) if tickers is not None else out


def ticker_slice(df: DataFrame, ticker: str) -> DataFrame:
    return df.filter(F.col("Ticker") == ticker)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(quoted(column)).isNotNull())


def distinct_labels(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two labels differ."""
    return df.filter(F.col(left) != F.col(right))
