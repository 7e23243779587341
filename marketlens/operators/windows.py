"""Returns, moving averages and rolling alerts.

``daily=True`` states that a ticker has at most one row per day, as after
``dedup_bars``.  Then a group cannot outgrow the calendar and a plain window is
safe.  Without it the heavy tickers are cut into slices (see ``skew``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlens.functions import day_name, friday_label, percent_change, ratio_return
from marketlens.operators.skew import ROWS_PER_SLICE, ordered_window
from marketlens.schemas import quoted


def _over_ticker(
    df: DataFrame,
    order: Sequence[str],
    lookback: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    daily: bool,
    rows_per_slice: int,
) -> DataFrame:
    if not daily:
        return ordered_window(df, ["Ticker"], order, lookback, build, rows_per_slice)
    return df.withColumns(build(Window.partitionBy("Ticker").orderBy(*order)))


def add_day_of_week(df: DataFrame) -> DataFrame:
    return df.withColumn("DayOfWeek", day_name(F.col("Date")))


def add_is_friday(df: DataFrame) -> DataFrame:
    return df.withColumn("IsFriday", friday_label(F.col("Date")))


def add_simple_return(
    df: DataFrame, order: Sequence[str] = ("Date",), daily: bool = False, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """``Close / previous Close - 1``; null on the first row and after a zero close."""
    return _over_ticker(
        df, order, 1,
        lambda w: {"Return": ratio_return(F.col("Close"), F.lag("Close").over(w))},
        daily, rows_per_slice,
    )


def add_daily_returns(
    df: DataFrame, order: Sequence[str] = ("Date",), daily: bool = False, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Percent change of the close; rows without one are left out."""
    out = _over_ticker(
        df, order, 1,
        lambda w: {"Return": percent_change(F.col("Close"), F.lag("Close").over(w))},
        daily, rows_per_slice,
    )
    return out.filter(F.col("Return").isNotNull())


def friday_effect(df: DataFrame, daily: bool = False, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    returns = add_daily_returns(df.select("Date", "Ticker", "Close"), daily=daily, rows_per_slice=rows_per_slice)
    return add_is_friday(add_day_of_week(returns)).select("Date", "Ticker", "Close", "Return", "DayOfWeek", "IsFriday")


def add_sma(
    df: DataFrame,
    order: Sequence[str] = ("EventTS",),
    window: int = 10,
    daily: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Mean of the last ``window`` closes, fewer at the start of a series."""
    return _over_ticker(
        df, order, window - 1,
        lambda w: {"SMA": F.avg("Close").over(w.rowsBetween(-(window - 1), 0))},
        daily, rows_per_slice,
    )


def deficiency_notice(
    df: DataFrame,
    threshold: float = 1.0,
    frame: int = 31,
    min_hits: int = 30,
    order: Sequence[str] = ("Date",),
    daily: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Flag rows where at least ``min_hits`` of the last ``frame`` closes lie below the threshold.

    A missing close is not below; frames at the start of a series are shorter.
    """
    below = F.when(F.col("Close") < threshold, 1).otherwise(0)
    return _over_ticker(
        df, order, frame - 1,
        lambda w: {"DeficiencyNotice": F.sum(below).over(w.rowsBetween(-(frame - 1), 0)) >= min_hits},
        daily, rows_per_slice,
    )


def deficiency_notice_wide(
    df: DataFrame,
    column: str = "UNI",
    date: str = "Dia",
    threshold: float = 1.0,
    frame: int = 31,
    min_hits: int = 30,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The alert on one column of a wide table, as ``Deficiency Notice <column>``."""
    below = F.when(F.col(quoted(column)).try_cast("double") < threshold, 1).otherwise(0)
    return ordered_window(
        df, [], [date], frame - 1,
        lambda w: {f"Deficiency Notice {column}": F.sum(below).over(w.rowsBetween(-(frame - 1), 0)) >= min_hits},
        rows_per_slice,
    )


def chart_series(
    df: DataFrame,
    order: Sequence[str] = ("EventTS",),
    window: int = 10,
    daily: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """What a price chart draws: close, low-high band, moving average, volume with gaps as 0."""
    shown = ["Ticker", "Close", "Low", "High", "SMA"]
    times = [c for c in order if c not in (*shown, "Volume")]
    return add_sma(df, order, window, daily, rows_per_slice).select(
        *times, *shown, F.coalesce("Volume", F.lit(0.0)).alias("Volume")
    )
