"""Live ticks to a stored table, and the report on it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.projections import normalize_any
from marketlens.operators.skew import ROWS_PER_SLICE
from marketlens.operators.windows import chart_series
from marketlens.streaming.ticks import compact_ticks, read_tick_bars, read_tick_stream, run_ticks, start_ticks


def collect_ticks(
    spark: SparkSession,
    source: str,
    table: str,
    quotes: Callable[[], DataFrame] | None = None,
    seconds: int | None = 5,
    timeout_seconds: float | None = 60,
) -> None:
    """Read tick files as they arrive for a while and store them below ``table``."""
    ticks = read_tick_stream(spark, source)
    query = start_ticks(ticks, f"{table}/ticks", f"{table}/metrics", f"{table}/checkpoint", quotes, seconds=seconds)
    run_ticks(query, timeout_seconds)


def tick_report(
    spark: SparkSession, sink: str, window: int = 10, start: str | None = None, end: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Chart series of every stored ticker, over the days from ``start`` to ``end`` where given."""
    ticks = read_tick_bars(spark, sink, start, end)
    timed = not ticks.filter(F.col("EventTS").isNotNull()).isEmpty()  # ends at the first file as a rule
    return report_on(ticks, window, rows_per_slice, timed)


def report_on(stored: DataFrame, window: int = 10, rows_per_slice: int = ROWS_PER_SLICE, timed: bool = False) -> DataFrame:
    """Chart series of any table of ticks or bars; rows are a second apart where it has no times.

    ``timed`` states that it has some.

    Ticks of one batch share their time, so the other columns complete the order.
    """
    ticks = normalize_any(stored, rows_per_slice=rows_per_slice, timed=timed)
    order = ["EventTS", "Close", "High", "Low", "Volume"]
    series = chart_series(ticks, order, window, rows_per_slice=rows_per_slice)
    return series.select("EventTS", "Ticker", "Close", "Low", "High", "SMA", "Volume")


def compact(spark: SparkSession, table: str, before: str) -> int:
    """Put the ticks that ``collect_ticks`` stored before a day together."""
    return compact_ticks(spark, f"{table}/ticks", before)
