"""Long bars: ingest, validate, store, merge, and the studies on the stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marketlens.operators import aggregates as agg
from marketlens.operators import filters, ordering, sets, windows
from marketlens.sources import readers, writers


def ingest(spark: SparkSession, source: str, **options) -> DataFrame:
    return readers.read_source(spark, source, **options)


def validate(spark: SparkSession, source: str, **options) -> DataFrame:
    return filters.clean_and_validate(ingest(spark, source, **options))


def store_new(spark: SparkSession, source: str, table: str, **options) -> None:
    """Validated bars of tickers the table does not hold yet."""
    writers.store_new_tickers(sets.dedup_bars(validate(spark, source, **options)), table)


def enrich_stored(spark: SparkSession, source: str, table: str, **options) -> DataFrame:
    store_new(spark, source, table, **options)
    return windows.add_day_of_week(readers.read_bars(spark, table))


def update(
    spark: SparkSession, feed: str, table: str, tickers: Sequence[str], start: str, end: str, interval: str = "1d"
) -> dict[str, DataFrame]:
    """Merge the bars of several tickers from a feed table into the history and preview it.

    Tickers the feed lacks are reported and do not stop the others.
    """
    offered = readers.read_source(spark, "table", path=feed, start=start, end=end, interval=interval)
    new = readers.load_tickers(filters.clean_and_validate(offered), tickers)
    writers.update_history(new, table)
    history = filters.history_slice(readers.read_bars(spark, table, start=start, end=end), start, end, tickers)
    return {
        "missing": readers.missing_tickers(offered, tickers),
        "history": history,
        "head": ordering.head(history, 5),
        "head_per_ticker": windows.add_day_of_week(ordering.head_per_ticker(history, 5)),
    }


def friday_returns(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """Returns with their day and what the histogram, box and violin charts show."""
    # The merge leaves one bar per ticker and day.
    returns = windows.add_simple_return(readers.read_bars(spark, table, ["Date", "Ticker", "Close"]), daily=True)
    returns = filters.not_null(windows.add_is_friday(windows.add_day_of_week(returns)), "Return")
    return {
        "returns": returns,
        "histogram": agg.return_histogram(returns),
        "box": agg.return_box(returns, daily=True),
        "outliers": agg.box_outliers(returns, daily=True),
        "violin": agg.return_violin(returns, daily=True),
    }


def price_volume(spark: SparkSession, table: str, points: int = 5000, seed: int = 42) -> dict[str, DataFrame]:
    bars = readers.read_bars(spark, table, ["Date", "Ticker", "Close", "Volume"])
    return {"corr": agg.corr_bar(bars), "points": ordering.scatter_sample(bars, points, seed)}
