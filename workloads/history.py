"""Queries over the stored history."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import sets, windows
from marketlens.session import scratch_path
from marketlens.sources import readers, writers
from workloads.adapters import bars_supplier, stored_bars, with_sql
from workloads.registry import query


@query("merge_history", with_sql("""
SELECT * FROM bars_supplier"""))
def merge_history(spark, sf):
    """Stored bars at other prices merged with new ones, which win on every shared day."""
    return sets.merge_history(stored_bars(spark, sf), bars_supplier(spark, sf))


@query("merge_history_keep", with_sql("""
SELECT * FROM stored_bars UNION ALL
SELECT * FROM bars_supplier WHERE ("Ticker", "Date") NOT IN (SELECT ("Ticker", "Date") FROM stored_bars)"""))
def merge_history_keep(spark, sf):
    return sets.merge_history(stored_bars(spark, sf), bars_supplier(spark, sf), prefer_new=False)


@query("update_history", with_sql("""
SELECT * FROM bars_supplier WHERE year("Date") >= 1998
UNION ALL SELECT * FROM stored_bars WHERE year("Date") < 1998"""))
def update_history(spark, sf):
    """Stored table on disk, updated with new bars from 1998 on; older years stay as they are."""
    path = scratch_path(spark, "history-table")
    writers.write_bars(stored_bars(spark, sf), path)
    writers.update_history(bars_supplier(spark, sf).filter(F.year("Date") >= 1998), path)
    return readers.read_bars(spark, path)


@query("store_new_tickers", with_sql("""
SELECT *, dayname("Date") AS "DayOfWeek" FROM stored_bars UNION ALL
SELECT *, dayname("Date") FROM bars_supplier WHERE "Ticker" NOT IN (SELECT "Ticker" FROM stored_bars)"""))
def store_new_tickers(spark, sf):
    """Only tickers not stored yet are appended; the table is then read with the day of the week."""
    path = scratch_path(spark, "ticker-table")
    writers.write_bars(stored_bars(spark, sf), path)
    writers.store_new_tickers(bars_supplier(spark, sf), path)
    return windows.add_day_of_week(readers.read_bars(spark, path))
