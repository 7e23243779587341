"""The wide close table from CSV to statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.operators import aggregates as agg
from marketlens.operators import projections as shape
from marketlens.operators import windows
from marketlens.operators.joins import name_tickers
from marketlens.sources.readers import read_declared_csv, read_wide_csv
from marketlens.sources.writers import store_raw_and_cleaned


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Raw text table, the same with dates, and with short column names."""
    raw = read_wide_csv(spark, path)
    dated = shape.parse_date(raw)
    return {"raw": raw, "dated": dated, "short": shape.remove_suffix(dated)}


def load_named(spark: SparkSession, path: str) -> DataFrame:
    """Long closes with company names.  Long, because several tickers share a name."""
    return name_tickers(shape.wide_to_long(read_declared_csv(spark, path)))


def quality(short: DataFrame) -> dict[str, DataFrame | int]:
    """Duplicates and empty columns taken out, rows removed, companies left."""
    cleaned = shape.drop_empty_columns(agg.dedup_rows(short))
    return {"cleaned": cleaned, "removed": agg.rows_removed(short), "companies": len(cleaned.columns) - 1}


def coverage(dated: DataFrame) -> dict[str, DataFrame]:
    return {"span": agg.date_span(dated), "days": agg.days_with_data(dated)}


def statistics(short: DataFrame, alert_on: str = "UNI") -> dict[str, DataFrame]:
    """Annual figures, rolling alert, variation and quartiles, long and wide."""
    named = shape.rename_column(short, "Fecha", "Dia")
    long = shape.wide_to_long(named, "Dia")
    out = {
        "annual": agg.annual_stats(long),
        "annual_wide": agg.annual_stats_wide(named),
        "variation": agg.variation(long),
        "quartiles": agg.assign_quartiles(long),
        "quartiles_wide": agg.assign_quartiles_wide(named),
    }
    if alert_on in named.columns:
        out["deficiency"] = windows.deficiency_notice_wide(named, alert_on)
    return out


def store(raw: DataFrame, cleaned: DataFrame, url: str, properties: dict[str, str] | None = None,
          raw_table: str = "Datos2024", cleaned_table: str = "Datos2024_Tratados") -> None:
    store_raw_and_cleaned(raw, cleaned, url, raw_table, cleaned_table, properties)
