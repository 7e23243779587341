"""The whole quality run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from marketlens.operators import quality
from marketlens.operators.projections import wide_ohlcv

# Suite names.
FORMAT_SUITE = "stocks_format_suite"
BUSINESS_SUITE = "stocks_business_suite"


def validate_wide(bars: DataFrame, tickers: Sequence[str], checked: str) -> dict[str, DataFrame]:
    """Widen, clean, then run the format and business suites on the columns of one ticker."""
    clean = quality.clean_wide(wide_ohlcv(bars, tickers))
    results = quality.validate(clean, {
        FORMAT_SUITE: quality.format_rules("Date", f"{checked}_Close"),
        BUSINESS_SUITE: quality.business_rules(f"{checked}_"),
    })
    return {
        "clean": clean,
        "results": results,
        "failures": quality.failures(results),
        "report": quality.failure_report(results),
        "summary": quality.summary(results),
    }
