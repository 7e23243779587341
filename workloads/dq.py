"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import projections, quality
from marketlens.operators.filters import clean_and_validate
from marketlens.plans.quality import validate_wide
from marketlens.schemas import quoted
from marketlens.session import scratch_path
from marketlens.sources import writers
from workloads.adapters import TYPES, bars_type, raw_bars, with_sql
from workloads.registry import query

FIELDS = ["Open", "High", "Low", "Close", "Volume"]


def _row(no: int, kind: str, kwargs: str, evaluated: str, unexpected: str, source: str, suite: str) -> str:
    return (
        f"SELECT '{suite}' AS suite_name, {no} AS rule_no, '{kind}' AS expectation_type, '{kwargs}' AS kwargs, "
        f"CAST({evaluated} AS BIGINT) AS evaluated, CAST({unexpected} AS BIGINT) AS unexpected, ({unexpected}) = 0 AS success FROM {source}"
    )


def rules_sql(suite: str, rules: list[quality.Rule], source: str) -> str:
    """Each rule counted by a query of its own."""
    parts = []
    for no, r in enumerate(rules):
        c, a, b = (f'"{x}"' if x else None for x in (r.column, r.column_A, r.column_B))
        low = f"{r.min_value:.1f}" if r.min_value is not None else None
        if r.expectation_type == quality.ROW_COUNT:
            made = (f'{{"min_value":{low}}}', "count(*)", f"CASE WHEN count(*) < {low} THEN 1 ELSE 0 END")
        elif r.expectation_type == quality.NOT_NULL:
            made = (f'{{"column":{c}}}', "count(*)", f"count(*) - count({c})")
        elif r.expectation_type == quality.BETWEEN:
            made = (f'{{"column":{c},"min_value":{low}}}', f"count({c})", f"count(*) FILTER ({c} < {low})")
        elif r.expectation_type == quality.UNIQUE:
            copies = f"(SELECT {c}, count(*) AS copies FROM {source} WHERE {c} IS NOT NULL GROUP BY 1)"
            made = (f'{{"column":{c}}}', f"(SELECT sum(copies) FROM {copies})",
                    f"(SELECT coalesce(sum(copies), 0) FROM {copies} WHERE copies > 1)")
            parts.append(_row(no, r.expectation_type, *made, "(SELECT 1)", suite))
            continue
        else:
            made = (f'{{"column_A":{a},"column_B":{b},"or_equal":true}}', f"count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)",
                    f"count(*) FILTER ({a} < {b})")
        parts.append(_row(no, r.expectation_type, *made, source, suite))
    return " UNION ALL ".join(parts)


def _register(name: str, rules: list[quality.Rule]) -> None:
    @query(name, with_sql(rules_sql("checks", rules, "raw_bars")))
    def run(spark, sf):
        return quality.validate(raw_bars(spark, sf), {"checks": rules})


_register("dq_row_count", [quality.Rule(quality.ROW_COUNT, min_value=1.0)])
_register("dq_not_null", [quality.Rule(quality.NOT_NULL, column=c) for c in ("Date", "Close", "Volume")])
_register("dq_between", [quality.Rule(quality.BETWEEN, column=c, min_value=0.0) for c in FIELDS])
_register("dq_unique", [quality.Rule(quality.UNIQUE, column=c) for c in ("Date", "Close")])
_register("dq_pair", [
    quality.Rule(quality.PAIR, column_A="High", column_B="Low", or_equal=True),
    quality.Rule(quality.PAIR, column_A="High", column_B="Close", or_equal=True),
])
_register("dq_format", quality.format_rules())
_register("dq_business", quality.business_rules())

SUITES = {"format": quality.format_rules(), "business": quality.business_rules()}
SUITES_SQL = " UNION ALL ".join(rules_sql(s, r, "raw_bars") for s, r in SUITES.items())


def _results(spark, sf):
    return quality.validate(raw_bars(spark, sf), SUITES)


@query("dq_failures", with_sql(f"SELECT * FROM ({SUITES_SQL}) WHERE NOT success"))
def dq_failures(spark, sf):
    return quality.failures(_results(spark, sf))


@query("dq_summary", with_sql(f"""
SELECT suite_name, bool_and(success) AS success, CAST(count(*) FILTER (NOT success) AS INTEGER) AS failed,
       coalesce(string_agg(expectation_type || ' ' || kwargs, '; ' ORDER BY rule_no) FILTER (NOT success), '') AS details
FROM ({SUITES_SQL}) GROUP BY 1"""))
def dq_summary(spark, sf):
    return quality.summary(_results(spark, sf))


@query("suite_rules", with_sql(f"SELECT * FROM ({SUITES_SQL})"))
def suite_rules(spark, sf):
    """Suites written as JSON files, read back, compiled and run."""
    path = scratch_path(spark, "suites")
    quality.write_suites(quality.rules_table(spark, SUITES), path)
    rules = quality.read_suites(spark, path)
    return quality.validate(raw_bars(spark, sf), {s: quality.rules_of(rules, s) for s in SUITES})


@query("dq_results_table", with_sql(
    f"SELECT * FROM ({rules_sql('business', SUITES['business'], 'raw_bars')} UNION ALL {rules_sql('format', SUITES['format'], 'valid_bars')})"))
def dq_results_table(spark, sf):
    """Results stored by suite; a second run of one suite replaces only its own rows."""
    path = scratch_path(spark, "dq-results")
    writers.write_replacing(_results(spark, sf), path, "suite_name")
    again = quality.validate(clean_and_validate(raw_bars(spark, sf)), {"format": SUITES["format"]})
    writers.write_replacing(again, path, "suite_name")
    return spark.read.schema(again.schema).parquet(path)


# --- wide OHLCV -------------------------------------------------------------------

WIDE_SQL = "wide AS (SELECT \"Date\", " + ", ".join(
    f"""max("{f}") FILTER ("Ticker" = '{t}') AS "{t}_{f}\"""" for t in TYPES for f in FIELDS) + " FROM bars_type GROUP BY 1)"


@query("wide_ohlcv", with_sql(f"WITH {WIDE_SQL} SELECT * FROM wide"))
def wide_ohlcv(spark, sf):
    return projections.wide_ohlcv(bars_type(spark, sf), TYPES)


@query("flatten_names", with_sql(f"WITH {WIDE_SQL} SELECT " + ", ".join(
    ['"Date"', *[f'"{t}_{f}" AS "{t}.MC_{f}"' for t in TYPES for f in FIELDS]]) + " FROM wide"))
def flatten_names(spark, sf):
    """Two-level labels with dots in them, flattened by hand."""
    bars = bars_type(spark, sf).withColumn("Ticker", F.concat("Ticker", F.lit(".MC")))
    wide = projections.wide_ohlcv(bars, [f"{t}.MC" for t in TYPES])
    labels = [("Date", "")] + [(f"{t}.MC", f) for t in TYPES for f in FIELDS]
    return wide.select(*[F.col(quoted(c)).alias(projections.flatten_name(n)) for c, n in zip(wide.columns, labels)])


@query("wide_to_long_ohlcv", with_sql("""
SELECT *, ("High" - "Low") / nullif("Open", 0) AS "RangeOpen", ("High" - "Low") / nullif("Low", 0) AS "RangeLow" FROM bars_type"""))
def wide_to_long_ohlcv(spark, sf):
    wide = projections.wide_ohlcv(bars_type(spark, sf), TYPES)
    return projections.range_features(projections.long_ohlcv(wide, TYPES))


@query("clean_wide", with_sql('SELECT DISTINCT * FROM raw_bars WHERE "Close" IS NOT NULL AND "Volume" IS NOT NULL'))
def clean_wide(spark, sf):
    return quality.clean_wide(raw_bars(spark, sf))


PREFIX = "view.MC_"
WIDE_SUITES = {
    "stocks_format_suite": quality.format_rules("Date", f"{PREFIX}Close"),
    "stocks_business_suite": quality.business_rules(PREFIX),
}
DOTTED_SQL = WIDE_SQL + ", dotted AS (SELECT DISTINCT " + ", ".join(
    ['"Date"', *[f'"{t}_{f}" AS "{t}.MC_{f}"' for t in TYPES for f in FIELDS]]
) + " FROM wide WHERE " + " AND ".join(f'"{t}_{f}" IS NOT NULL' for t in TYPES for f in FIELDS) + ")"


@query("dq_report", with_sql(f"WITH {DOTTED_SQL} SELECT * FROM (" + " UNION ALL ".join(
    rules_sql(s, r, "dotted") for s, r in WIDE_SUITES.items()) + ")"))
def dq_report(spark, sf):
    """The whole quality run: widen, clean, both suites."""
    bars = bars_type(spark, sf).withColumn("Ticker", F.concat("Ticker", F.lit(".MC")))
    return validate_wide(bars, [f"{t}.MC" for t in TYPES], "view.MC")["results"]
