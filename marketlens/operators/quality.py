"""Declarative data-quality suites.

All count, null, range and pair rules of a suite are compiled into one aggregate
over the table.  Uniqueness needs its own group-by.  Nulls never break a range,
pair or uniqueness rule, and a rule holds only if every row it looks at does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import without_nan
from marketlens.operators.filters import drop_incomplete
from marketlens.schemas import MEASURES, PRICES, quoted

# Rule names as they stand in suite files.
ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
PAIR = "expect_column_pair_values_a_to_be_greater_than_b"

KWARGS = "column string, column_A string, column_B string, min_value double, max_value double, or_equal boolean"
SUITE_SCHEMA = (
    "expectation_suite_name string, "
    f"expectations array<struct<expectation_type string, kwargs struct<{KWARGS}>>>"
)
RULE_SCHEMA = f"suite_name string, rule_no int, expectation_type string, {KWARGS}"


@dataclass(frozen=True)
class Rule:
    expectation_type: str
    column: str | None = None
    column_A: str | None = None
    column_B: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    or_equal: bool | None = None


def format_rules(date: str = "Date", price: str = "Close") -> list[Rule]:
    return [
        Rule(ROW_COUNT, min_value=1.0),
        Rule(NOT_NULL, column=date),
        Rule(NOT_NULL, column=price),
        Rule(BETWEEN, column=price, min_value=0.0),
        Rule(UNIQUE, column=date),
    ]


def business_rules(prefix: str = "") -> list[Rule]:
    """Nothing negative; high is the highest and low the lowest of the four prices."""
    name = {c: f"{prefix}{c}" for c in MEASURES}

    def at_least(a: str, b: str) -> Rule:
        return Rule(PAIR, column_A=name[a], column_B=name[b], or_equal=True)

    return [
        *[Rule(BETWEEN, column=name[c], min_value=0.0) for c in PRICES],
        at_least("High", "Low"),
        at_least("Open", "Low"),
        at_least("High", "Open"),
        at_least("Close", "Low"),
        at_least("High", "Close"),
        Rule(BETWEEN, column=name["Volume"], min_value=0.0),
    ]


# --- suites as tables ---------------------------------------------------------

def rules_table(spark: SparkSession, suites: dict[str, Sequence[Rule]]) -> DataFrame:
    rows = [(s, i, *asdict(r).values()) for s, rules in suites.items() for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def read_suites(spark: SparkSession, path: str) -> DataFrame:
    """Suite files (one JSON document each) as one row per rule."""
    files = spark.read.schema(SUITE_SCHEMA).option("multiLine", True).json(path)
    return files.select(
        F.col("expectation_suite_name").alias("suite_name"), F.posexplode("expectations").alias("rule_no", "rule")
    ).select("suite_name", "rule_no", "rule.expectation_type", "rule.kwargs.*")


def write_suites(rules: DataFrame, path: str) -> None:
    """The inverse of ``read_suites``."""
    kwargs = F.struct("column", "column_A", "column_B", "min_value", "max_value", "or_equal")
    rule = F.struct("rule_no", "expectation_type", kwargs.alias("kwargs"))
    ordered = F.transform(
        F.array_sort(F.collect_list(rule)),
        lambda r: F.struct(r["expectation_type"].alias("expectation_type"), r["kwargs"].alias("kwargs")),
    )
    (
        rules.groupBy(F.col("suite_name").alias("expectation_suite_name"))
        .agg(ordered.alias("expectations"))
        .write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
    )


def rules_of(rules: DataFrame, suite: str) -> list[Rule]:
    """The rules of one suite on the driver, where they are compiled into expressions."""
    rows = rules.filter(F.col("suite_name") == suite).orderBy("rule_no").drop("suite_name", "rule_no").collect()
    return [Rule(**r.asDict()) for r in rows]


# --- validation ---------------------------------------------------------------

def _measures(rule: Rule) -> tuple[Column, Column]:
    """Rows looked at, and rows among them that break the rule."""
    if rule.expectation_type == ROW_COUNT:
        n = F.count(F.lit(1))
        return n, F.when(_outside(n, rule), 1).otherwise(0).cast("bigint")
    if rule.expectation_type == NOT_NULL:
        return F.count(F.lit(1)), F.count_if(F.col(quoted(rule.column)).isNull())
    if rule.expectation_type == BETWEEN:
        x = F.col(quoted(rule.column))
        return F.count(x), F.count_if(_outside(x, rule))
    if rule.expectation_type == PAIR:
        a, b = F.col(quoted(rule.column_A)), F.col(quoted(rule.column_B))
        both = a.isNotNull() & b.isNotNull()
        return F.count_if(both), F.count_if((a < b) if rule.or_equal else (a <= b))
    raise ValueError(f"unknown rule {rule.expectation_type}")


def _outside(x: Column, rule: Rule) -> Column:
    sides = []
    if rule.min_value is not None:
        sides.append(x < rule.min_value)
    if rule.max_value is not None:
        sides.append(x > rule.max_value)
    return reduce(lambda a, b: a | b, sides, F.lit(False))


def _result(suite: str, no: int, rule: Rule, evaluated: Column, unexpected: Column) -> Column:
    given = {k: v for k, v in asdict(rule).items() if v is not None and k != "expectation_type"}
    kwargs = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in given.items()])) if given else F.lit("{}")
    return F.struct(
        F.lit(suite).alias("suite_name"),
        F.lit(no).alias("rule_no"),
        F.lit(rule.expectation_type).alias("expectation_type"),
        kwargs.alias("kwargs"),
        evaluated.alias("evaluated"),
        unexpected.alias("unexpected"),
        (unexpected == 0).alias("success"),
    )


def validate(df: DataFrame, suites: dict[str, Sequence[Rule]]) -> DataFrame:
    """One row per rule of every suite; all suites share one pass over the table.  NaN counts as missing."""
    df = df.select(*[without_nan(df, c).alias(c) for c in df.columns])
    numbered = [(s, i, r) for s, rules in suites.items() for i, r in enumerate(rules)]
    scalar = [(s, i, r) for s, i, r in numbered if r.expectation_type != UNIQUE]
    parts = []
    if scalar:
        counts = []
        for j, (_, _, rule) in enumerate(scalar):
            seen, bad = _measures(rule)
            counts += [seen.alias(f"e{j}"), bad.alias(f"u{j}")]
        results = F.array(*[
            _result(s, i, r, F.col(f"e{j}"), F.col(f"u{j}")) for j, (s, i, r) in enumerate(scalar)
        ])
        parts.append(df.agg(*counts).select(F.inline(results)))
    unique = [(s, i, r) for s, i, r in numbered if r.expectation_type == UNIQUE]
    if unique:
        # A grouping set a column: each row stands once for every rule, and copies are combined before the shuffle.
        named = sorted({r.column for _, _, r in unique})
        values = df.select(*[F.col(quoted(c)).alias(f"v{j}") for j, c in enumerate(named)])
        keys = [F.col(f"v{j}") for j in range(len(named))]
        copies = values.groupingSets([[k] for k in keys], *keys).agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
        all_set, counts = 2 ** len(named) - 1, []
        for j in range(len(named)):
            n = F.when((F.col("__set") == all_set - 2 ** (len(named) - 1 - j)) & F.col(f"v{j}").isNotNull(), F.col("__n"))
            counts += [
                F.coalesce(F.sum(n), F.lit(0)).alias(f"e{j}"),
                F.coalesce(F.sum(F.when(F.col("__n") > 1, n)), F.lit(0)).alias(f"u{j}"),
            ]
        at = {c: j for j, c in enumerate(named)}
        results = F.array(*[_result(s, i, r, F.col(f"e{at[r.column]}"), F.col(f"u{at[r.column]}")) for s, i, r in unique])
        parts.append(copies.agg(*counts).select(F.inline(results)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def clean_wide(df: DataFrame) -> DataFrame:
    """Full-row duplicates go, then rows with any gap."""
    return drop_incomplete(df.dropDuplicates())


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success"))


def failure_report(results: DataFrame) -> DataFrame:
    """One row per suite: verdict and the list of failed rules (as long as the suite)."""
    failed = F.struct("rule_no", "expectation_type", "kwargs")
    return results.groupBy("suite_name").agg(
        F.bool_and("success").alias("success"),
        F.array_sort(F.collect_list(F.when(~F.col("success"), failed))).alias("failed_expectations"),
    )


def summary(results: DataFrame) -> DataFrame:
    """Verdict per suite with a line of text that names the failed rules."""
    lines = F.transform(
        "failed_expectations", lambda r: F.concat(r["expectation_type"], F.lit(" "), r["kwargs"])
    )
    return failure_report(results).select(
        "suite_name",
        "success",
        F.size("failed_expectations").alias("failed"),
        F.array_join(lines, "; ").alias("details"),
    )
