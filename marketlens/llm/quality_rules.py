"""Quality rules as a bitmask ledger; DataFrame functions only.

``ledger`` measures every document once and stores one failure bit per rule beside the measurements.  A policy is a named set
of rules, so a change of policy, or the question what one rule costs, needs no second look at the texts: ``kept`` is one
bitwise test and ``ablations`` one aggregate over the bits.  No step shuffles a text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, blank_words, grams

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rules in the order of their bits; each condition holds where a document fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "2 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
#: Rules by version of the policy; a version is never changed, only followed by another.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
}


def mask(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def _count_bytes(text: Column, chars: str) -> Column:
    """How often ASCII characters stand in a text: what the text loses without them."""
    return reduce(lambda a, b: a + b, [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars])


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside a run of ``WINDOW`` words that stands in the text more than once.

    ``runs`` are the hashes of all runs.  Equal runs meet by sorting (hash, place) within the document, which only texts that
    repeat a run need; a word that several runs cover counts once.  Each step is a column, so that no step is done anew for
    every element of the next.
    """
    repeats = F.size(F.array_distinct("runs")) < F.size("runs")
    placed = F.sort_array(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("placed", F.when(repeats, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    again = F.transform("placed", lambda x, j: F.when(
        F.get("placed", j - 1)["h"].eqNullSafe(x["h"]) | F.get("placed", j + 1)["h"].eqNullSafe(x["h"]), x["i"]
    ))
    df = df.withColumn("at", F.sort_array(F.filter(again, lambda i: i.isNotNull())))
    steps = F.transform("at", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("at", j + 1) - i, F.lit(WINDOW))))
    return df.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda a, b: a + b).cast("long")).drop("placed", "at")


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of every row of ``doc_id`` and ``text``, and ``fails``: bit ``i`` is set where rule ``i`` fails.

    A null text counts as empty: all measurements are 0, and ``few_words`` fails.  A null ``doc_id`` and repeated rows are
    kept as they are, a row each.  Other columns, whatever their names, are not read.  An empty table gives no rows.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = text.select("doc_id", "text", blank_words(F.col("text")).alias("words"), F.filter(
        F.split("text", "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0
    ).alias("lines"))
    measured = cut.select(
        "doc_id", "words", grams(F.col("words"), WINDOW).alias("runs"),
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - _count_bytes(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        _count_bytes(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    measured = _with_repeat_words(measured).drop("words", "runs")
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(0) for i, (_, condition) in enumerate(RULES)]
    return measured.withColumn("fails", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def kept(policy: str = "v1") -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("fails").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: ``rule, n_failed``, and ``n_only``, the documents that would come back without the rule.

    One aggregate over the bits: two counters a rule, whatever the number of documents.
    """
    own = F.col("fails").bitwiseAND(F.lit(mask(policy)))
    at = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    counts = [F.struct(
        F.lit(name).alias("rule"),
        F.count(F.when(own.bitwiseAND(F.lit(at[name])) != 0, 1)).alias("n_failed"),
        F.count(F.when(own == at[name], 1)).alias("n_only"),
    ) for name in POLICIES[policy]]
    return rows.agg(F.array(*counts).alias("rules")).select(F.inline("rules"))


def judge(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with ``base_failed`` and the policy's ``kept``."""
    return ledger(docs).select("*", (~kept("base")).alias("base_failed"), kept(policy).alias("kept"))


def oracle_sql(policy: str = "v1") -> str:
    names = dict(RULES)
    fails = " OR ".join(f"({names[name]})" for name in POLICIES[policy])
    base = " OR ".join(f"({names[name]})" for name in POLICIES["base"])
    bits = " + ".join(f"CASE WHEN {condition} THEN {1 << i} ELSE 0 END" for i, (_, condition) in enumerate(RULES))
    word = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}+') AS ws FROM documents),
l AS (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{word}')] AS ls FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + {WINDOW - 1}]) AS n FROM w, range(1, len(ws) - {WINDOW - 2}) r(i)),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM g, range(0, {WINDOW}) s(j) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN ws]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[{SYMBOLS}]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT *, ({bits})::BIGINT AS fails, ({base}) AS base_failed, NOT ({fails}) AS kept FROM m
"""
