"""URL rules by a sort-merge range join.

A rule is a host and a path.  Its key is the host with its labels reversed, followed by a separator and the path: the urls it fits, on that
very host, are those whose key starts with the rule's, an interval of the key order.  A subdomain puts labels between host and
path, so a url gets one key for each of its host suffixes, up to as many labels as the longest rule host has.

Keys and rules are sorted together and swept once.  Intervals of prefixes nest or are disjoint, so the sweep keeps a stack of
the rules that hold at the place it has reached; its top is the longest one.  The key range is cut into buckets at sampled
(key, row) pairs, so even a url that a third of the rows share is spread, and a rule is sent to each bucket that its interval
meets.  Where the cuts lie only steers the load.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rules of the task, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Verdict where no rule fits: a url without a host is blocked, all others are allowed.
NO_HOST, NO_RULE = "block", "allow"
#: Sampled keys for each bucket border.
SAMPLES = 20

#: Stands between host and path in a key, below every letter, so that no label is a prefix of another.
SEP = "\x01"
_SWEPT = pa.schema([("row", pa.int64()), ("rule", pa.string()), ("verdict", pa.string()), ("size", pa.int32()), ("labels", pa.int32())])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _cuts(keys: DataFrame, n: int) -> list[tuple[str, int]]:
    """At most ``n - 1`` border pairs (key, row) from a sample of ``SAMPLES * n`` rows."""
    total = keys.count()
    every = max(1, total // (SAMPLES * n))
    sampled = sorted((r[0], r[1]) for r in keys.where(F.pmod(F.xxhash64("key", "row", F.lit("cut")), F.lit(every)) == 0).select("key", "row").collect())
    return [sampled[len(sampled) * i // n] for i in range(1, n)] if len(sampled) >= n else []


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (bucket, key, rules first): give each url key the longest rule that holds there."""
    stack: list[tuple[str, str, str]] = []
    bucket = None
    for batch in batches:
        out = []
        for b, key, is_url, row, rule, verdict in zip(*[c.to_pylist() for c in batch.columns]):
            if b != bucket:
                bucket, stack = b, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                stack.append((key, rule, verdict))
            elif stack:
                _, rule, verdict = stack[-1]
                out.append((row, rule, verdict, len(rule), rule.split("/", 1)[0].count(".")))
        columns = list(zip(*out)) or [()] * len(_SWEPT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SWEPT)], schema=_SWEPT)


def judge(pages: DataFrame, rules: DataFrame, buckets: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``page_id`` and ``url``.

    The longest rule, host and path together, decides; at equal length the longer host.  Equal rules with different verdicts
    block.  A null url, or one without ``://``, has an empty host and path and fits no rule.  Rules with a null host or path
    are ignored; host letters A-Z of a rule count as lower case.  Repeated pages are judged a row each.  Empty tables on
    either side are allowed, and other columns are not read.
    """
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("row", F.xxhash64("page_id", "host", "path"))
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        "verdict", F.translate("host", _UPPER, _LOWER).alias("host"), "path"
    )
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.select(
        F.concat(_reversed(F.split("host", r"\.")), F.lit(SEP), "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict",
        F.size(F.split("host", r"\.")).alias("depth"),
    )
    depth = rules.agg(F.max("depth")).first()[0] or 0

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth))), lambda n: F.concat(
        _reversed(F.slice(labels, -n, n)), F.lit(SEP), F.col("path")
    ))
    keys = urls.where((F.col("host") != "") & F.lit(depth > 0)).select("row", F.explode(suffixes).alias("key")).distinct()
    cuts = _cuts(keys, buckets)

    def deal_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column("key").to_pylist(), b.column("row").to_pylist())
            yield b.append_column("bucket", pa.array([bisect_right(cuts, pair) for pair in pairs], pa.int32()))

    def deal_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # From the bucket of the first pair (key, any row) to that of the last key with this prefix.
            reach = [range(bisect_right(cuts, (k,)), bisect_right(cuts, (k + chr(0x10FFFF), 0)) + 1) for k in b.column("key").to_pylist()]
            yield b.append_column("bucket", pa.array([list(r) for r in reach], pa.list_(pa.int32())))

    placed_urls = keys.mapInArrow(deal_urls, "row long, key string, bucket int")
    placed_rules = rules.select("key", "rule", "verdict").mapInArrow(deal_rules, "key string, rule string, verdict string, bucket array<int>")
    events = placed_urls.select(
        "bucket", "key", F.lit(True).alias("is_url"), "row", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    ).unionByName(placed_rules.select(
        F.explode("bucket").alias("bucket"), "key", F.lit(False).alias("is_url"), F.lit(0).cast("long").alias("row"), "rule", "verdict"
    ))
    swept = events.repartition(buckets, "bucket").sortWithinPartitions("bucket", "key", "is_url", "row").mapInArrow(
        _sweep, "row long, rule string, verdict string, size int, labels int"
    )
    best = swept.groupBy("row").agg(F.max(F.struct("size", "labels", "rule", "verdict")).alias("best"))
    default = F.when(F.col("host") == "", NO_HOST).otherwise(NO_RULE)
    return urls.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", default).alias("verdict")
    )


def oracle_sql(rules=RULES) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES {values}),
f AS (SELECT page_id, rhost || rpath AS rule, verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS n
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, path, rule,
  coalesce(verdict, CASE WHEN host = '' THEN '{NO_HOST}' ELSE '{NO_RULE}' END) AS verdict
FROM p LEFT JOIN f ON f.page_id = p.page_id AND n = 1
"""
