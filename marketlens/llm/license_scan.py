"""License scan by diagonal voting; DataFrame functions only.

Every run of ``K`` words of a document is hashed and joined to the places where the same run stands in a template.  A hit at
document word ``p`` and template word ``q`` votes for the diagonal ``p - q``.  A phrase stands at word ``d`` exactly if all
its runs vote for the diagonal ``d``.  For longer license texts, diagonals at most ``GAP`` apart are merged, so that inserted
or missing words do not break a span.  A span is then verified: it counts if it holds ``COVER`` of the template's runs, each
of them once however many diagonals vote for it, so a text that only repeats a few template words gets no label.  The places
of a template that were met are kept as bits, so a diagonal is one row of fixed size.

The template table has a row per template word and comes from the lists below, so its broadcast has a fixed size.  Only hits
and one marker per document are shuffled, counted before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import alnum_words, grams

K = 2
GAP = 3
COVER = 0.6

# Phrases and labels of the task.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Openings of well-known license texts, in lower case without punctuation.
TEXTS = (
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
)


def templates(spark: SparkSession, phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """``gram``, ``template``, ``label``, ``is_base``, ``n_grams``, ``at``: a row per run of a template, and the marker's."""
    rows = [(i, label, i < len(phrases), text) for i, (text, label) in enumerate((*phrases, *texts))]
    df = spark.createDataFrame(rows, "template int, label string, is_base boolean, text string")
    runs = grams(F.split("text", " "), K)
    df = df.select("template", "label", "is_base", F.size(runs).alias("n_grams"), F.posexplode(runs).alias("at", "gram"))
    mark = spark.range(1).select(
        F.lit(-1).alias("template"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("is_base"),
        F.lit(0).alias("n_grams"), F.lit(0).alias("at"), _marker().alias("gram"),
    )
    return df.unionByName(mark)


def _marker() -> Column:
    return F.xxhash64(F.lit("a row for each document"))


def scan(docs: DataFrame, phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """A row per document of ``doc_id`` and ``text``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    A null text counts as empty: no words, no labels, score 0.  A null ``doc_id`` is kept.  Rows that repeat both ``doc_id``
    and ``text`` are judged together and come back as often as they stand in the table.  Other columns, whatever their names, are not read.  An empty table gives no rows.
    ``score`` is the best covered share of any template; 1 where a phrase stands whole.
    """
    spark = docs.sparkSession
    words = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), alnum_words(F.coalesce("text", F.lit(""))).alias("words"))
    runs = words.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), grams(F.col("words"), K).alias("runs"))
    hits = runs.select(
        "doc_id", "row", "n_words", F.posexplode(F.concat(F.array(_marker()), "runs")).alias("p", "gram")
    ).join(F.broadcast(templates(spark, phrases, texts)), "gram")
    keys = ["doc_id", "row", "n_words"]
    longest = max((len(t.split()) for t, _ in (*phrases, *texts)), default=K)
    met = [f"met{i}" for i in range(1 + longest // 64)]
    diagonals = hits.groupBy(
        *keys, "template", "label", "is_base", "n_grams", (F.col("p") - 1 - F.col("at")).cast("long").alias("diagonal")
    ).agg(F.count(F.lit(1)).alias("hits"), *[
        F.bit_or(F.when(F.floor(F.col("at") / 64) == i, F.expr("shiftleft(1L, at % 64)"))).alias(m) for i, m in enumerate(met)
    ])
    votes = sum((F.bit_count(F.coalesce(F.bit_or(m), F.lit(0).cast("long"))) for m in met), F.lit(0))
    # Neighbouring diagonals of one document and template make a span; a phrase stays on its own diagonal.
    near = Window.partitionBy("row", "doc_id", "template").orderBy("diagonal")
    starts = F.col("is_base") | (F.col("diagonal") - F.lag("diagonal").over(near) > GAP)
    spans = diagonals.withColumn("span", F.sum(F.coalesce(starts, F.lit(True)).cast("int")).over(near)).groupBy(
        *keys, "template", "label", "is_base", "n_grams", "span"
    ).agg(votes.alias("votes"), F.min("diagonal").alias("first"), F.sum("hits").alias("hits"))
    share = F.least(F.lit(1.0), F.col("votes") / F.greatest("n_grams", F.lit(1)))
    found = spans.withColumn("share", F.when(F.col("template") >= 0, share).otherwise(0.0))
    whole = F.col("is_base") & (F.col("votes") == F.col("n_grams"))
    kept = F.when(whole | (~F.col("is_base") & (F.col("share") >= COVER)), F.col("label"))
    return found.groupBy(*keys).agg(
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("first"))).alias("first_word"),
        F.max(F.when(whole, F.col("first"))).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(whole, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(kept))).alias("labels"),
        F.max(F.when(F.col("is_base") & ~whole, 0.0).otherwise(F.col("share"))).alias("score"),
        F.max(F.when(F.col("template") < 0, F.col("hits"))).alias("copies"),  # each row has hit the marker once
    ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("row", "copies", "copy")


def oracle_sql(phrases=PHRASES, texts=TEXTS) -> str:
    """The same in DuckDB, from the word lists themselves instead of hashes."""
    rows = ", ".join(
        f"({i}, '{label}', {str(i < len(phrases)).lower()}, string_split('{text}', ' '))"
        for i, (text, label) in enumerate((*phrases, *texts))
    )
    return f"""
WITH t(template, label, is_base, tw) AS (VALUES {rows}),
tg AS (SELECT template, label, is_base, len(tw) - 1 AS n, j - 1 AS q, tw[j] AS a, tw[j + 1] AS b FROM t, range(1, len(tw)) r(j)),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
g AS (SELECT doc_id, i - 1 AS p, ws[i] AS a, ws[i + 1] AS b FROM w, range(1, len(ws)) r(i)),
d AS (SELECT doc_id, template, label, is_base, n, p - q AS d, list(DISTINCT q) AS qs FROM g JOIN tg USING (a, b) GROUP BY ALL),
m AS (SELECT *, CASE WHEN is_base OR d - lag(d) OVER x > {GAP} OR lag(d) OVER x IS NULL THEN 1 ELSE 0 END AS s
      FROM d WINDOW x AS (PARTITION BY doc_id, template ORDER BY d)),
c AS (SELECT *, sum(s) OVER (PARTITION BY doc_id, template ORDER BY d) AS span FROM m),
v AS (SELECT doc_id, label, is_base, n, len(list_distinct(flatten(list(qs)))) AS v, min(d) AS first
      FROM c GROUP BY doc_id, template, label, is_base, n, span),
f AS (SELECT doc_id, label, is_base, v >= n AS whole, least(1.0, v::DOUBLE / n::DOUBLE) AS share, first FROM v),
r AS (SELECT doc_id, count(*) FILTER (is_base AND whole) AS n_base, min(first) FILTER (is_base AND whole) AS first_word,
        max(first) FILTER (is_base AND whole) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base AND whole) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER ((is_base AND whole) OR (NOT is_base AND share >= {COVER})) AS labels,
        max(CASE WHEN is_base AND NOT whole THEN 0.0 ELSE share END) AS score
      FROM f GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN r ON w.doc_id = r.doc_id
"""
