"""Phrases against a version that counts everything in memory, whatever the sample proposes."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_small_cases import ROWS, frame, same

from marketlens.llm import phrase_mining
from marketlens.llm.common import table


def brute_phrases(rows, least=10, covered=50, top=2000):
    count, total, out = collections.defaultdict(collections.Counter), collections.Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    count[lang][words[i:i + k]] += 1
    for lang, f in count.items():
        told = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            if any(100 * n >= covered * a and n >= least and phrase in (p[:2], p[1:]) for p, n in f.items() if len(p) == 3 and len(phrase) == 2):
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase)))
            told.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(told)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return out


def found(docs, **options):
    return [tuple(r) for r in phrase_mining.collocations(docs, **options).collect()]


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "straße", "A-B", "x|y", "#", "漢", "z z"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words[:rng.choice([3, 8, 19])]) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!"]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "de", None, ""]), text if i % 9 else None))
    return rows


@pytest.mark.parametrize("seed,sample", [(1, {}), (2, {"per_language": 3}), (3, {"per_language": 1, "seen": 4}), (4, {"seen": 10 ** 6}), (5, {"seen": 1, "per_language": 2})])
def test_random(spark, seed, sample):
    """Border failures of words and pairs: samples that propose everything, little, and nothing."""
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    same(found(docs, **sample), brute_phrases(rows))


def test_top_and_ties(spark):
    rows = [("en", " ".join(f"a{i} b{i}" for i in range(20)) + ".")] * 11 + [("en", "a a a a a a a a a a a a")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    expected = brute_phrases(rows, top=7)
    same(found(docs, top=7), expected)
    assert len(expected) == 7


def test_small_cases(spark):
    rows = [(r[0], r[1], "x" if n % 2 else None) for n, r in enumerate(ROWS)]
    docs = frame(spark).drop("lang").join(spark.createDataFrame([(0, "en")], "k int, lang string").drop("k"))
    same(found(docs), brute_phrases([("en", t) for _, t in ROWS]))
    assert found(frame(spark, [])) == [] and rows
    assert found(frame(spark, [(1, None), (2, ""), (3, "one two")])) == []


def test_long_text(spark):
    rows = [("en", "to be or not to be " * 300_000), (None, "é" * 100_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    same(found(docs), brute_phrases(rows))


def test_score_beyond_64_bits(spark):
    big = [(9 * 10 ** 15 + 7, 9 * 10 ** 15 + 9, 3 * 10 ** 16 + 1), (10 ** 12, 10 ** 12, 10 ** 12), (10, 11, 12), (4 * 10 ** 15, 9 * 10 ** 18, 9 * 10 ** 18)]
    rows = spark.createDataFrame(big, "a long, l long, r long").select("a", "l", "r", phrase_mining._score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    for x in rows.collect():
        assert x.s == 1_000_000 * x.a * x.a // (x.l * x.r)


def test_table(spark, sf):
    """A sample of four documents a language leaves most of the table to the later passes."""
    docs = table(spark, sf, "documents")
    rows = [(r.lang, r.text) for r in docs.collect()]
    same(found(docs, per_language=4), brute_phrases(rows))


@pytest.mark.parametrize("lang", ["en", "two\nlines", ""])
def test_full_pass_counts_numbers(lang):
    """Rare pairs and triples, most of what is shuffled, go without their words; what is frequent is spelled."""
    rng = random.Random(5)
    known = ["a", "é", "x|y", "#1", "z", "q"]
    pairs = [f"{a} {b}" for a in known for b in known if rng.random() < 0.5]
    told = pa.Table.from_pylist([{"lang": lang, "words": n, "phrase": p} for n, own in ((1, known), (2, pairs)) for p in own])
    texts = ["".join(rng.choice([*known, "new"]) + rng.choice([" ", " ", "\t", ", ", ".", "\n"]) for _ in range(rng.randrange(80))) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([lang] * 30 + ["other"] * 10), pa.array(texts)], names=["lang", "text"])
    proposed = phrase_mining.Proposals(told)
    rows = list(phrase_mining._count_numbered(iter([batch]), proposed))
    assert all(r["word"] is None or r["head"] == -1 and " " not in r["word"] for b in rows for r in b.to_pylist())
    expected = collections.Counter()
    for own, text in zip(batch["lang"].to_pylist(), texts):
        for piece in re.split(r"[.,\n]", text):
            words = piece.split()
            expected[own, 0, ""] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    w = words[i:i + k]
                    if k == 1 or own == lang and (set(w) <= set(known) if k == 2 else {f"{w[0]} {w[1]}", f"{w[1]} {w[2]}"} <= set(pairs)):
                        expected[own, k, " ".join(w)] += 1
    spelled = [tuple(r.values()) for b in phrase_mining._spelled(iter(rows), proposed) for r in b.to_pylist()]
    same(spelled, [(*k, n) for k, n in expected.items()])


def test_counts_of_many_distinct_words():
    """Three of 3 million words don't fit one number of 64 bits."""
    w, at = phrase_mining.Words(pa.array(["a b a b c a b a"], pa.large_string())), np.arange(6)
    expected = {"a b a": 2, "b a b": 1, "a b c": 1, "b c a": 1, "c a b": 1}
    for more in (0, 3_000_000):
        w.distinct = pa.concat_arrays([w.distinct, pa.array([f"w{i}" for i in range(more)], pa.large_string())])
        phrase, count = w.counts(3, at)
        assert dict(zip(phrase.to_pylist(), count.tolist())) == expected
