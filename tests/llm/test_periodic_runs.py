"""Runs of repeated words against a version that tries every start and period."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from test_small_cases import CLASHES, ROWS, frame, same

from marketlens.llm import periodic_runs, queries
from marketlens.llm.common import table


def brute_runs(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q):
                part = words[i:i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def brute_looped(doc_id, text):
    words = split(text)
    h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(split(text))
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute_report(doc_id, text):
    words = brute_looped(doc_id, text)
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{a},{b},{c}\n" for a, b, c in runs)), digest(brute_collapse(words, runs)),
    )


@pytest.mark.parametrize("seed", range(6))
def test_find_runs(seed):
    rng = random.Random(seed)
    texts = [[], [0], [0] * 5, [0] * 6, [0] * 40, [0, 1] * 4, [0, 1] * 3, [0, 1, 2] * 4 + [0], [0, 1, 2] * 4 + [1]]
    for _ in range(150):
        text = []
        while len(text) < rng.randrange(120):
            text += [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(1, 9))] * rng.choice([1, 1, 2, 3, 5, 9])
        texts.append(text)
    upto = np.append(0, np.cumsum([len(t) for t in texts]))
    start, length, period = periodic_runs.find_runs(np.array([w for t in texts for w in t], np.int64), upto)
    found = collections.defaultdict(list)
    for s, n, q in zip(start, length, period):
        i = int(np.searchsorted(upto, s, "right")) - 1
        found[i].append((int(s - upto[i]), int(n), int(q)))
    for i, t in enumerate(texts):
        assert found[i] == brute_runs(t), t


def test_report(spark):
    rows = ROWS + [(i, " ".join(random.Random(i).choice("abc") for _ in range(i))) for i in range(300)]
    rows += [(1000, "x " * 3000), (1001, "a b " * 500 + "c\n" * 7), (1002, "ä ß\tä ß\x0bä ß\x0cä ß\rä"), (1003, "           "), (1000, "x " * 3000)]
    rows = [r for r in rows if len(r[1] or "") < 100_000]
    found = periodic_runs.report(frame(spark, rows).repartition(3)).collect()
    same([tuple(r) for r in found], [brute_report(i, t) for i, t in rows])
    assert periodic_runs.report(frame(spark, [])).count() == 0


def test_long_text(spark):
    """A text longer than a step, with a run across its whole end."""
    words = [f"w{i}" for i in range(1 << 19)] + ["a", "b", "c"] * (1 << 17)
    docs = spark.createDataFrame([(None, " ".join(words))], "doc_id long, text string")
    (r,) = periodic_runs.detect(docs).collect()
    assert [tuple(x) for x in r.runs] == [(1 << 19, 3 << 17, 3)] and r.collapsed.endswith(" a b c") and r.collapsed.count(" ") == (1 << 19) + 2


def test_detect_keeps_columns(spark):
    docs = frame(spark)
    found = periodic_runs.detect(docs.withColumnRenamed("row", "runs"))
    assert found.columns == [c for c in ["doc_id", "text", "lang", "n_chars", *CLASHES] if c != "row"] + ["runs", "collapsed"]
    same([(r.doc_id, r.text) for r in found.collect()], ROWS)


def test_table(spark, sf):
    docs = table(spark, sf, "documents").collect()
    found = queries.QUERIES["op11_periodic_runs"](spark, sf).collect()
    expected = [brute_report(r.doc_id, r.text) for r in docs]
    same([tuple(r) for r in found], expected)
    assert sum(r[1] > 0 for r in expected) > len(docs) / 20
