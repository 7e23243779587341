"""The suffix stage against a word-based brute force."""

import collections
import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from test_brute_force import brute_repeats
from test_small_cases import ROWS, frame, same

from marketlens.llm import suffix_dedup
from marketlens.llm.common import parked, table


def brute_passages(texts, length, least):
    """What is left without strings of ``length`` bytes and passages of ``least`` words that stand more than once."""
    words = {k: [m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", t)] for k, t in texts.items()}
    runs = {k: [tuple(texts[k][a:b] for a, b in w[i:i + least]) for i in range(len(w) - least + 1)] for k, w in words.items()}
    count = collections.Counter(r for own in runs.values() for r in own)
    strings = collections.Counter(t[i:i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for k, t in texts.items():
        kept = np.ones(len(t), bool)
        for i, r in enumerate(runs[k]):
            if count[r] > 1:
                kept[words[k][i][0]:words[k][i + least - 1][1]] = False
        for i in range(len(t) - length + 1):
            if strings[t[i:i + length]] > 1:
                kept[i:i + length] = False
        out[k] = bytes(np.frombuffer(t, np.uint8)[kept]).decode("utf-8", "ignore")
    return out


def test_short_passage_across_documents(spark):
    """60 words in fewer than 400 bytes leave both documents; 50 words stay."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    own = [" ".join(word() for _ in range(30)) for _ in range(6)]
    long, short = " ".join(word() for _ in range(60)), " ".join(word() for _ in range(50))
    rows = [(1, f"{own[0]} {long} {own[1]}"), (2, f"{own[2]} {long} {own[3]}"), (3, f"{own[4]} {short}"), (4, f"{short} {own[5]}")]
    left = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, frame(spark, rows), "").collect()}
    assert left == {1: f"{own[0]}  {own[1]}", 2: f"{own[2]}  {own[3]}", 3: rows[2][1], 4: rows[3][1]}


@pytest.mark.parametrize("length,least", [(60, 5), (400, 51)])
def test_passages(spark, length, least):
    rng = random.Random(length)
    texts = [t or "" for _, t in ROWS if t is None or len(t) < 5000] + ["a " * least, " ".join("b" * least), "b " * least]
    for n in range(40):
        own = [rng.choice(["é", "to", "x", "long"]) + str(rng.randrange(9)) for _ in range(2 * least)]
        passage = [f"p{i}" for i in range(3 * least)]
        cut = rng.randrange(2 * least)
        own[5:5] = passage[cut:cut + rng.randrange(least - 2, least + 9)] if n % 2 else []
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in own))
    rows = list(enumerate(texts))
    rest = brute_passages({i: t.encode() for i, t in rows}, length, least)
    assert rest != {i: r.decode("utf-8", "ignore") for i, (_, _, r) in brute_repeats({i: t.encode() for i, t in rows}, length).items()}
    found = suffix_dedup.remove(frame(spark, rows), length, least).collect()
    same([(r.doc_id, r.text) for r in found], [(i, rest[i]) for i, t in rows if rest[i] or not t])


def test_stage(spark, sf):
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = parked(stage(spark, docs, sf), name)
    before = {r.doc_id: r.text for r in docs.collect()}
    rest = brute_passages({i: (t or "").encode() for i, t in before.items()}, 400, 51)
    after = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, sf).collect()}
    assert after == {i: t for i, t in rest.items() if t or not before[i]}


def brute_elsewhere(texts, least):
    """(runs, bytes) of each text covered by passages of ``least`` words that stand in another text, too."""
    words = {k: [m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", t)] for k, t in texts.items()}
    runs = {k: [tuple(texts[k][a:b] for a, b in w[i:i + least]) for i in range(len(w) - least + 1)] for k, w in words.items()}
    holders = collections.Counter(r for own in runs.values() for r in set(own))
    out = {}
    for k, t in texts.items():
        told = np.zeros(len(t) + 1, np.int8)
        for i, r in enumerate(runs[k]):
            if holders[r] > 1:
                told[words[k][i][0]:words[k][i + least - 1][1]] = 1
        out[k] = (int((np.diff(np.append(0, told)) == 1).sum()), int(told.sum()))
    return out


@pytest.mark.parametrize("length,least", [(60, 5), (400, 51)])
def test_passage_columns(spark, length, least):
    """Passages that only their own document repeats don't count, those that another has do, wherever they stand."""
    rng = random.Random(length)
    texts = [t or "" for _, t in ROWS if t is None or len(t) < 5000] + ["a " * least, " ".join("b" * least), "b " * least, "c " * 4 * least]
    own = lambda n: [rng.choice(["é", "to", "x", "long"]) + str(rng.randrange(9)) for _ in range(n)]
    for n in range(40):
        text = own(2 * least)
        passage = [f"p{i}" for i in range(3 * least)]
        cut = rng.randrange(2 * least)
        text[5:5] = passage[cut:cut + rng.randrange(least - 2, least + 9)] if n % 2 else []
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in text))
    for n in range(6):  # twice in one document, with and without a part of it in another
        twice = [f"{n}q{i}" for i in range(least + 8)]
        texts.append(" ".join(own(9) + twice + own(9) + twice + own(9)))
        if n % 2:
            texts.append(" ".join(own(9) + twice[3:3 + least + n - 2] + own(9)))
    rows = list(enumerate(texts))
    expected = brute_elsewhere({i: t.encode() for i, t in rows}, least)
    found = {r.doc_id: (r.n_passages, r.n_passage_bytes) for r in suffix_dedup.report(frame(spark, rows).repartition(3), length, least).collect()}
    assert found == expected


def test_passage_columns_of_table(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    found = {r.doc_id: (r.n_passages, r.n_passage_bytes) for r in suffix_dedup.report(docs).collect()}
    assert found == brute_elsewhere(texts, 51)


def test_repeated_rows_hold_each_others_passages(spark):
    text = " ".join(f"w{i % 7}" for i in range(60))  # fewer than 400 bytes
    rows = [(1, text), (1, text), (2, "other")]
    found = collections.Counter((r.doc_id, r.n_removed, r.n_passages, r.n_passage_bytes) for r in suffix_dedup.report(frame(spark, rows)).collect())
    assert found == {(1, 0, 1, len(text)): 2, (2, 0, 0, 0): 1}


class Steps:
    """Instead of a table: the function that it would be mapped by."""

    def mapInArrow(self, function, schema):
        return function


def test_suffixes_are_named_many_texts_at_a_time():
    """A batch of a few rows for each text costs more than the names in it."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randrange(70, 120))) for _ in range(500)]
    data = [t.encode() for t in texts]
    runs = [[{"key": 2 * i, "start": a, "end": a + 40 + i % 9, "open": i % 2 == 0, "others": None} for a in (11, 3)] for i in range(len(texts))]
    kind = pa.list_(pa.struct([("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("open", pa.bool_()), ("others", pa.bool_())]))
    whole = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts), pa.array(runs, kind)], names=["row", "text", "runs"])
    named = list(suffix_dedup._name_suffixes(Steps(), 40, None)(iter([whole.slice(7)])))
    assert len(named) < 10
    found = pa.Table.from_batches(named).to_pylist()
    places = [(r["row"], r["key"], r["place"] & (1 << 32) - 1, r["place"] >> 32, r["open"], r["others"]) for r in found]
    same(places, [(i, 2 * i, a + j, 40, i % 2 == 0, None) for i in range(7, 500) for a in (11, 3) for j in range(i % 9 + 1)])
    string = {}
    for r, p in zip(found, places):
        assert string.setdefault(r["name"], data[p[0]][p[2]:p[2] + 40]) == data[p[0]][p[2]:p[2] + 40]
    assert len(string) == len(set(string.values()))


def test_strings_longer_than_a_step(spark):
    length = suffix_dedup.STEP + 5_000
    rng = np.random.default_rng(1)
    letters = lambda n: rng.integers(97, 123, n, np.uint8).tobytes().decode()
    shared = letters(length + 300)
    rows = [(1, letters(500) + shared + letters(90_000)), (2, shared[1:]), (3, letters(2 * length)), (4, "x" * 200_000)]
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.report(frame(spark, rows), length, 10 ** 5).collect()}
    assert found == {1: (length + 299, 1), 2: (length + 299, 1), 3: (0, 0), 4: (200_000, 1)}
