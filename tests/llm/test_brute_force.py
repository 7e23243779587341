"""Each operator against a plain version of itself over whole tables."""

import collections
import functools
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.compute as pc
import pytest
import regex
from tokenizers import Tokenizer

from marketlens.llm import queries
from marketlens.llm.common import table


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}


def run(spark, sf, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, sf).collect()]


def brute_classes(sets, percent):
    """Smallest id of each class, by comparing all pairs."""
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in ids}


def shingles(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_jaccard(spark, sf, docs):
    sets = {i: shingles(t, 4) for i, t in docs.items()}
    expected = brute_classes(sets, 85)
    found = run(spark, sf, "op1_ngram_jaccard")
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(s) for i, s in sets.items()}


def test_packing(spark, sf, docs):
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*words.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in docs.items()}
    rows = run(spark, sf, "op4_packing")
    covered, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        covered[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in ids.items():
        at = 0
        for start, length in sorted(covered[i]):
            assert start == at and length > 0
            at += length
        assert at == len(own)
    padded = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and len(pieces) <= 256
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    assert padded < 0.01 * sum(map(len, ids.values()))


def test_token_files(spark, sf, docs):
    words = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, expected = 0, {}
    for i in sorted(docs):
        ids = np.array([*words.encode(docs[i], add_special_tokens=False).ids, 0], "<u4")
        expected[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, sf, "op5_token_files")} == expected


def brute_repeats(texts, length):
    """(n_removed, n_spans, rest) of each text."""
    count = collections.Counter(t[i:i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for k, t in texts.items():
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[k] = (int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


def test_suffix_dedup(spark, sf, docs):
    texts = {i: t.encode() for i, t in docs.items()}
    expected = {i: (len(texts[i]), n, s, hashlib.sha256(rest).hexdigest()) for i, (n, s, rest) in brute_repeats(texts, 400).items()}
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in run(spark, sf, "op7_suffix_dedup")}
    assert found == expected


def alnum(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())


def weighted(words, k=5):
    k = min(k, len(words))
    return collections.Counter(" ".join(words[i:i + k]) for i in range(len(words) - k + 1)) if words else collections.Counter()


def brute_leaks(texts, items):
    out = collections.defaultdict(set)
    for j, item in items.items():
        want = alnum(item)
        theirs = weighted(want)
        for i, t in texts.items():
            words = alnum(t)
            for a in range(max(1, len(words) - len(want) + 1)):
                ours = weighted(words[a:a + len(want)])
                if not (ours.keys() & theirs.keys()):
                    continue
                shared = sum(min(n, theirs[s]) * len(s) for s, n in ours.items())
                whole = sum(max(ours[s], theirs[s]) * len(s) for s in ours.keys() | theirs.keys())
                if 100 * shared >= 80 * whole:
                    out[i].add(j)
    return out


def test_decontamination(spark, sf, docs):
    items = {r.item_id: r.text for r in table(spark, sf, "benchmark").collect()}
    expected = brute_leaks(docs, items)
    assert expected
    found = run(spark, sf, "op8_decontamination")
    assert {r["doc_id"]: r["items"] for r in found if r["contaminated"]} == {
        i: ",".join(map(str, sorted(x))) for i, x in expected.items()
    }
    assert len(found) == len(docs)


def test_language_accuracy(spark, sf):
    lang = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    rows = run(spark, sf, "op6_language_id")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]  # refusing to answer is an error, too
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(lang)


def brute_languages(rows):
    """Label and posterior of every text, word by word; ``rows`` are (doc_id, text, lang)."""
    letters = lambda t: regex.findall(r"\p{L}+", pc.utf8_lower(t or "").as_py())
    seen = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    langs = set()
    for i, text, lang in rows:
        if lang is not None and text is not None and i is not None and zlib.crc32(str(i).encode()) % 5:
            langs.add(lang)
            for w in letters(text):
                seen[0][w][lang] += 1
                for n in range(1, 6):
                    for a in range(len(w) + 3 - n):
                        seen[n][f" {w} "[a:a + n]][lang] += 1
    langs = sorted(langs)
    sums = {n: {x: sum(c[x] for c in keys.values()) for x in langs} for n, keys in seen.items()}

    def shares(n, key):
        logs = np.array([math.log((seen[n][key][x] + 0.5) / (sums[n][x] + 0.5 * len(seen[n]))) for x in langs])
        return logs - math.log(sum(math.exp(v) for v in logs))

    def word(w):
        if w in seen[0]:
            return shares(0, w)
        for n in range(5, 0, -1):
            known = [g for g in (f" {w} "[a:a + n] for a in range(len(w) + 3 - n)) if g in seen[n]]
            if known:
                return np.mean([shares(n, g) for g in known], axis=0)
        return np.zeros(len(langs))

    word = functools.cache(word)
    out = []
    for i, text, _ in rows:
        words = letters(text)
        if not words or not langs:
            out.append((i, {"und": 0.0}))
            continue
        total = sum(word(w) for w in words)
        with np.errstate(over="ignore"):
            out.append((i, dict(zip(langs, 1 / np.exp(total[None, :] - total[:, None]).sum(axis=1)))))
    return out


def test_languages(spark, sf):
    """Every document's label and score; texts that are held out fall back to n-grams for their own words."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    expected = dict(brute_languages(docs))
    for r in run(spark, sf, "op6_language_id"):
        own = expected[r["doc_id"]]
        assert own[r["lang_pred"]] >= max(own.values()) - 1e-3 and abs(own[r["lang_pred"]] - r["score"]) < 1e-3
