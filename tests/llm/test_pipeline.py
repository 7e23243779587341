"""Each stage of the pipeline on its own input, against a plain version of the stage."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_brute_force import brute_classes, brute_languages, brute_leaks
from test_passages import brute_passages
from test_small_cases import frame
from tokenizers import Tokenizer

from marketlens.llm.common import parked, table


def five(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The rows that go into each stage, and those of the last."""
    out = [table(spark, sf, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(parked(stage(spark, out[-1], sf), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(spark, sf, steps):
    for df in steps[:-1]:
        assert df.columns == table(spark, sf, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "suffix_dedup", "decontamination", "packing"]


def test_language_stage(spark, sf, steps):
    """Kept are those whose language has at least half of the posterior; the margin is that of single precision."""
    before, after = texts(steps[0]), texts(steps[1])
    assert after.items() <= before.items()
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang").collect()
    sure = {i: max(own.values()) for i, own in brute_languages(rows) if "und" not in own}
    assert {i for i, p in sure.items() if p >= 0.501} <= set(after) <= {i for i, p in sure.items() if p >= 0.499}


def test_near_copy_stage(steps):
    before, after = texts(steps[1]), texts(steps[2])
    top = brute_classes({i: five(t) for i, t in before.items()}, 80)
    assert set(after) == set(top.values()) and after.items() <= before.items()


def test_suffix_stage(steps):
    """Strings of 400 bytes and passages of over 50 words, the stage's own rule."""
    before, after = texts(steps[2]), texts(steps[3])
    rest = brute_passages({i: (t or "").encode() for i, t in before.items()}, 400, 51)
    assert after == {i: t for i, t in rest.items() if t or not before[i]}
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_leak_stage(spark, sf, steps):
    before, after = texts(steps[3]), texts(steps[4])
    leaked = brute_leaks(before, {r.item_id: r.text for r in table(spark, sf, "benchmark").collect()})
    assert after == {i: t for i, t in before.items() if i not in leaked}


def test_packing_stage(steps):
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*words.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts(steps[4]).items()}
    rows = sorted(steps[5].collect(), key=lambda r: (r.doc_id, r.start))
    at = dict.fromkeys(ids, 0)
    for r in rows:
        assert r.start == at[r.doc_id] and zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()}


def test_stages_take_odd_rows(spark, sf):
    """Nulls, repeats, long texts, clashing columns and an empty table pass through all stages."""
    for rows in (frame(spark), frame(spark, [])):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = parked(stage(spark, docs, sf), name)
        assert docs.columns[:3] == ["doc_id", "start", "length"]
