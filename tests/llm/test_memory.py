"""What a Python worker holds beside the rows that Spark hands over, and that the steps it works in don't show in the results."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marketlens.llm import language_id, wordwise

WORDS = {"de": ["der", "hund", "läuft", "straße"], "en": ["the", "dog", "runs", "street"]}


def model():
    rows = [(lang, 0, w, 3) for lang, words in WORDS.items() for w in words]
    rows += [(lang, n, f" {w} "[i:i + n], 1) for lang, words in WORDS.items() for n in (1, 2, 3) for w in words for i in range(len(w) + 3 - n)]
    rows = list({row[:3]: row for row in rows}.values())
    return language_id.Model(sorted(WORDS), pa.table(dict(zip(("lang", "n", "key", "count"), map(list, zip(*rows))))))


def some_texts(n, seed=5):
    r = random.Random(seed)
    known = [w for words in WORDS.values() for w in words]
    return [None, "", "1 2", *(" ".join(r.choice([*known, "".join(r.choices("derunhst", k=5))]).title() for _ in range(r.randint(1, 30))) for _ in range(n))]


def test_language_lowers_a_step_of_texts_at_a_time(monkeypatch):
    """However large the batch is, beside it only the texts of one step are held."""
    texts = pa.array(["The dog RUNS " * 800] * 2_000)  # 20 MB
    held, before, totals = [], pa.total_allocated_bytes(), language_id.Model._totals

    def watched(self, step):
        held.append(pa.total_allocated_bytes() - before)
        return totals(self, step)

    monkeypatch.setattr(language_id.Model, "_totals", watched)
    names, _ = model().guess(texts)
    assert set(names) == {"en"} and len(held) > 2 and max(held) < 3 * language_id.STEP


def test_language_does_not_depend_on_steps(monkeypatch):
    texts = pa.array(some_texts(300))
    names, scores = model().guess(texts)
    monkeypatch.setattr(language_id, "STEP", 40)
    monkeypatch.setattr(language_id, "WORDS_STEP", 3)
    assert model().guess(texts)[0] == names and (model().guess(texts)[1] == scores).all()
    assert names[:3] == ["und"] * 3 and {"de", "en"} <= set(names)


def test_known_words_that_share_a_key_are_told_apart(monkeypatch):
    texts = pa.array(some_texts(300))
    names, scores = model().guess(texts)
    keys = language_id._word_keys
    monkeypatch.setattr(language_id, "_word_keys", lambda words: keys(words) % np.uint64(2))
    assert model().guess(texts)[0] == names and (model().guess(texts)[1] == scores).all()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokens_do_not_depend_on_parts(monkeypatch, name):
    r = random.Random(7)
    signs = ["a", "Bc", "é", "×", "ß", " ", "  ", "\n", "\t", "12", "'s", ".", "-", "語", " ", "ÿ", "’"]
    texts = [None, "", *("".join(r.choices(signs, k=r.randint(1, 60))) for _ in range(400)), ""]
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for part in (5, 64, wordwise.PART):
        monkeypatch.setattr(wordwise, "PART", part)
        assert [x.tolist() for x in wordwise.WordWise(public_tokenizers.path(name)).encode(pa.array(texts))] == expected


def test_a_step_of_tokens_needs_little_more_than_its_texts():
    """Numpy's share: less than a dozen bytes for each byte of text, the ids and the number of each piece included."""
    words = wordwise.WordWise(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array(["of the dogs, 12 run. " * 200] * 1_500, pa.large_string())  # 6 MB
    words.encode(texts.slice(0, 2))
    tracemalloc.start()
    try:
        words.encode(texts)
        assert tracemalloc.get_traced_memory()[1] < 12 * pa.compute.sum(pa.compute.binary_length(texts)).as_py()
    finally:
        tracemalloc.stop()
