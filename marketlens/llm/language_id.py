"""Language identification: known words first, character n-grams for the others.

A known word gives each language its log frequency there.  A word that no language has seen falls back to its longest known
character n-grams, from ``LONGEST`` letters down to one.  Each word's scores are turned into shares that sum to one, and a
document belongs to the language with the largest sum of log shares over all its words.

The model is fitted on about ``DOCS_PER_LANGUAGE`` labelled documents of each language, a documented bound, and keeps all that
they hold, so its size has a bound too, whatever the size of the corpus.  Prediction reads every whole text once and shuffles
nothing.  Only the texts go to Python; there, equal words of some ``STEP`` bytes of texts meet in a dictionary and are scored
once, together.  Nothing is remembered from one step to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, give_back
from .prefix_hash import PrefixHash, mixed

DOCS_PER_LANGUAGE = 2_000
LONGEST = 5
UNKNOWN = "und"
#: Bytes of text that are handled at a time, unless a single text is longer; and unseen words.
STEP, WORDS_STEP = 500_000, 10_000

#: A word is a run of letters.
LETTERS = regex.compile(r"\p{L}+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that can be part of a letter.
_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


class Model:
    """Log shares by language: ``word_logs`` has a row for each of ``words``, ``gram_logs[n]`` one for each of ``gram_keys[n]``."""

    def __init__(self, languages: list[str], counts: pa.Table | None = None):
        """``counts``: columns ``lang, n, key, count``; ``n`` is 0 for words and the length of n-grams."""
        self.languages = languages
        self.words = pa.array([], pa.large_string())
        self.word_keys = np.zeros(0, np.uint64)
        self.word_logs = np.zeros((0, len(languages)), np.float32)
        self.gram_keys: dict[int, np.ndarray] = {}
        self.gram_logs: dict[int, np.ndarray] = {}
        for n in pc.unique(counts["n"]).to_pylist() if counts is not None else ():
            part = counts.filter(pc.equal(counts["n"], n))
            known = part["key"].combine_chunks().cast(pa.large_string()).dictionary_encode()
            lang = pc.index_in(part["lang"].combine_chunks(), value_set=pa.array(languages)).to_numpy()
            seen = np.zeros((len(known.dictionary), len(languages)))
            np.add.at(seen, (known.indices.to_numpy(), lang), part["count"].to_numpy())
            # Half an occurrence for what a language lacks, so that a score stays finite.
            logs = np.log((seen + 0.5) / (seen.sum(axis=0) + 0.5 * len(seen)))
            logs = (logs - np.logaddexp.reduce(logs, axis=1, keepdims=True)).astype(np.float32)
            if n == 0:
                keys = _word_keys(known.dictionary)
                order = np.argsort(keys)
                self.words, self.word_keys, self.word_logs = known.dictionary.take(pa.array(order)), keys[order], logs[order]
            else:
                keys = _gram_keys(_codes(known.dictionary.to_pylist()), n)[n][::n]
                order = np.argsort(keys)
                self.gram_keys[n], self.gram_logs[n] = keys[order], logs[order]

    def score(self, words: list[str]) -> np.ndarray:
        """Log shares of the languages, a row for each word in lower case; zeros if nothing of it is known."""
        out = np.zeros((len(words), len(self.languages)))
        at = self._places(pa.array(words, pa.large_string()))
        out[at >= 0] = self.word_logs[at[at >= 0]]
        rest = np.flatnonzero(at < 0)
        for a in range(0, len(rest), WORDS_STEP):
            part = rest[a:a + WORDS_STEP]
            out[part] = self._back_off([words[i] for i in part])
        return out

    def _places(self, words: pa.Array) -> np.ndarray:
        """The place of each word among the known ones, or -1."""
        out, keys = np.full(len(words), -1), _word_keys(words)
        at = np.searchsorted(self.word_keys, keys)
        open_ = np.arange(len(words))
        while len(open_):  # once, unless known words share a key
            open_ = open_[at[open_] < len(self.word_keys)]
            open_ = open_[self.word_keys[at[open_]] == keys[open_]]
            same = pc.equal(self.words.take(pa.array(at[open_])), words.take(pa.array(open_))).to_numpy(zero_copy_only=False)
            out[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
        return out

    def _back_off(self, words: list[str]) -> np.ndarray:
        """The mean over each word's longest known n-grams."""
        out = np.zeros((len(words), len(self.languages)))
        codes = _codes([f" {w} " for w in words])
        sizes = np.array([len(w) + 2 for w in words])
        end = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(words)), sizes)
        left = np.repeat(end, sizes) - np.arange(len(codes))  # characters up to the end of the word
        keys = _gram_keys(codes, LONGEST)
        waits = np.ones(len(words), bool)
        for n in sorted(self.gram_keys, reverse=True):
            i = np.flatnonzero((left >= n) & waits[owner])
            at = np.searchsorted(self.gram_keys[n], keys[n][i])
            at[at == len(self.gram_keys[n])] = 0
            hit = self.gram_keys[n][at] == keys[n][i]
            own, at = owner[i[hit]], at[hit]
            if len(own):
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                total = np.add.reduceat(self.gram_logs[n][at], first, axis=0, dtype=np.float64)
                out[own[first]] = total / np.diff(np.append(first, len(own)))[:, None]
                waits[own[first]] = False
        return out

    def guess(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + STEP, "right")))
            # Only these texts are copied, however many rows Spark hands over at once.
            total, n = self._totals(pc.utf8_lower(texts.slice(a, b - a).cast(pa.large_string()).fill_null("")))
            best = np.argmax(total, axis=1)  # ties: the first language by name
            scores[a:b] = np.where(n > 0, 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1), 0)
            names[a:b] = [self.languages[i] if known else UNKNOWN for i, known in zip(best, n)]
            a = b
        return names, scores

    def _totals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the scores of each text's words, and their number."""
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        total, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        if bounds[0] == bounds[-1]:
            return total, n
        buf = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        # Runs of what can be letters; only those beyond ASCII have to be looked at again.
        letter = _LETTER[buf]
        new = np.append(True, ~letter[:-1])
        new[bounds[:-1][bounds[:-1] < len(buf)]] = True
        start = np.flatnonzero(letter & new)
        packed = buf[letter]
        upto = np.append(np.cumsum(letter)[start] - 1, len(packed)).astype(np.int64)
        runs = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(upto), pa.py_buffer(packed)).dictionary_encode()
        words, owner = [], []
        for i, run in enumerate(runs.dictionary.to_pylist()):
            own = [run] if run.isascii() else LETTERS.findall(run)
            words += own
            owner += [i] * len(own)
        owner = np.array(owner, np.int64)
        score, count = np.zeros((len(runs.dictionary), len(self.languages))), np.bincount(owner, minlength=len(runs.dictionary))
        np.add.at(score, owner, self.score(words))
        place = runs.indices.to_numpy()
        cut = np.searchsorted(start, bounds)
        some = np.flatnonzero(cut[1:] > cut[:-1])
        if len(some):
            total[some] = np.add.reduceat(score[place], cut[some], axis=0)
            n[some] = np.add.reduceat(count[place], cut[some])
        return total, n


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)


def _word_keys(words: pa.Array) -> np.ndarray:
    """64-bit names of words."""
    out = np.zeros(len(words), np.uint64)
    for a in range(0, len(words), WORDS_STEP):
        part = words.slice(a, WORDS_STEP)
        _, offsets, data = part.buffers()
        bounds = np.frombuffer(offsets, np.int64)[part.offset:part.offset + len(part) + 1]
        if bounds[-1] > bounds[0]:
            hashes = PrefixHash(np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]])
            out[a:a + len(part)] = hashes.of(bounds[:-1] - bounds[0], bounds[1:] - bounds[0])
    return out


def _gram_keys(codes: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """64-bit names of the n-grams that begin at each character, by length; every character is mixed in on its own."""
    keys = {1: mixed(codes + _ODD)}
    for n in range(2, longest + 1):
        keys[n] = mixed(keys[n - 1][:max(0, len(codes) - n + 1)] * _ODD + codes[n - 1:])
    return keys


def held_out(doc_id: Column) -> Column:
    """One document in five, by its id, is never learned from; neither is one without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from ``text`` and non-null ``lang`` of documents that are not held out.

    Documents are drawn by a hash of id and text, with the same expected number for each language.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model([])
    spread = 1 << 30
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(spread, spread * docs_per_language // n))])
    drawn = usable.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(spread)) < share[F.col("lang")])

    words = drawn.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("key"))
    words = words.groupBy("lang", "key").count()
    marked = F.concat(F.lit(" "), F.col("key"), F.lit(" "))
    cuts = F.flatten(F.array(*[
        F.when(F.length(marked) >= n, F.transform(F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.struct(
            F.lit(n).alias("n"), F.substring(marked, i, F.lit(n)).alias("key")
        ))).otherwise(F.array().cast("array<struct<n:int,key:string>>"))
        for n in range(1, LONGEST + 1)
    ]))
    grams = words.select("lang", "count", F.explode(cuts).alias("gram")).groupBy("lang", "gram.n", "gram.key").agg(F.sum("count").alias("count"))
    counts = words.select("lang", F.lit(0).alias("n"), "key", "count").unionByName(grams)
    # What the drawn documents hold, whatever the size of the corpus.
    return Model(sorted(sizes), counts.toArrow())


def told(text: Column, model: Model, spark: SparkSession) -> Column:
    """Struct ``lang, score`` of a text.

    Not deterministic by declaration, or a filter on the result would be pushed below it and predict once more.
    """
    bound = spark.sparkContext.broadcast(model)

    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = bound.value.guess(texts)
            del texts
            give_back()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return F.arrow_udf(guess, "lang string, score double", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()(text)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``lang_score``, from ``text`` alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be learned.  The score is
    the posterior of the predicted language.  Ties go to the first language by name.  Repeated rows are kept.  Columns that
    already have one of the two names are replaced.
    """
    docs = docs.drop("lang_pred", "lang_score")
    own = fresh(docs, "told")
    return docs.withColumn(own, told(F.col("text"), model, docs.sparkSession)).select(
        *docs.columns, F.col(f"{own}.lang").alias("lang_pred"), F.col(f"{own}.score").alias("lang_score")
    )


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, with a model fitted on ``docs`` itself."""
    model = fit(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language can be told, with the columns of ``docs`` as they are, whatever their names."""
    own = fresh(docs, "told")
    marked = docs.withColumn(own, told(F.col("text"), fit(docs), docs.sparkSession))
    return marked.where((F.col(f"{own}.lang") != UNKNOWN) & (F.col(f"{own}.score") >= least)).drop(own)
