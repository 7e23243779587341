"""Collocations by Toivonen's mining: a sample proposes phrases, a full pass counts them together with their negative border.

Everything is per language.  A phrase of more than one word can only be frequent if all its parts are.

1. *Sample.*  About ``DOCS_PER_LANGUAGE`` documents of each language, a documented bound, propose the words and pairs that they
   hold ``SEEN`` times or more.  The proposals are as bounded as the sample, so all tasks have them.
2. *Full pass.*  Counted exactly: all words (proposed, or border: a word has no smaller part), all pairs of proposed words
   (proposed or border), and all triples of two proposed pairs (proposed or border).
3. *Border failures* are frequent phrases that were not proposed.  Frequent words that were not make a second pass count the
   pairs of frequent words that hold one; frequent pairs that were not make a third count the triples of frequent pairs that
   hold one.  Then nothing frequent is left to count, since phrases have ``LONGEST`` words at most.  A pass is left out where
   there is no failure.

What a pass counts depends on the phrase alone, so a count is the whole count or there is none.  The frequent phrases may be
too many for every task to know, so the later passes ask a bitmap of bounded size that may let others through; those cost
time and fail the threshold like any other.  All tasks know what was proposed, so the full pass counts its pairs and triples by
numbers, and only frequent ones are spelled.  Texts are counted some ``STEP`` bytes at a time, where equal phrases become one row,
and Spark adds these up, before and after the shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parked
from .prefix_hash import mixed
from .spans import by_size, bytes_of, stretches

#: A candidate occurs so often; a longer one that holds it and has so many hundredths of its count replaces it.
LEAST, COVERED = 10, 50
#: Phrases told for each language.
TOP = 2_000
LONGEST = 3
DOCS_PER_LANGUAGE, SEEN = 2_000, 2
UNKNOWN = "und"
#: Bytes of text counted at a time, unless a single text is longer; and rows handed on at a time.
STEP, ROWS = 4_000_000, 1 << 16
#: Of the bitmap of frequent phrases: 64 a row, 2 ** 20 rows at most.
FILTER_BITS = 1 << 26
#: Parts of a language that are ranked on their own first.
PARTS = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
_INSIDE = ~_ENDS
_INSIDE[[9, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SCHEMA = "lang string, words int, phrase string, count long"
_ARROW = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("count", pa.int64())])
NUMBERED = "head long, rest long, word string, count long"
_NUMBERED = pa.schema([("head", pa.int64()), ("rest", pa.int64()), ("word", pa.string()), ("count", pa.int64())])
#: Bits of a word's rank.
_RANK = 32


class Proposals:
    """The words of each language that the sample proposes, and its pairs as sorted numbers."""

    def __init__(self, told: pa.Table):
        self.words: dict[str, pa.Array] = {}
        self.pairs: dict[str, np.ndarray] = {}
        for lang in pc.unique(told["lang"]).to_pylist():
            own = told.filter(pc.equal(told["lang"], lang))
            one, two = (own.filter(pc.equal(own["words"], n))["phrase"].combine_chunks().cast(pa.large_string()) for n in (1, 2))
            self.words[lang] = one
            sides = pc.split_pattern(two, " ").flatten()
            at = pc.index_in(sides, value_set=one).to_numpy().astype(np.int64).reshape(-1, 2)
            self.pairs[lang] = np.sort(at[:, 0] * len(one) + at[:, 1])


class Words:
    """The words of some texts of one language: ``ids`` into ``distinct``, and whether the next one belongs to the same piece."""

    def __init__(self, texts: pa.Array):
        buf, bounds = bytes_of(texts)
        buf = _LOWER[buf]
        inside = _INSIDE[buf]
        start, end, upto = stretches(inside, bounds)
        places = np.append(0, np.cumsum(end - start)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(buf[inside])).dictionary_encode()
        self.distinct, self.ids = words.dictionary, words.indices.to_numpy().astype(np.int64)
        self.goes_on = np.ones(len(start), bool)
        for after in (upto[1:], np.searchsorted(start, np.flatnonzero(_ENDS[buf]))):  # the words before an end of a text or piece
            self.goes_on[after[after > 0] - 1] = False

    def rank(self, known: pa.Array) -> np.ndarray:
        """The place of each distinct word among the known ones, or -1."""
        return pc.fill_null(pc.index_in(self.distinct, value_set=known), -1).to_numpy().astype(np.int64)

    def hashes(self) -> np.ndarray:
        return _word_hashes(self.distinct)

    def counts(self, words: int, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """How often each phrase of so many words begins at the places ``at``."""
        base = max(1, len(self.distinct))
        code = self.ids[at]
        if base ** words < 1 << 63:
            for i in range(1, words):
                code = code * base + self.ids[at + i]
            code, count = np.unique(code, return_counts=True)
            ids = []
            for _ in range(words):
                code, last = np.divmod(code, base)
                ids.insert(0, last)
        else:  # a single text of millions of words
            for i in range(1, words):
                if i > 1:
                    _, code = np.unique(code, return_inverse=True)
                code = code * base + self.ids[at + i]
            _, first, count = np.unique(code, return_index=True, return_counts=True)
            ids = [self.ids[at[first] + i] for i in range(words)]
        parts = [self.distinct.take(pa.array(i)) for i in ids]
        phrase = parts[0] if words == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return phrase, count


def _word_hashes(words: pa.Array) -> np.ndarray:
    return mixed(np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.uint64, len(words)) + _ODD)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * _ODD + b)


class Bitmap:
    """Phrases by hash; tells for sure what is not among them."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes % np.uint64(FILTER_BITS)
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(phrases: DataFrame, words: int) -> Bitmap:
    """Of the phrases ``lang, phrase`` of so many words: ``FILTER_BITS`` bits, whatever their number."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = pc.split_pattern(b.column("phrase"), " ").flatten()
            hashes = _word_hashes(sides).reshape(-1, words)
            total = _word_hashes(b.column("lang"))
            for i in range(words):
                total = _joined(total, hashes[:, i])
            at = total % np.uint64(FILTER_BITS)
            yield pa.RecordBatch.from_arrays([
                pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))
            ], names=["place", "bits"])

    rows = phrases.where(F.col("words") == words).select("lang", "phrase").mapInArrow(place, "place long, bits long")
    rows = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bitmap(bits)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Some ``STEP`` bytes of texts at a time, by language."""
    for batch in batches:
        langs, a = batch.column("lang"), 0
        for texts in by_size(batch.column("text"), STEP):
            own = langs.slice(a, len(texts))
            a += len(texts)
            for lang in pc.unique(own).to_pylist():
                yield lang, Words(texts.filter(pc.equal(own, lang)).cast(pa.large_string()))


def _count(docs: DataFrame, tell) -> DataFrame:
    """``lang, words, phrase, count``, summed; ``tell(lang, Words)`` gives (words, phrases, counts)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, w in _steps(batches):
            for words, phrases, counts in tell(lang, w):
                for lo in range(0, len(counts), ROWS):
                    n = min(ROWS, len(counts) - lo)
                    yield pa.RecordBatch.from_arrays([
                        pa.repeat(lang, n), pa.repeat(pa.scalar(words, pa.int32()), n),
                        phrases.slice(lo, n).cast(pa.string()), pa.array(counts[lo:lo + n].astype(np.int64)),
                    ], schema=_ARROW)

    return docs.mapInArrow(count, SCHEMA).groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))


def _places(proposed: Proposals, lang: str, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of the words among the proposed, where a pair of them begins, their pair as a number, and for each word the rank of
    its pair among the proposed pairs; -1 for what was not proposed.
    """
    known = proposed.words.get(lang, pa.array([], pa.large_string()))
    rank = w.rank(known)[w.ids]
    pair = np.flatnonzero(w.goes_on & (rank >= 0) & (np.append(rank[1:], -1) >= 0))
    pairs = proposed.pairs.get(lang, np.empty(0, np.int64))
    code = rank[pair] * len(known) + rank[pair + 1]
    at = np.searchsorted(pairs, code)
    at[at == len(pairs)] = 0
    pair_rank = np.full(len(w.ids), -1, np.int64)
    if len(pairs):
        pair_rank[pair] = np.where(pairs[at] == code, at, -1)
    return rank, pair, code, pair_rank


def _count_numbered(batches: Iterator[pa.RecordBatch], proposed: Proposals) -> Iterator[pa.RecordBatch]:
    """Counts of all words, and of the pairs and triples of what was proposed, in rows ``head, rest, word, count``.

    Pairs and triples are many, most of them rare, and their words are all proposed: ``head`` is the language's and the first word's
    rank, ``rest`` the second's and one more than the third's, 0 in a pair.  Other rows have -1 there, and in ``word`` the
    language and, after a line feed, the word, or nothing for the count of all words.
    """
    number = {lang: i for i, lang in enumerate(proposed.words)}

    def rows(head: np.ndarray, rest: np.ndarray, word: pa.Array | None, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(counts), ROWS):
            part = slice(lo, min(lo + ROWS, len(counts)))
            n = part.stop - lo
            yield pa.RecordBatch.from_arrays([
                pa.array(head[part]), pa.array(rest[part]), pa.nulls(n, pa.string()) if word is None else word.slice(lo, n).cast(pa.string()),
                pa.array(counts[part].astype(np.int64)),
            ], schema=_NUMBERED)

    for lang, w in _steps(batches):
        words, counts = w.counts(1, np.arange(len(w.ids)))
        words = pc.binary_join_element_wise(pa.scalar(lang, pa.large_string()), pa.concat_arrays([words, pa.array([""], pa.large_string())]), pa.scalar("\n", pa.large_string()))
        none = np.full(len(words), -1, np.int64)
        yield from rows(none, none, words, np.append(counts, len(w.ids)))
        if lang not in number:
            continue
        _, _, code, pair_rank = _places(proposed, lang, w)
        base, head = len(proposed.words[lang]), number[lang] << _RANK
        code, counts = np.unique(code, return_counts=True)
        yield from rows(head | code // max(1, base), code % max(1, base) << _RANK, None, counts)
        at = np.flatnonzero((pair_rank[:-1] >= 0) & (pair_rank[1:] >= 0))
        pairs = proposed.pairs[lang]
        code, counts = np.unique(pair_rank[at] * base + pairs[pair_rank[at + 1]] % max(1, base), return_counts=True)
        pair, third = pairs[code // max(1, base)], code % max(1, base)
        yield from rows(head | pair // max(1, base), (pair % max(1, base) << _RANK) | (third + 1), None, counts)


def _spelled(batches: Iterator[pa.RecordBatch], proposed: Proposals) -> Iterator[pa.RecordBatch]:
    """``lang, words, phrase, count`` of such rows."""
    langs, low = list(proposed.words), (1 << _RANK) - 1
    for b in batches:
        head, rest = b.column("head").to_numpy(), b.column("rest").to_numpy()
        own = b.filter(pa.array(head < 0))
        told = [text.rpartition("\n") for text in own.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([t[0] for t in told], pa.string()), pa.array([int(t[2] != "") for t in told], pa.int32()), pa.array([t[2] for t in told], pa.string()), own.column("count")
        ], schema=_ARROW)
        for i in np.unique(head[head >= 0] >> _RANK):
            for words in (2, 3):
                at = np.flatnonzero((head >> _RANK == i) & ((rest & low > 0) == (words == 3)))
                ranks = [head[at] & low, rest[at] >> _RANK, (rest[at] & low) - 1][:words]
                parts = [proposed.words[langs[i]].take(pa.array(r)) for r in ranks]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(langs[i], len(at)), pa.repeat(pa.scalar(words, pa.int32()), len(at)), phrase, b.column("count").take(pa.array(at))
                ], schema=_ARROW)


def _propose(docs: DataFrame, per_language: int, seen: int) -> Proposals:
    sizes = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}  # as many as languages
    spread = 1 << 30
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(spread, spread * per_language // n))]) if sizes else None
    drawn = docs.where(F.pmod(F.xxhash64("text"), F.lit(spread)) < share[F.col("lang")]) if sizes else docs

    def tell(lang: str, w: Words):
        yield 1, *w.counts(1, np.arange(len(w.ids)))
        yield 2, *w.counts(2, np.flatnonzero(w.goes_on))

    return Proposals(_count(drawn, tell).where(F.col("count") >= seen).select("lang", "words", "phrase").toArrow())


def frequent(docs: DataFrame, least: int = LEAST, per_language: int = DOCS_PER_LANGUAGE, seen: int = SEEN) -> tuple[DataFrame, DataFrame]:
    """Tables ``lang, words, phrase, count`` of all phrases of 1 to 3 words that occur ``least`` times, and ``lang, n`` of all words.

    ``docs`` has ``lang`` and ``text`` without nulls.  The sample steers which pass counts a phrase and not the result.
    """
    spark = docs.sparkSession
    proposed = spark.sparkContext.broadcast(_propose(docs, per_language, seen))

    counted = docs.mapInArrow(lambda batches: _count_numbered(batches, proposed.value), NUMBERED)
    counted = counted.groupBy("head", "rest", "word").agg(F.sum("count").alias("count"))
    counted = counted.where((F.col("count") >= least) | F.endswith("word", F.lit("\n")))
    found = parked(counted.mapInArrow(lambda batches: _spelled(batches, proposed.value), SCHEMA), "phrases")
    if _failures(found, 1, proposed):
        shared_words = spark.sparkContext.broadcast(_bitmap(found, 1))

        def pairs(lang: str, w: Words):
            rank = _places(proposed.value, lang, w)[0]
            base = np.repeat(_word_hashes(pa.array([lang])), len(w.distinct))
            ok = shared_words.value.holds(_joined(base, w.hashes()))[w.ids]
            both = w.goes_on & ok & np.append(ok[1:], False)
            yield 2, *w.counts(2, np.flatnonzero(both & ((rank < 0) | (np.append(rank[1:], -1) < 0))))

        found = found.unionByName(parked(_count(docs, pairs).where(F.col("count") >= least), "pairs"))
    if _failures(found, 2, proposed):
        shared_pairs = spark.sparkContext.broadcast(_bitmap(found, 2))

        def triples(lang: str, w: Words):
            proposed_pair = _places(proposed.value, lang, w)[3] >= 0
            base = np.repeat(_word_hashes(pa.array([lang])), len(w.distinct))
            hashes = w.hashes()
            one, two = _joined(base, hashes)[w.ids], hashes[w.ids]
            ok = w.goes_on.copy()
            ok[:-1] &= shared_pairs.value.holds(_joined(one[:-1], two[1:]))
            yield 3, *w.counts(3, np.flatnonzero(ok[:-1] & ok[1:] & ~(proposed_pair[:-1] & proposed_pair[1:])))

        found = found.unionByName(parked(_count(docs, triples).where(F.col("count") >= least), "triples"))
    totals = found.where("words = 0").select("lang", F.col("count").alias("n"))
    return found.where("words > 0"), totals


def _failures(found: DataFrame, words: int, proposed) -> bool:
    """Whether some frequent phrase was not proposed."""
    def missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang in pc.unique(b.column("lang")).to_pylist():
                phrases = b.filter(pc.equal(b.column("lang"), lang)).column("phrase").cast(pa.large_string())
                known = proposed.value.words.get(lang, pa.array([], pa.large_string()))
                at = pc.fill_null(pc.index_in(pc.split_pattern(phrases, " ").flatten(), value_set=known), -1).to_numpy().astype(np.int64).reshape(-1, words)
                seen = (at >= 0).all(axis=1)
                if words == 2:
                    seen &= np.isin(at[:, 0] * len(known) + at[:, 1], proposed.value.pairs.get(lang, np.empty(0, np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([int((~seen).sum())])], names=["missed"])

    rows = found.where(F.col("words") == words).select("lang", "phrase").mapInArrow(missed, "missed long")
    return bool(rows.agg(F.sum("missed")).first()[0])


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits, enough for counts of 9e15; at most 1000000, as no part is rarer."""
    whole = lambda x: x.cast("decimal(19,0)")
    return F.call_function("div", whole(a) * whole(a) * F.lit(1_000_000).cast("decimal(7,0)"), whole(l) * whole(r))


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP, **sample: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to 3 words of each language.

    Texts get A-Z in lower case, are split into pieces at ``[.,;:!?\\x0A-\\x0D]``, and those into words at spaces and tabs.  ``a``
    is the count of a phrase, ``l`` and ``r`` those of the parts of the cut with the lowest score ``floor(1000000 a a / (l r))``; ties
    go to the shorter first part.  Phrases with fewer than ``least`` occurrences are no candidates.  One whose words stand
    in a longer candidate with ``covered`` hundredths of its count or more is dropped.  Ranks go by score, then ``a``, both
    descending, then phrase by its bytes.  ``n`` counts all words of the language.

    A null language is ``und``, a null text is empty, repeated rows count each.  Other columns are not read.  An empty table, or
    one without frequent phrases, gives no rows.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found, totals = frequent(texts, least, **sample)
    part = found.select("lang", F.col("phrase").alias("part"), F.col("count"))
    words = F.split("phrase", " ")
    cuts = found.where("words > 1").select("lang", "words", "phrase", F.col("count").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice(words, F.col("k") + 1, F.lit(LONGEST)), " ").alias("rest"))
    left, right = part.toDF("lang", "first", "l"), part.toDF("lang", "rest", "r")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).select(
        "lang", "words", "phrase", "a", F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut")
    )
    scored = scored.groupBy("lang", "words", "phrase", "a").agg(F.min("cut").alias("cut"))
    # The largest longer candidate that holds a pair.
    longer = found.where("words = 3").select("lang", "count", F.explode(F.array_distinct(F.array(
        F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " ")
    ))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("count").alias("holder"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("holder").isNull() | (100 * F.col("holder") < covered * F.col("a")))
    # A language may hold most phrases: parts of it are ranked on their own, and the first of each once more.
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    own = Window.partitionBy("lang", "part").orderBy(*order)
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score")
    )


def oracle_sql() -> str:
    return rf"""
WITH texts AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
runs AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang),
places AS (SELECT lang, unnest(list_zip(w, w[2:], w[3:])) AS s FROM runs WHERE len(w) > 0),
words AS (SELECT lang, s[1] AS w1, s[2] AS w2, s[3] AS w3 FROM places),
ones AS (SELECT lang, w1, count(*) AS f FROM words GROUP BY ALL HAVING count(*) >= {LEAST}),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM words WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM words WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM twos c JOIN ones l ON l.lang = c.lang AND l.w1 = c.w1 JOIN ones r ON r.lang = c.lang AND r.w1 = c.w2
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, l.f, r.f
  FROM threes c JOIN ones l ON l.lang = c.lang AND l.w1 = c.w1 JOIN twos r ON r.lang = c.lang AND r.w1 = c.w2 AND r.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, l.f, r.f
  FROM threes c JOIN twos l ON l.lang = c.lang AND l.w1 = c.w1 AND l.w2 = c.w2 JOIN ones r ON r.lang = c.lang AND r.w1 = c.w3
), scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored),
longer AS (
  SELECT lang, phrase, max(f) AS holder FROM (
    SELECT lang, f, w1 || ' ' || w2 AS phrase FROM threes UNION ALL SELECT lang, f, w2 || ' ' || w3 FROM threes
  ) GROUP BY lang, phrase
), kept AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE pick = 1 AND (o.holder IS NULL OR 100 * o.holder < {COVERED} * b.a)
)
SELECT kept.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM kept JOIN totals ON totals.lang = kept.lang WHERE rank <= {TOP}"""
