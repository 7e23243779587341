"""Removal of byte strings that stand more than once, by buckets of suffixes that share a content-drawn sample.

A suffix counts up to ``LENGTH`` bytes, so the question is which suffixes tie with another to that depth.

*Cover.*  A difference cover is a sample of positions such that two suffixes reach sample positions after the same number of
bytes, so that their tie is settled by what is known of the samples.  Here the cover is drawn by content: the position of the
smallest hash of ``LENGTH // 5`` bytes within each suffix.  Tied suffixes have it at the same distance by construction, and it
takes one position in 160 where a cover by position number would take one in ten.

*Buckets.*  The suffixes that share a sample at nearly the same distance (a class of ``CLASS`` distances) hold a common string
of ``LENGTH - CLASS + 1`` bytes or a little more.  Its name is their bucket.  Neighbouring suffixes of a text in one bucket
form a run, and a run is what is shuffled, not its suffixes.

*Ties.*  Runs with the same bytes tie suffix by suffix, so they are counted before the shuffle and any number of copies leaves a
task as one row.  A run alone in its bucket has no tie.  Only the other runs are opened: their suffixes are named by all
``LENGTH`` bytes and counted within the bucket.  A bucket that a third of the corpus shares is thus spread by what follows.

*Words.*  Passages may be asked for by words too: a word is one number, its hash, and a passage of so many words is found like
a string of so many bytes, whatever white space stands in it.  Both kinds of runs go through the same joins; the lowest bit of a
bucket's name tells them apart.

Buckets are handled one after the other by Spark's sort and aggregation, which spill.  Names are 64-bit hashes, always taken
two at a time (bucket and run, bucket and suffix).  The result is exact, not a sample.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, parked, release
from .prefix_hash import PrefixHash, mixed
from .spans import by_size, bytes_of, stretches

LENGTH = 400
#: A passage of over 50 words.
WORDS = 51
CLASS = 128
#: Kinds of spans.
BYTES, WITHIN, ELSEWHERE, WHOLE = range(4)
#: The same for words.
WORD_CLASS = 21
#: Bytes or words hashed at a time, so few that the numbers stay in a core's cache; a longer text is cut into overlapping steps.
STEP = 1 << 16
#: Bytes of texts handled at a time, unless a single text is longer.
SLICE = 1 << 20
_PLACE = (1 << 20) - 1
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
#: A bucket's name has 47 bits, as its runs and suffixes have names of their own; the lowest bit tells words.
_KEY = np.uint64((1 << 48) - 2)
_RUN = pa.schema([("key", pa.int64()), ("sub", pa.int64()), ("row", pa.int64()), ("place", pa.int64())])
_SUFFIX = pa.schema([("key", pa.int64()), ("name", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("open", pa.bool_()), ("others", pa.bool_())])
#: Of the bitmap of documents that are opened.
FILTER_BITS = 1 << 26
#: The place of a run or suffix is its first byte and, above these bits, its size.
_FIRST = 32


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each ``w`` neighbours, from running minima within blocks of ``w``."""
    n = len(x)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def _step(length: int) -> int:
    """``STEP``, or more if strings are as long."""
    return max(STEP, length)


def _words(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts ``buf[bounds[i]:bounds[i + 1]]``: hash, first byte, the byte after the last; and how many come before each text."""
    first, last, upto = stretches(_IN_WORD[buf], bounds)
    values = np.empty(len(first), np.uint64)
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(last, first[a] + STEP, "right")))
        values[a:b] = PrefixHash(buf[first[a]:last[b - 1]]).of(first[a:b] - first[a], last[a:b] - first[a])
        a = b
    return values, first, last, upto


def _runs(buf: np.ndarray, length: int, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """key, sub, start, n of all runs of the texts ``buf[bounds[i]:bounds[i + 1]]``."""
    words = buf.dtype != np.uint8
    size = WORD_CLASS if words else CLASS
    k = max(1, length // 5)
    w = length - k + 1
    hashes = PrefixHash(buf)
    marked = (hashes.rolling(k) & ~np.uint64(_PLACE)) | np.arange(len(buf) - k + 1, dtype=np.uint64)
    sample = (_window_min(marked, w) & np.uint64(_PLACE)).astype(np.int64)
    start = np.arange(len(sample))
    end = np.repeat(bounds[1:], np.diff(bounds))[:len(sample)]
    own = start + length <= end
    start, sample = start[own], sample[own]
    if not len(start):
        return (np.empty(0, np.int64),) * 4
    far = sample - start
    kind = far // size
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(sample) != 0) | (np.diff(kind) != 0)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1
    s0, s1, p, c = start[at], start[last], sample[at], kind[at]
    shared = hashes.of(p - c * size, p - np.minimum(c * size + size - 1, w - 1) + length)
    key = (mixed(shared + c.astype(np.uint64)) & _KEY) | np.uint64(words)
    sub = mixed(hashes.of(s0, s1 + length) + (far[at] * 4096 + (s1 - s0)).astype(np.uint64))
    return key.view(np.int64), sub.view(np.int64), s0, s1 - s0 + 1


def _steps(texts: list[np.ndarray], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], np.ndarray]]:
    """Buffers with the bounds of their texts, the texts' numbers, and how far into its text each begins."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def buffer():
        sizes = [len(t) for *_, t in held]
        return np.concatenate([t for *_, t in held]), np.concatenate([[0], np.cumsum(sizes)]), [i for i, *_ in held], np.array([a for _, a, _ in held])

    step = _step(length)
    for i, text in enumerate(texts):
        for a in range(0, max(1, len(text) - length + 1), step):
            piece = text[a:a + step + length - 1]
            if len(piece) < length:
                continue
            if size + len(piece) > 2 * step - length and held:
                yield buffer()
                held, size = [], 0
            held.append((i, a, piece))
            size += len(piece)
    if held:
        yield buffer()


def _placed(steps, length: int, rows: np.ndarray, first_byte, last_byte) -> list[tuple[np.ndarray, ...]]:
    """Columns of the runs of each step; the functions tell the byte at which unit x of text i begins, and that before which unit x - 1 ends."""
    out = []
    for buf, bounds, which, begin in steps:
        key, sub, start, n = _runs(buf, length, bounds)
        of = np.searchsorted(bounds, start, "right") - 1
        start = start - bounds[of] + begin[of]
        of = np.array(which)[of]
        first, end = first_byte(of, start), last_byte(of, start + n + (length - 1))
        out.append((key, sub, rows[of], first | ((end - first) << _FIRST)))
    return out


def _find_runs(docs: DataFrame, length: int, words: int | None) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies of a text within a partition have the same runs
        for whole in batches:
            at = 0
            for texts in by_size(whole.column("text"), SLICE):
                b = whole.slice(at, len(texts))
                at += len(texts)
                short = pc.less(pc.binary_length(texts), length).to_numpy(zero_copy_only=False)  # copies of these are found by their runs alone
                new = np.array([same not in seen and not seen.add(same) for same in b.column("same").to_pylist()])
                b = b.filter(pa.array(new | short))
                if not len(b):
                    continue
                rows = b.column("row").to_numpy()
                buf, bounds = bytes_of(b.column("text").cast(pa.large_string()))
                found = [_placed(_steps(np.split(buf, bounds[1:-1]), length), length, rows, lambda i, x: x, lambda i, x: x)]
                if words is not None:
                    values, first, last, upto = _words(buf, bounds)
                    steps = _steps(np.split(values, upto[1:-1]), words)
                    found.append(_placed(steps, words, rows, lambda i, x: first[upto[i] + x] - bounds[i], lambda i, x: last[upto[i] + x - 1] - bounds[i]))
                columns = [np.concatenate(c) for c in zip(*(x for f in found for x in f))]
                if columns:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_RUN)

    shortest = length if words is None else min(length, 2 * words - 1)
    texts = docs.where(F.octet_length("text") >= shortest).select("row", F.xxhash64("text").alias("same"), "text")
    return texts.mapInArrow(find, "key long, sub long, row long, place long")


def _name_suffixes(opened: DataFrame, length: int, words: int | None) -> DataFrame:
    """A row per suffix of the opened runs of each text."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            for texts in by_size(whole.column("text"), SLICE):
                b = whole.slice(at, len(texts))
                at += len(texts)
                buf, bounds = bytes_of(texts.cast(pa.large_string()))
                runs = b.column("runs")
                of = np.repeat(np.arange(len(b)), pc.list_value_length(runs).to_numpy())
                runs = pa.RecordBatch.from_struct_array(runs.flatten())
                start = bounds[of] + runs.column("start").to_numpy()
                order = np.argsort(start, kind="stable")
                columns = {c: runs.column(c).to_numpy(zero_copy_only=False)[order] for c in ("key", "open", "others")}
                columns |= {"of": of[order], "start": start[order], "end": (bounds[of] + runs.column("end").to_numpy())[order]}
                rows = b.column("row").to_numpy()
                for by_word, least in ((False, length), (True, words)):
                    own = np.flatnonzero((columns["key"] & 1 == 1) == by_word)
                    if len(own):
                        units = _words(buf, bounds)[:3] if by_word else (buf, None, None)
                        yield from of_kind(rows, bounds, units, {c: x[own] for c, x in columns.items()}, least)

    def of_kind(rows, bounds, units, runs, least) -> Iterator[pa.RecordBatch]:
        values, first, last = units
        begin, end = runs["start"], runs["end"]
        if first is not None:
            begin, end = np.searchsorted(first, begin), np.searchsorted(last, end) + 1
        a, room = 0, 2 * _step(least)
        while a < len(begin):  # as many runs as lie within two steps
            base = begin[a]
            z = a + max(1, int(np.searchsorted(end[a:], base + room, "right")))
            hashes = PrefixHash(values[base:base + room])
            n = end[a:z] - begin[a:z] - (least - 1)
            start = np.repeat(begin[a:z] - base - (np.cumsum(n) - n), n) + np.arange(n.sum())
            names = hashes.of(start, start + least).view(np.int64)
            start = start + base
            of = np.repeat(runs["of"][a:z], n)
            size = np.full(len(start), least) if first is None else last[start + least - 1] - first[start]
            place = ((start if first is None else first[start]) - bounds[of]) | (size << _FIRST)
            others = pa.array(runs["others"][a:z]).cast(pa.bool_()).take(pa.array(np.repeat(np.arange(z - a), n)))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(runs["key"][a:z], n)), pa.array(names), pa.array(rows[of]), pa.array(place),
                pa.array(np.repeat(runs["open"][a:z].astype(bool), n)), others,
            ], schema=_SUFFIX)
            a = z

    return opened.mapInArrow(name, "key long, name long, row long, place long, open boolean, others boolean")


def row_of() -> Column:
    """Tells documents apart, see ``repeats``."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", row_of().alias("row"), F.coalesce("text", F.lit("")).alias("text"))


def repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``row, spans``: the repeated bytes of each document that has some, as (kind, start, end).

    ``kind`` is ``BYTES`` for strings, ``ELSEWHERE`` for passages that another document has too, ``WITHIN`` for those that only
    stand more than once in their own, and ``WHOLE`` for a text of which there are copies.  Spans of one kind don't touch.

    Repeated is what lies in a string of ``length`` bytes or, if given, in a passage of ``words`` words that also starts anywhere
    else.  Words are parted by white space, of which the passages need not have the same.

    ``row`` is ``row_of``.  Rows that repeat both ``doc_id`` and ``text`` share it, and are copies of each other.
    """
    texts = _texts(docs)
    runs = _find_runs(texts.select("row", "text"), length, words)

    # Each step ends in a table, and the shuffle files of the step before can go.
    spark = docs.sparkSession

    # Most buckets hold one run; only the runs of the others are written.
    several = runs.groupBy("key").count().where("count > 1").select("key")
    runs = parked(runs.join(several, "key"), "runs")
    release(spark)
    by_word = F.col("key").bitwiseAND(1) == 1
    row_by_word = F.when(by_word, F.col("row"))
    others = F.min(row_by_word) < F.max(row_by_word)  # null for bytes, which don't ask
    subs = runs.groupBy("key", "sub").agg(F.count("*").alias("same"), F.min(F.struct("row", "place")).alias("one"), others.alias("others"))
    # Joined by bucket and run, so that a bucket that a third of the corpus shares is spread; copies of a run are one row here.
    held = runs.join(subs, ["key", "sub"])
    kind = F.when(~by_word, BYTES).otherwise(F.when(F.col("others"), ELSEWHERE).otherwise(WITHIN))
    first = F.col("place").bitwiseAND((1 << _FIRST) - 1)
    piece = [F.col("row"), kind.alias("kind"), first.alias("start"), (first + F.shiftright("place", _FIRST)).alias("end")]
    closed = parked(_swept(held.where("same > 1").select(*piece)), "closed")
    release(spark)

    # Of runs that tie with each other, one is opened too, for the others of its bucket.  Words that only one document repeats
    # are opened wherever they stand, as each may be found in another document yet.
    alone = (F.col("same") == 1) | (by_word & ~F.col("others"))
    mixed_keys = subs.groupBy("key").count().where("count > 1").select("key")
    to_open = held.where(alone | (F.struct("row", "place") == F.col("one"))).join(mixed_keys, "key", "left_semi")
    opened = F.struct("key", first.alias("start"), (first + F.shiftright("place", _FIRST)).alias("end"), alone.alias("open"), "others")
    to_open = parked(to_open.groupBy("row").agg(F.collect_list(opened).alias("runs")), "opened")
    discard(runs)
    release(spark)
    suffixes = _name_suffixes(_likely(texts.select("row", "text"), to_open).join(to_open, "row"), length, words)
    again = suffixes.groupBy("key", "name").agg(F.count("*").alias("count"), (others | F.bool_or("others")).alias("others"))
    again = again.where("count > 1").select("key", "name", "others")
    ties = parked(_swept(suffixes.where("open").drop("others", "open").join(again, ["key", "name"]).select(*piece)), "ties")
    discard(to_open)
    release(spark)

    # Copies of whole texts: every byte is repeated.
    least = length if words is None else min(length, 2 * words - 1)
    whole = texts.where(F.octet_length("text") >= least).select("row", F.md5("text").alias("copy"), F.octet_length("text").cast("long").alias("end"))
    copied = whole.groupBy("copy").count().where("count > 1").select("copy")
    whole = whole.join(copied, "copy").select("row", F.lit(WHOLE).alias("kind"), F.lit(0).cast("long").alias("start"), "end").distinct()
    return _swept(closed.unionByName(ties)).unionByName(whole).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("spans"))


def _likely(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts whose ``row`` may be among ``rows``, by a bitmap of ``FILTER_BITS``: most other texts needn't be shuffled.

    It has ``FILTER_BITS / 64`` rows of two numbers at most, whatever the size of the table, and so may be broadcast.  Where it
    gets full, more texts pass that the join after it drops.
    """
    place = F.pmod("row", F.lit(FILTER_BITS))
    word, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    bitmap = rows.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    marked = texts.withColumns({"word": word, "bit": bit}).join(F.broadcast(bitmap), "word")
    return marked.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).select(*texts.columns)


def _swept(pieces: DataFrame) -> DataFrame:
    """Pieces of one kind that overlap or touch are merged, by a sorted sweep that spills; only maximal ones are gathered later."""
    sweep = Window.partitionBy("row", "kind").orderBy("start", "end")
    reach = F.max("end").over(sweep.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.select("*", F.when(F.col("start") <= reach, 0).otherwise(1).alias("new"))
    marked = marked.select("*", F.sum("new").over(sweep.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    return marked.groupBy("row", "kind", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def _told(text: bytes, spans: list[dict] | None, length: int, words: int | None) -> Iterator[tuple[int, int, int]]:
    """The spans as kind, start and end, with what a copy of a whole text means for its bytes and its words."""
    for s in spans or ():
        if s["kind"] != WHOLE:
            yield s["kind"], s["start"], s["end"]
            continue
        if len(text) >= length:
            yield BYTES, 0, len(text)
        if words is not None:
            _, first, last, _ = _words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            if len(first) >= words:
                yield ELSEWHERE, int(first[0]), int(last[-1])


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _rest(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


def report(docs: DataFrame, length: int = LENGTH, words: int = WORDS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, n_passage_bytes`` for every row of ``doc_id`` and ``text``.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in the same document or
    another; overlaps count, and matches never cross documents.  The last two columns tell of passages of ``words`` words and
    more that stand in another document too, which may be shorter than ``length`` bytes: how many there are, as maximal runs, and
    how many bytes they cover.  They change nothing in the others.

    A null text counts as empty.  Null ids are kept, and repeated rows are copies of each other like any two documents.  Other
    columns are not read.  An empty table gives no rows.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_bytes"]
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                out = []
                for text, spans in zip(b.column("text"), b.column("spans").to_pylist()):
                    data = text.as_buffer().to_pybytes()
                    told = list(_told(data, spans, length, words))
                    spans = _merged((a, z) for kind, a, z in told if kind == BYTES)
                    passages = _merged((a, z) for kind, a, z in told if kind == ELSEWHERE)
                    out.append((
                        len(data), sum(z - a for a, z in spans), len(spans), hashlib.sha256(_rest(data, spans)).hexdigest(),
                        len(passages), sum(z - a for a, z in passages),
                    ))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), *[pa.array(c, pa.string() if n == "kept_sha256" else pa.int64()) for n, c in zip(names[1:], columns)]
                ], names=names)

    joined = _texts(docs).join(repeats(docs, length, words), "row", "left")
    return joined.mapInArrow(
        digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, n_passage_bytes long"
    )


def remove(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``, and ``n_chars``, if there, counted anew; see ``repeats``.

    A character that loses one of its bytes goes as a whole.  A document of which nothing is left is dropped; documents
    that were empty or null before are kept as they are.
    """
    columns = docs.columns
    key, own = fresh(docs, "row_of"), fresh(docs, "spans")
    spans = repeats(docs, length, words).select(F.col("row").alias(key), F.col("spans").alias(own))
    joined = docs.withColumn(key, row_of()).join(spans, key, "left").drop(key)
    at = joined.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                texts = []
                for text, spans in zip(b.column("text"), b.column(own).to_pylist()):
                    if not spans:
                        texts.append(text.as_py())
                        continue
                    data = text.as_buffer().to_pybytes()
                    texts.append(_rest(data, _merged((a, z) for _, a, z in _told(data, spans, length, words))).decode("utf-8", "ignore"))
                yield b.set_column(at, "text", pa.array(texts, pa.string()))

    left = joined.mapInArrow(cut, joined.schema).where(F.col(own).isNull() | (F.col("text") != "")).select(*columns)
    if "n_chars" in columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left
