"""Periodic stretches of words by a dictionary of basic factors.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal), at least ``max(LEAST, TIMES * q)`` words long,
that no neighbouring word extends with that period.

Basic factors are the stretches of 1, 2, 4, 8, ... words.  A factor's name is the pair of names of its halves, made dense by a
sort; a factor that stands only once in its text has no name, and neither has any that holds it, so the sorts soon get short.
Where the next occurrence of a factor of ``L`` words is ``d`` words on, with ``L / 2 < d <= L``, a period ``d`` is proposed.  Inside
a run of period ``q`` the factors whose length is the power of two from ``q`` up have exactly that distance, since a nearer
occurrence would give the run a smaller period; so the places that propose ``d`` one after the other are an arithmetic
progression that tells the whole run, as far as it extends.  Each period belongs to one length, and so does each run.

Texts are handled some ``STEP`` bytes at a time, a longer one alone; their words never meet those of another text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank_words, fresh
from .spans import by_size, bytes_of, stretches

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 6, 4
STEP = 4_000_000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
SCHEMA = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(words: np.ndarray, upto: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """``start, length, period`` of all runs of the texts ``words[upto[i]:upto[i + 1]]``; ``words`` are numbers from 0."""
    sizes = np.diff(upto)
    end = np.repeat(upto[1:], sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    name = np.full(len(words), -1, np.int64)
    at, keys, size = np.arange(len(words)), text * (int(words.max(initial=0)) + 1) + words, 1
    found = []
    while len(at):
        order = np.argsort(keys, kind="stable")
        place, keys = at[order], keys[order]
        again = keys[1:] == keys[:-1]
        # Periods from the distance to the next occurrence.
        gap = place[1:] - place[:-1]
        proposes = again & (gap <= size) & (2 * gap > size)
        first, period = place[:-1][proposes], gap[proposes]
        if len(first):
            order = np.argsort(first)
            first, period = first[order], period[order]
            new = np.append(True, (np.diff(first) != 1) | (np.diff(period) != 0) | (text[first[1:]] != text[first[:-1]]))
            cut = np.flatnonzero(new)
            first, period, n = first[cut], period[cut], np.diff(np.append(cut, len(new)))
            length = n + size - 1 + period
            long = length >= np.maximum(least, times * period)
            found.append((first[long], length[long], period[long]))
        # Names for what stands more than once; then the factors of twice the length.
        shared = np.append(again, False) | np.append(False, again)
        name[:] = -1
        name[place[shared]] = np.cumsum(np.append(False, ~again))[shared]
        at = np.sort(place[shared])
        at = at[at + 2 * size <= end[at]]
        at = at[name[at + size] >= 0]
        keys = name[at] * (int(name.max(initial=0)) + 1) + name[at + size]
        size *= 2
    start, length, period = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _step(texts: pa.Array, least: int, times: int) -> pa.StructArray:
    """Runs and collapsed text of each text of a string array without nulls."""
    buf, bounds = bytes_of(texts)
    start, end, upto = stretches(~_BLANK[buf], bounds)
    inside = np.append(0, np.cumsum(end - start))
    packed = buf[~_BLANK[buf]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(inside.astype(np.int64)), pa.py_buffer(packed)])
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    first, length, period = find_runs(numbers, upto, least, times)

    # A word goes if it stands in a run after the run's first period.
    change = np.zeros(len(start) + 1, np.int64)
    np.add.at(change, first + period, 1)
    np.add.at(change, first + length, -1)
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    # Kept words and a space after each, without the last of a text.
    size = end[kept] - start[kept] + 1
    ends = np.cumsum(size)
    source = np.repeat(start[kept] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    out = np.append(buf, np.uint8(32))[source]
    out[ends - 1] = 32
    split = np.append(0, ends)[np.searchsorted(kept, upto)]
    last = split[1:][np.diff(split) > 0] - 1
    out = np.delete(out, last)
    split = split - np.append(0, np.cumsum(np.diff(split) > 0))
    collapsed = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(split.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())

    own = np.searchsorted(first, upto)
    first = first - np.repeat(upto[:-1], np.diff(own))
    spans = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (first, length, period)], names=["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), spans)
    return pa.StructArray.from_arrays([runs, collapsed], names=["runs", "collapsed"])


def periodic(text: Column, least: int = LEAST, times: int = TIMES) -> Column:
    """Struct ``runs, collapsed`` of a text: its runs by start and period, and its words without the repetitions.

    Words are what ASCII white space separates, compared byte by byte.  A word is dropped if any run contains it after that
    run's first ``period`` words; the rest is joined by one space.  A null or empty text has no runs and an empty rest.  Very long
    texts are handled whole; runs may overlap, and repeated rows get the same answer.  Not deterministic by declaration, so that
    no filter on the result is evaluated by running it twice.
    """
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = texts.cast(pa.large_string()).fill_null("")
            parts = [_step(part, least, times) for part in by_size(texts, STEP)]
            yield pa.concat_arrays(parts) if parts else _step(texts, least, times)

    told = F.arrow_udf(find, f"struct<{SCHEMA.replace(' array', ':array').replace(' string', ':string')}>", F.ArrowUDFType.SCALAR_ITER)
    return told.asNondeterministic()(text)


def detect(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """All columns of ``docs`` with ``runs`` and ``collapsed``, see ``periodic``; columns of these names are replaced.

    Every row is kept, also one without id or text.  An empty table gives no rows.
    """
    docs = docs.drop("runs", "collapsed")
    own = fresh(docs, "told")
    return docs.withColumn(own, periodic(F.col("text"), least, times)).select(*docs.columns, f"{own}.runs", f"{own}.collapsed")


def looped(doc_id: Column, text: Column) -> Column:
    """One text in ten, by its id, with an end that repeats a stretch of it: known runs in every table.

    Let ``h`` be the checksum of the id and ``g`` a tenth of it.  Where ``h`` divides by ten, each of the ``n`` words from ``a = g % n``
    on repeats the first ``1 + (n - a) / (3 + g % 8)`` of them.  Without an id nothing changes.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = blank_words(text)
    n = F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    end = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), end).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` of every row's ``looped`` text.

    The four numbers tell of the run with the greatest ratio of length and period, compared exactly; ties go to the smallest
    start, then period.  They are null without a run.  The digests are of the runs as ``start,length,period`` lines, by start and
    period, and of the collapsed text; they are never null.  Other columns are not read.
    """
    told = detect(docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text")))
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # Runs come by start and period, so the first of equals stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r
    ).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"], )), "\n")
    told = told.select("doc_id", "runs", "collapsed", best.alias("best"))
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
