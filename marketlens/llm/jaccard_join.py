"""N-gram Jaccard join by a token-group matrix.

A document is the set of its distinct word shingles; two documents link if the sets are similar enough, and the result is the
class that links connect.  No pair list of a class is ever made: what is wanted is which documents hang together.

1. *Sets.*  Equal sets become one node, counted before the shuffle, so copies cost nothing further.
2. *Tokens.*  All shingles are ordered by how common they are, and a set keeps its first ``n - need + extra`` shingles, where
   ``need`` is the least overlap that any similar set must have.  Two similar sets then share at least the smaller ``extra`` of
   those.  The order comes from a count of all shingles in a table of fixed size; it steers the cost and not the result.
3. *Leaders.*  Within a token's sets the smallest node leads.  Every set is compared with the leader it shares most tokens
   with, and those left alone with a member of the largest class near them.  That is two comparisons a set and connects most
   of each class.
4. *Token-group matrix.*  Sets whose leaders chain together are similar; they form groups of about ``GROUP`` sets.  The matrix
   holds which tokens occur in which group.  A set that shares enough tokens with a group queries it for members of larger
   classes than its own, so that members of the largest class nearby ask nothing.  The query opens the group only if its whole
   shingle set overlaps the union of the group's sets enough, and then counts its overlap with all members at once.
5. *Classes* are joined by both kinds of links.  Every pair that the bounds don't rule out is either connected already or
   compared, so no class is missed.

Texts travel once, for sets that share a token with others, and again for those that are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, parked
from .components import components
from .prefix_hash import PrefixHash, mixed

K, PERCENT = 4, 85
#: Sets in a group, about; and queries that one task puts to a group.
GROUP, QUERIES = 1024, 1024
#: Counters of the shingle count, and the pieces it is summed in.
COUNTERS, PIECES = 1 << 18, 16
#: One more shared token is asked for with every so many shingles.
PER_EXTRA = 64
STEP = 1_000_000


def _shingle_sets(texts: list[bytes], k: int) -> Iterator[list[np.ndarray]]:
    """The sorted distinct shingle hashes (uint64) of each text, a list for each ``STEP`` bytes of texts."""
    held: list[list[bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        words = text.lower().split()
        held.append(words)
        size += len(text)
        if size > STEP or i == len(texts) - 1:
            yield _sets_of(held, k)
            held, size = [], 0


def _sets_of(held: list[list[bytes]], k: int) -> list[np.ndarray]:
    n = np.array([len(w) for w in held], np.int64)
    flat = [w for words in held for w in words]
    if not flat:
        return [np.empty(0, np.uint64)] * len(held)
    data = b" ".join(flat)
    size = np.array([len(w) for w in flat], np.int64)
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    end = start + size
    hashes = PrefixHash(np.frombuffer(data, np.uint8))
    upto = np.concatenate([[0], np.cumsum(n)])
    out = []
    # A shingle is the stretch from its first word's start to its last word's end, one blank between words.
    rolled = hashes.of(start[:len(flat) - k + 1], end[k - 1:]) if len(flat) >= k else np.empty(0, np.uint64)
    for a, b in zip(upto, upto[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            out.append(hashes.of(start[a:a + 1], end[b - 1:b]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _need(n: int, percent: int) -> int:
    """The least overlap of a set of ``n`` with any set that is similar enough."""
    return -(-percent * n // 100)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _count_shingles(texts: DataFrame, k: int) -> np.ndarray:
    """How many sets hold a shingle, by the first bits of its hash: ``COUNTERS`` numbers for the whole table."""
    piece = COUNTERS // PIECES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(COUNTERS, np.int64), set()
        for batch in batches:
            for sets in _shingle_sets(_unseen(batch, seen), k):
                total += np.bincount(np.concatenate(sets) >> np.uint64(46), minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(PIECES), pa.int32()), pa.array([total[i * piece:(i + 1) * piece].astype("<i8").tobytes() for i in range(PIECES)], pa.binary()),
        ], names=["piece", "counts"])

    def add(key: tuple, pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(piece, np.int64)
        for batch in pieces:
            for x in batch.counts:
                total += np.frombuffer(x, "<i8")
        yield pd.DataFrame({"piece": [key[0]], "counts": [total.astype("<i8").tobytes()]})

    partial = texts.select("same", "text").mapInArrow(count, "piece int, counts binary")
    summed = {r.piece: r.counts for r in partial.groupBy("piece").applyInPandas(add, "piece int, counts binary").collect()}
    return np.concatenate([np.frombuffer(summed.get(i, bytes(8 * piece)), "<i8") for i in range(PIECES)])


def _unseen(batch: pa.RecordBatch, seen: set[int]) -> list[bytes]:
    out = []
    for same, text in zip(batch.column("same").to_pylist(), batch.column("text")):
        if same not in seen:
            seen.add(same)
            out.append(text.as_buffer().to_pybytes())
    return out


def _sets(texts: DataFrame, common: np.ndarray, k: int, percent: int) -> DataFrame:
    """``doc_id, row, n, node, prefix`` for every text; ``prefix`` only where a partition meets a set for the first time.

    ``node`` names the set by its size and two sums of mixed hashes, in 64 bits; null for an empty set.
    """
    known = texts.sparkSession.sparkContext.broadcast(common)
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            at = 0
            for sets in _shingle_sets([t.as_buffer().to_pybytes() for t in batch.column("text")], k):
                nodes, prefixes = [], []
                for s in sets:
                    node = prefix = None
                    if len(s):
                        other = mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                        sums = mixed(np.array([s.sum(dtype=np.uint64), other.sum(dtype=np.uint64)]))
                        node = int(mixed(sums[:1] * np.uint64(3) + sums[1:] + np.uint64(len(s))).view(np.int64)[0])
                        if node not in seen:
                            seen.add(node)
                            order = np.lexsort((other, known.value[s >> np.uint64(46)]))
                            prefix = s[order[:len(s) - _need(len(s), percent) + _extra(len(s))]].view(np.int64)
                    nodes.append(node)
                    prefixes.append(prefix)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(sets)), batch.column("row").slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())),
                ], schema=schema)
                at += len(sets)

    return texts.select("doc_id", "row", "text").mapInArrow(name, "doc_id long, row long, n long, node long, prefix array<long>")


def _extra(n: int) -> int:
    return 1 + n // PER_EXTRA


def _extra_of(n: Column) -> Column:
    return 1 + F.floor(n / PER_EXTRA)


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Sizes near enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _compare(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose sets link."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 200):
                b = whole.slice(lo, 200)
                sides = []
                for side in ("text_a", "text_b"):
                    sides.append([s for sets in _shingle_sets([t.as_buffer().to_pybytes() for t in b.column(side)], k) for s in sets])
                yield b.select(["a", "b"]).filter(pa.array([_linked(x, y, percent) for x, y in zip(*sides)], pa.bool_()))

    ours = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return ours.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def _query_groups(opened: DataFrame, members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``a, b`` from ``opened`` (a node, its class rank and the group it queries) to members of a higher rank."""
    group = ["cluster", "piece"]
    parts = opened.groupBy(*group).agg(F.ceil(F.count("*") / QUERIES).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    asked = opened.join(parts, group).select(*group, part.alias("part"), "node", "size", "comp", F.lit(True).alias("asks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    own = members.join(parts, group).select(*group, every.alias("part"), "node", "size", "comp", F.lit(False).alias("asks"))

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [s for part in _shingle_sets([t.encode() for t in rows.text], k) for s in part]
        ranks, nodes, asks = list(zip(rows["size"], rows.comp)), rows.node.to_numpy(), rows.asks.to_numpy(bool)
        held = np.flatnonzero(~asks)
        # Members by token; its distinct tokens are the group's union.
        sizes = np.array([len(sets[i]) for i in held], np.int64)
        tokens = np.concatenate([sets[i] for i in held])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], np.repeat(np.arange(len(held)), sizes)[order]
        a, b = [], []
        for i in np.flatnonzero(asks):
            q = sets[i]
            lo, n = np.searchsorted(tokens, q), 0
            n = np.searchsorted(tokens, q, "right") - lo
            if np.count_nonzero(n) < _need(len(q), percent):
                continue
            upto = np.cumsum(n)
            both = np.bincount(owner[np.repeat(lo - (upto - n), n) + np.arange(upto[-1])], minlength=len(held))
            linked = np.flatnonzero(100 * both >= percent * (len(q) + sizes - both))
            met = set()  # one link to each class is enough
            for j in linked:
                rank = ranks[held[j]]
                if rank > ranks[i] and rank not in met:
                    met.add(rank)
                    a.append(nodes[i])
                    b.append(nodes[held[j]])
        return pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})

    rows = asked.unionByName(own).join(texts, "node")
    return rows.groupBy(*group, "part").applyInPandas(answer, "a long, b long")


def _ranked(nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """``nodes`` with their class, the node itself if links put it in none, and the size of the class."""
    found = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return found.join(found.groupBy("comp").agg(F.count("*").alias("size")), "comp")


def classes(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """``doc_id, row, n_shingles, node, comp`` for every row: its set, and the class of sets it hangs together with.

    ``row`` is ``row_of``; ``node`` and ``comp`` are null where the set is empty.
    """
    texts = docs.select("doc_id", row_of().alias("row"), F.xxhash64("text").alias("same"), F.coalesce("text", F.lit("")).alias("text"))
    common = _count_shingles(texts, k)
    sets = parked(_sets(texts, common, k, percent), "sets")
    met = sets.where("prefix IS NOT NULL")
    # Several partitions may tell of the same set, so a token counts as shared if two different sets have it.
    tokens = met.select("node", F.explode("prefix").alias("token"))
    led = tokens.groupBy("token").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").drop("last")
    shared = parked(tokens.join(led, "token").distinct(), "shared")
    # A set that shares fewer tokens in all than the smallest similar set asks for links with none.
    rows = met.groupBy("node").agg(F.first("n").alias("n"), F.min("row").alias("row"))
    nodes = shared.groupBy("node").agg(F.count("*").alias("tokens")).join(rows, "node")
    nodes = parked(nodes.where(F.col("tokens") >= _extra_of(F.floor(F.col("n") * percent / 100))).drop("tokens"), "nodes")
    # Both sides grow with the corpus, so this is a sort-merge join at any size.
    held = parked(nodes.join(texts.hint("merge"), "row").select("node", "text").dropDuplicates(["node"]), "texts")

    rows_shared, shared = shared, shared.join(nodes.select("node", "n"), "node")
    leads = shared.where("node <> lead").groupBy("node", "n", "lead").agg(F.count("*").alias("tokens"))
    leads = leads.join(nodes.select(F.col("node").alias("lead"), F.col("n").alias("lead_n")), "lead")
    enough = F.col("tokens") >= F.least(_extra_of(F.col("n")), _extra_of(F.col("lead_n")))
    leads = leads.where(enough & _may_link(F.col("n"), F.col("lead_n"), percent))
    pairs = leads.groupBy("node").agg(F.max_by("lead", F.struct("tokens", "lead")).alias("b"))
    pairs = parked(pairs.select(F.col("node").alias("a"), "b"), "pairs")
    near = parked(_compare(pairs, held, k, percent), "near")

    # Sets left alone are compared once more, with a member of the largest class that they share enough tokens with.
    first = near
    by_lead = components(near)
    found = _ranked(nodes, by_lead)
    placed = shared.select("token", "node").join(found, "node")
    head = F.struct("size", "comp", F.xxhash64("node", F.lit("head")).alias("draw"), "node", "n")
    heads = placed.where("size > 1").groupBy("token").agg(F.max(head).alias("head"))
    alone = placed.where("size = 1").join(heads, "token").groupBy("node", "n", "head").agg(F.count("*").alias("tokens"))
    enough = F.col("tokens") >= F.least(_extra_of(F.col("n")), _extra_of(F.col("head.n")))
    alone = alone.where(enough & _may_link(F.col("n"), F.col("head.n"), percent))
    again = alone.groupBy(F.col("node").alias("a")).agg(F.max_by("head.node", F.struct("head.size", "tokens", "head.node")).alias("b"))
    near = parked(near.unionByName(_compare(again, held, k, percent)), "near")

    # Groups: sets whose leaders chain together, in pieces.
    by_pair, by_near = components(pairs), components(near)
    clusters = _ranked(nodes.select("node"), by_pair).select(
        "node", F.col("comp").alias("cluster"), F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / GROUP)).alias("piece")
    )
    found = parked(_ranked(nodes, by_near).join(clusters, "node"), "found")
    placed = shared.select("token", "node").join(found, "node")
    rank = F.struct("size", "comp")
    matrix = placed.groupBy("token", "cluster", "piece").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(rank).alias("top"))
    ours = placed.select("token", "node", "n", rank.alias("own"))
    # Sizes differ by little within a link, so only groups with a member of a fitting size are asked.
    fits = (100 * F.col("most") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("least"))
    hits = ours.join(matrix, "token").where((F.col("own") < F.col("top")) & fits)
    hits = hits.groupBy("node", "n", "own", "cluster", "piece").agg(F.count("*").alias("tokens"), F.min("least").alias("least"))
    opened = hits.where(F.col("tokens") >= F.least(_extra_of(F.col("n")), _extra_of(F.col("least"))))
    opened = parked(opened.select("node", "own.size", "own.comp", "cluster", "piece"), "opened")
    far = _query_groups(opened, found.select("cluster", "piece", "node", "size", "comp"), held, k, percent)

    final = components(near.unionByName(far))
    out = parked(sets.select("doc_id", "row", F.col("n").alias("n_shingles"), "node").join(final, "node", "left").select(
        "doc_id", "row", "n_shingles", "node", F.coalesce("comp", "node").alias("comp")
    ), "classes")
    discard(sets, rows_shared, nodes, held, pairs, first, near, by_lead, by_pair, by_near, found, opened, final)
    return out


def row_of() -> Column:
    """Tells documents apart: rows that repeat both ``doc_id`` and ``text`` are one document."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def report(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``doc_id`` and ``text``.

    Words are what ASCII white space separates, with A-Z in lower case; a text with fewer than ``k`` words is one shingle, and
    a text without words, or a null, is empty and links with nothing.  Two documents link if ``100 * shared >= percent *
    united``.  ``component_id`` is the smallest id of the class, the document's own where the set is empty; null ids are
    skipped there unless there is no other.  Repeated rows are copies of each other.  Other columns are not read.
    """
    found = classes(docs, k, percent)
    first = found.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return found.join(first, "comp", "left").select(
        "doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def deduplicate(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """One document of each class, the one with the smallest id, and every document without words; columns as in ``docs``.

    Rows that repeat both ``doc_id`` and ``text`` are one document; if they differ elsewhere, the one with the smallest hash of
    all columns stays.
    """
    found = classes(docs, k, percent)
    kept = found.groupBy(F.col("comp"), F.when(F.col("comp").isNull(), F.col("row"))).agg(F.min(F.struct("doc_id", "row")).alias("one"))
    key = fresh(docs, "row_of")
    marked = docs.withColumn(key, row_of()).join(kept.select(F.col("one.row").alias(key)), key, "left_semi")
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("one")
    return marked.groupBy(key).agg(one).select("one.*")
