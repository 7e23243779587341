"""Near copies among vectors by iterative quantisation and multi-index Hamming tables.

Two vectors link if their cosine is at least ``LEAST``.

1. *Codes.*  On a bounded sample, principal directions and a rotation that brings the projections closest to the corners of the
   cube are learned, ``TABLES`` times from different starts.  The signs are a code of ``BITS`` bits; every vector gets one, and a
   sketch: its direction in bytes, with how far that is off.  What follows moves sketches, a quarter of the vectors' size.
2. *Tables.*  Codes are cut into blocks of ``BLOCK`` bits.  Two vectors meet if some block differs in one bit at most.  Vectors
   that link differ in a tenth of the bits or less, and are missed only if every block differs in two.
3. *Balls.*  Equal vectors are one node.  In each table entry the smallest node (a hash) leads; a node surely within half the
   angle of ``LEAST`` from its leader belongs to its ball, whose centre is the leader's vector even where the leader went to
   another ball.  All nodes of a ball link with each other, by the triangle inequality of angles, so large groups of near copies
   are counted and never paired.  ``ROUNDS`` rounds gather what is left; others are balls of their own.  What meets are balls:
   an entry holds each once.
4. *Meetings.*  Blocks that differ in one bit are equal in one half.  All that share a half are compared by their sketches in one
   task, and only pairs are told that meet and that the sketches cannot rule out, so chance meetings leave no rows.  Tables are
   taken a few blocks at a time, so that what is moved at once is no larger than the vectors.
5. *Reranking with the original vectors.*  Two balls link wholly, or not at all, if the angle of their centres says so with both
   radii; two single vectors always do.  Else their members are compared, in pieces of ``PIECE``.

Counts add up per ball and per member, links between balls give the components.  The only loss is that of step 2; a link that is
told is always right.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, parked, release
from .components import components

LEAST = 0.95
#: Vectors of the sample, steps of the fit.
SAMPLE, STEPS = 20_000, 50
BITS, BLOCK, TABLES = 64, 16, 2
ROUNDS, PIECE = 3, 512
#: Rows that are moved at once beyond those of the vectors, rows of a half that a task compares with each other, rows of a group
#: within them, products at a time.
AT_ONCE, HALF_ROWS, GROUP, PRODUCTS = 1 << 19, 1 << 16, 96, 1 << 21
#: On angles, for rounding.
SLACK = 1e-9
NONE, ALL, OPEN = range(3)


class Codes:
    """A mean and, for each table, a projection whose signs are the code."""

    def __init__(self, sample: np.ndarray):
        units = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.mean = units.mean(axis=0)
        centred = units - self.mean
        bits = min(BITS, sample.shape[1])
        _, directions = np.linalg.eigh(centred.T @ centred)
        directions = directions[:, ::-1][:, :bits]
        near = centred @ directions
        self.projections = []
        for t in range(TABLES):
            rotation, _ = np.linalg.qr(np.random.default_rng(t).standard_normal((bits, bits)))
            for _ in range(STEPS):
                u, _, v = np.linalg.svd(np.where(near @ rotation >= 0, 1.0, -1.0).T @ near)
                rotation = (u @ v).T
            self.projections.append(directions @ rotation)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The value of each block of each vector's code."""
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        out = []
        for projection in self.projections:
            signs = (units - self.mean) @ projection >= 0
            for a in range(0, signs.shape[1], BLOCK):
                part = signs[:, a:a + BLOCK]
                value = part @ (1 << np.arange(part.shape[1], dtype=np.int64))
                out.append(value.astype(np.uint16).view(np.int16))
        return np.stack(out, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _sketch_type(size: int) -> np.dtype:
    return np.dtype([("scale", "f4"), ("off", "f4"), ("bytes", "i1", (size,))])


def _sketches(vectors: np.ndarray) -> pa.Array:
    """Directions as bytes times a scale, and how far that may be off; ``_directions`` reads them."""
    units = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    out = np.empty(len(units), _sketch_type(units.shape[1]))
    out["scale"] = np.abs(units).max(axis=1) / 127
    scale = out["scale"].astype(np.float64)[:, None]
    out["bytes"] = np.clip(np.rint(units / scale), -127, 127)
    out["off"] = np.linalg.norm(units - out["bytes"] * scale, axis=1) * (1 + 1e-6) + 1e-6
    offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.dtype.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(out), [None, offsets.buffers()[1], pa.py_buffer(out.tobytes())])


def _directions(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(column.to_pylist()), _sketch_type(size))
    return rows["bytes"] * rows["scale"][:, None], rows["off"].astype(np.float64)


def _usable(v: Column, size: int) -> Column:
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return v.isNotNull() & (F.size(v) == size) & finite & F.exists(v, lambda x: x != 0)


def _fit(nodes: DataFrame, sample: int) -> Codes | None:
    n = nodes.count()
    drawn = nodes.where(F.pmod(F.xxhash64("node", F.lit("fit")), F.lit(1 << 30)) < (1 << 30) * min(1.0, sample / max(1, n)))
    rows = drawn.select("v").toArrow()["v"].combine_chunks()
    return Codes(_matrix(rows)) if len(rows) else None


def _with_keys(nodes: DataFrame, codes: Codes) -> DataFrame:
    bound = nodes.sparkSession.sparkContext.broadcast(codes)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = _matrix(b.column("v"))
            keys = bound.value.keys(x)
            lists = pa.ListArray.from_arrays(np.arange(len(b) + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("copies"), b.column("least"), lists, _sketches(x)], names=["node", "copies", "least", "keys", "sketch"]
            )

    return nodes.mapInArrow(name, "node long, copies long, least long, keys array<short>, sketch binary")


def _entries(column: pa.Array, blocks: int) -> np.ndarray:
    return column.flatten().to_numpy().view(np.uint16).reshape(-1, blocks) + (np.arange(blocks, dtype=np.int64) << BLOCK)


def _leads(rest: DataFrame, blocks: int) -> np.ndarray:
    """The smallest node of each table entry, of which there are ``blocks`` times 2^16 at most."""
    nobody = np.iinfo(np.int64).max

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full(blocks << BLOCK, nobody)
        for b in batches:
            if len(b):
                np.minimum.at(best, _entries(b.column("keys"), blocks).ravel(), np.repeat(b.column("node").to_numpy(), blocks))
        key = np.flatnonzero(best != nobody)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(best[key])], names=["key", "node"])

    found = rest.select("node", "keys").mapInArrow(smallest, "key long, node long").groupBy("key").agg(F.min("node").alias("node")).toArrow()
    leads = np.full(blocks << BLOCK, nobody)
    leads[found["key"].to_numpy()] = found["node"].to_numpy()
    return leads


def _to_leaders(rest: DataFrame, half: float, blocks: int, size: int) -> DataFrame:
    """``node, ball, angle`` of the nodes near enough to the first leader among their table entries; the angle is not above that told."""
    bound = rest.sparkSession.sparkContext.broadcast(_leads(rest, blocks))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                ball = pa.array(bound.value[_entries(b.column("keys"), blocks)].min(axis=1))
                yield pa.RecordBatch.from_arrays([b.column("node"), ball, b.column("sketch")], names=["node", "ball", "sketch"])

    chosen = rest.select("node", "keys", "sketch").mapInArrow(choose, "node long, ball long, sketch binary")
    both = chosen.join(rest.select(F.col("node").alias("ball"), F.col("sketch").alias("centre")), "ball")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            (x, x_off), (y, y_off) = (_directions(b.column(c), size) for c in ("sketch", "centre"))
            apart = np.linalg.norm(x.astype(np.float64) - y, axis=1) + x_off + y_off
            angle = 2 * np.arcsin(np.minimum(apart / 2, 1))
            angle[b.column("node").to_numpy() == b.column("ball").to_numpy()] = 0
            near = pa.array(angle <= half)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("ball"), pa.array(angle)], names=["node", "ball", "angle"]).filter(near)

    return both.mapInArrow(measure, "node long, ball long, angle double")


class Side:
    """Balls that share half of a block: ids, values of the block, radii, and sketches of the centres."""

    def __init__(self, ball: np.ndarray, value: np.ndarray, radius: np.ndarray, x: np.ndarray, off: np.ndarray):
        self.columns = (ball, value, radius, x, off)
        self.ball, self.value, self.radius, self.x, self.off = self.columns
        self.square = (x * x).sum(axis=1, dtype=np.float64)

    def take(self, at: np.ndarray | slice) -> Side:
        return Side(*(c[at] for c in self.columns))


def _in_reach(a: Side, b: Side, most: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs whose sketches allow an angle up to ``most`` and both radii."""
    if not len(a.ball) or not len(b.ball):
        return
    chord = lambda radii, off: 2 * np.sin(np.minimum(most + SLACK + radii, math.pi) / 2) + off
    rounded = 1e-6 + 1e-7 * a.x.shape[1]
    loosest = (a.square + b.square.min() - chord(a.radius + b.radius.max(), a.off + b.off.max()) ** 2) / 2 - rounded
    step = max(1, PRODUCTS // len(b.ball))
    for at in range(0, len(a.ball), step):
        i, j = np.nonzero(a.x[at:at + step] @ b.x.T >= loosest[at:at + step, None].astype(np.float32) - np.float32(rounded))
        i += at
        apart = ((a.x[i].astype(np.float64) - b.x[j]) ** 2).sum(axis=1)
        near = apart <= (chord(a.radius[i] + b.radius[j], a.off[i] + b.off[j]) + rounded) ** 2
        yield i[near], j[near]


def _meetings(a: Side, b: Side | None, upper: bool, most: float) -> np.ndarray:
    """``a, b, radii`` of the balls of two sides, or of one, that meet and are in reach; each pair once, the smaller first."""
    one, b = b is None, b or a
    # Taken apart by the first bits of the other half, more of them the more rows there are; these too differ in one bit at most.
    bits = min(8, max(0, int(math.log2(max(1, len(a.ball), len(b.ball)) / GROUP))))
    first = lambda s: (s.value & 255 if upper else s.value >> 8) >> (8 - bits)
    a, b = (s.take(np.argsort(first(s), kind="stable")) for s in (a, b))
    keys = first(b)

    def near(k: int) -> np.ndarray:
        wanted = [w for w in (k, *(k ^ 1 << i for i in range(bits))) if w >= k or not one]
        return np.concatenate([np.arange(*np.searchsorted(keys, [w, w + 1])) for w in wanted])

    values, starts = np.unique(first(a), return_index=True)
    tasks = ((a.take(slice(s, e)), b.take(near(int(k)))) for k, s, e in zip(values, starts, [*starts[1:], len(a.ball)]))
    out = []
    for x, y in tasks:
        for i, j in _in_reach(x, y, most):
            differ = x.value[i] ^ y.value[j]
            # Equal blocks share both halves; the lower one tells of them.
            meet = ((differ & (differ - 1)) == 0) & (x.ball[i] != y.ball[j]) & ((differ != 0) | (not upper))
            i, j = i[meet], j[meet]
            pair = np.empty(len(i), [("a", "i8"), ("b", "i8"), ("radii", "f8")])
            pair["a"], pair["b"] = np.minimum(x.ball[i], y.ball[j]), np.maximum(x.ball[i], y.ball[j])
            pair["radii"] = x.radius[i] + y.radius[j]
            out.append(np.unique(pair))
    return np.unique(np.concatenate(out)) if out else np.empty(0, [("a", "i8"), ("b", "i8"), ("radii", "f8")])


def _compare_halves(rows: DataFrame, most: float, size: int) -> DataFrame:
    """``a, b, radii`` of the balls that meet, from rows sorted by the half they share and the pieces of it that are compared."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            column = lambda c: t[c].to_numpy()
            sides = Side(column("ball"), column("value").astype(np.int64) & 0xFFFF, column("radius"), *_directions(t["sketch"], size))
            own, first, second = column("piece"), t["i"][0].as_py(), t["j"][0].as_py()
            parts = (sides, None) if first == second else (sides.take(own == first), sides.take(own == second))
            found = _meetings(*parts, bool(t["half"][0].as_py() >> 8 & 1), most)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[c])) for c in ("a", "b", "radii")], names=["a", "b", "radii"])

        last = None
        for batch in batches:
            if not len(batch):
                continue
            at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("half", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1), len(at)]
            for start, end in zip(cuts, cuts[1:]):
                group = tuple(at[start])
                if held and group != last:
                    yield finish()
                    held.clear()
                last = group
                held.append(batch.slice(start, end - start))
        if held:
            yield finish()

    return rows.mapInArrow(compare, "a long, b long, radii double")


def _pairs(balls: DataFrame, blocks: int, most: float, size: int, at_once: int) -> DataFrame:
    """``a, b, radii`` of the balls that meet and are in reach, a few blocks at a time."""
    spark = balls.sparkSession
    # A half: number of the block, which half, its value.
    value = F.col("value").cast("int").bitwiseAND(0xFFFF)
    low = F.col("block") * 512 + value.bitwiseAND(255)
    high = F.col("block") * 512 + 256 + F.shiftright(value, 8)
    split = balls.select("ball", "radius", "sketch", F.posexplode("values").alias("block", "set"))
    split = split.select("ball", "radius", "sketch", "block", F.explode("set").alias("value"))
    split = split.select("ball", "radius", "sketch", "block", "value", F.explode(F.array(low, high)).alias("half"))
    counts = {r["half"]: r["count"] for r in split.groupBy("half").count().collect()}  # 512 a block at most
    large = {h: math.ceil(n / HALF_ROWS) for h, n in counts.items() if n > HALF_ROWS}
    pieces = F.lit(1)
    if large:
        pieces = F.coalesce(F.create_map(*[F.lit(x) for h, n in large.items() for x in (h, n)])[F.col("half")], F.lit(1))
    split = split.withColumn("pieces", pieces).withColumn("piece", F.pmod(F.xxhash64("ball"), F.col("pieces")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    split = split.withColumn("i", F.least("piece", "other")).withColumn("j", F.greatest("piece", "other"))
    steps: list[list[int]] = []
    room = 0
    for block in range(blocks):
        rows = sum(n * large.get(h, 1) for h, n in counts.items() if h // 512 == block)
        if not steps or room < rows:
            steps.append([])
            room = at_once
        steps[-1].append(block)
        room -= rows
    tables = []
    for step in steps:
        rows = sum(n * large.get(h, 1) for h, n in counts.items() if h // 512 in step)
        tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(rows / (1 << 18)))
        dealt = split.where(F.col("block").isin(step)).select("half", "i", "j", "piece", "ball", "value", "radius", "sketch")
        dealt = dealt.repartition(tasks, "half", "i", "j").sortWithinPartitions("half", "i", "j")
        tables.append(parked(_compare_halves(dealt, most, size).distinct(), "met"))
        del dealt
        release(spark)
    met = tables[0]
    for t in tables[1:]:
        met = met.unionByName(t)
    met = parked(met.distinct(), "pairs")
    discard(*tables)
    return met


def _in_parts(rows: DataFrame, parts: int, work: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``work`` on so many parts of the pairs, one after the other, so that what it moves is gone before the next."""
    tables = []
    for part in range(parts):
        tables.append(parked(work(rows.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part) if parts > 1 else rows), name))
        release(rows.sparkSession)
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    if parts > 1:
        out = parked(out, name)
        discard(*tables)
    return out


def _judge(pairs: DataFrame, least: float) -> DataFrame:
    """``a, b, kind`` of pairs of balls with centres and radii; those that share nothing are left out."""
    most = math.acos(least)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, y = _matrix(b.column("va")), _matrix(b.column("vb"))
            cosine = (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            angle, radii = np.arccos(np.clip(cosine, -1, 1)), b.column("radii").to_numpy()
            kind = np.where(angle + radii <= most - SLACK, ALL, np.where(angle - radii <= most + SLACK, OPEN, NONE))
            kind = np.where(radii == 0, np.where(cosine >= least, ALL, NONE), kind)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(kind.astype(np.int32))], names=["a", "b", "kind"]).filter(pa.array(kind != NONE))

    return pairs.mapInArrow(judge, "a long, b long, kind int")


def _compare(opened: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """``a, b, node, links`` of the members of opened pairs of balls, for nodes that link with some of the other ball."""
    sized = members.join(members.groupBy("ball").agg(F.ceil(F.count("*") / PIECE).alias("pieces")), "ball")
    pieces = sized.groupBy("ball", F.pmod(F.xxhash64("node"), F.col("pieces")).alias("piece")).agg(F.collect_list(F.struct("node", "copies", "v")).alias("rows"))
    sides = opened.select("a", "b").join(pieces.toDF("a", "piece_a", "rows_a"), "a").join(pieces.toDF("b", "piece_b", "rows_b"), "b")

    def unpack(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = _matrix(rows.field("v"))
        return rows.field("node").to_numpy(), rows.field("copies").to_numpy(), x / np.linalg.norm(x, axis=1, keepdims=True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                a, b = one.column("a")[0].as_py(), one.column("b")[0].as_py()
                (na, ca, xa), (nb, cb, xb) = unpack(one.column("rows_a").flatten()), unpack(one.column("rows_b").flatten())
                linked = xa @ xb.T >= least
                node, links = np.append(na, nb), np.append(linked @ cb, linked.T @ ca)
                some = links > 0
                n = int(some.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(a, pa.int64()), n), pa.repeat(pa.scalar(b, pa.int64()), n), pa.array(node[some]), pa.array(links[some].astype(np.int64))
                ], names=["a", "b", "node", "links"])

    return sides.select("a", "b", "rows_a", "rows_b").mapInArrow(compare, "a long, b long, node long, links long")


def _named(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, node``: -0.0 is 0.0, equal vectors are one node, and vectors that cannot link have none."""
    sizes = vectors.where(F.size("v") > 0).groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    plain = F.transform("v", lambda x: x + F.lit(0.0).cast("float"))
    return vectors.select("vec_id", plain.alias("v"), F.when(_usable(F.col("v"), sizes["size"] if sizes else 0), F.xxhash64(plain)).alias("node"))


def near_copies(vectors: DataFrame, least: float = LEAST, sample: int = SAMPLE) -> DataFrame:
    """``node, links, component`` of every distinct vector that can link, ``vectors`` being ``vec_id, v, node``.

    ``links`` counts the rows that a row with this vector links with, ``component`` is the smallest id reachable.  The vectors are
    stored once, and moved only to find equal ones and for the pairs that sketches leave open.
    """
    spark = vectors.sparkSession
    nodes = vectors.where("node IS NOT NULL").groupBy("v").agg(F.first("node").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = parked(nodes.select("node", "v", "copies", "least"), "nodes")
    release(spark)
    codes = _fit(nodes, sample)
    if codes is None:
        discard(nodes)
        return vectors.where("false").select("node", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    keyed = parked(_with_keys(nodes, codes), "keyed")
    half, most = math.acos(least) / 2 - SLACK, math.acos(least)
    size, blocks = len(codes.mean), sum(math.ceil(p.shape[1] / BLOCK) for p in codes.projections)
    at_once = max(AT_ONCE, 2 * nodes.count())

    rest, rounds = keyed, []
    for _ in range(ROUNDS):
        # A round's balls of one are no gain: they may find a nearer leader among those left.
        near = parked(_to_leaders(rest, half, blocks, size), "balls")
        full = near.groupBy("ball").agg(F.count("*").alias("n")).where("n > 1").select("ball")
        placed = parked(near.join(full, "ball").select("node", "ball", "angle"), "placed")
        discard(near)
        if placed.isEmpty():
            discard(placed)
            break
        rounds.append(placed)
        before, rest = rest, parked(rest.join(placed.select("node"), "node", "left_anti"), "rest")
        if before is not keyed:
            discard(before)
        del near, full, before
        release(spark)
    if rest is not keyed:
        discard(rest)
    placed = keyed.select("node", F.col("node").alias("ball"), F.lit(0.0).alias("angle")).where("false")
    for r in rounds:
        placed = placed.unionByName(r)
    members = keyed.join(placed, "node", "left").withColumn("ball", F.coalesce("ball", "node")).withColumn("angle", F.coalesce("angle", F.lit(0.0)))
    members = parked(members, "members")
    # An entry holds a ball once, however many of its members have it.  A leader may be a member of another ball than its own.
    led = placed.select("ball").distinct()
    alone = members.join(led, "ball", "left_anti").select(
        "ball", F.lit(0.0).alias("radius"), F.col("copies").alias("weight"), "least", F.lit(1).cast("long").alias("size"),
        F.transform("keys", lambda k: F.array(k)).alias("values"), "sketch",
    )
    sets = F.array(*[F.collect_set(F.get("keys", F.lit(t))) for t in range(blocks)])
    groups = members.join(led, "ball", "left_semi").groupBy("ball").agg(
        F.max("angle").alias("radius"), F.sum("copies").alias("weight"), F.min("least").alias("least"), F.count("*").alias("size"), sets.alias("values"),
    ).join(keyed.select(F.col("node").alias("ball"), "sketch"), "ball")
    balls = parked(alone.unionByName(groups), "centres")
    discard(keyed, *rounds)
    del rest, placed, led, alone, groups, keyed
    release(spark)

    pairs = _pairs(balls, blocks, most, size, at_once)
    sides = nodes.select(F.col("node").alias("ball"), "v")

    def judge(part: DataFrame) -> DataFrame:
        return _judge(part.join(sides.toDF("a", "va"), "a").join(sides.toDF("b", "vb"), "b").select("a", "b", "va", "vb", "radii"), least)

    judged = _in_parts(pairs, math.ceil(max(1, pairs.count()) / at_once), judge, "judged")
    discard(pairs)
    held = balls.select("ball", "size")
    opened = judged.where(F.col("kind") == OPEN).select("a", "b")
    opened = parked(opened.join(held.toDF("a", "na"), "a").join(held.toDF("b", "nb"), "b"), "opened")
    moved = opened.agg(F.sum(F.col("na") + F.col("nb"))).first()[0] or 1

    def compare(part: DataFrame) -> DataFrame:
        wanted = part.select(F.explode(F.array("a", "b")).alias("ball")).distinct()
        own = members.select("ball", "node", "copies").join(wanted, "ball", "left_semi").join(nodes.select("node", "v"), "node")
        return _compare(part, own, least)

    compared = _in_parts(opened, math.ceil(moved / at_once), compare, "compared")
    discard(nodes, opened)

    whole = judged.where(F.col("kind") == ALL).select("a", "b")
    weights = balls.select("ball", "weight")
    both = whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
    by_ball = both.join(weights.toDF("b", "w"), "b").groupBy(F.col("a").alias("ball")).agg(F.sum("w").alias("of_ball"))
    by_node = compared.groupBy("node").agg(F.sum("links").alias("of_node"))
    found = components(whole.unionByName(compared.select("a", "b")).distinct())
    comps = balls.select("ball", "weight", "least").join(found.withColumnRenamed("node", "ball"), "ball", "left").withColumn("comp", F.coalesce("comp", "ball"))
    comps = comps.join(comps.groupBy("comp").agg(F.min("least").alias("component")), "comp")
    told = members.select("node", "ball").join(comps, "ball").join(by_ball, "ball", "left").join(by_node, "node", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    links = (F.col("weight") - 1 + zero(F.col("of_ball")) + zero(F.col("of_node"))).cast("long")
    out = parked(told.select("node", links.alias("links"), "component"), "told")
    discard(members, balls, judged, compared, found)
    release(spark)
    return out


def report(embeddings: DataFrame, least: float = LEAST, sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``.

    ``n_links`` counts the other rows whose cosine with this one is ``least`` or more, in double precision; ``component_id`` is the
    smallest id reachable by links, the row's own included; ``kept`` tells whether it is the row's own.  Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, and so do those of another length than most (the
    shorter of equally frequent ones).  Rows that repeat an id are vectors of their own; rows without an id are counted, and are
    never kept.  Other columns are not read.  An empty table gives no rows.
    """
    vectors = _named(embeddings.select("vec_id", F.col("embedding").cast("array<float>").alias("v")))
    joined = vectors.select("vec_id", "node").join(near_copies(vectors, least, sample), "node", "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def oracle_sql() -> str:
    """All pairs; for tables whose vectors are finite, of one length, and have ids of their own."""
    return f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE list_any_value(list_filter(embedding, lambda x: x <> 0)) IS NOT NULL
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= {LEAST}
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), component AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
counted AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counted USING (vec_id)"""
