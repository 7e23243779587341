"""Near copies of vectors against all pairs."""

import numpy as np
import pytest
from test_small_cases import same

from marketlens.llm import embedding_dedup, queries
from marketlens.llm.common import table


def brute(rows, least=0.95):
    size = 64 if not rows else max({len(v) for _, v in rows if v}, key=lambda n: (sum(len(v or ()) == n for _, v in rows), -n), default=0)
    ok = [v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    x = np.array([np.array(v, np.float32).astype(float) if good else np.zeros(size) for (_, v), good in zip(rows, ok)]).reshape(len(rows), size)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(norm == 0, 1, norm)
    linked = (x @ x.T >= least) & ~np.eye(len(rows), dtype=bool)
    linked &= np.outer(ok, ok)
    group = np.arange(len(rows))
    while True:
        lower = np.array([min([group[i], *group[linked[i]]]) for i in range(len(rows))])
        if (lower == group).all():
            break
        group = lower
    ids = [i for i, _ in rows]
    out = []
    for i, own in enumerate(ids):
        comp = min((ids[j] for j in np.flatnonzero(group == group[i]) if ids[j] is not None), default=None)
        out.append((own, int(linked[i].sum()), comp, own is not None and own == comp))
    return out


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, v, "own", 1) for i, v in rows], "vec_id long, embedding array<float>, v string, node int")
    return [tuple(r) for r in embedding_dedup.report(docs.repartition(3), **options).collect()]


def groups(seed, spread, n=400, size=64):
    """Groups around centres, the first of them a third of all."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, size))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    which = np.where(rng.random(n) < 0.33, 0, rng.integers(0, 20, n))
    noise = rng.standard_normal((n, size)) * spread / np.sqrt(size)
    return [(int(i), [float(y) for y in x]) for i, x in enumerate((centres[which] + noise) * rng.uniform(0.1, 9, (n, 1)))]


@pytest.mark.parametrize("spread", [0.02, 0.1, 0.2])
def test_groups(spark, spread):
    """Copies near enough that the tables miss nothing: counts and components are those of all pairs."""
    rows = groups(1, spread)
    same(found(spark, rows), brute(rows))


def test_recall_and_precision(spark):
    """Pairs spread over the whole border: nothing below it is linked, nine tenths above are found."""
    rows = groups(2, 0.3, 600)
    ours, theirs = found(spark, rows), brute(rows)
    told, all_ = sum(r[1] for r in ours), sum(r[1] for r in theirs)
    assert told >= 0.9 * all_ > 0
    most = {r[0]: r[1] for r in theirs}
    assert all(r[1] <= most[r[0]] for r in ours)


def test_odd_rows(spark):
    e = [0.0] * 63
    rows = [
        (1, None), (2, []), (3, [0.0] * 64), (4, [1.0, *e]), (4, [1.0, *e]), (5, [2.0, *e]), (None, [1.0, *e]), (6, [float("nan"), *e]), (7, [float("inf"), *e]),
        (8, [None, 1.0, *e[1:]]), (9, [1.0, 0.0]), (10, [-1.0, *e]), (11, [1.0, -0.0, *e[1:]]), (12, [3e38] * 64), (13, [1e-38] * 64), (14, [0.0, 1.0, *e[1:]]),
    ]
    same(found(spark, rows), brute(rows))
    assert found(spark, []) == []
    same(found(spark, [(1, None), (2, [0.0])]), [(1, 0, 1, True), (2, 0, 2, True)])


def test_short_vectors(spark):
    rows = [(i, [float(np.cos(i / 9)), float(np.sin(i / 9))]) for i in range(50)]
    ours, theirs = found(spark, rows), brute(rows)
    assert sum(r[1] for r in ours) >= 0.9 * sum(r[1] for r in theirs)


def test_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    same([tuple(r) for r in queries.QUERIES["op12_embedding_dedup"](spark, sf).collect()], brute(rows))


def test_large_table(spark):
    """Every fifth vector of the 10,256 of the check's tables, with groups of up to 194."""
    try:
        docs = table(spark, "/root/testdata/check_h", "embeddings").where("vec_id % 5 = 0").cache()
    except Exception as e:
        pytest.skip(str(e)[:80])
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    ours, theirs = [tuple(r) for r in embedding_dedup.report(docs).collect()], brute(rows)
    assert sum(r[1] for r in ours) >= 0.99 * sum(r[1] for r in theirs)
    assert sum(a[2] == b[2] for a, b in zip(sorted(ours), sorted(theirs))) >= 0.99 * len(rows)


def test_circle(spark):
    """In the plane all that link meet, and leaders may belong to another ball: counts are those of all pairs."""
    angles = np.random.default_rng(1).uniform(0, 2 * np.pi, 300)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)]
    same(found(spark, rows), brute(rows))


def test_chance_meetings_leave_no_rows(spark, monkeypatch):
    """Vectors that are far apart share thousands of table entries; none of these pairs may be moved with their vectors."""
    judged, judge = [], embedding_dedup._judge
    monkeypatch.setattr(embedding_dedup, "_judge", lambda pairs, least: judged.append(pairs.count()) or judge(pairs, least))
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(np.random.default_rng(5).standard_normal((3000, 64)))]
    rows += [(5000 + i, [1.01 * y + 0.001 for y in v]) for i, v in rows[:20]]
    same(found(spark, rows), brute(rows))
    assert sum(judged) < 200


def test_halves_in_pieces(spark, monkeypatch):
    """Halves shared by many are compared in pieces and groups, tables and pairs are taken in parts: the same rows."""
    monkeypatch.setattr(embedding_dedup, "HALF_ROWS", 20)
    monkeypatch.setattr(embedding_dedup, "GROUP", 2)
    monkeypatch.setattr(embedding_dedup, "AT_ONCE", 100)
    rows = groups(3, 0.2)
    same(found(spark, rows), brute(rows))
