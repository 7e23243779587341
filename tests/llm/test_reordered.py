"""Benchmark items whose parts stand in another order, against brute force."""

import random

from test_brute_force import brute_leaks
from test_small_cases import frame, listed

from marketlens.llm import decontaminate


def test_reordered_items(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 10)))
    items = {i: [word() for _ in range(n)] for i, n in enumerate([55, 55, 30, 80, 55, 3, 12])}
    items[7] = items[2][:15] * 3
    rows = []
    for i, item in items.items():
        for cut in (0, 3, 8, 20):
            for shown in (item, item[cut:] + item[:cut], item[cut // 2:], item[:10] + [word()] + item[10:]):
                rows.append((len(rows), " ".join([word() for _ in range(rng.randrange(30))] + shown + [word() for _ in range(rng.randrange(30))])))
    rows += [(500, " ".join(items[3][2:])), (501, rows[0][1]), (501, rows[0][1]), (502, " ".join(items[7] * 20))]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], "item_id long, text string")
    expected = brute_leaks(dict(rows), {i: " ".join(x) for i, x in items.items()})
    moved = items[0][8:] + items[0][:8]
    assert any(" ".join(moved) in t and 0 in expected[i] for i, t in rows)
    found = {r["doc_id"]: r["items"] for r in listed(decontaminate.report(frame(spark, rows), bench))}
    assert found == {i: ",".join(map(str, sorted(expected.get(i, ())))) for i, _ in rows}
