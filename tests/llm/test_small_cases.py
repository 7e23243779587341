"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names; each operator on small tables."""

import collections
import hashlib
import random
import re
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_brute_force import alnum, brute_classes, brute_languages, brute_leaks, brute_repeats, shingles
from tokenizers import Tokenizer

from marketlens.llm import decontaminate, html_text, jaccard_join, language_id, license_scan, packing, quality_rules, suffix_dedup, token_store, url_filter

#: Names that the operators use for columns of their own.
CLASHES = ["row", "node", "words", "spans", "part", "key", "comp", "item", "start", "same", "lang_pred", "lang_score", "title"]
DOCS = "doc_id long, text string, lang string, n_chars int, " + ", ".join(f"{c} string" for c in CLASHES)

ARTICLE = " ".join(f"term{i}" for i in range(120))
LONG = " ".join(f"word{i % 997} and{i}" for i in range(40_000))
ROWS = [
    (1, ARTICLE), (2, ARTICLE), (3, ARTICLE + " more"), (None, ARTICLE), (4, None), (5, ""), (6, " \t\n"), (7, "one two"), (7, "one two"),
    (8, "ONE  TWO"), (9, LONG), (10, "déjà vu Ünïcode K İ\u00a0x\u0085y 🙂 # * |"), (11, "7"), (12, "same line here\nsame line here\n\nother"),
]


def frame(spark, rows=ROWS, lang=None):
    return spark.createDataFrame([(i, t, lang, None if t is None else len(t), *["own"] * len(CLASHES)) for i, t in rows], DOCS)


def listed(df):
    return [r.asDict() for r in df.collect()]


def same(found, expected):
    assert collections.Counter(found) == collections.Counter(expected)


def test_jaccard(spark):
    sets = {n: shingles(t or "", 4) for n, (_, t) in enumerate(ROWS)}
    top = brute_classes(sets, 85)
    ids = collections.defaultdict(list)
    for n, (i, _) in enumerate(ROWS):
        if i is not None:
            ids[top[n]].append(i)
    expected = [(i, len(sets[n]), min(ids[top[n]])) for n, (i, _) in enumerate(ROWS)]
    same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in listed(jaccard_join.report(frame(spark)))], expected)
    assert jaccard_join.report(frame(spark, [])).count() == 0


def test_jaccard_tie_and_border(spark):
    """Exactly at the border links, just below does not."""
    base = [f"w{i}" for i in range(23)]  # 20 shingles of four words
    rows = [(1, " ".join(base)), (2, " ".join([*base, "x", "y", "z"])), (3, " ".join([*base, "x", "y", "q", "r"]))]  # 20/23, 20/24
    found = {r["doc_id"]: r["component_id"] for r in listed(jaccard_join.report(frame(spark, rows)))}
    sets = {i: shingles(t, 4) for i, t in rows}
    assert found == brute_classes(sets, 85)
    exact = [(1, " ".join(f"w{i}" for i in range(20))), (2, " ".join(f"w{i}" for i in range(23)))]  # 17/20
    assert {r["component_id"] for r in listed(jaccard_join.report(frame(spark, exact)))} == {1}


def test_jaccard_chains_and_random(spark):
    """Chains of small changes hang together over texts that are not similar themselves."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rng.randrange(60)] = f"n{i}"
    found = {r["doc_id"]: r["component_id"] for r in listed(jaccard_join.report(frame(spark, rows)))}
    assert found == brute_classes({i: shingles(t, 4) for i, t in rows}, 85)


def test_deduplicate(spark):
    kept = listed(jaccard_join.deduplicate(frame(spark), k=5, percent=80))
    assert all(r["row"] == "own" and r["title"] == "own" for r in kept)
    assert sum(r["text"] is not None and r["text"].startswith("term0") for r in kept) == 1
    assert {4, 5, 6, 9, 10, 11, 12} <= {r["doc_id"] for r in kept} and sum(r["doc_id"] in (7, 8) for r in kept) == 1


def test_license(spark):
    rows = [(1, "The MIT License"), (2, None), (3, ""), (4, "cc by, cc BY"), (4, "cc by, cc BY"), (None, "apache"), (5, LONG + " Apache\nLicense")]
    found = listed(license_scan.scan(frame(spark, rows)))
    n = len(alnum(LONG))
    same(
        [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found],
        [(1, 3, 1, 1, 1, "mit"), (2, 0, 0, None, None, ""), (3, 0, 0, None, None, ""), (4, 4, 2, 0, 2, "cc-by"), (4, 4, 2, 0, 2, "cc-by"), (None, 1, 0, None, None, ""),
         (5, n + 2, 1, n, n, "apache")],
    )
    assert all(0 <= r["score"] <= 1 for r in found)
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_license_span_with_a_gap(spark):
    text = license_scan.TEXTS[3][0].split()
    rows = [(1, " ".join(text[:4] + ["here"] + text[4:])), (2, " ".join(text[:3]))]
    assert {r["doc_id"]: r["labels"] for r in listed(license_scan.scan(frame(spark, rows)))} == {1: "bsd", 2: ""}


def test_urls(spark):
    urls = [
        (1, None), (2, ""), (3, "no scheme/x"), (4, "http://Example.ORG/es/x#y"), (5, "https://a.example.org/en/12?q=/es/"), (6, "http://example.org"),
        (7, "http://notexample.org/es/"), (8, "x://de.com/de/" + "p" * 50_000), (9, "http://fr.com/fr/"), (9, "http://fr.com/fr/"), (None, "http://a.net/"),
        (10, "http://"), (11, "http:///de/"), (12, "http://com/de/"), (13, "http://.org/"),
    ]
    pages = spark.createDataFrame([(i, u, "own", "own", "own", 1) for i, u in urls], "page_id long, url string, host string, rule string, key string, bucket int")
    found = [(r["page_id"], r["host"], r["rule"], r["verdict"]) for r in listed(url_filter.judge(pages, url_filter.rule_table(spark)))]
    same(found, [
        (1, "", None, "block"), (2, "", None, "block"), (3, "", None, "block"), (4, "example.org", "example.org/es/", "block"),
        (5, "a.example.org", "example.org/en/1", "block"), (6, "example.org", None, "allow"), (7, "notexample.org", "org/", "allow"),
        (8, "de.com", "com/de/", "block"), (9, "fr.com", "com/fr/", "allow"), (9, "fr.com", "com/fr/", "allow"), (None, "a.net", None, "allow"),
        (10, "", None, "block"), (11, "", None, "block"), (12, "com", "com/de/", "block"), (13, ".org", "org/", "allow"),
    ])
    rules = url_filter.rule_table(spark)
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r["rule"] for r in listed(url_filter.judge(pages, rules.limit(0)))} == {None}
    clash = url_filter.rule_table(spark, [("allow", "a.net", "/"), ("block", "A.net", "/"), ("block", None, "/"), ("allow", "b.net", None)])
    assert [r["verdict"] for r in listed(url_filter.judge(pages, clash)) if r["page_id"] is None] == ["block"]


@pytest.mark.parametrize("seed", range(6))
def test_packer_limits(seed):
    """Every token once, no limit exceeded, whatever sizes come."""
    rng = random.Random(seed)
    docs = [(i, n, rng.randrange(0, n + 1)) for i, n in enumerate(rng.choice([1, 3, 17, 64, 200, 999]) for _ in range(300))]
    packer = packing.Packer(tokens=64, segments=3, loss=20, waiting=16)
    sequences = [s for i, n, loss in docs for s in packer.put(i, n, loss)]
    sequences += list(packer.close())
    covered = collections.defaultdict(list)
    for pieces in sequences:
        assert 0 < len(pieces) <= 3 and sum(n for *_, n in pieces) <= 64
        bearing = 0
        for i, at, n in pieces:
            assert n > 0
            covered[i] += range(at, at + n)
            bearing += sum(x >= docs[i][1] - docs[i][2] for x in range(at, at + n))
        assert bearing <= 20
    assert {i: sorted(x) for i, x in covered.items()} == {i: list(range(n)) for i, n, _ in docs}


def test_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = listed(packing.pack(frame(spark), path, end_id=1))
    sizes = {i: len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in ROWS}
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == sizes
    total = collections.Counter()
    for r in rows:
        total[r["doc_id"]] += r["length"]
    assert total == {i: n * (2 if i == 7 else 1) for i, n in sizes.items()}
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert packing.pack(frame(spark, []), path, end_id=1).count() == 0
    bearing = listed(packing.pack(frame(spark).withColumn("answer", F.lit(2)), path, end_id=1, loss=100, loss_chars="answer"))
    per = collections.Counter()
    for r in bearing:
        per[r["sequence_id"]] += r["loss_tokens"]
    assert max(per.values()) <= 100


def test_token_files(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    store = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/store"
    token_store.write(frame(spark), store, path, end_id=0, parts=3)
    found = sorted(listed(token_store.digests(spark, store)), key=lambda r: r["start"])
    ids = [(i, np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for i, t in ROWS]
    same([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found], [(i, len(x), zlib.crc32(x.tobytes())) for i, x in ids])
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in found]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    one = token_store.read(spark, store).where("doc_id = 3").select("n_tokens").collect()
    assert [r[0] for r in one] == [len(x) for i, x in ids if i == 3]
    empty = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/store"
    token_store.write(frame(spark, []), empty, path, end_id=0, parts=3)
    assert token_store.digests(spark, empty).count() == 0


def test_language(spark):
    english = [(i, f"the house and the garden of the people number {i}") for i in range(40)]
    german = [(100 + i, f"das Haus und der Garten von den Leuten Nummer {i}") for i in range(40)]
    blank = [(200, None), (201, ""), (202, "12 34 !?"), (None, "the people and the house"), (203, "gartenhaus"), (203, "gartenhaus")]
    docs = frame(spark, english, "en").unionByName(frame(spark, german, "de")).unionByName(frame(spark, blank))
    found = listed(language_id.identify(docs))
    assert len(found) == 86
    by = {r["doc_id"]: r for r in found}
    assert all(by[i]["lang_pred"] == "en" for i, _ in english) and all(by[i]["lang_pred"] == "de" for i, _ in german)
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (200, 201, 202))
    assert by[None]["lang_pred"] == "en" and by[203]["lang_pred"] == "de"
    kept = listed(language_id.accepted(docs))
    assert {r["doc_id"] for r in kept}.isdisjoint({200, 201, 202}) and {r["lang_pred"] for r in kept} == {"own"}
    assert set(kept[0]) == set(docs.columns)
    assert {r["lang_pred"] for r in listed(language_id.identify(frame(spark)))} == {"und"}
    assert language_id.identify(frame(spark, [])).count() == 0


def test_language_odd_texts(spark):
    """Nulls, signs that are no letters, letters nobody learned, very long and tied texts with a fitted model."""
    learned = [(i, f"the house and the garden of the people number {i}", "en") for i in range(40)]
    learned += [(100 + i, f"das Haus und der Garten von den Leuten Nummer {i}", "de") for i in range(40)]
    odd = [(200, None), (201, ""), (202, "½ ² ③ 12 _ !?"), (203, "漢字"), (204, "x" * 300_000), (205, "garden " * 200_000), (206, "die\x00häuser²garten"),
           (207, "the das"), (None, "den Garten"), (205, "garden " * 200_000), (208, "E\u0301 i\u0307 İ"), (209, "q")]
    rows = learned + [(i, t, None) for i, t in odd]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    expected = collections.defaultdict(list)
    for i, own in brute_languages(rows):
        expected[i].append(own)
    found = listed(language_id.identify(docs))
    assert len(found) == len(rows)
    for r in found:
        own = expected[r["doc_id"]][0]
        assert own[r["lang_pred"]] >= max(own.values()) - 1e-3 and abs(own[r["lang_pred"]] - r["score"]) < 1e-3, r
    by = {r["doc_id"]: r for r in found}
    assert [by[i]["lang_pred"] for i in (200, 201, 202)] == ["und"] * 3
    assert by[203]["lang_pred"] in ("de", "en")


def test_language_tie(spark):
    rows = [(1, "one text", "b"), (2, "one text", "a"), (3, "one text", None)]
    assert [zlib.crc32(str(i).encode()) % 5 > 0 for i in (1, 2)] == [True, True]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in listed(language_id.identify(docs))} == {("a", 0.5)}


@pytest.mark.parametrize("length", [20, 400])
def test_suffix_report(spark, length):
    rng = random.Random(length)
    texts = [t or "" for _, t in ROWS if t is None or len(t) < 5000]
    texts += ["a" * n for n in (1, length - 1, length, length + 1, 3 * length)]
    passage = "".join(rng.choice("abcdé") for _ in range(3 * length))
    for n in range(30):
        own = "".join(rng.choice("ab ") for _ in range(rng.randrange(4 * length)))
        cut = rng.randrange(2 * length)
        texts.append(own[:50] + (passage[cut:cut + rng.randrange(length, 2 * length)] if n % 2 else "") + own[50:])
    rows = list(enumerate(texts))
    data = {i: t.encode() for i, t in rows}
    expected = [(i, len(data[i]), n, s, hashlib.sha256(rest).hexdigest()) for i, (n, s, rest) in brute_repeats(data, length).items()]
    found = listed(suffix_dedup.report(frame(spark, rows), length))
    same([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found], expected)


def test_suffix_edges(spark):
    found = listed(suffix_dedup.report(frame(spark)))
    assert len(found) == len(ROWS)
    gone = {r["doc_id"]: r["n_removed"] for r in found}
    assert gone[None] == gone[1] == gone[2] == len(ARTICLE) and gone[4] == gone[5] == gone[9] == 0
    assert suffix_dedup.report(frame(spark, [])).count() == 0
    kept = listed(suffix_dedup.remove(frame(spark)))
    assert {r["doc_id"] for r in kept} == {3, 4, 5, 6, 7, 8, 9, 10, 11, 12}
    assert {r["doc_id"]: r["text"] for r in kept}[3] == " more" and {r["doc_id"]: r["n_chars"] for r in kept}[3] == 5
    assert all(r["spans"] == "own" for r in kept)


def test_decontamination(spark):
    plain = " ".join(f"q{i}" for i in range(30))
    changed = plain.replace("q29", "zz")
    rows = [
        (1, plain), (2, f"before {plain} after"), (3, changed), (4, None), (5, ""), (6, "q0 q1"), (7, "short item"), (7, "short item"), (None, plain),
        (8, LONG + " " + plain), (9, " ".join(f"q{i}" for i in range(15))), (10, "some short item here"),
    ]
    items = [(1, plain, "own"), (1, plain, "own"), (2, "short item", "own"), (3, None, "own"), (4, "", "own"), (None, plain, "own")]
    bench = spark.createDataFrame(items, "item_id long, text string, row string")
    expected = brute_leaks({n: t or "" for n, (_, t) in enumerate(rows) if t != rows[9][1]}, {1: plain, 2: "short item"})
    expected[9] = {1}
    found = listed(decontaminate.report(frame(spark, rows), bench))
    same([(r["doc_id"], r["items"], r["contaminated"]) for r in found],
         [(i, ",".join(map(str, sorted(expected.get(n, ())))), bool(expected.get(n))) for n, (i, _) in enumerate(rows)])
    clean = listed(decontaminate.remove(frame(spark, rows), bench))
    assert sorted(r["doc_id"] for r in clean) == [4, 5, 6, 9] and {r["row"] for r in clean} == {"own"}
    assert not any(r["contaminated"] for r in listed(decontaminate.report(frame(spark, rows), bench.limit(0))))
    assert decontaminate.report(frame(spark, []), bench).count() == 0


def test_html(spark):
    body = "A sentence of the article, with a comma, and some more words to read. " * 5
    deep = "<div>" * 5000 + f"<p>{body}</p>" + "</div>" * 5000
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body><nav><a href=x>Menu</a></nav><article><h1>Caf&eacute; &amp; more</h1>
    <p>{body}</p><script>var x = "<p>no</p>";</script><p>Second,\n\t  line &#x41;</p><div class="comments"><p>Reader says, hello</p></div></article>
    <aside>Side</aside><footer>Foot</footer></body></html>"""
    pages = [(1, "u", None), (2, "u", ""), (3, None, page), (3, None, page), (None, "u", deep), (4, "u", "<nav>only a menu</nav>"), (5, "u", "<p"), (6, "u", "plain")]
    df = spark.createDataFrame([(*p, "own") for p in pages], "page_id long, url string, html string, text string")
    text = f"Café & more\n{body.strip()}\nSecond, line A"
    found = listed(html_text.extract(df))
    same([(r["page_id"], r["url"], r["text"]) for r in found], [
        (1, "u", ""), (2, "u", ""), (3, None, text), (3, None, text), (None, "u", body.strip()), (4, "u", ""), (5, "u", ""), (6, "u", "plain"),
    ])
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.extract(df.limit(0)).count() == 0


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(runs)
    again = {i + j for i, r in enumerate(runs) if often[r] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), n < 10 or 100 * len(again) > 20 * n)


def test_quality(spark):
    loop = "a b c d e f " * 40
    rows = [*ROWS, (20, loop), (20, loop), (21, "x " * 9), (22, "a b c d e a b c d e " + " ".join(f"n{i}" for i in range(40))), (23, "a\r\na\r\n \n\n# #")]
    found = listed(quality_rules.judge(frame(spark, rows)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same([(r["doc_id"], *[r[c] for c in names]) for r in found], [(i, *brute_quality(t or "")) for i, t in rows])
    assert not any(r["kept"] and r["base_failed"] for r in found)
    bits = quality_rules.ledger(frame(spark, rows))
    fails = [r["fails"] for r in listed(bits)]
    for r in listed(quality_rules.ablations(bits)):
        bit = 1 << [name for name, _ in quality_rules.RULES].index(r["rule"])
        assert (r["n_failed"], r["n_only"]) == (sum(bool(f & bit) for f in fails), sum(f == bit for f in fails))
    assert quality_rules.judge(frame(spark, [])).count() == 0


def test_license_counts_each_template_run_once_and_keeps_repeated_rows(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, "the license " * 12), (2, "mit license"), (2, "mit license"), (3, None), (3, None), (4, long), (5, " ".join(long.split()[60:135]))]
    columns = spark.createDataFrame(rows, "doc_id long, text string")
    found = license_scan.scan(columns).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 2, 2, 3, 3, 4, 5]
    assert {r["doc_id"]: r["labels"] for r in found} == {1: "", 2: "mit", 3: "", 4: "", 5: ""}
    assert all(r["score"] < 0.2 for r in found if r["doc_id"] == 1)
    # A template of more runs than a mask has bits.
    found = {r["doc_id"]: r for r in license_scan.scan(columns, texts=[(long, "long")]).collect()}
    assert (found[4]["labels"], found[4]["score"]) == ("long", 1.0) and found[5]["labels"] == ""
    assert abs(found[5]["score"] - 74 / 199) < 1e-9
