"""What the decontamination works out, it works out once, and where Spark compiles it."""

from pyspark.sql import functions as F
from test_small_cases import LONG, frame, listed

from marketlens.llm import decontaminate
from marketlens.llm.common import alnum_words, grams


def test_windows_are_worked_out_once(spark):
    """The opened windows and their texts are read once; a filter on a window doesn't cut it out of its document again."""
    item = " ".join(f"q{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.matches(frame(spark, [(1, f"before {item} after"), (2, LONG)]), bench)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("slice(") == 1
    assert sum("Relation [row#" in line and "marks#" in line for line in plan.splitlines()) == 1
    assert {r["start"] for r in listed(found)} >= {1}


def test_places(spark):
    """The runs of a document are those of ``grams``, without a function that Spark interprets."""
    rows = [(1, None), (2, ""), (3, "A b"), (4, "--a b; c,, d e--"), (5, "a b c d e a b c d e f"), (6, "ß É x\ny 1 2 K İ"), (7, LONG)]
    words = frame(spark, rows).select(F.col("doc_id").alias("row"), alnum_words(F.coalesce("text", F.lit(""))).alias("words"))
    for n in (1, 2, 5):
        places = decontaminate._places(words, n)
        assert "lambda" not in places._jdf.queryExecution().optimizedPlan().toString()
        plain = words.select("row", F.size("words").alias("n_doc"), F.posexplode(grams(F.col("words"), n)).alias("p", "gram"))
        assert places.schema.simpleString() == plain.schema.simpleString()
        assert sorted(map(tuple, places.collect())) == sorted(map(tuple, plain.collect()))
