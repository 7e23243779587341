"""Small helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path

#: One white-space character of the word rule: space, tab, \n, \v, \f, \r.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def parked(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and losing an executor loses nothing.

    Whoever parks a table discards it when nothing that is still to be computed reads it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _places[out] = path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now; it does so when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


#: What Python workers remember from one task to the next, by operator.
kept: dict[str, dict] = {}


def give_back(operator: str | None = None) -> None:
    """Forget what other operators remember in this Python worker, and return what is free to the system.

    Spark keeps workers for later stages; what an earlier one left there counts against theirs.
    """
    for name, store in kept.items():
        if name != operator:
            store.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # a C library without it
            ctypes.CDLL(None).malloc_trim(0)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``parked`` made; others are left alone."""
    for df in tables:
        place = _places.pop(df, None)
        if place:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def blank_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``.  Six byte replacements and a split on one character, no pattern matching."""
    for c in BLANKS[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def lowered(text: Column) -> Column:
    """A-Z in lower case.

    ``lower`` also changes letters outside ASCII, which no caller compares; the two of them that would turn into ASCII
    letters (the Kelvin sign and I with a dot) are replaced by other letters first.
    """
    text = F.replace(text, F.lit("K"), F.lit("ĸ"))
    return F.lower(F.replace(text, F.lit("İ"), F.lit("ı")))


def alnum_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text in lower case: digits, a-z and all beyond ASCII."""
    return F.array_remove(F.split(lowered(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def grams(words: Column, k: int) -> Column:
    """Hashes of every run of ``k`` words, in order; empty if there are fewer words."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    return F.when(F.size(words) >= k, F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))).otherwise(
        F.array().cast("array<bigint>")
    )
