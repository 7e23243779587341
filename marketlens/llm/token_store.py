"""Token ids in Parquet list columns, in ascending order of ``doc_id``.

A store is a folder of Parquet files, one per key range, with a row per document: ``doc_id, part, start_in_part, n_tokens,
ids``.  Ids are dictionary encoded (a vocabulary fits the dictionary), counters delta encoded; row groups are small enough to
be read on their own and pages carry an index, so a read of a few documents, or of the counters alone, touches little else.
Texts are shuffled once, as text, which is smaller than its ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .wordwise import steps, tokenizer

ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 2_000
SCHEMA = "doc_id long, part int, start_in_part long, n_tokens int, ids array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int, parts: int | None = None) -> None:
    """Encode every whole ``text`` and write the store.

    A null text is empty, so its only id is ``end_id``.  A null ``doc_id`` comes first.  Rows with the same ``doc_id`` are all
    kept, ordered by the hash of their text.  An empty table gives a store without rows.  Other columns are not read.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at, part = tokenizer(vocabulary), 0, TaskContext.get().partitionId()
        for batch in batches:
            for b in steps(batch, "text"):
                ids = [np.append(x, np.uint32(end_id)) for x in words.encode(b.column("text"))]
                n = np.array([len(x) for x in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n.astype(np.int32)), lists], schema=_ARROW
                )

    tie = F.xxhash64("text")
    dealt = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (
        dealt.select("doc_id", "text").mapInArrow(encode, SCHEMA).write
        .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#start_in_part", "false")
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; select columns and filter on ``doc_id`` to read only what is needed."""
    return spark.read.schema(SCHEMA).parquet(path)


def bases(spark: SparkSession, path: str) -> dict[int, int]:
    """Ids before each part, from the counters alone: one number per file."""
    ends = read(spark, path).groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens"))).orderBy("part").collect()
    out, at = {}, 0
    for part, n in ends:
        out[part] = at
        at += n
    return out


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored row, from the ids in the files."""
    before = bases(spark, path)
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            base = np.array([before[p] for p in b.column("part").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(base + b.column("start_in_part").to_numpy()), pa.array(np.diff(offsets).astype(np.int64)),
                pa.array([zlib.crc32(values[i:j].tobytes()) for i, j in zip(offsets, offsets[1:])], pa.int64()),
            ], schema=out)

    rows = read(spark, path).select("doc_id", "part", "start_in_part", "ids")
    return rows.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
