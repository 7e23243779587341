"""Vector bin packing of token sequences with the dot-product rule.

An example has three sizes: tokens, segments (one), and tokens that bear loss.  A sequence has a limit for each.  Into the open
sequence goes the waiting example whose sizes, as shares of the limits, have the largest dot product with the room that is
left; so the size that is still plentiful decides.  Where none fits, the one with most tokens is cut to fill the room, and its
rest waits on.

Every task packs the documents of its own partition as they stream by, with at most ``WAITING`` rests of less than a sequence
in memory.  Nothing is shuffled, and a lost task packs the same way again.  A task's last tokens, less than a full sequence,
become sequences whose lengths are powers of two, so nothing but gaps below ``LEAST_CUT`` is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back
from .wordwise import steps, tokenizer

TOKENS, SEGMENTS = 2048, 256
WAITING = 2048
LEAST_CUT = 16
#: Sequences that a task may number.
PER_TASK = 1 << 40

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])


class Packer:
    """Packs pieces as they come.  ``put`` and ``close`` give finished sequences: lists of (document, start, length)."""

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int | None = None, waiting: int = WAITING):
        self.limits = np.array([tokens, segments, loss or tokens], np.int64)
        self.size = np.zeros((waiting, 3), np.int64)
        self.what: list = [None] * waiting
        self.free = list(range(waiting))[::-1]
        self.room, self.open = self.limits.copy(), []

    def put(self, doc, n: int, loss: int) -> Iterator[list]:
        """Take a document of ``n`` tokens, the last ``loss`` of which bear loss."""
        at = 0
        while n - at >= self.limits[0]:
            length = self._cut(at, n, loss, self.limits)
            yield [(doc, at, length)]
            at += length
        if at < n:
            while not self.free:  # a fill that only cuts leaves its rest waiting
                yield from self._fill()
            self._wait(doc, at, n, loss)

    def _wait(self, doc, at: int, n: int, loss: int) -> None:
        slot = self.free.pop()
        self.what[slot] = (doc, at, n, loss)
        self.size[slot] = n - at, 1, min(loss, n - at)

    @staticmethod
    def _cut(at: int, n: int, loss: int, room: np.ndarray) -> int:
        """The most tokens from ``at`` on that the room takes."""
        plain = max(0, n - loss - at)  # tokens before the first that bears loss
        return int(min(n - at, room[0], plain + room[2]))

    def _fill(self) -> Iterator[list]:
        """Fill the open sequence from those that wait."""
        used = self.size[:, 0] > 0
        while used.any():
            fits = used & (self.size <= self.room).all(axis=1)
            if fits.any():
                value = (self.size / self.limits) @ (self.room / self.limits)
                slot = int(np.argmax(np.where(fits, value, -1.0)))
                doc, at, n, loss = self.what[slot]
                length = n - at
            else:
                slot = int(np.argmax(np.where(used, self.size[:, 0], -1)))
                doc, at, n, loss = self.what[slot]
                length = self._cut(at, n, loss, self.room) if self.room[1] else 0
                if length < LEAST_CUT and self.open:
                    break
            self.open.append((doc, at, length))
            self.room -= (length, 1, min(length, max(0, at + length - (n - loss))))
            self.free.append(slot)
            self.size[slot] = 0
            used[slot] = False
            if at + length < n:
                self._wait(doc, at + length, n, loss)
                used = self.size[:, 0] > 0
            if not self.room[0]:
                break
        if self.open:
            yield self.open
        self.room, self.open = self.limits.copy(), []

    def close(self) -> Iterator[list]:
        """What is left; the last sequence is split into lengths that are powers of two."""
        while (self.size[:, 0] > 0).any():
            for pieces in self._fill():
                yield from [pieces] if (self.size[:, 0] > 0).any() else _powers(pieces, int(self.limits[0]))


def _powers(pieces: list, full: int) -> Iterator[list]:
    total = sum(length for *_, length in pieces)
    if total == full:
        yield pieces
        return
    pieces = pieces[::-1]
    while total:
        room, out = 1 << (total.bit_length() - 1), []
        total -= room
        while room:
            doc, at, length = pieces.pop()
            take = min(room, length)
            out.append((doc, at, take))
            room -= take
            if take < length:
                pieces.append((doc, at + take, length - take))
        yield out


def pack(docs: DataFrame, vocabulary: str, end_id: int, tokens: int = TOKENS, segments: int = SEGMENTS,
         loss: int | None = None, loss_chars: str | None = None) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens``.

    Every whole ``text`` is encoded and followed by ``end_id``.  ``loss_chars`` names a column with the number of characters at
    the end of the text that bear loss, as in prompt and answer; without it all tokens do.  The answer is encoded with its
    prompt, and its share of the tokens is that of its characters, rounded up.

    A null text is empty: a single piece of one id.  A null ``doc_id`` and repeated rows are packed as they are.  Other columns
    are not read.  An empty table gives no rows.  Sequences hold at most ``tokens`` ids, ``segments`` pieces and ``loss``
    loss-bearing ids; offsets have no gaps.
    """
    asked = docs.select("doc_id", "text", (F.col(loss_chars).cast("long") if loss_chars else F.lit(-1).cast("long")).alias("loss"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = tokenizer(vocabulary), Packer(tokens, segments, loss)
        number = TaskContext.get().partitionId() * PER_TASK
        rows: list[tuple] = []

        def note(sequences: Iterator[list]) -> None:
            nonlocal number
            for pieces in sequences:
                at = 0
                for (doc_id, ids, n_loss), start, length in pieces:
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    bearing = min(length, max(0, start + length - (len(ids) - n_loss)))
                    rows.append((doc_id, start, length, crc, len(ids), number, at, bearing))
                    at += length
                number += 1

        def table() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(_ARROW)
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)
            rows.clear()
            return batch

        for batch in batches:
            for b in steps(batch, "text"):
                texts = b.column("text")
                for doc_id, ids, chars, text in zip(b.column("doc_id").to_pylist(), words.encode(texts), b.column("loss").to_pylist(), texts):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    n_loss = len(ids)
                    if loss_chars:
                        size = max(1, len(text.as_py() or ""))
                        n_loss = min(len(ids), -(-len(ids) * min(size, max(0, chars or 0)) // size))
                    note(packer.put((doc_id, ids, n_loss), len(ids), n_loss))
                yield table()
            give_back("wordwise")
        note(packer.close())
        yield table()

    return asked.mapInArrow(place, SCHEMA)
