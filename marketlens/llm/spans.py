"""Words of many texts at once, as stretches of one byte buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_size(texts: pa.Array, step: int) -> Iterator[pa.Array]:
    """Slices of a string array of ``step`` bytes at most, unless a single text is longer."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy())
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + step, "right")))
        yield texts.slice(a, b - a)
        a = b


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large string array without nulls, and the place of each text in them."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if bounds[-1] > bounds[0] else np.empty(0, np.uint8)
    return buf, bounds - bounds[0]


def stretches(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all stretches of true bytes of the texts that ``bounds`` part, and their number before each text."""
    edge = np.zeros(len(inside) + 1, bool)  # none goes on into the next text
    edge[bounds] = True
    start = np.flatnonzero(inside & (edge[:-1] | np.append(True, ~inside[:-1])))
    end = np.flatnonzero(inside & (edge[1:] | np.append(~inside[1:], True))) + 1
    return start, end, np.searchsorted(start, bounds)
