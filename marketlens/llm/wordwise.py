"""Whole texts to token ids with a public BPE tokenizer, each distinct piece of text encoded once.

Such a tokenizer first cuts a text into words and signs and then encodes each on its own.  Texts are therefore cut beforehand
where the tokenizer is sure to cut too, equal pieces of a batch meet in a dictionary, and only pieces this worker has not seen
are handed to the tokenizer.  Ids are the same as for the whole text, which the tests check on awkward texts.

Sure cuts, between two characters that are both ASCII or a Latin-1 letter: before white space, and between a letter, a digit
and a sign.  An apostrophe is never cut off (contractions), nor is any other character beyond ASCII (it may be white space or
combine with its neighbour).  Texts that hold the opening of a special token go to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

#: Pieces that a worker remembers; beyond, it starts anew, which costs time only.
REMEMBER = 1 << 20
#: Bytes of text that are handled at a time, unless a single text is longer.
STEP = 8_000_000
#: Bytes that are held against the rules for cuts at a time, so that a step needs little more than its texts.
PART = 1_000_000

_OTHER, _LETTER, _DIGIT, _SIGN, _BLANK = range(5)
_CLASS = np.zeros(256, np.uint8)
for _b in range(33, 127):
    _CLASS[_b] = _SIGN
for _b in b"0123456789":
    _CLASS[_b] = _DIGIT
for _b in range(26):
    _CLASS[65 + _b] = _CLASS[97 + _b] = _LETTER
for _b in b" \t\n\x0b\f\r":
    _CLASS[_b] = _BLANK
_CLASS[ord("'")] = _OTHER

_LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"

_open: dict[str, "WordWise"] = kept.setdefault("wordwise", {})


def tokenizer(path: str) -> "WordWise":
    """The worker's own tokenizer for a file; pieces are remembered across batches and tasks."""
    if path not in _open:
        _open[path] = WordWise(path)
    return _open[path]


def steps(batch: pa.RecordBatch, column: str, size: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold at most ``size`` bytes, or a single longer one."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield batch.slice(a, b - a)
        a = b


class WordWise:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path) as f:
            told = json.load(f)
        steps = told["pre_tokenizer"]
        #: Words end in a mark and white space is dropped; else a space belongs to the word after it.
        self.word_ends = steps["type"] == "Sequence" and told["model"]["end_of_word_suffix"] == "</w>"
        self.cuts = self.word_ends or (steps["type"] == "ByteLevel" and steps["use_regex"] and not steps["add_prefix_space"])
        names = self.whole.get_vocab()
        self.marked = np.zeros(max(names.values()) + 1, bool)
        for name, i in names.items():
            self.marked[i] = name.endswith("</w>") if self.word_ends else name.startswith("Ġ")
        #: Only letters; before them, where spaces count, exactly one space.
        self.is_word = re.compile(_LETTERS if self.word_ends else b" " + _LETTERS).fullmatch
        self.forget()

    def forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)  # place i of self.ids to place i + 1 hold piece i
        self.n = 0

    def _learn(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Note pieces whose ids stand one after the other, piece i's up to ``ends[i]``."""
        a, n = self.starts[self.n], len(pieces)
        while a + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + n + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[a:a + len(ids)] = ids
        self.starts[self.n + 1:self.n + n + 1] = a + ends
        self.at.update(zip(pieces, range(self.n, self.n + n)))
        self.n += n

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """The place of each distinct piece, learned first if it is new."""
        if self.n > REMEMBER:
            self.forget()
        known = list(map(self.at.get, pieces))
        new = [p for p, place in zip(pieces, known) if place is None]
        if new:
            self._learn_new(new)
            known = list(map(self.at.__getitem__, pieces))
        return np.array(known, np.int64)

    def _learn_new(self, new: list[bytes]) -> None:
        words, rest = {}, []
        for p in new:
            word = p.strip().lower() if self.word_ends else p
            if self.is_word(word):
                words[p] = word
            else:
                rest.append(p)
        plain = [w for w in dict.fromkeys(words.values()) if w not in self.at]
        for i in range(0, len(plain), 1000):
            self._learn_words(plain[i:i + 1000])
        if self.word_ends:
            for p, word in words.items():
                self.at[p] = self.at[word]
        if rest:
            self._learn_each(rest)

    def _learn_each(self, pieces: list[bytes]) -> None:
        found = [e.ids for e in self.whole.encode_batch([p.decode() for p in pieces], add_special_tokens=False)]
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        self._learn(pieces, np.array([i for ids in found for i in ids], np.uint32), ends)

    def _learn_words(self, words: list[bytes]) -> None:
        text = b" ".join(words) if self.word_ends else b"".join(words)
        ids = np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        at = np.flatnonzero(self.marked[ids])
        bounds = np.concatenate([[0], at + 1]) if self.word_ends else np.concatenate([at, [len(ids)]])
        if len(bounds) == len(words) + 1 and bounds[0] == 0 and bounds[-1] == len(ids):
            self._learn(words, ids, bounds[1:])
        else:  # the marks don't tell these words apart
            self._learn_each(words)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Token ids (uint32) of each text; a null counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        return [ids for step in steps(batch, "text") for ids in self._encode(step.column("text"))]

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if not self.cuts:
            special[:] = True
        direct = {int(i): self.whole.encode(texts[int(i)].as_py(), add_special_tokens=False).ids for i in np.flatnonzero(special)}
        if direct:
            texts = pc.if_else(pa.array(special), pa.scalar("", pa.large_string()), texts)
        # A slice of a string array shares its buffers, so the offsets tell where the bytes are.
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        start, end = int(bounds[0]), int(bounds[-1])
        bounds = bounds - start
        if end == start:
            found = [np.empty(0, np.uint32)] * len(texts)
        else:
            buf = np.frombuffer(data, np.uint8)[start:end]
            places = self._cut(buf, bounds)
            pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(buf)])
            known = pieces.dictionary_encode()
            _, ends, piece_data = known.dictionary.buffers()
            ends = np.frombuffer(ends, np.int64)[:len(known.dictionary) + 1].tolist()
            piece_data = piece_data.to_pybytes()
            place = self._places([piece_data[i:j] for i, j in zip(ends, ends[1:])])
            found = self._gather(place, known.indices.to_numpy(), np.searchsorted(places, bounds))
        for i, own in direct.items():
            found[i] = np.array(own, np.uint32)
        return found

    def _cut(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the pieces of the texts begin, and the end of the last, ``PART`` bytes at a time."""
        cut = np.zeros(len(buf), bool)
        for a in range(0, len(buf), PART):
            lo, hi = max(0, a - 3), min(len(buf), a + PART + 2)  # as far as the rules look
            cut[a:a + PART] = _sure_cuts(buf[lo:hi], self.word_ends)[a - lo:a - lo + PART]
        cut[bounds[:-1][bounds[:-1] < len(buf)]] = True
        cut[0] = True
        return np.append(np.flatnonzero(cut), len(buf))

    def _gather(self, place: np.ndarray, pieces: np.ndarray, split: np.ndarray) -> list[np.ndarray]:
        """The ids of each text, whose pieces are numbers of ``place``; those of text i end at ``split[i + 1]``."""
        found, i = [], 0
        while i < len(split) - 1:
            j = max(i + 1, int(np.searchsorted(split, split[i] + PART // 4, "right")) - 1)
            own = place[pieces[split[i]:split[j]]]
            first, n = self.starts[own], self.starts[own + 1] - self.starts[own]
            upto = np.concatenate([[0], np.cumsum(n)])
            ids = self.ids[np.repeat(first - upto[:-1], n) + np.arange(upto[-1])]
            at = upto[split[i:j + 1] - split[i]]
            found += [ids[a:b] for a, b in zip(at, at[1:])]
            i = j
        return found


def _classes(buf: np.ndarray) -> np.ndarray:
    """The class of each byte; both bytes of a Latin-1 letter are letters."""
    kind = _CLASS[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    lead = lead[(buf[lead + 1] != 0x97) & (buf[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


def _sure_cuts(buf: np.ndarray, word_ends: bool) -> np.ndarray:
    """Where a piece may start."""
    kind = _classes(buf)
    a, b = kind[:-1], kind[1:]
    known = (a != _OTHER) & (b != _OTHER)
    cut = np.zeros(len(buf), bool)
    cut[1:] = known & (a != b) & (a != _BLANK)
    if word_ends:  # every digit is a word
        cut[1:] |= (a == _DIGIT) & (b == _DIGIT)
    else:  # a single line break between other characters stands alone
        alone = (buf[1:-1] == 10) & (kind[:-2] != _BLANK) & (kind[:-2] != _OTHER) & (kind[2:] != _BLANK) & (kind[2:] != _OTHER)
        cut[2:] |= alone
    return cut
