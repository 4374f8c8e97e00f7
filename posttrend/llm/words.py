"""Words and shingles of many texts at once, as arrays of 64-bit hashes.

Texts are taken as UTF-8 bytes and handled in slices of about ``SLICE`` bytes, so a task needs a few dozen times that
much memory, or as much for its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPACE_WORD_BYTES = ~_SPACE
LETTER_WORD_BYTES = np.ones(256, bool)
LETTER_WORD_BYTES[:0x80] = False
LETTER_WORD_BYTES[0x30:0x3A] = True
LETTER_WORD_BYTES[0x61:0x7B] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_rng = np.random.default_rng(20240501)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _place(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), _STEP, np.uint64))
    return _powers


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts Arrow batches into runs of rows, each with its texts as bytes (NULL as empty).  ``text``: a column's name,
    or ``column.field`` of a struct column."""
    name, _, field = text.partition(".")
    for batch in batches:
        column = batch.column(name)
        if field:
            column = column.field(column.type.get_field_index(field))
        texts = [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
        begin, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > SLICE:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(t)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


class Words:
    """``hashes`` of all words of the texts one after the other; text ``i`` has words ``first[i]:first[i + 1]``.
    ``begin`` and ``end`` are their places in ``buffer``, in which the texts stand apart by one space."""

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray, lower: bool = True):
        joined = b" " + b" ".join(texts) + b" "
        if lower:
            joined = joined.translate(_LOWER)
        self.buffer = np.frombuffer(joined, np.uint8)
        inside = word_bytes[self.buffer]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.begin, self.end = edges[::2], edges[1::2]
        lengths = self.end - self.begin
        at = np.cumsum(lengths) - lengths
        if len(at):
            place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
            codes = _BYTE_CODE[self.buffer[inside]] * _place(int(lengths.max()) + 1)[place]
            self.hashes = mix(np.add.reduceat(codes, at) + lengths.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        text_end = np.cumsum(sizes)
        self.first = np.concatenate([[0], np.searchsorted(self.begin, text_end)])
        self.text_begin = text_end - sizes + 1


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes (as int64) of its runs of ``n`` words; of all its words, if it has fewer."""
    h = words.hashes
    total = len(h)
    runs = np.zeros(max(0, total - n + 1), np.uint64)
    for k in range(n):
        runs = runs * _STEP + h[k : total - n + 1 + k] if len(runs) else runs
    runs = mix(runs).view(np.int64)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = short * _STEP + h[k]
            out.append(mix(short).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out
