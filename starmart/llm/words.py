"""Words of whole texts as 64-bit codes, worked out for a whole Arrow batch at a time.

Runs inside Spark's Python tasks. Nothing here holds more than one slice of a batch: `slices` cuts
a batch into runs of rows of at most SLICE_BYTES of text (a longer single text is a slice of its own).
A word's code is a polynomial over its bytes modulo 2**64, mixed; two words of one corpus share
a code with a chance of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

# Byte classes. Both only single out ASCII bytes, so that bytes serve as well as characters.
SPACED = np.ones(256, bool)                    # [^\x20\x09-\x0D]
SPACED[[0x20, *range(0x09, 0x0E)]] = False
LETTERS = np.zeros(256, bool)                  # [^\x00-\x2F\x3A-\x60\x7B-\x7F], after A-Z became a-z
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit codes (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


_kept_powers: dict[tuple[int, int], np.ndarray] = {}


def _powers(n: int, of: int) -> np.ndarray:
    if n > 2 * SLICE_BYTES:                       # a single long text: not kept
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, of, np.uint64))))
    if (n, of) not in _kept_powers:
        _kept_powers[n, of] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, of, np.uint64))))
    return _kept_powers[n, of]


def _room(n: int) -> int:
    return max(SLICE_BYTES, 1 << int(n).bit_length())


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A code for the bytes of each span [start, end)."""
    room = _room(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _powers(room, int(BASE))[:len(data)], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * _powers(room, int(_INVERSE))[starts]
    return mix(codes + (ends - starts).astype(np.uint64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


class Words:
    """All words of the rows of a slice: `starts`, `ends` in `data`, `codes`, and for row r the
    words from first[r] up to first[r + 1]. `data` is lower-cased (A-Z only)."""

    def __init__(self, column: pa.Array, kind: np.ndarray):
        raw, offsets = utf8(column)
        self.data, self.rows = LOWER[raw], len(offsets) - 1
        # a word ends with its row: a separator is set between rows
        inside = np.zeros(len(raw) + self.rows + 1, bool)
        shift = np.repeat(np.arange(self.rows), np.diff(offsets))
        inside[np.arange(len(raw)) + shift] = kind[self.data]
        turns = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
        starts, ends = turns[::2], turns[1::2]
        row_starts = offsets[:-1] + np.arange(self.rows)
        self.row = np.searchsorted(row_starts, starts, "right") - 1
        self.starts, self.ends = starts - self.row, ends - self.row
        self.codes = span_codes(self.data, self.starts, self.ends)
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))
        self.offsets = offsets

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all runs of k words, and where each row's runs begin; a row of fewer words,
        but not none, has its whole sequence as one run."""
        n = self.counts()
        per_row = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
        first = np.concatenate(([0], np.cumsum(per_row)))
        at = np.arange(first[-1]) - np.repeat(first[:-1] - self.first[:-1], per_row)
        length = np.repeat(np.minimum(n, k), per_row)
        sums = np.zeros(first[-1], np.uint64)
        for j in range(k):
            inside = j < length
            word = self.codes[np.minimum(at + j, max(len(self.codes) - 1, 0))] if len(self.codes) else sums
            sums = np.where(inside, (sums ^ word) * BASE + np.uint64(j + 1), sums)
        return mix(sums + length.astype(np.uint64)), first


def row_sets(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct codes, ascending, and where each row begins."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((codes, row))
    codes, row = codes[order], row[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
    codes, row = codes[new], row[new]
    return codes, np.searchsorted(row, np.arange(len(first)))
