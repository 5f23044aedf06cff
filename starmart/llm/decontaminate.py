"""Benchmark decontamination by Wu-Manber search over words.

A pattern is a window of WINDOW consecutive words of a benchmark item; an item with fewer words,
but not none, is one shorter pattern. Patterns of one length share a shift table over hashed blocks
of two words: it tells how far the window may move before any pattern could end there. Where it
says zero, the bucket of that last block holds the patterns to try, found by the code of the whole
window and confirmed by comparing the words themselves.

Benchmark items are searched in blocks of about BLOCK_BYTES of text, so that the tables in
a Python worker keep a fixed size; each block is one pass over the documents.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z. Null texts have no words and
are never hit. Items without words give no pattern; repeated items count by distinct item_id; a
null item_id still hits, and stands as the empty string in the list of items. Empty tables give
empty results or no hits. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.common import text_key
from starmart.llm.words import BASE, LETTERS, Words, mix, slices
from starmart.session import materialize

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHIFT_BITS = 22
FOUND = "n_words long, n_hit long, hit binary, items array<string>"   # a bit per word; distinct item ids, sorted


def window_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """A code for each run of `length` words."""
    n = max(len(codes) - length + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = (out ^ codes[j:j + n]) * BASE + np.uint64(1)
    return mix(out)


def block_slots(codes: np.ndarray, size: int) -> np.ndarray:
    """The place in the shift table of the block of `size` words that ends at each word from size - 1 on."""
    return (window_codes(codes, size) >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)


@dataclass
class Table:
    """All patterns of one length."""
    length: int
    block: int
    shift: bytes                 # by slot of the last block
    codes: np.ndarray            # of whole windows, ascending
    origin: np.ndarray           # item number and first word of each, in the same order

    @property
    def most(self) -> int:
        return self.length - self.block + 1


def spoken(words: Words, start: int, end: int) -> bytes:
    return b" ".join(words.data[words.starts[i]:words.ends[i]].tobytes() for i in range(start, end))


class Patterns:
    """Shift tables and buckets for a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids = [i for i, _ in items]
        self.words = Words(pa.array([t for _, t in items], pa.large_string()), LETTERS)
        lengths: dict[int, list[tuple[int, int]]] = {}
        for item, n in enumerate(self.words.counts()):
            for at in range(max(n - window, 0) + 1 if n else 0):
                lengths.setdefault(min(int(n), window), []).append((item, int(self.words.first[item]) + at))
        self.tables = [self._table(length, np.array(places)) for length, places in sorted(lengths.items())]

    def _table(self, length: int, origin: np.ndarray) -> Table:
        block = min(2, length)
        most = length - block + 1
        slots = block_slots(self.words.codes, block)     # by first word of the block
        shift = np.full(1 << SHIFT_BITS, most, np.uint8)
        for j in range(most):                            # the block that begins j words into the pattern
            at = slots[origin[:, 1] + j]
            np.minimum.at(shift, at, np.uint8(most - 1 - j))
        codes = window_codes(self.words.codes, length)[origin[:, 1]]
        order = np.argsort(codes, kind="stable")
        return Table(length, block, shift.tobytes(), codes[order], origin[order])

    def search(self, words: Words, row: int) -> tuple[np.ndarray, set[str]]:
        """Which words of a row are hit, and by which items."""
        first, end = int(words.first[row]), int(words.first[row + 1])
        hit, ids = np.zeros(end - first, bool), set()
        codes = words.codes[first:end]
        for t in self.tables:
            if len(codes) < t.length:
                continue
            slots = block_slots(codes, t.block).tolist()
            whole = None
            at, last, back, shift = t.length - t.block, len(slots), t.length - t.block, t.shift
            while at < last:
                move = shift[slots[at]]
                if move:
                    at += move
                    continue
                if whole is None:
                    whole = window_codes(codes, t.length)
                code = whole[at - back]
                lo, hi = np.searchsorted(t.codes, code, "left"), np.searchsorted(t.codes, code, "right")
                if lo < hi:
                    here = spoken(words, first + at - back, first + at - back + t.length)
                    for item, start in t.origin[lo:hi].tolist():
                        if spoken(self.words, start, start + t.length) == here:
                            hit[at - back:at - back + t.length] = True
                            ids.add(self.ids[item])
                at += 1
        return hit, ids


def scan(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    """docs (doc_id, text and FOUND) with the finds of one block of items added."""
    shared = docs.sparkSession.sparkContext.broadcast(items)    # of at most about BLOCK_BYTES

    def search(batches):
        patterns = Patterns(shared.value, window)
        for batch in slices(batches):
            words = Words(batch.column("text"), LETTERS)
            hits, ids, n_hit = [], [], []
            for row, (old, had) in enumerate(zip(batch.column("hit").to_pylist(), batch.column("items").to_pylist())):
                hit, found = patterns.search(words, row)
                if old:
                    hit |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(hit)).astype(bool)
                n_hit.append(int(hit.sum()))
                hits.append(np.packbits(hit).tobytes() if hit.any() else None)
                ids.append(sorted(found | set(had or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(words.counts(), pa.int64()),
                 pa.array(n_hit, pa.int64()), pa.array(hits, pa.binary()), pa.array(ids, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "n_hit", "hit", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(search, f"doc_id {kind}, text string, {FOUND}")


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text, n_words, n_hit, hit (a bit per word, null without any) and items of every document."""
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    bench = bench.where("text is not null").distinct()
    size = bench.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = -(-size // block_bytes) or 1
    out = docs.select("doc_id", "text", F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("items"))
    for b in range(blocks):
        block = bench.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else bench
        out = scan(out, [(r["id"], r["text"]) for r in block.sort("id", "text").collect()], window)
        if b + 1 < blocks:
            out = materialize(out, "decontaminate")
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    return find(docs, benchmark, window).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, with the columns they had."""
    names = docs.columns
    key = [docs["doc_id"].alias("doc_id"), docs["text"].alias("text")]
    whole = docs.select(F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("row"), *key, text_key(docs["text"]).alias("k"))
    hit = materialize(find(docs.select(*key), benchmark, window).where("hit is not null")
                      .select(F.col("doc_id").alias("d"), text_key(F.col("text")).alias("t")).distinct(), "contaminated")
    return whole.join(hit, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("t")), "left_anti").select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
