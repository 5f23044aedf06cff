"""Substring dedup: content-defined cuts of whole texts, the bytes behind them found by digest, passages by comparing.

A gear hash (h = 2h + code of the byte, modulo 2**16, so it sees the last 16 bytes) rolls over the bytes of a text.
A chunk begins at each character whose hash is the largest of some REACH places in a row, also where others equal it, so
every REACH places have a cut, and where it is follows from the bytes around it alone. Text with a period of up to 16 bytes has
its largest hash once a period: of those cuts the ones within 16
bytes of the first, those within GRAM + 16 of the last, and one in about 32 bytes stay.

The GRAM bytes behind a cut are a seed. A seed is repeated if its digest occurs in documents with different doc_ids. Any
passage of 160 bytes holds a seed: a full hash after 15 bytes, a cut in the next 64, and 64 bytes more (up to 3 more for whole
characters). Repeated seeds that touch form a run. From both ends of a run the bytes are compared with those beside the
same seed in all other documents (sorted, so the nearest neighbours of another document share the most); this gives the true
extent, and from MIN_RUN bytes on it is a repeated passage. Like the seeds of a run, its two ends may be shared with different
documents. Reported spans leave out the letters of a word that is shared in part only. A whole text that
stands in another document is a passage at any length.

A null doc_id stands for a document of its own, told from others by its text. Rows with the same doc_id
are one document, whose own repetitions do not count. Null and empty texts have no chunks. Extra columns are
ignored or, in `without_repeats`, kept. An empty table gives an empty result.

Cost: the places of one seed are sorted by one task, SIDE + INNER bytes each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.words import mix, slices, span_codes, utf8
from starmart.session import materialize

REACH = 64               # places; any so many in a row have a cut
GRAM = 64                # bytes of a seed
MIN_RUN = 160            # bytes: some 25 words
SIDE = 96                # bytes compared on either side of a run; a passage ends less than that from its outer seeds
INNER = 24               # bytes of the seed that go along, so that a broken word can be left out
PAD = REACH + 16         # keeps neighbouring rows of a slice out of each other's windows

GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.uint16)
_WORD = np.zeros(257, bool)                      # 256 stands for no byte
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_INSIDE = np.zeros(257, bool)                    # bytes of a character behind its first
_INSIDE[0x80:0xC0] = True


def cuts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a slice, and row, start and end (in those bytes) of every chunk."""
    data, offsets = utf8(column)
    length = np.diff(offsets)
    rows = len(length)
    shift = np.repeat(np.arange(rows) * PAD, length)
    at = np.arange(len(data)) + shift + PAD
    gear = np.zeros(len(data) + (rows + 1) * PAD, np.uint16)
    gear[at] = GEAR[data]
    for step in (1, 2, 4, 8):                    # after step s the hash covers 2s bytes
        gear[step:] = gear[step:] + (gear[:-step] << np.uint16(step))
    outside = 1 << 17
    h = np.full(len(gear), outside, np.int32)    # windows that leave a row have no largest place
    h[at] = np.where(_INSIDE[data], -1, gear[at].astype(np.int32))
    top = h.copy()                               # largest of the REACH places from here on
    for step in (1, 2, 4, 8, 16, 32):
        top[:-step] = np.maximum(top[:-step], top[step:])
    least = top                                  # smallest of those over the windows that hold this place
    for step in (1, 2, 4, 8, 16, 32):
        least[step:] = np.minimum(least[step:], least[:-step].copy())
    cut = np.flatnonzero((least[at] == h[at]) & (h[at] >= 0)) if len(data) else np.zeros(0, np.int64)
    if len(cut):
        place = at[cut]
        tied = np.zeros(len(cut) + 1, bool)      # with the cut before, a period of at most 16 bytes away
        tied[1:-1] = (np.diff(place) <= 16) & (h[place[1:]] == h[place[:-1]])
        first = np.maximum.accumulate(np.where(tied[:-1], 0, np.arange(len(cut))))
        last = np.minimum.accumulate(np.where(tied[1:], len(cut), np.arange(len(cut)))[::-1])[::-1]
        # neighbours of a passage may move its first and last cut by some periods: all stay that can begin an outer seed
        near = (place - place[first] <= 16) | (place[last] - place <= GRAM + 16)
        step = (place - place[first]) // 32
        cut = cut[near | (step != np.concatenate(([0], step[:-1])))]
    starts = np.unique(np.concatenate((offsets[:-1][length > 0], cut)))
    ends = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
    return data, np.searchsorted(offsets, starts, "right") - 1, starts, ends


def _document() -> Column:
    """doc_id, or for null a negative stand-in from the text."""
    return F.coalesce(F.col("doc_id").cast("long"), -F.pmod(F.xxhash64("text"), F.lit(1 << 62)) - 1)


def _row() -> Column:
    return F.xxhash64("doc_id", "text")


def chunks(docs: DataFrame) -> DataFrame:
    """document, row (hash of doc_id and text), digest, start and size in bytes of every seed; a whole text has start -1."""
    def run(batches):
        for batch in slices(batches):
            data, row, starts, _ = cuts(batch.column("text"))
            _, offsets = utf8(batch.column("text"))
            full = starts + GRAM <= offsets[row + 1]
            row, starts = row[full], starts[full]
            ends = starts + GRAM
            for _ in range(3):                   # on to the end of a character
                more = ends < offsets[row + 1]
                more[more] = _INSIDE[data[ends[more]]]
                ends = ends + more
            some = np.flatnonzero(np.diff(offsets))
            whole = span_codes(data, offsets[some], offsets[some + 1]) ^ _BYTES_OF_ALL
            yield pa.RecordBatch.from_arrays(
                [batch.column("document").take(pa.array(np.concatenate((row, some)))), batch.column("row").take(pa.array(np.concatenate((row, some)))),
                 pa.array(np.concatenate((span_codes(data, starts, ends), whole)).view(np.int64), pa.int64()),
                 pa.array(np.concatenate((starts - offsets[row], np.full(len(some), -1))), pa.int32()),
                 pa.array(np.concatenate((ends - starts, np.diff(offsets)[some])), pa.int32())],
                ["document", "row", "digest", "start", "size"])

    texts = docs.where("text is not null").select(_document().alias("document"), _row().alias("row"), "text")
    return texts.mapInArrow(run, "document long, row long, digest long, start int, size int")


def _sides(batches):
    """The bytes beside each seed that is asked for, from INNER bytes inside it outwards."""
    for batch in batches:
        out = {n: [] for n in ("digest", "side", "row", "start", "wanted", "document", "bytes", "open")}
        for r in batch.to_pylist():
            raw = r["text"].encode()
            for s in r["asked"]:
                if s["side"]:
                    end = s["start"] + s["size"]
                    beside, reached = raw[end - INNER:end + SIDE], end + SIDE >= len(raw)
                else:
                    low = max(0, s["start"] - SIDE)
                    beside, reached = raw[low:s["start"] + INNER][::-1], low == 0
                for n, v in (("digest", s["digest"]), ("side", s["side"]), ("row", r["row"]), ("start", s["start"]), ("wanted", s["wanted"]),
                             ("document", r["document"]), ("bytes", beside), ("open", reached)):
                    out[n].append(v)
        yield pa.RecordBatch.from_pydict(out, pa.schema(_SIDES))


_BYTES_OF_ALL = np.uint64(0x5851F42D4C957F2D)    # keeps digests of whole texts apart from those of seeds
_SIDES = [("digest", pa.int64()), ("side", pa.int32()), ("row", pa.int64()), ("start", pa.int32()), ("wanted", pa.bool_()),
          ("document", pa.int64()), ("bytes", pa.binary()), ("open", pa.bool_())]


def _matrix(column: pa.Array, none: int) -> np.ndarray:
    out = np.full((len(column), INNER + SIDE + 1), none, np.int16)
    for i, b in enumerate(column.to_pylist()):
        if b:
            out[i, :len(b)] = np.frombuffer(b, np.uint8)
    return out


def _extents(batches):
    """How far beyond its seed each side is shared (bytes), and how far in whole words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        own, near = _matrix(batch.column("bytes"), 256), np.zeros(batch.num_rows, np.int64)
        for other in ("before", "after"):
            near = np.maximum(near, np.argmin(own == _matrix(batch.column(other), 257), axis=1))
        side = batch.column("side").to_numpy()
        length = (own < 256).sum(axis=1)
        at, every = near.copy(), np.arange(len(near))
        cut_off = ~batch.column("open").to_numpy(zero_copy_only=False) & (near == length)
        at -= cut_off                            # the byte beyond is not known
        best, found = at.copy(), np.zeros(len(at), bool)
        for _ in range(INNER):
            inner, outer = own[every, np.maximum(at - 1, 0)], own[every, at]
            whole = ~np.where(side == 1, _INSIDE[outer], _INSIDE[inner]) & ~(_WORD[inner] & _WORD[outer])
            best = np.where(whole & ~found, at, best)
            found |= whole
            at = np.maximum(at - ~found, 1)
        for _ in range(3):                       # no end of a word nearby: a whole character at least
            part = np.where(side == 1, _INSIDE[own[every, best]], _INSIDE[own[every, np.maximum(best - 1, 0)]])
            best = best - (part & ~found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("start"), batch.column("side"), pa.array(near - INNER, pa.int32()), pa.array(best - INNER, pa.int32())],
            ["row", "start", "side", "bytes", "words"])


_CHUNK = "struct<start: int, size: int, lo: bigint, hi: bigint>"
_SPAN = f"struct<start: int, end: int, lo: bigint, hi: bigint, chunks: array<{_CHUNK}>>"


def _spans(chunks: list, extents: list, min_run: int) -> list:
    beyond = {(e["start"], e["side"]): (e["bytes"], e["words"]) for e in extents or ()}
    runs, out = [], []
    for c in sorted((c for c in chunks if c["start"] >= 0), key=lambda c: c["start"]):
        if runs and c["start"] <= runs[-1][-1]["start"] + runs[-1][-1]["size"]:
            runs[-1].append(c)
        else:
            runs.append([c])
    for run in runs:
        left = [(c["start"], *beyond[c["start"], 0]) for c in run if (c["start"], 0) in beyond]
        right = [(c["start"] + c["size"], *beyond[c["start"], 1]) for c in run if (c["start"], 1) in beyond]
        if max(at + n for at, n, _ in right) - min(at - n for at, n, _ in left) >= min_run:
            out.append([min(at - n for at, _, n in left), max(at + n for at, _, n in right), run])
    for w in (c for c in chunks if c["start"] < 0):
        out.append([0, w["size"], [{**w, "start": 0}]])
    joined = []
    for start, end, run in sorted(out, key=lambda s: s[:2]):
        if joined and start < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
            joined[-1][2] = joined[-1][2] + run
        else:
            joined.append([start, end, run])
    return [{"start": s, "end": e, "lo": min(c["lo"] for c in run), "hi": max(c["hi"] for c in run), "chunks": run} for s, e, run in joined]


def passages(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """row, spans of every document with repeated passages. A span has start and end in bytes, the smallest (lo)
    and the largest (hi) document among those that its seeds or whole text occur in, and those (chunks)."""
    found = chunks(docs)
    repeated = found.groupBy("digest").agg(F.min("document").alias("lo"), F.max("document").alias("hi")).where("lo <> hi")
    at = found.select("digest", "row", "start", "size").join(repeated, "digest").dropDuplicates(["row", "start"])
    in_row = Window.partitionBy("row").orderBy("start")
    end = F.col("start") + F.col("size")
    # a whole text (start -1) is no neighbour of seeds
    before = F.lag(F.when(F.col("start") >= 0, end)).over(in_row)
    at = (at.withColumn("first", F.coalesce(F.col("start") > before, F.lit(True)) & (F.col("start") >= 0))
          .withColumn("last", F.coalesce(F.lead("start").over(in_row) > end, F.lit(True)) & (F.col("start") >= 0)))
    # cuts of one period may differ by some at the ends, so all seeds within 16 bytes of a run's end are compared
    back = in_row.orderBy(F.desc("start"))
    run = F.last(F.when(F.col("first"), F.col("start")), ignorenulls=True).over(in_row.rowsBetween(Window.unboundedPreceding, 0))
    run_end = F.last(F.when(F.col("last"), F.col("start")), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    at = at.withColumn("run", run).withColumn("run_end", run_end)
    at = materialize(at.withColumn("first", F.coalesce(F.col("start") - F.col("run") <= 16, F.lit(False)) & (F.col("start") >= 0))
                     .withColumn("last", F.coalesce(F.col("run_end") - F.col("start") <= 16, F.lit(False)) & (F.col("start") >= 0)).drop("run", "run_end"),
                     "chunk_seeds")
    asked = at.where("first").select("digest", F.lit(0).alias("side")).union(at.where("last").select("digest", F.lit(1))).distinct()
    asked = (at.join(asked, "digest").withColumn("wanted", F.when(F.col("side") == 0, F.col("first")).otherwise(F.col("last")))
             .groupBy("row").agg(F.collect_list(F.struct("digest", "side", "start", "size", "wanted")).alias("asked")))
    texts = docs.where("text is not null").select(_document().alias("document"), _row().alias("row"), "text")
    sides = texts.join(asked, "row").mapInArrow(_sides, "digest long, side int, row long, start int, wanted boolean, document long, bytes binary, open boolean")
    up = Window.partitionBy("digest", "side").orderBy("bytes", "document")
    down = Window.partitionBy("digest", "side").orderBy(F.desc("bytes"), F.desc("document"))

    def of_another(order):                       # the nearest bytes of a document other than the row's own
        turn = F.when(F.lag("document").over(order) != F.col("document"), F.lag("bytes").over(order))
        return turn, order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    for name, order in (("before", up), ("after", down)):
        turn, so_far = of_another(order)
        sides = sides.withColumn("turn", turn).withColumn(name, F.last("turn", ignorenulls=True).over(so_far)).drop("turn")
    extents = (sides.where("wanted").select("row", "start", "side", "bytes", "before", "after", "open")
               .mapInArrow(_extents, "row long, start int, side int, bytes int, words int")
               .groupBy("row", "start", "side").agg(F.max("bytes").alias("bytes"), F.max("words").alias("words"))
               .groupBy("row").agg(F.collect_list(F.struct("start", "side", "bytes", "words")).alias("extents")))
    per_row = at.groupBy("row").agg(F.collect_list(F.struct("start", "size", "lo", "hi")).alias("c")).join(extents, "row", "left")
    schema = f"row long, spans array<{_SPAN}>"
    chunk = pa.struct([("start", pa.int32()), ("size", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64())])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("chunks", pa.list_(chunk))])

    def assemble(batches):
        for batch in batches:
            rows = [(r["row"], _spans(r["c"], r["extents"], min_run)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.list_(span))], ["row", "spans"])

    return per_row.mapInArrow(assemble, schema).where(F.size("spans") > 0)


def report(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """The documents that hold a passage of some other document: doc_id, n_bytes, n_repeated (bytes in such passages), spans
    (start, end, first_doc_id, last_doc_id) and shared_with, the doc_ids at either end of those that share them."""
    spans = passages(docs, min_run)
    rows = docs.select("doc_id", _document().alias("document"), _row().alias("row"), F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(spans, "row").select(
        "doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_repeated"),
        F.expr("transform(spans, s -> struct(s.start AS start, s.end AS end, s.lo AS first_doc_id, s.hi AS last_doc_id))").alias("spans"),
        F.expr("array_sort(array_distinct(filter(flatten(transform(spans, s -> array(s.lo, s.hi))), i -> i <> document)))").alias("shared_with"))


def without_repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """The documents with the columns they had; a seed or whole text of a repeated passage stays
    only in the smallest document that has it, the bytes around the outer seeds everywhere."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, drops: pd.Series) -> pd.Series:
        def one(text, spans):
            if spans is None or not len(spans):
                return text
            raw, out, at = text.encode(), [], 0
            for s in spans:
                out.append(raw[at:max(at, s["start"])])
                at = max(at, s["start"] + s["size"])
            return b"".join([*out, raw[at:]]).decode()
        return pd.Series([one(t, d) for t, d in zip(texts, drops)])

    names = docs.columns
    at = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], _document().alias("document"), _row().alias("row"))
    drop = passages(docs, min_run).select("row", F.expr("flatten(transform(spans, s -> s.chunks))").alias("chunks"))
    mine = F.expr("array_sort(transform(filter(chunks, x -> x.lo < document), x -> struct(x.start AS start, x.size AS size)))")
    text = f"c{names.index('text')}"
    return (at.join(drop, "row", "left").withColumn("drop", mine)
            .select(*[(cut(F.col(text), F.col("drop")) if c == "text" else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)]))
