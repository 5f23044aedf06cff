"""Spelling variant grouping: words one edit apart, found with k-d trees over letter counts.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. One edit moves the vector of
letter counts by at most two in sum: a replacement takes one count down and another up, an insertion takes one up. So for each pair of
lengths (n, n) and (n, n + 1) the words of the one length search the k-d tree of the other by range, and drop every node whose
box lies further below or above than that. Words in the leaves that are reached are compared letter by letter. Letters are
counted in FOLDED counters (code point modulo FOLDED), which only moves vectors closer.

The tree of a length has two parts. Its top is split on a sample (the SAMPLE words with the smallest hashes), until a part is
expected to hold at most CELL words; every word lives in the cell that its counts lead to and is sent as a visitor to all cells within reach. Inside
a cell, one task builds the rest of the tree over all words that live there, with tight boxes, and streams the visitors
through it. A cell that holds more words than that (many words of the same letters) is dealt over several tasks, visitors
to each. Tree leaves with more than LEAF words hold words with equal counts; there the compared
letters are found by sorted hashes of the words with one place left out, so that no product of words arises.

A word's form is its near word of the largest n (ties: the first in code-point order) if that n is at least FACTOR times its own; forms
are followed to the root by doubling, as n grows FACTOR-fold with each step.

Null texts have no words, a null doc_id counts as empty in the damage. Repeated documents count as often as they stand there. Words may be of
any length; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from starmart.llm.common import fold_case
from starmart.session import materialize

MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
FOLDED = 32
TOP = 100                     # counts above it are taken as it, which moves vectors closer
SAMPLE = 1 << 15
CELL = 20_000
LEAF = 16
BATCH = 2048                  # visitors searched at once
PAIRS = 1 << 19               # pairs compared at once


# Words of the documents

def words(docs: DataFrame) -> DataFrame:
    """word, n: runs of letters after the contract's damage, those long and frequent enough."""
    run = F.explode(F.regexp_extract_all(fold_case(F.col("text")), F.lit(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("run")).alias("word")).where(
        F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


# Letters and counts

def letters(of: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, and each word's length."""
    return np.frombuffer("".join(of).encode("utf-32-le", "surrogatepass"), np.uint32), np.array([len(w) for w in of], np.int64)


def counts(of: list[str]) -> np.ndarray:
    codes, length = letters(of)
    row = np.repeat(np.arange(len(of)), length)
    every = np.bincount(row * FOLDED + codes % FOLDED, minlength=len(of) * FOLDED).reshape(-1, FOLDED)
    return np.minimum(every, TOP).astype(np.int8)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of b have one letter more."""
    n = a.shape[1]
    front, back = a == b[:, :n], (a == b[:, 1:])[:, ::-1]
    run = lambda x: np.where(x.all(axis=1), n, x.argmin(axis=1)) if n else np.zeros(len(x), int)
    return run(front) + run(back) >= n


# K-d trees

@dataclass
class Tree:
    """Nodes with boxes; children are -1 in a leaf, where first..last are places in `order` (or `first` is the cell)."""
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray
    last: np.ndarray
    order: np.ndarray


def grow(vectors: np.ndarray, stop, tight: bool) -> Tree:
    """A node is split at the letter whose counts vary most, above their mean, until `stop(words)` or no letter varies."""
    low, high, left, right, first, last, order = [], [], [], [], [], [], np.arange(len(vectors))
    whole = (np.zeros(FOLDED, np.int8), np.full(FOLDED, TOP, np.int8))
    todo = [(0, len(vectors), whole, None, 0)]
    cells = 0
    while todo:
        a, b, (lo, hi), parent, side = todo.pop()
        here = vectors[order[a:b]]
        node = len(low)
        if parent is not None:
            (left if side == 0 else right)[parent] = node
        if tight and b > a:
            lo, hi = here.min(axis=0), here.max(axis=0)
        low.append(lo), high.append(hi), left.append(-1), right.append(-1)
        spread = np.where(here.max(axis=0) > here.min(axis=0), here.astype(np.float32).var(axis=0), 0) if b - a > 1 else np.zeros(FOLDED)
        at = int(spread.argmax())
        if spread[at] <= 0 or stop(b - a):
            first.append(a if tight else cells), last.append(b)
            cells += 1
            continue
        first.append(-1), last.append(-1)
        border = int(np.floor(here[:, at].mean()))
        goes = here[:, at] <= border
        order[a:b] = np.concatenate([order[a:b][goes], order[a:b][~goes]])
        middle = a + int(goes.sum())
        hi_left, lo_right = hi.copy(), lo.copy()
        hi_left[at], lo_right[at] = border, border + 1
        todo += [(middle, b, (lo_right, hi), node, 1), (a, middle, (lo, hi_left), node, 0)]
    whole = lambda x: np.array(x, np.int64)
    return Tree(np.stack(low), np.stack(high), whole(left), whole(right), whole(first), whole(last), order)


def reached(tree: Tree, vectors: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (vector, leaf) where the box may hold words with at most `up` letters more and `down` fewer than the vector."""
    query, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    found = [(query[:0], node[:0])]
    while len(query):
        v = vectors[query]
        inside = (np.maximum(tree.low[node] - v, 0).sum(axis=1) <= up) & (np.maximum(v - tree.high[node], 0).sum(axis=1) <= down)
        query, node = query[inside], node[inside]
        leaf = tree.left[node] < 0
        found.append((query[leaf], node[leaf]))
        query, node = query[~leaf], node[~leaf]
        query, node = np.concatenate([query, query]), np.concatenate([tree.left[node], tree.right[node]])
    return np.concatenate([q for q, _ in found]), np.concatenate([n for _, n in found])


class Cell:
    """The words that live in a cell, all of one length."""

    def __init__(self, of: list[str], n: np.ndarray):
        self.words, self.n, self.length = of, n, len(of[0])
        self.codes = letters(of)[0].reshape(len(of), self.length)
        self.tree = grow(counts(of), lambda size: size <= LEAF, tight=True)
        self.rank = ranks(of)

    def near(self, visitors: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (visitor, word), each once; visitors are of this length or one shorter."""
        codes = letters(visitors)[0].reshape(len(visitors), -1)
        same = codes.shape[1] == self.length
        query, node = reached(self.tree, counts(visitors), 1, 1 if same else 0)
        size = self.tree.last[node] - self.tree.first[node]
        found = []
        small = size <= LEAF
        q, leaf, size = query[small], node[small], size[small]
        ends = np.cumsum(size)
        for a, b in _chunks(ends):
            places = np.repeat(self.tree.first[leaf[a:b]], size[a:b]) + np.arange(size[a:b].sum()) - np.repeat(ends[a:b] - size[a:b] - (ends[a - 1] if a else 0), size[a:b])
            found.append(self._checked(codes, np.repeat(q[a:b], size[a:b]), self.tree.order[places], same))
        for leaf in np.unique(node[~small]):
            members = self.tree.order[self.tree.first[leaf]:self.tree.last[leaf]]
            found += self._by_places(codes, query[node == leaf], members, same)
        if not found:
            return np.zeros(0, int), np.zeros(0, int)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _checked(self, codes, q, r, same):
        good = (one_replaced if same else one_inserted)(codes[q], self.codes[r])
        return q[good], r[good]

    def _by_places(self, codes, q, members, same):
        """Matches by hashes of the words with one place left out, instead of comparing all with all."""
        theirs, of = without_one(self.codes[members], gap=same)
        mine, by = without_one(codes[q], gap=True) if same else (whole_hash(codes[q]), np.arange(len(q)))
        order = np.argsort(theirs, kind="stable")
        first, last = np.searchsorted(theirs[order], mine, "left"), np.searchsorted(theirs[order], mine, "right")
        ends = np.cumsum(last - first)
        for a, b in _chunks(ends):
            size = (last - first)[a:b]
            places = np.repeat(first[a:b], size) + np.arange(size.sum()) - np.repeat(ends[a:b] - size - (ends[a - 1] if a else 0), size)
            pairs = np.unique(np.stack([np.repeat(q[by[a:b]], size), members[of[order[places]]]], 1), axis=0)
            yield self._checked(codes, pairs[:, 0], pairs[:, 1], same)


def _chunks(ends: np.ndarray):
    """Ranges of entries with about PAIRS pairs in each, from the running totals of their pairs."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
        yield a, b
        a = b


BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _terms(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (codes.astype(np.uint64) + np.uint64(1)) * np.cumprod(np.full(codes.shape[1], BASE, np.uint64))


def whole_hash(codes: np.ndarray) -> np.ndarray:
    return _terms(codes).sum(axis=1, dtype=np.uint64)


def without_one(codes: np.ndarray, gap: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word without one place, for every place, and the word's row; with a gap left there, or closed up."""
    terms = _terms(codes)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = terms.sum(axis=1, dtype=np.uint64)[:, None] - before - terms
    place = np.arange(codes.shape[1], dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    hashes = (before + after + place) if gap else before + after * INVERSE
    # a word has its place in the hash as well, so that only words with the gap at one place meet
    return hashes.ravel(), np.repeat(np.arange(len(codes)), codes.shape[1])


def ranks(of: list[str]) -> np.ndarray:
    rank = np.empty(len(of), np.int64)
    rank[sorted(range(len(of)), key=of.__getitem__)] = np.arange(len(of))
    return rank


def best(by: np.ndarray, of: np.ndarray, n: np.ndarray, rank: np.ndarray):
    """For each distinct `by`: how many `of` it meets, and the one of largest n, then smallest rank."""
    order = np.lexsort((rank[of], -n[of], by))
    keys, first, times = np.unique(by[order], return_index=True, return_counts=True)
    return keys, times, of[order][first]


# The search over all words

def tops(vocabulary: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, tuple[int, Tree]]:
    """For each length the number of its first cell, and the top of its tree."""
    sizes = {r["length"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [r["word"] for r in vocabulary.select("word").orderBy(F.xxhash64("word"), "word").limit(sample).collect()]
    by_length: dict[int, list[str]] = {}
    for word in chosen:
        by_length.setdefault(len(word), []).append(word)
    out, cells = {}, 0
    for length, size in sorted(sizes.items()):
        some = by_length.get(length, [])
        tree = grow(counts(some), lambda k: k * size <= cell * len(some), tight=False)  # noqa: B023
        out[length] = (cells, tree)
        cells += int((tree.left < 0).sum())
    return out


def _cells(top, vectors, up, down):
    """Pairs (vector, cell)."""
    base, tree = top
    query, node = reached(tree, vectors, up, down)
    return query, base + tree.first[node]


def _by_length(batch: pa.RecordBatch):
    of = batch.column("word").to_pylist()
    length = np.array([len(w) for w in of], np.int64)
    for size in np.unique(length).tolist():
        at = np.flatnonzero(length == size)
        yield size, at, [of[i] for i in at]


def homes(vocabulary: DataFrame, top) -> DataFrame:
    """cell, n: how many words live in each cell."""
    def run(batches):
        for batch in batches:
            for size, _, of in _by_length(batch):
                cell, n = np.unique(_cells(top[size], counts(of), 0, 0)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    return vocabulary.select("word").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def placed(vocabulary: DataFrame, top, parts: dict[int, int]) -> DataFrame:
    """cell, part, guest, word, n: each word at home (guest 0) and as a visitor (guest 1) of all cells within reach."""
    def run(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            for size, at, of in _by_length(batch):
                vectors = counts(of)
                rows = []
                query, cell = _cells(top[size], vectors, 0, 0)
                split = np.array([parts.get(c, 1) for c in cell.tolist()])
                share = whole_hash(letters(of)[0].reshape(len(of), size))[query] >> np.uint64(33)
                rows.append((query, cell, (share % split.astype(np.uint64)).astype(np.int64), 0))
                for other, up, down in ((size, 1, 1), (size + 1, 1, 0)):
                    if other in top:
                        query, cell = _cells(top[other], vectors, up, down)
                        split = np.array([parts.get(c, 1) for c in cell.tolist()], np.int64)
                        ends = np.cumsum(split)
                        part = np.arange(split.sum()) - np.repeat(ends - split, split)
                        rows.append((np.repeat(query, split), np.repeat(cell, split), part, 1))
                for query, cell, part, guest in rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int64()), pa.array(part, pa.int64()), pa.array(np.full(len(cell), guest), pa.int32()),
                         pa.array([of[i] for i in query], pa.string()), pa.array(n[at][query], pa.int64())], ["cell", "part", "guest", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "cell bigint, part bigint, guest int, word string, n bigint")


def _search(batches):
    key, living, cell = None, [], None

    def told(words_, by, of, n, rank, others, other_n):
        keys, times, first = best(by, of, n, rank)
        return pa.RecordBatch.from_arrays(
            [pa.array([words_[i] for i in keys], pa.string()), pa.array(times, pa.int64()), pa.array(-other_n[first], pa.int64()),
             pa.array([others[i] for i in first], pa.string())], ["word", "n_near", "minus_n", "near"])

    for batch in batches:
        place = np.stack([batch.column(c).to_numpy() for c in ("cell", "part", "guest")], 1)
        of, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1)])) if len(of) else []
        for a, b in zip(starts, [*starts[1:], len(of)]):
            *here, guest = place[a].tolist()
            if here != key:
                key, living, cell = here, [], None
            if not guest:
                living.append((of[a:b], n[a:b]))
                continue
            if cell is None and living:
                cell = Cell([w for x, _ in living for w in x], np.concatenate([x for _, x in living]))
            if cell is None:
                continue
            length = np.array([len(w) for w in of[a:b]])
            for size in np.unique(length).tolist():
                mine = a + np.flatnonzero(length == size)
                for i in range(0, len(mine), BATCH):
                    chosen = mine[i:i + BATCH]
                    visitors, their_n = [of[k] for k in chosen], n[chosen]
                    v, r = cell.near(visitors)
                    if not len(v):
                        continue
                    yield told(visitors, v, r, cell.n, cell.rank, cell.words, cell.n)
                    if size < cell.length:
                        yield told(cell.words, r, v, their_n, ranks(visitors), visitors, their_n)


def near(vocabulary: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """word, n_near, best_n, best: for every word with near words their number, and the one of largest n."""
    top = tops(vocabulary, sample, cell)
    parts = {r["cell"]: -(-r["n"] // (2 * cell)) for r in homes(vocabulary, top).where(F.col("n") > 2 * cell).collect()}
    # a stated number of tasks: the work of a cell is far more than its bytes, by which small tasks would be merged
    tasks = max(int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(int((t.left < 0).sum()) for _, t in top.values()) // 4)
    dealt = placed(vocabulary, top, parts).repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part", "guest")
    found = dealt.mapInArrow(_search, "word string, n_near bigint, minus_n bigint, near string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "near")).alias("first")).select(
        "word", "n_near", (-F.col("first.minus_n")).alias("best_n"), F.col("first.near").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: forms followed to the last, by doubling."""
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        moved = Observation()
        a, b = links.alias("a"), links.alias("b")
        step = a.join(b, F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved"))
        links = materialize(step.observe(moved, F.count_if("moved").alias("n")), "spelling-roots").drop("moved")
        if not moved.get["n"]:
            return links


def group(vocabulary: DataFrame, factor: int = FACTOR, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """word, n -> word, form, root, n, n_near, form_n; the vocabulary holds each word once."""
    vocabulary = materialize(vocabulary, "spelling-words")
    met = near(vocabulary, sample, cell)
    chosen = F.col("best_n") >= F.col("n") * factor
    all_ = materialize(vocabulary.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best")).alias("form"),
        F.when(chosen, F.col("best_n")).alias("form_n")), "spelling-forms")
    last = roots(all_.where("form is not null"))
    return all_.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    return group(words(docs))
