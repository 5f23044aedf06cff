"""HTML extraction: the main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is a chain of blocks (see blocks.py), each main text or not. The score of a labelling is the sum of the blocks'
feature weights (names and class, id and role words of all ancestors, the block's own element, length, links, punctuation of its text) and
of a weight for each pair of neighbours, of one kind for blocks of one parent and of another for others. Weights
maximise the log likelihood of labelled pages, less a square penalty; forward and backward sums give its gradient. A
page is decoded by the Viterbi path, in two numbers per block.

Labelled pages are html whose main text stands in elements with the attribute data-main (data-main="no" takes parts out
again). By default these are the pages of labelled.py; of a larger table at most LABELLED pages are
learned from, those with the smallest hashes. Every page is decoded whole, in one pass.

Null and empty pages have an empty text. Character references are decoded once, white space in a block becomes one space,
blocks are joined by newlines. Repeated pages are treated alike; extra columns are ignored; an empty table
gives an empty result. Without any labelled page all text counts as main.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.blocks import Block, blocks
from starmart.llm.labelled import pages as labelled_pages

LABELLED = 2000
STEPS = 300
PENALTY = 0.005


@dataclass
class Model:
    """Feature numbers, the weight of main over other per feature, pair weights [one parent][label before][label]."""
    numbers: dict[str, int]
    weights: list[float]
    pairs: list[list[list[float]]]


def _sum(x, axis):
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + np.squeeze(most, axis)


def fit(pages: list[str], steps: int = STEPS, penalty: float = PENALTY) -> Model | None:
    """A model from labelled pages; None if there is nothing to learn from."""
    chains = [c for c in map(blocks, pages) if c]
    if not chains:
        return None
    names = sorted({f for chain in chains for b in chain for f in b.features})
    numbers = {f: i + 1 for i, f in enumerate(names)}            # 0 is the intercept
    count, longest, width = len(chains), max(map(len, chains)), len(names) + 1
    x = np.zeros((count, longest, width), np.float32)
    y = np.zeros((count, longest), int)
    there = np.zeros((count, longest), bool)
    same = np.zeros((count, longest), int)
    for i, chain in enumerate(chains):
        for t, block in enumerate(chain):
            x[i, t, [0, *(numbers[f] for f in block.features)]] = 1
            y[i, t], there[i, t], same[i, t] = block.main, True, t > 0 and chain[t - 1].parent == block.parent
    total = there.sum()
    flat = x.reshape(-1, width)
    linked = there[:, 1:]
    truth = np.zeros((2, 2, 2))
    np.add.at(truth, (same[:, 1:][linked], y[:, :-1][linked], y[:, 1:][linked]), 1)
    w, pairs = np.zeros(width), np.zeros((2, 2, 2))
    state = [np.zeros(width), np.zeros(width), np.zeros((2, 2, 2)), np.zeros((2, 2, 2))]
    for step in range(1, steps + 1):
        unary = np.zeros((count, longest, 2))
        unary[:, :, 1] = (flat @ w).reshape(count, longest)
        between = pairs[same]                                     # chain, place, label before, label
        ahead, back = np.zeros_like(unary), np.zeros_like(unary)
        ahead[:, 0] = unary[:, 0]
        for t in range(1, longest):
            moved = unary[:, t] + _sum(ahead[:, t - 1, :, None] + between[:, t], 1)
            ahead[:, t] = np.where(there[:, t, None], moved, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = _sum(between[:, t + 1] + (unary[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(there[:, t + 1, None], moved, 0)
        whole = _sum(ahead[:, -1], 1)
        chance = np.exp(ahead + back - whole[:, None, None])[:, :, 1] * there
        both = np.exp(ahead[:, :-1, :, None] + between[:, 1:] + (unary + back)[:, 1:, None, :] - whole[:, None, None, None]) * linked[:, :, None, None]
        expected = np.stack([(both * (same[:, 1:] == k)[:, :, None, None]).sum(axis=(0, 1)) for k in (0, 1)])
        slope = flat.T @ (chance - y * there).ravel() / total + penalty * w / 10
        pair_slope = (expected - truth) / total + penalty * pairs / 10
        for at, (value, g) in enumerate(((w, slope), (pairs, pair_slope))):
            m, v = state[2 * at], state[2 * at + 1]
            m[...] = 0.9 * m + 0.1 * g
            v[...] = 0.999 * v + 0.001 * g * g
            value -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(numbers, w.tolist(), pairs.tolist())


def decode(model: Model, chain: list[Block]) -> list[bool]:
    """The labels of the best path; features are numbers already."""
    other = main = 0.0
    before: list[tuple[bool, bool]] = []                        # for each label: whether the best path came from main
    last = None
    for block in chain:
        here = model.weights[0] + sum(model.weights[f] for f in block.features)
        if last is None:
            main = here
        else:
            (oo, om), (mo, mm) = model.pairs[int(block.parent == last)]
            before.append((main + mo > other + oo, main + mm > other + om))
            other, main = max(other + oo, main + mo), max(other + om, main + mm) + here
        last = block.parent
    label = main > other
    labels = [label]
    for from_other, from_main in reversed(before):
        label = from_main if label else from_other
        labels.append(label)
    return labels[::-1] if chain else []


def main_text(model: Model | None, html: str | None) -> str:
    if model is None:
        return "\n".join(b.text for b in blocks(html))
    chain = blocks(html, model.numbers.get)
    return "\n".join(b.text for b, main in zip(chain, decode(model, chain)) if main)


def train(labelled: DataFrame | None = None, size: int = LABELLED) -> Model | None:
    """A model from the column html of a table of labelled pages."""
    if labelled is None:
        return fit(labelled_pages())
    chosen = labelled.select("html").where("html is not null").orderBy(F.xxhash64("html"), "html").limit(size).collect()
    return fit([r["html"] for r in chosen])


def extract(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, url, html -> page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(train(labelled))

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = [main_text(model, h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
