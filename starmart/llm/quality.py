"""Quality classifier from trusted positives and unlabelled text (positive-unlabelled learning).

A linear model with logistic loss minimises the non-negative unbiased risk: with positives P,
unlabelled U and the share c of positives in U, the risk is

    c * loss(P as positive) + max(0, loss(U as negative) - c * loss(P as negative)),

and where the second part would fall below zero, the step goes against it instead. Negative labels are
never used. The share c is estimated: a first model tells P from U; among the thresholds on its
scores, over rows it was not fitted on, the smallest ratio (share of U at or above it) / (share of P at or above
it), with a margin for chance, bounds c from above.

Features are of the whole text: shares of kinds of bytes, how often neighbouring bytes are of which kinds,
lengths of words and lines, repetition of words. The model is fitted on at most SAMPLE positives
and SAMPLE documents of the whole table as unlabelled ones, those with the smallest hashes of their ids;
their fixed number of features comes to the driver.

Null and empty texts have the features of no text at all and a score like any other. Null labels are passed
over; of repeated labels of a document the lowest counts. Without any trusted positive or any
document every score is 1, so that nothing is rejected unseen. Repeated rows are scored alike, extra
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import one_text
from starmart.llm.words import SPACED, Words, slices, utf8

SAMPLE = 5000
STEPS = 400
GOOD = 0.3                   # score from which a document counts as good

# Kinds of bytes.
KIND = np.zeros(256, np.int64)
for _kind, _members in enumerate([range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b" ", b"\n", b".", b",", b"\t\r\x0b\x0c",
                                  b"!?", b"'\"-()", b":;", b"|", b"*#%&$@^~+=", b"<>/\\[]{}_`", range(0x80, 0x100)]):
    KIND[list(_members)] = _kind + 1
KINDS = 16


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers for each text, all between 0 and about 3."""
    data, offsets = utf8(column)
    rows, length = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(rows), length)
    kind = KIND[data]
    some = np.maximum(length, 1)[:, None]
    single = np.bincount(row * KINDS + kind, minlength=rows * KINDS).reshape(rows, KINDS) / some
    same = row[:-1] == row[1:]
    pair = (row[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
    pairs = np.bincount(pair[same], minlength=rows * KINDS * KINDS).reshape(rows, KINDS * KINDS) / some
    words = Words(column, SPACED)
    n = words.counts()
    per_word = np.maximum(n, 1)

    def mean(values, of=words.row):
        return np.bincount(of, values, minlength=rows) / per_word

    order = np.lexsort((words.codes, words.row))
    first = np.ones(len(order), bool)
    first[1:] = (words.codes[order][1:] != words.codes[order][:-1]) | (words.row[order][1:] != words.row[order][:-1])
    distinct = np.bincount(words.row[order][first], minlength=rows)
    again = np.zeros(len(words.codes))
    again[1:] = (words.codes[1:] == words.codes[:-1]) & (words.row[1:] == words.row[:-1])
    size = (words.ends - words.starts).astype(float)
    told = np.stack([
        np.log1p(n) / 4, mean(size) / 6, np.sqrt(np.maximum(mean(size ** 2) - mean(size) ** 2, 0)) / 4, mean(size > 20), mean(size == 1),
        np.where(n > 0, distinct / per_word, 0), np.where(n > 0, distinct / np.maximum(per_word, 1) ** 0.75, 0), mean(again),
        (n == 0).astype(float)], axis=1)
    return np.concatenate([np.sqrt(single), np.sqrt(pairs), told], axis=1).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _descend(gradient, width: int, steps: int) -> np.ndarray:
    """Adam; the last of the weights is the intercept."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS // 2) -> float:
    """Upper bound on the share of positives among the unlabelled."""
    fit_p, fit_u = positive[::2], unlabelled[::2]

    def gradient(w):
        return (-fit_p.T @ _sigmoid(-(fit_p @ w)) / len(fit_p) + fit_u.T @ _sigmoid(fit_u @ w) / len(fit_u)) / 2 + 1e-4 * w

    w = _descend(gradient, positive.shape[1], steps)
    p, u = np.sort(positive[1::2] @ w), np.sort(unlabelled[1::2] @ w)
    if not len(p) or not len(u):
        return 0.5
    at = np.quantile(p, np.linspace(0, 0.9, 91))
    above_p, above_u = 1 - np.searchsorted(p, at) / len(p), 1 - np.searchsorted(u, at) / len(u)
    margin = np.sqrt(np.log(40) / (2 * len(u))) + np.sqrt(np.log(40) / (2 * len(p)))
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean and spread of the features, weights, and the share of positives that was used."""
    both = np.concatenate([positive, unlabelled])
    mean, spread = both.mean(0), both.std(0) + 0.02
    scale = lambda x: np.concatenate([np.clip((x - mean) / spread, -6, 6), np.ones((len(x), 1))], axis=1).astype(np.float32)
    p, u = scale(positive), scale(unlabelled)
    c = prior(p, u)

    def gradient(w):
        as_positive = -p.T @ _sigmoid(-(p @ w)) / len(p)
        p_margin, u_margin = p @ w, u @ w
        rest = np.logaddexp(0, u_margin).mean() - c * np.logaddexp(0, p_margin).mean()
        rest_gradient = u.T @ _sigmoid(u_margin) / len(u) - c * p.T @ _sigmoid(p_margin) / len(p)
        return (c * as_positive + rest_gradient if rest >= 0 else -rest_gradient) + 1e-3 * w

    return mean, spread, _descend(gradient, p.shape[1], steps), c


def sample(docs: DataFrame, chosen: DataFrame) -> np.ndarray:
    """The features of the documents with the doc_ids of `chosen`, which is of a fixed size."""
    one_each = one_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))

    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x.tobytes() for x in features(batch.column("text"))], pa.binary())], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = one_each.mapInArrow(run, f"doc_id {kind}, x binary").toPandas().sort_values("doc_id")
    return np.stack([np.frombuffer(x, np.float32) for x in rows["x"]]) if len(rows) else np.zeros((0, 0), np.float32)


def train(docs: DataFrame, labels: DataFrame, usable: Column, size: int = SAMPLE):
    """A model from the positives among the labels; `usable` is a condition on doc_id. None without any."""
    known = labels.where(usable).groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    trusted = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    some = docs.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(size)
    positive, unlabelled = sample(docs, trusted), sample(docs, some.distinct())
    return fit(positive, unlabelled) if len(positive) > 3 and len(unlabelled) > 3 else None


def scorer(model, spark) -> Column:
    if model is None:
        return lambda text: F.lit(1.0)
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        mean, spread, w, _ = shared.value
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        out = [_sigmoid(np.clip((features(part.column("text")) - mean) / spread, -6, 6) @ w[:-1] + w[-1]) for part in slices(iter([batch]))]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return F.pandas_udf(score, "double")


def usable() -> Column:
    """Labels of the other documents are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = train(docs, labels, usable())
    scored = docs.select("doc_id", F.coalesce(~usable(), F.lit(False)).alias("held_out"),
                         scorer(model, docs.sparkSession)(F.col("text")).alias("score"))
    return scored.select("*", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with the columns they had."""
    model = train(docs, labels, usable())
    return docs.where(scorer(model, docs.sparkSession)(docs["text"]) >= GOOD)
