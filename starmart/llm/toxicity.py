"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words, pairs of neighbours, pairs with one word between, and the beginnings
(STEMS) of longer words, each hashed to one of 2**BITS places and present or absent. Words are
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the whole text after A-Z became a-z.

The model is fitted on at most PER_CLASS labelled documents of either label, those with the smallest
hashes of their ids; their hashed features come to the driver (a bounded sample). Each place has a learning
rate of its own that falls with the gradients it has seen, and L1 holds most weights at zero, so that
what is broadcast is a list of at most 2**BITS places and usually a few thousand.

Null and empty texts have no features: their score is the model's without evidence. Labels that are null or
belong to no document are passed over; of repeated labels of a document the highest counts. Without
both labels in the sample every score is the share of toxic ones in it (0 without any). Repeated rows
are scored alike, extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import one_text
from starmart.llm.words import BASE, LETTERS, Words, mix, slices, span_codes

BITS = 20
STEMS = (4, 5, 6, 7)         # bytes
PER_CLASS = 4000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.3, 1.0, 20.0, 0.1
TOXIC = 0.7                  # score from which a document counts as toxic


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Place and row of every feature of a slice; a feature may repeat in its row."""
    c, row = words.codes, words.row
    out, rows = [mix(c)], [row]
    for gap in (1, 2):
        same = row[:-gap] == row[gap:]
        out.append(mix((c[:-gap] * BASE + c[gap:] + np.uint64(gap))[same]))
        rows.append(row[:-gap][same])
    for stem in STEMS:
        long = words.ends - words.starts > stem
        out.append(span_codes(words.data, words.starts[long], words.starts[long] + stem))
        rows.append(row[long])
    return (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows)


def fit(samples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights by place and the intercept; samples holds each document's distinct places."""
    z, n, weights = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0
    order = np.random.default_rng(7)
    share = np.array([np.mean(labels == 0), np.mean(labels == 1)])
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            at, y = samples[i], labels[i]
            margin = float(np.clip(weights[at].sum() + bias, -35, 35))
            g = (1 / (1 + np.exp(-margin)) - y) * 0.5 / share[y]      # either label weighs the same in all
            # every feature present shares the document's gradient
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / ALPHA * weights[at]
            n[at] += g * g
            weights[at] = np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + grown) / ALPHA + L2))
            grown = np.sqrt(bias_n + g * g)
            bias_z += g - (grown - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
            bias = -bias_z / ((BETA + grown) / ALPHA + L2)
    return weights, bias


def places(docs: DataFrame) -> DataFrame:
    """text and further columns -> those columns and the distinct places of the text."""
    others = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches):
        for batch in slices(batches):
            at, row = features(Words(batch.column("text"), LETTERS))
            at = [np.unique(x) for x in _by_row(at, row, batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in others] + [pa.array([x.astype(np.int32).tobytes() for x in at], pa.binary())],
                [f.name for f in others] + ["places"])

    return docs.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others) + ", places binary")


def _by_row(at: np.ndarray, row: np.ndarray, rows: int) -> list[np.ndarray]:
    order = np.argsort(row, kind="stable")
    return np.split(at[order], np.searchsorted(row[order], np.arange(1, rows)))


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> tuple[np.ndarray, np.ndarray, float]:
    """Places with a weight, their weights, and the intercept. `usable` is a condition on doc_id."""
    known = labels.where(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    one_each = one_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "label")
    # the order of learning is that of the ids, not that in which tasks end
    rows = places(one_each).toPandas().sort_values("doc_id", ignore_index=True)
    y = rows["label"].to_numpy(int)
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return np.zeros(0, np.int64), np.zeros(0), 40.0 if share == 1 else -40.0
    weights, bias = fit([np.frombuffer(x, np.int32) for x in rows["places"]], y)
    used = np.flatnonzero(weights)
    return used, weights[used], bias


def scorer(model: tuple[np.ndarray, np.ndarray, float], spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        used, weights, bias = shared.value
        dense = np.zeros(1 << BITS)
        dense[used] = weights
        out = []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        for part in slices(iter([batch])):
            at, row = features(Words(part.column("text"), LETTERS))
            kept = dense[at] != 0
            pairs = np.unique(row[kept].astype(np.int64) << BITS | at[kept])    # a feature counts once in a row
            margin = bias + np.bincount(pairs >> BITS, dense[pairs & (1 << BITS) - 1], minlength=part.num_rows)
            out.append(1 / (1 + np.exp(-np.clip(margin, -35, 35))))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return F.pandas_udf(score, "double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out documents are not learned from."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = train(docs, labels, ~held_out)
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                         scorer(model, docs.sparkSession)("text").alias("score"))
    return scored.select("*", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
