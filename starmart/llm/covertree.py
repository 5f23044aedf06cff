"""Embedding near-dedup: exact pairs above a cosine, by dual traversal of a cover tree.

Vectors are scaled to length 1, where cosine >= t means a distance of at most sqrt(2 - 2t). The tree's centres
come from a bounded sample (SAMPLE vectors, those with the smallest hashes of their rows): levels of radius 2, 1,
1/2, ... down to about the searched distance, each holding all centres of the level above, any two centres of a level further apart
than its radius. Every vector joins its nearest centre on the lowest level. A node's covering radius
is measured over all vectors below it, so the bounds hold for all rows although centres are sampled.

The dual traversal starts with the root against itself and drops pairs of nodes whose centres are further apart
than both covering radii and the searched distance; what is left are pairs of leaves. Leaves are
packed into blocks of about BLOCK vectors, large leaves split into several, and each pair of blocks that holds
a pair of leaves is one row of work, made by Spark from the pairs of leaves: one matrix product in single precision, decided in double precision wherever
a value comes near the threshold. A pair of blocks returns sums of links per vector and edges that span its
components, never the pairs themselves.

Equal vectors are folded to one with a weight first.

Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different
length do not link. Each row is a vector, also where rows repeat; a null vec_id is no smallest id, and such a row is
kept only if it says so itself (never). Extra columns are ignored; an empty table gives an empty result.

Cost: where vectors are spread evenly in many dimensions no bound prunes anything, and the work is all pairs of
blocks; it falls with the degree to which vectors cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.components import components
from starmart.session import materialize

COSINE = 0.9
SAMPLE = 1024
BLOCK = 4096
SLACK = 1e-4             # for single precision
CHUNK = 1 << 14          # pairs of nodes measured at once


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def nets(points: np.ndarray, least: float) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Levels from the root down: radius, the centres' places among the points, and for each its parent's place in
    the level above. The last level's radius is the first not above `least`."""
    levels = [(2.0, np.array([0]), np.array([0]))]
    while levels[-1][0] > least:
        radius, chosen = levels[-1][0] / 2, list(levels[-1][1])
        near = np.min(_distances(points, points[chosen]), axis=1)
        while near.max(initial=0) > radius:
            far = int(np.argmax(near))
            chosen.append(far)
            near = np.minimum(near, _distances(points, points[far:far + 1])[:, 0])
        chosen = np.array(chosen)
        parent = np.argmin(_distances(points[chosen], points[levels[-1][1]]), axis=1)
        levels.append((radius, chosen, parent))
    return levels


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def traverse(points: np.ndarray, levels, leaf_radius: np.ndarray, within: float) -> np.ndarray:
    """Pairs a <= b of leaves that may hold vectors within that distance; unused leaves have a negative radius."""
    radii = [leaf_radius]
    for (_, below, parent), (_, above, _) in zip(levels[:0:-1], levels[-2::-1]):
        reach = radii[0] + np.linalg.norm(points[below] - points[above][parent], axis=1)
        covering = np.full(len(above), -1.0)
        np.maximum.at(covering, parent[radii[0] >= 0], reach[radii[0] >= 0])
        radii.insert(0, covering)
    a = b = np.zeros(1, np.int64)
    for depth, (_, centres, parent) in enumerate(levels):
        if depth:
            # every child of a with every child of b, each pair once
            order = np.argsort(parent, kind="stable")
            first = np.searchsorted(parent[order], np.arange(len(levels[depth - 1][1]) + 1))
            size = np.diff(first)
            each = size[a] * size[b]
            pair = np.repeat(np.arange(len(a)), each)
            within_pair = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
            left, right = order[first[a][pair] + within_pair // size[b][pair]], order[first[b][pair] + within_pair % size[b][pair]]
            both = np.unique(np.minimum(left, right) * len(centres) + np.maximum(left, right))
            a, b = both // len(centres), both % len(centres)
        r, kept = radii[depth], np.zeros(len(a), bool)
        for i in range(0, len(a), CHUNK):
            x, y = a[i:i + CHUNK], b[i:i + CHUNK]
            apart = np.linalg.norm(points[centres[x]] - points[centres[y]], axis=1)
            kept[i:i + CHUNK] = (r[x] >= 0) & (r[y] >= 0) & (apart <= r[x] + r[y] + within + SLACK)
        a, b = a[kept], b[kept]
    return np.stack([a, b], axis=1)


def packed(sizes: np.ndarray, block: int) -> list[list[tuple[int, int]]]:
    """For each leaf the first block and the number of blocks its vectors go to; leaves follow each other in tree order."""
    out, current, used = [], 0, 0
    for n in sizes.tolist():
        if n > block:
            if used:
                current, used = current + 1, 0
            parts = -(-n // block)
            out.append((current, parts))
            current += parts
            continue
        if used + n > block:
            current, used = current + 1, 0
        out.append((current, 1))
        used += n
    return out


def _linked(a: np.ndarray, b: np.ndarray, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns with links, and the matrix of links between those; a and b hold vectors in double precision."""
    ua, ub = unit(a).astype(np.float32), unit(b).astype(np.float32)
    rows, cols = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for start in range(0, len(a), 512):
        some = ua[start:start + 512] @ ub.T >= cosine - SLACK
        if same:
            some[np.arange(len(some)), start + np.arange(len(some))] = False
        rows[start:start + 512] = some.any(axis=1)
        cols |= some.any(axis=0)
    rows, cols = np.flatnonzero(rows), np.flatnonzero(cols)
    if not len(rows):
        return rows, cols, np.zeros((0, 0), bool)
    links = unit(a[rows]) @ unit(b[cols]).T >= cosine
    if same:
        links &= rows[:, None] != cols[None, :]
    return rows, cols, links


def _spanning(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column with links the smallest row that it is connected to."""
    of_row = np.arange(len(links))
    while True:
        of_col = np.where(links, of_row[:, None], len(links)).min(axis=0)
        lower = np.minimum(of_row, np.where(links, of_col[None, :], len(links)).min(axis=1))
        if (lower == of_row).all():
            return of_row, of_col
        of_row = lower


def _work(cosine: float):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = batch.column("a")[row].as_py(), batch.column("b")[row].as_py()
                sides = []
                for side in "ab":
                    ids = batch.column(f"{side}_ids")[row].values.to_numpy(zero_copy_only=False)
                    weights = batch.column(f"{side}_n")[row].values.to_numpy(zero_copy_only=False)
                    flat = batch.column(f"{side}_flat")[row].values.to_numpy(zero_copy_only=False)
                    sides.append((ids, weights, flat.reshape(len(ids), -1).astype(float)))
                (a_ids, a_n, a), (b_ids, b_n, b) = sides
                rows, cols, links = _linked(a, b, cosine, left == right)
                if not links.any():
                    continue
                # within one block a row and a column are the same vector
                of_row, of_col = _spanning(links | (rows[:, None] == cols[None, :]) if left == right else links)
                by_row, by_col = links @ b_n[cols], links.T @ a_n[rows]
                some = by_col > 0
                rid, n, root = a_ids[rows], by_row, a_ids[rows[of_row]]
                if left != right:
                    rid, n = np.concatenate((rid, b_ids[cols[some]])), np.concatenate((n, by_col[some]))
                    root = np.concatenate((root, a_ids[rows[of_col[some]]]))
                yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(n, pa.int64()), pa.array(root, pa.int64())],
                                                 ["rid", "n", "root"])
    return run


def _tree_links(vectors: DataFrame, cosine: float, sample: int, block: int) -> DataFrame:
    """rid, n (how often it occurs), vector (all different, valid and of one length) -> rid, n (links), root (a vector
    connected to it), in parts."""
    spark, within = vectors.sparkSession, float(np.sqrt(2 - 2 * cosine))
    some = vectors.orderBy(F.xxhash64("rid"), "rid").limit(sample).toPandas()
    points = unit(np.stack(some["vector"].to_list()).astype(float))
    levels = nets(points, max(within, 0.25))
    leaves = points[levels[-1][1]]
    shared = spark.sparkContext.broadcast(leaves)          # at most `sample` vectors

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1))
            far = _distances(x, shared.value)
            leaf = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("n"), pa.array(leaf, pa.int32()), pa.array(far[np.arange(len(x)), leaf]), batch.column("vector")],
                ["rid", "n", "leaf", "far", "vector"])

    kind = vectors.schema["vector"].dataType.simpleString()
    placed = materialize(vectors.mapInArrow(assign, f"rid long, n long, leaf int, far double, vector {kind}"), "tree_placed")
    seen = placed.groupBy("leaf").agg(F.max("far").alias("far"), F.count("*").alias("n")).toPandas()
    radius, sizes = np.full(len(leaves), -1.0), np.zeros(len(leaves), int)
    radius[seen["leaf"]], sizes[seen["leaf"]] = seen["far"], seen["n"]
    pairs = traverse(points, levels, radius, within)
    # at most `sample` leaves and their pairs are known here; what pairs of blocks these make is worked out by Spark
    where = spark.createDataFrame([(i, at, n) for i, (at, n) in enumerate(packed(sizes, block))], "leaf int, at int, parts int")
    near = spark.createDataFrame(pa.table({"a_leaf": pa.array(pairs[:, 0], pa.int32()), "b_leaf": pa.array(pairs[:, 1], pa.int32())}))
    spread = lambda side: F.explode(F.sequence(f"{side}_at", F.col(f"{side}_at") + F.col(f"{side}_parts") - 1)).alias(side)
    for side in "ab":
        near = near.join(where.select(*[F.col(c).alias(f"{side}_{c}") for c in where.columns]), f"{side}_leaf")
    todo = near.select(spread("a"), "b_at", "b_parts").select("a", spread("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    whole = materialize(
        placed.join(F.broadcast(where), "leaf").withColumn("block", F.col("at") + F.pmod(F.xxhash64(F.lit(3), "rid"), "parts").cast("int"))
        .groupBy("block").agg(F.collect_list(F.struct("rid", "n", "vector")).alias("v"))
        .select("block", F.col("v.rid").alias("ids"), F.col("v.n").alias("n"), F.flatten("v.vector").alias("flat")), "tree_blocks")
    a, b = (whole.select(F.col("block").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("ids", "n", "flat")]) for s in "ab")
    rows = todo.join(a, "a").join(b, "b")
    return materialize(rows.mapInArrow(_work(cosine), "rid long, n long, root long"), "tree_links")


def report(embeddings: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    x = F.col("embedding")
    valid = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))) & F.exists(x, lambda v: v != 0)
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = x if single else x.cast("array<double>")
    rows = materialize(
        embeddings.select("vec_id", vector.alias("vector"), F.coalesce(valid, F.lit(False)).alias("valid"))
        .withColumns({"rid": F.monotonically_increasing_id(), "k1": F.xxhash64(F.lit(1), "vector"), "k2": F.xxhash64(F.lit(2), "vector")}), "tree_rows")
    # equal vectors (by 128 bits) become one with a weight, so that a group of copies is one vector however large
    distinct = materialize(rows.where("valid").groupBy("k1", "k2").agg(
        F.min("rid").alias("rep"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")), "tree_distinct")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                           F.col("vec_id").isNotNull().alias("kept"))
    links = None
    for r in distinct.select(F.size("vector").alias("d")).distinct().sort("d").collect():     # one length as a rule
        some = distinct.where(F.size("vector") == r["d"]).select(F.col("rep").alias("rid"), F.col("copies").alias("n"), "vector")
        part = _tree_links(some, cosine, sample, block)
        links = part if links is None else links.unionByName(part)
    if links is None:
        return alone
    n = links.groupBy(F.col("rid").alias("rep")).agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("rid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    told = distinct.select("k1", "k2", "rep", "copies").join(n, "rep", "left").join(roots, "rep", "left").select(
        "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    joined = materialize(rows.where("valid").select("vec_id", "k1", "k2").join(told, ["k1", "k2"]).select("vec_id", "n_links", "root"), "tree_joined")
    least = joined.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return joined.join(least, "root").select("vec_id", "n_links", "component_id",
                                             F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")).unionByName(alone)
