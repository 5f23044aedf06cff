"""Which titles stand together in the most carts: exact top pairs, of which most are never made.

A pair cannot occur more often than its rarer title, times the number of products that may share the other title. The pairs of the most
frequent titles are counted first; the k-th best of them is a threshold that every pair of the answer reaches, so titles
that cannot reach it are dropped with their lines before any other pair is made. All of it is one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FREQUENT = 256        # titles whose pairs give the threshold; any number gives the same answer
LEAF_LINES = 64       # a part of a cart with this many lines or fewer is not divided further
BLOCK_TITLES = 1024
DIGIT = 4             # bits of a product id that a level of the division looks at


def _within(lines: DataFrame) -> DataFrame:
    """Pairs of lines of small carts, lower id first."""
    a = lines.select("cart_id", F.col("product_id").alias("a_id"), F.col("title").alias("product_a"))
    b = lines.select("cart_id", F.col("product_id").alias("b_id"), F.col("title").alias("product_b"))
    pairs = a.join(b, "cart_id").filter(F.col("a_id") < F.col("b_id"))
    return pairs.select("product_a", "product_b", F.lit(1).cast("bigint").alias("n"))


def _divided(lines: DataFrame, large: DataFrame) -> DataFrame:
    """Pair counts of large carts from title counts of the parts that a division by id digits gives.

    Any two products of a cart part company at exactly one digit: above it their ids agree, there the lower id has the lower
    digit. Per digit only the title counts of sibling parts are multiplied, so a cart of n lines and t titles costs n
    counted rows and at most t * t products per digit, whatever n is.
    """
    digits = F.ceil(F.length(F.bin("top")) / DIGIT).cast("int")
    levels = F.explode(F.sequence(F.lit(0), digits - 1)).alias("level")
    parts = (
        lines.join(large, "cart_id").select("cart_id", "size", "title", "product_id", levels)
        .selectExpr("cart_id", "size", "level", "title", f"shiftright(product_id, {DIGIT} * (level + 1)) AS node",
                    f"cast(shiftright(product_id, {DIGIT} * level) & {(1 << DIGIT) - 1} AS int) AS digit")
        .groupBy("cart_id", "size", "level", "node", "digit", "title").agg(F.count("*").alias("n"))
    )
    # a part holds no more titles than ids or than the cart has lines; they are dealt over blocks of about BLOCK_TITLES, and each
    # block on the left meets each on the right as a join key of its own
    most = F.least(F.col("size").cast("double"), F.pow(F.lit(2.0 ** DIGIT), F.col("level") + 1))
    blocks = F.greatest(F.lit(1), F.floor(most / BLOCK_TITLES)).cast("int")
    own, other = F.pmod(F.xxhash64("title"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    node = ["cart_id", "level", "node", "left_block", "right_block"]
    left = parts.withColumn("left_block", own).withColumn("right_block", other).select(
        *node, F.col("digit").alias("low"), F.col("title").alias("product_a"), F.col("n").alias("n_a"))
    right = parts.withColumn("right_block", own).withColumn("left_block", other).select(
        *node, F.col("digit").alias("high"), F.col("title").alias("product_b"), F.col("n").alias("n_b"))
    # few bytes here become many rows behind the join: a fixed number keeps tasks from being merged
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = left.repartition(tasks, *node).join(right, node).filter("low < high")
    return met.select("product_a", "product_b", (F.col("n_a") * F.col("n_b")).alias("n"))


def pair_counts(lines: DataFrame, leaf_lines: int = LEAF_LINES) -> DataFrame:
    """lines(cart_id, product_id, title) -> product_a, product_b, carts_together, lower id first; ids are not negative."""
    sizes = lines.groupBy("cart_id").agg(F.count("*").alias("size"), F.max("product_id").alias("top"))
    large = sizes.filter(F.col("size") > leaf_lines)
    pairs = _within(lines.join(large, "cart_id", "left_anti")).unionByName(_divided(lines, large))
    return pairs.groupBy("product_a", "product_b").agg(F.sum("n").alias("carts_together"))


def top_pairs(lines: DataFrame, products: DataFrame, k: int, key: str = "product_id", frequent: int = FREQUENT,
              leaf_lines: int = LEAF_LINES) -> DataFrame:
    """lines(cart_id, key) once per cart and product, products(key, product_id, title) -> the k pairs of titles that most pairs
    of lines in one cart bear, the title of the lower product_id first; ties by title."""
    order = [F.desc("carts_together"), F.col("product_a"), F.col("product_b")]
    titles = lines.groupBy(key).agg(F.count("*").alias("lines")).join(products, key).groupBy("title").agg(
        F.sum("lines").alias("lines"), F.count("*").alias("products"))
    named = lines.select("cart_id", key).join(products, key).select("cart_id", "product_id", "title")
    some = titles.orderBy(F.desc("lines"), "title").limit(frequent).select("title")
    best = pair_counts(named.join(some, "title", "left_semi"), leaf_lines).orderBy(*order).limit(k)
    threshold = best.agg(F.when(F.count("*") == k, F.min("carts_together")).otherwise(0)).scalar()
    shared = titles.agg(F.coalesce(F.max("products"), F.lit(1))).scalar()
    kept = titles.filter(F.col("lines") * shared >= threshold).select("title")
    return pair_counts(named.join(kept, "title", "left_semi"), leaf_lines).orderBy(*order).limit(k)
