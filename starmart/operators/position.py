"""Exact global positions, equal-sized tiles and stable keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number within a partition in these


def with_position(df: DataFrame, order: list[Column], name: str = "position", total: str | None = None,
                  running: tuple[str, str] | None = None) -> DataFrame:
    """Adds each row's 1-based position in `order`, which has to break all ties.

    `total` names a column for the number of rows; `running` = (column, name) adds that column's
    running sum. Range partitions are sorted and numbered on their own and written once; the start
    of each partition is a running sum over one small row per partition. The written table fixes
    the range boundaries, so a lost executor cannot shift them.
    """
    numbered = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    kept = materialize(numbered, "positions").withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    value = F.col(running[0]) if running else F.lit(0)
    parts = kept.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start_sum"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    # one row per written partition, so the broadcast side is bounded by the number of tasks
    out = kept.join(F.broadcast(starts), "_part")
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    added = [(F.col("_start") + row + 1).alias(name)]
    if total:
        added.append(F.col("_total").alias(total))
    if running:
        within = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
        added.append((F.col("_start_sum") + F.sum(running[0]).over(within)).alias(running[1]))
    return out.select(*df.columns, *added)


def tile(position: Column, total: Column, tiles: int) -> Column:
    """The NTILE number at a position: tiles differ by at most one row, larger ones first."""
    size = F.floor(total / tiles)
    larger = total % tiles
    in_larger = larger * (size + 1)
    return F.when(position <= in_larger, F.floor((position - 1) / (size + 1)) + 1).otherwise(
        larger + F.floor((position - 1 - in_larger) / F.greatest(size, F.lit(1))) + 1
    ).cast("bigint")
