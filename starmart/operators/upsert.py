"""Insert-or-change operators: what a batch does to a table, decided by joins on the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def insert_absent(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key the table does not have; rows it has stay as they are."""
    return batch.join(existing.select(*keys), keys, "left_anti")


def same(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of two rows."""
    return F.struct(*[c.alias(f"c{i}") for i, c in enumerate(left)]).eqNullSafe(
        F.struct(*[c.alias(f"c{i}") for i, c in enumerate(right)])
    )


def classify(existing: DataFrame, batch: DataFrame, keys: list[str], compare: list[str], keep: list[str]) -> DataFrame:
    """Each batch row with its action and, as old_*, the kept columns of the row it meets."""
    wanted = list(dict.fromkeys([*compare, *keep]))
    old = existing.select(*keys, *[F.col(c).alias(f"old_{c}") for c in wanted], F.lit(True).alias("met"))
    unchanged = same([F.col(f"old_{c}") for c in compare], [F.col(c) for c in compare])
    action = F.when(F.col("met").isNull(), INSERT).when(unchanged, UNCHANGED).otherwise(UPDATE)
    joined = batch.join(old, keys, "left")
    return joined.select(*batch.columns, *[f"old_{c}" for c in keep], action.alias("action"))


def apply_changes(existing: DataFrame, batch: DataFrame, key: str, attributes: list[str], now: Column) -> DataFrame:
    """The table's own rows after the batch: changed where the batch differs, else as they were.

    Rows the batch does not mention stay; rows only the batch has are not added here.
    """
    new = batch.select(key, *[F.col(a).alias(f"new_{a}") for a in attributes], F.lit(True).alias("met"))
    joined = existing.join(new, key, "left")
    changed = F.col("met").isNotNull() & ~same(
        [F.col(a) for a in attributes], [F.col(f"new_{a}") for a in attributes]
    )
    out = {a: F.when(F.col("changed"), F.col(f"new_{a}")).otherwise(F.col(a)) for a in attributes}
    out["updated_at"] = F.when(F.col("changed"), now).otherwise(F.col("updated_at"))
    return joined.withColumn("changed", changed).withColumns(out).select(existing.columns)
