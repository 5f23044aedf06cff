"""Record validation: field rules, first-wins keys, cart lines, references, quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.json_fields import Field, is_object
from starmart.rules import ENTITY_KEYS, RULES
from starmart.session import counted, materialize, together

# The reason for a record that is no object, and what stands between reasons.
NOT_AN_OBJECT = "record_not_an_object"
SEPARATOR = "; "


def is_clean() -> Column:
    """A plain comparison, so that the Parquet scan can skip on it."""
    return F.col("reasons") == ""


@dataclass
class Checked:
    """The rows of one entity, each with its reasons; a row without reasons is valid."""

    entity: str
    input_count: int   # what came in, counted before the rules, to reconcile against
    rows: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.rows.filter(is_clean()).drop("reasons")

    @property
    def rejected(self) -> DataFrame:
        return failed_rows(self.rows).select(
            F.lit(self.entity).alias("entity"),
            F.col("reasons").alias("reject_reason"),
            raw_record(self.entity).alias("raw_record"),
        )

    def counts(self) -> DataFrame:
        """One row: entity, input_count, valid_count, rejected_count."""
        split = self.rows.agg(
            F.count_if(is_clean()).alias("valid_count"),
            F.count_if(~is_clean()).alias("rejected_count"),
        )
        came_in = F.lit(self.input_count).cast("bigint")
        return split.select(
            F.lit(self.entity).alias("entity"), came_in.alias("input_count"), "valid_count", "rejected_count"
        )


def raw_record(entity: str) -> Column:
    """The rejected record as text: as it came in, or for a cart line its own fields and the cart's."""
    if entity != "cart_items":
        return F.col("rec")
    return F.to_json(F.struct("cart_id", F.col("line_value").alias("line"), "order_date",
                              F.variant_get("line_value", "$.productId", "variant").alias("product_id"),
                              F.variant_get("line_value", "$.quantity", "variant").alias("quantity"), "user_id"))


def _fields(entity: str) -> list[Field]:
    return [Field(rule, flattened=entity != "cart_items") for rule in RULES[entity]]


def flatten(source: DataFrame, entity: str, variant: Column, keep: list[str]) -> DataFrame:
    """One token type and one text per rule; nested names joined by an underscore."""
    fields = _fields(entity)
    parts = {name: c for f in fields for name, c in f.part(variant).items()}
    texts = {name: c for f in fields for name, c in f.text().items()}
    tokens = [name for name in parts if name.endswith("__token")]
    return source.select(*keep, *[c.alias(name) for name, c in parts.items()]).select(*keep, *tokens, *[c.alias(name) for name, c in texts.items()])


def apply_rules(flat: DataFrame, entity: str, keep: list[str]) -> DataFrame:
    """Typed values, and all failed tests per row in rule order, joined; empty for a clean row."""
    fields, out = _fields(entity), flat
    for step in (Field.kinds, Field.numbers):
        out = out.withColumns({name: c for f in fields for name, c in step(f).items()})
    blank = lambda f: F.col(f"{f.rule.name}__blank")
    out = out.withColumns({f.rule.name: F.when(~blank(f), f.value()) for f in fields})
    messages = [m for f in fields for m in f.reasons()]
    return out.select(*keep, *[f.rule.name for f in fields], F.concat_ws(SEPARATOR, *messages).alias("reasons"))


def check_records(records: DataFrame, entity: str) -> DataFrame:
    """records(pos, rec) -> pos, rec, one typed column per rule, reasons. No shuffle."""
    parsed = records.select("pos", "rec", F.try_parse_json("rec").alias("v"))
    parsed = parsed.withColumn("is_object", is_object(F.col("v"), F.col("rec")))
    keep = ["pos", "rec", "is_object"]
    if entity == "carts":
        parsed = parsed.withColumn("cart_lines", F.variant_get("v", "$.products", "variant"))
        keep.append("cart_lines")
    out = apply_rules(flatten(parsed, entity, F.col("v"), keep), entity, keep)
    reasons = F.when(F.col("is_object"), F.col("reasons")).otherwise(NOT_AN_OBJECT)
    return out.withColumn("reasons", reasons).drop("is_object")


def explode_lines(valid_carts: DataFrame) -> DataFrame:
    """One row per entry of each valid cart's products list, numbered within the cart."""
    carts = valid_carts.select(
        F.col("id").alias("cart_id"), F.col("userId").alias("user_id"), F.col("date").alias("order_date"), "cart_lines"
    )
    entries = carts.sparkSession.tvf.variant_explode(F.col("cart_lines").outer())
    return carts.lateralJoin(entries).select(
        "cart_id", "user_id", "order_date", F.col("pos").alias("line"), F.col("value").alias("line_value")
    )


def check_lines(lines: DataFrame) -> DataFrame:
    keep = ["cart_id", "user_id", "order_date", "line", "line_value"]
    return apply_rules(flatten(lines, "cart_items", F.col("line_value"), keep), "cart_items", keep)


def repeated_keys(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keys that more than one clean row has, with the place of the first.

    A count and a minimum per key: partial aggregation folds a hot key before the exchange.
    """
    clean = rows.filter(is_clean())
    groups = clean.groupBy(*keys).agg(F.min(order).alias("first_place"), F.count("*").alias("n"))
    return groups.filter(F.col("n") > 1).drop("n")


def reject_repeats(rows: DataFrame, entity: str, order: str) -> DataFrame:
    """First wins: a clean row behind the first one of its key is rejected, a failed row holds no key.

    Only the repeated keys are joined back. They are written first, so their size is known when
    the join is planned; usually they are few and the rows stay where they are.
    """
    keys = ENTITY_KEYS[entity]
    repeated = materialize(repeated_keys(rows, keys, order), f"{entity}_repeats")
    reason = F.when(F.col(order) > F.col("first_place"), f"duplicate_key:{'+'.join(keys)}").otherwise("")
    marked = rows.filter(is_clean()).join(repeated, keys, "left").withColumn("reasons", reason).select(rows.columns)
    return marked.unionByName(failed_rows(rows))


def failed_rows(rows: DataFrame) -> DataFrame:
    """Rows that later steps pass by: many have no key at all and would crowd one partition of a join."""
    return rows.filter(~is_clean())


def orphan_ids(rows: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Distinct referenced ids that no valid record has. Both sides are unique ids: no hot key."""
    wanted = rows.filter(is_clean()).select(column).distinct()
    return wanted.join(known.select(F.col("id").alias(column)), column, "left_anti")


def reject_orphans(lines: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Adds orphan reasons to clean lines whose user or product is not valid in this batch."""
    out = lines.filter(is_clean())
    found = together(
        lambda: materialize(orphan_ids(lines, "user_id", users), "orphan_users"),
        lambda: materialize(orphan_ids(lines, "product_id", products), "orphan_products"),
    )
    for column, lost in zip(("user_id", "product_id"), found):
        out = out.join(lost.withColumn(f"no_{column}", F.lit(True)), column, "left")
    reasons = F.concat_ws(
        SEPARATOR, F.when(F.col("no_user_id"), "orphan_reference:user_id"),
        F.when(F.col("no_product_id"), "orphan_reference:product_id"),
    )
    # a line that is in order is not written once more as it came: only rejected ones are kept as such
    as_came = F.when(F.col("reasons") != "", F.col("line_value"))
    return out.withColumn("reasons", reasons).withColumn("line_value", as_came).select(lines.columns).unionByName(failed_rows(lines))


def validate_entity(records: DataFrame, entity: str) -> Checked:
    records, came_in = counted(records)
    rows = materialize(check_records(records, entity), f"{entity}_checked")
    return Checked(entity, came_in(), reject_repeats(rows, entity, "pos"))


def validate_lines(carts: Checked) -> Checked:
    """Lines of the valid carts, checked on their own; references come after."""
    lines, came_in = counted(explode_lines(carts.valid))
    rows = materialize(check_lines(lines), "cart_items_checked")
    return Checked("cart_items", came_in(), reject_repeats(rows, "cart_items", "line"))


def validate_all(records: dict[str, DataFrame]) -> dict[str, Checked]:
    def carts_and_lines():
        carts = validate_entity(records["carts"], "carts")
        return carts, validate_lines(carts)

    products, users, (carts, lines) = together(
        lambda: validate_entity(records["products"], "products"),
        lambda: validate_entity(records["users"], "users"),
        carts_and_lines,
    )
    rows = materialize(reject_orphans(lines.rows, users.valid, products.valid), "cart_items_final")
    items = Checked("cart_items", lines.input_count, rows)
    return {"products": products, "users": users, "carts": carts, "cart_items": items}


def union_rejected(checked: dict[str, Checked]) -> DataFrame:
    out = None
    for one in checked.values():
        out = one.rejected if out is None else out.unionByName(one.rejected)
    return out


def union_counts(checked: dict[str, Checked]) -> DataFrame:
    """Counts per entity, and the share of rejected records (0 where nothing came in)."""
    out = None
    for one in checked.values():
        out = one.counts() if out is None else out.unionByName(one.counts())
    ratio = F.when(F.col("input_count") > 0, F.col("rejected_count") / F.col("input_count")).otherwise(F.lit(0.0))
    return out.withColumn("reject_ratio", ratio)
