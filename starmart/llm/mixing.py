"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Each source has a target number of words; every document of it shall be taken target / source size
times. The whole part is taken as such. The fraction is rounded by pairing: two documents with
fractional copies p, q and sizes a, b exchange words, one gains what the other loses
(a * p + b * q stays the same), in a random direction weighed so that neither's expected copies change,
until one of them is whole. The other one meets the next document. A group of documents leaves
one fractional document; the leftovers of GROUP groups meet again, level by level, until a source has
one, which is rounded by chance. A source's taken words thus miss its target by less than
one document.

Draws are hashes of the seed and of the two rows that meet, so reruns agree. A document counts as (doc_id, source,
text); repeated rows of it share its fate and size together. Null texts and texts without words have
size 0 and 0 copies. A null source is a source of its own. Sources whose documents are all empty
have target 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.common import fresh, text_key
from starmart.session import materialize

SHARE = 1.5              # words taken, in all words there are
MOST = 2                 # copies of a document at most
WEIGHTS = (5, 2, 1)      # of the sources in order, repeating
GROUP = 256              # documents rounded one after the other by one task
SEED = 17

_SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in the text: each run of words and what follows shrinks to one letter."""
    lead = F.regexp_replace(F.coalesce(text, F.lit("")), rf"\A[{_SPACE}]++", "")
    return F.length(F.regexp_replace(lead, rf"[^{_SPACE}]++[{_SPACE}]*+", "x")).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size -> source, source_size, target.

    The level at which sources fill: those with the smallest size per weight reach their limit first.
    One row per source, so both windows see the list of sources, never documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long")
    weighed = sizes.withColumn("weight", weight)
    full = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    level = ((share * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # the first source that its level does not fill sets the level for all after it
    stepped = weighed.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < most * F.col("source_size"))
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    limit = (most * F.col("source_size")).cast("double")
    return stepped.withColumn("final", final).select(
        "source", "source_size", F.least(limit, F.coalesce(F.col("final") * F.col("weight"), limit)).alias("target"))


# A unit is (key, size, part); part is the fraction still open. At each meeting one unit is settled and
# the other one is left over; nothing is left over if both became whole.
_UNIT = "struct<key: string, size: bigint, part: double>"
_DRAW = f"(pmod(xxhash64({SEED}, {{of}}), {1 << 52}L) / {float(1 << 52)!r}D)"


def _left(key: str, size: str, part: str) -> str:
    return f"if({part} > 1e-12 and {part} < 1 - 1e-12, named_struct('key', {key}, 'size', {size}, 'part', {part}), null)"


def _meet(level: int) -> str:
    x, y = "acc.left", "u"
    up = f"least({x}.size * (1 - {x}.part), {y}.size * {y}.part)"        # words x can gain and y can lose
    down = f"least({x}.size * {x}.part, {y}.size * (1 - {y}.part))"

    def whole(this: str, is_up: str, other: str, part: str) -> str:
        # rounding may leave the other one a hair away from whole: then it is settled as well
        near = f"if({part} > 1e-12 and {part} < 1 - 1e-12, array(), array(named_struct('key', {other}.key, 'up', {part} > 0.5)))"
        return (f"named_struct('left', {_left(f'{other}.key', f'{other}.size', part)}, 'done', "
                f"concat(acc.done, array(named_struct('key', {this}.key, 'up', {is_up})), {near}))")

    return f"""
      aggregate(units, named_struct('left', cast(null as {_UNIT}), 'done', cast(array() as array<struct<key: string, up: boolean>>)),
        (acc, {y}) -> CASE
          WHEN {x} is null THEN named_struct('left', {y}, 'done', acc.done)
          WHEN {_DRAW.format(of=f"{level}, {x}.key, {y}.key")} * ({up} + {down}) < {down} THEN
            if({x}.size * (1 - {x}.part) <= {y}.size * {y}.part,
               {whole(x, 'true', y, f'({y}.part - {up} / {y}.size)')},
               {whole(y, 'false', x, f'({x}.part + {up} / {x}.size)')})
          ELSE
            if({x}.size * {x}.part <= {y}.size * (1 - {y}.part),
               {whole(x, 'false', y, f'({y}.part + {down} / {y}.size)')},
               {whole(y, 'true', x, f'({x}.part - {down} / {x}.size)')})
          END)"""


def settle(units: DataFrame, group: int = GROUP) -> DataFrame:
    """source, n, key, size, part -> source, key, up: every part rounded to up or down.

    n is the number of units of the source, 0 < part < 1 and size > 0. A source of n units has
    ceil(n / group) groups on a level, and as many units on the next one.
    """
    n, level, settled = units.agg(F.max("n").alias("n")).first()["n"] or 0, 0, []
    while n > 1:
        groups = F.ceil(F.col("n") / group)
        met = materialize(
            units.groupBy("source", groups.alias("n"), F.pmod(F.xxhash64(F.lit(level), "key"), groups).alias("g"))
            .agg(F.sort_array(F.collect_list(F.struct("key", "size", "part"))).alias("units"))
            .select("source", "n", F.expr(_meet(level)).alias("m")), "mixing_level")
        settled.append(met.select("source", F.inline("m.done")))
        units = met.where("m.left is not null").select("source", "n", "m.left.*")
        n, level = -(-n // group), level + 1
    last = units.select("source", "key", (F.expr(_DRAW.format(of="'last', key")) < F.col("part")).alias("up"))
    for part in settled:
        last = last.unionByName(part)
    return last


def row_key(docs: DataFrame) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), text_key(docs["text"])))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, source, key, size, source_size, target, copies.

    Needs most * size per source to reach `share` in all, so that the targets have a solution.
    """
    rows = materialize(docs.select("doc_id", "source", row_key(docs).alias("key"), word_count(docs["text"]).alias("size")),
                       "mixing_rows")
    per_unit = rows.where("size > 0").groupBy("source", "key").agg(F.sum("size").alias("size"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_distinct(F.when(F.col("size") > 0, F.col("key"))).alias("n"))
    goal = targets(sizes.select("source", "source_size"), weights, share, most)
    goal = materialize(
        goal.alias("a").join(sizes.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
        .select("a.*", "n", F.coalesce(F.col("target") / F.nullif("a.source_size", F.lit(0)), F.lit(0.0)).alias("times"))
        .select("*", F.floor("times").alias("whole"), (F.col("times") - F.floor("times")).alias("part")), "mixing_targets")
    open_units = (per_unit.alias("u").join(goal.alias("g"), F.col("u.source").eqNullSafe(F.col("g.source")))
                  .where("part > 0").select("u.source", "n", "key", "size", "part"))
    up = settle(open_units, group).where("up").select(F.col("source").alias("s"), F.col("key").alias("k"), "up")
    return (rows.alias("r").join(goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
            .join(up, F.col("r.source").eqNullSafe(F.col("s")) & (F.col("r.key") == F.col("k")), "left")
            .select("doc_id", "r.source", "key", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.col("whole") + F.col("up").isNotNull().cast("int")).otherwise(0).cast("int").alias("copies")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words of each document, its source's and what the mix takes."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents themselves, each repeated as often as the mix takes it, with the columns they had."""
    names = docs.columns
    at = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], docs["source"].alias("s"), row_key(docs).alias("k"))
    taken = mix(docs).where("copies > 0").groupBy("source", "key").agg(F.max("copies").alias("copies"))
    return (at.join(taken, F.col("s").eqNullSafe(F.col("source")) & (F.col("k") == F.col("key")))
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.explode(F.sequence(F.lit(1), "copies")).alias(fresh(docs, "copy")))
            .drop(fresh(docs, "copy")))
