"""N-gram Jaccard join: grouped prefix join over the word shingles of whole texts.

A text's set holds its distinct runs of `k` words (`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased); with fewer words, the whole
sequence as one; without words or text it is empty and linked with nothing. Two sets link if their
intersection is at least num / den of their union.

Sets are ordered by how common a shingle is, rare ones first, so that linked sets share one of their
first few shingles (the prefix). Any fixed order is right; how common a shingle is comes from a table of
2**LEVEL_BITS counters over all documents, which also bounds what is broadcast. Equal sets become one row,
then sets with the same prefix and size one group. Groups that meet on a prefix shingle are
filtered by size and by the place of that shingle, and only then expanded to members, which are filtered by
the parity of their shingles' bits and verified on the full sets.

A shingle's list of at most SHORT groups gives all pairs of its groups of one set. In longer lists, and for larger groups, what is asked for helps: components, so
two sets that are connected already need no test. ROUNDS rounds pair every set with one well-placed
partner per list, as many pairs as sets; taken for links, these leave few pairs between different components. The sets of all those pairs are read once and verified. A
last round then tests every pair that is left between components of verified links. Large groups of near
copies thus cost rows in proportion to their size, and no link between components is lost.

Repeated rows (same doc_id and text) count as one document. A null doc_id comes after all others where
the smallest is wanted. Extra columns are ignored or, in `one_of_each`, kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import text_key
from starmart.llm.components import components
from starmart.llm.words import SPACED, Words, mix, row_sets, slices
from starmart.session import materialize

LEVEL_BITS = 20
ROUNDS = 2
EARLY = 4                # long columns of 64 parity bits each, that postings carry; a power of two
SHORT = 16
MASK_BITS = 23           # slots of the mask of documents whose texts are read again


@dataclass(frozen=True)
class Rule:
    """k words to a shingle; linked from num / den on."""
    k: int
    num: int
    den: int

    def overlap(self, a: str, b: str) -> Column:
        """Smallest intersection of two linked sets of these sizes; in whole numbers."""
        both = F.col(a) + F.col(b)
        return F.floor((both * self.num + (self.num + self.den - 1)) / (self.num + self.den))

    def sized(self, a: str, b: str) -> Column:
        return (F.col(a) * self.den >= F.col(b) * self.num) & (F.col(b) * self.den >= F.col(a) * self.num)

    def band(self, n: str) -> Column:
        """Bands of sizes that can be linked with each other."""
        return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(self.den / self.num * 1.0001))).cast("int")


def _sets(column, k: int):
    words = Words(column, SPACED)
    return row_sets(*words.shingles(k))


def _slots(codes: np.ndarray) -> np.ndarray:
    return (mix(codes) >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)


def _slot(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << MASK_BITS) - 1))


def commonness(docs: DataFrame, k: int) -> np.ndarray:
    """For each of 2**LEVEL_BITS slots how common its shingles are, as a power of two; 0 for most."""
    def count(batches):
        seen, total = np.zeros(1 << LEVEL_BITS, np.int64), 0
        for batch in slices(batches):
            codes, _ = _sets(batch.column("text"), k)
            seen += np.bincount(_slots(codes), minlength=len(seen))
            total += len(codes)
        # only what stands out against a task's even spread; what that misses is taken for rare
        slots = np.flatnonzero(seen >= 4 + 4 * total / len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(seen[slots], pa.int64())], ["slot", "seen"])

    counted = docs.select("text").mapInArrow(count, "slot int, seen long").groupBy("slot").agg(F.sum("seen").alias("seen"))
    rows = counted.select("slot", F.floor(F.log2("seen")).cast("int").alias("level")).toPandas()   # at most 2**LEVEL_BITS rows
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    levels[rows["slot"].to_numpy()] = rows["level"].to_numpy()
    return levels


def _parity(codes: np.ndarray, row: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row how often its codes fall on each of at least n places, as parity bits: longs of all rows, and where a row's begin."""
    longs = np.left_shift(1, np.ceil(np.log2(np.maximum(n / 64, EARLY))).astype(np.int64))
    held = np.concatenate(([0], np.cumsum(longs)))
    place = held[row] * 64 + (codes & (longs[row] * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place, minlength=int(held[-1]) * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64), held


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, tk (key of the text), n, sk (key of the set), gk (key of the group), prefix, bits and s0.. (parity) of each document."""
    levels = docs.sparkSession.sparkContext.broadcast(commonness(docs, rule.k))
    k, num, den = rule.k, rule.num, rule.den

    def run(batches):
        for batch in slices(batches):
            codes, first = _sets(batch.column("text"), k)
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)
            order = np.argsort(row * 64 + levels.value[_slots(codes)], kind="stable")   # codes ascend within a level
            ordered = codes[order].view(np.int64)
            length = np.where(n > 0, n + (-n * num // den) + 1, 0)
            at = np.arange(len(codes)) - np.repeat(first[:-1], n)
            prefix = ordered[at < np.repeat(length, n)]
            starts = np.concatenate(([0], np.cumsum(length)))
            bits, held = _parity(codes, row, n)
            early = np.bitwise_xor.reduceat(bits.reshape(-1, EARLY), held[:-1] // EARLY, axis=0) if len(n) else bits.reshape(-1, EARLY)
            sk = [hashlib.blake2b(codes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first, first[1:])]
            gk = [int.from_bytes(hashlib.blake2b(prefix[a:b].tobytes() + int(m).to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True)
                  for a, b, m in zip(starts, starts[1:], n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tk"), pa.array(n, pa.int64()), pa.array(sk, pa.binary()), pa.array(gk, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(prefix, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(held, pa.int32()), pa.array(bits, pa.int64())),
                 *[pa.array(early[:, j], pa.int64()) for j in range(EARLY)]],
                ["doc_id", "tk", "n", "sk", "gk", "prefix", "bits", *[f"s{j}" for j in range(EARLY)]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    parity = ", bits array<long>" + "".join(f", s{j} long" for j in range(EARLY))
    return docs.select("doc_id", "text", text_key(F.col("text")).alias("tk")).mapInArrow(
        run, f"doc_id {kind}, tk string, n long, sk binary, gk long, prefix array<long>{parity}")


class Join:
    """The steps of one join; every frame that several steps read is written."""

    def __init__(self, docs: DataFrame, rule: Rule):
        self.docs, self.rule = docs, rule
        self.rows = materialize(signatures(docs, rule), "jaccard_rows")
        parity = ["bits", *[f"s{j}" for j in range(EARLY)]]
        some = self.rows.where("n > 0")
        self.sets = materialize(some.groupBy("sk").agg(
            F.first(F.struct("gk", "n", *parity)).alias("v"),
            F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tk")).alias("place")).select("sk", "v.*", "place"), "jaccard_sets")
        posted = some.groupBy("gk", "n").agg(F.first("prefix").alias("prefix")).select("gk", "n", F.posexplode("prefix").alias("at", "token"))
        several = posted.groupBy("token").agg(F.count("*").cast("int").alias("groups")).where("groups > 1")
        posted = materialize(posted.join(several, "token").select("token", "gk", "n", "at", "groups"), "jaccard_posted")
        # a group of several sets has no parity of its own
        alone = self.sets.groupBy("gk").agg(F.count("*").alias("members"), *[F.first(f"s{j}").alias(f"s{j}") for j in range(EARLY)])
        self.several = materialize(self.sets.join(alone.where("members > 1").select("gk"), "gk"), "jaccard_several")
        self.posted = materialize(posted.join(alone.select("gk", *[F.when(F.col("members") == 1, F.col(f"s{j}")).alias(f"s{j}") for j in range(EARLY)]), "gk"),
                                  "jaccard_lists")
        # lists that are long, or hold a group of several sets
        wide = self.posted.where(F.col("s0").isNull() & (F.col("groups") <= SHORT)).select("token").distinct()
        self.long = materialize(self.posted.where(F.col("groups") > SHORT).unionByName(
            self.posted.where(F.col("groups") <= SHORT).join(wide, "token", "left_semi")), "jaccard_long")

    def labels(self, links: DataFrame | None) -> DataFrame:
        """sk, comp, size of the sets that have links; all others are components of their own."""
        if links is None:
            return None
        roots = components(links.select("a", "b"))
        sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
        return materialize(roots.join(sizes, "root").select(F.col("id").alias("sk"), F.col("root").alias("comp"), "size"), "jaccard_labels")

    def members(self, labels: DataFrame | None, sets: DataFrame | None = None) -> DataFrame:
        sets = self.sets if sets is None else sets
        if labels is None:
            return sets.withColumn("comp", F.col("sk"))
        return sets.join(labels.select("sk", F.col("comp").alias("c")), "sk", "left").withColumn("comp", F.coalesce("c", "sk")).drop("c")

    def lists(self, labels: DataFrame | None) -> DataFrame:
        """Postings with a label of their group: of its component, or its own where it stands alone or in several."""
        if labels is None:
            return self.long.withColumn("label", F.col("gk")).withColumn("size", F.lit(1).cast("long"))
        marked = (self.sets.select("sk", "gk").join(labels, "sk", "left").groupBy("gk")
                  .agg(F.min(F.coalesce("comp", "sk")).alias("lo"), F.max(F.coalesce("comp", "sk")).alias("hi"), F.max("size").alias("size"))
                  .where("size is not null and lo = hi").select("gk", F.xxhash64("lo").alias("label"), "size"))
        return self.long.join(marked, "gk", "left").withColumn("label", F.coalesce("label", "gk")).withColumn("size", F.coalesce("size", F.lit(1)))

    def mixed_groups(self, labels: DataFrame | None) -> DataFrame:
        several = self.members(labels, self.several).groupBy("gk").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        return several.select(F.col("gk").alias("ga"), F.col("gk").alias("gb"))

    def met(self, x: str, y: str) -> Column:
        """Two postings of one shingle allow for a link: by size, by the shingles left from this one on, by early parity."""
        left = F.least(F.col(f"{x}.n") - F.col(f"{x}.at"), F.col(f"{y}.n") - F.col(f"{y}.at"))
        need = self.rule.overlap(f"{x}.n", f"{y}.n")
        differ = self.early(x, y)
        return self.rule.sized(f"{x}.n", f"{y}.n") & (left >= need) & (
            differ.isNull() | (differ <= F.col(f"{x}.n") + F.col(f"{y}.n") - 2 * need))

    def early(self, x: str, y: str) -> Column:
        """At most the number of shingles that only one of the two has, from few bits."""
        out = F.lit(0)
        for j in range(EARLY):
            out = out + F.bit_count(F.col(f"{x}.s{j}").bitwiseXOR(F.col(f"{y}.s{j}")))
        return out

    def differ(self, x: str, y: str) -> Column:
        """The same from all bits: as many as shingles, so that it stays sharp for long texts. The longer row of bits is folded once."""
        a, b = F.col(f"{x}.bits"), F.col(f"{y}.bits")

        def folded(bits: Column, other: Column) -> Column:
            half = F.floor(F.size(bits) / 2).cast("int")
            return F.when(F.size(bits) > F.size(other), F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(bits)

        u, v = folded(a, b), folded(b, a)
        count = F.aggregate(F.zip_with(u, v, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, c: total + c)
        return F.when(F.size(u) == F.size(v), count).otherwise(F.lit(0))

    def pairs(self, groups: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Pairs of groups ga, gb (each once) to pairs of their members."""
        members = self.members(labels)
        both = groups.join(members.alias("a"), F.col("ga") == F.col("a.gk")).join(members.alias("b"), F.col("gb") == F.col("b.gk"))
        return self.apart(both.where((F.col("ga") != F.col("gb")) | (F.col("a.sk") < F.col("b.sk"))))

    def short(self) -> DataFrame:
        """All pairs of groups of one set from short lists that the filters let through."""
        lists = self.posted.where((F.col("groups") <= SHORT) & F.col("s0").isNotNull()).select("token", "gk", "n", "at", *[f"s{j}" for j in range(EARLY)])
        x, y = lists.alias("x"), lists.alias("y")
        groups = x.join(y, F.col("x.token") == F.col("y.token")).where((F.col("x.gk") < F.col("y.gk")) & self.met("x", "y"))
        groups = groups.select(F.col("x.gk").alias("ga"), F.col("y.gk").alias("gb")).distinct()
        return materialize(self.pairs(groups, None).select("a", "b", "an", "bn"), "jaccard_short")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """a, b, an, bn, differ of the pairs of members that are in different components and whose parities allow a link."""
        most = F.col("a.n") + F.col("b.n") - 2 * self.rule.overlap("a.n", "b.n")
        return (pairs.where((F.col("a.comp") != F.col("b.comp")) & self.rule.sized("a.n", "b.n") & (self.early("a", "b") <= most))
                .select(F.col("a.sk").alias("a"), F.col("b.sk").alias("b"), F.col("a.n").alias("an"), F.col("b.n").alias("bn"),
                        self.differ("a", "b").alias("differ"), most.alias("most")).where("differ <= most").drop("most"))

    def near(self, number: int, labels: DataFrame | None) -> DataFrame:
        """Every set with the closest of the pivots of its lists: one pivot per shingle and band of sizes. It is a group
        that has the shingle first of all: with the fewest rare shingles of its own it is closest to the others, and for near copies mostly the same in all their lists."""
        lists = self.lists(labels)
        lists = lists.withColumn("band", self.rule.band("n"))
        pivots = lists.groupBy("token", "band").agg(
            F.min_by(F.struct("gk", "n", "at", "label", *[f"s{j}" for j in range(EARLY)]), F.struct("at", F.xxhash64(F.lit(number), "gk"))).alias("p"),
            F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token", "band", "p.*").alias("y")
        groups = (lists.alias("x").join(pivots, ["token", "band"]).where((F.col("x.label") != F.col("y.label")) & self.met("x", "y"))
                  .select(F.col("x.gk").alias("ga"), F.col("y.gk").alias("gb")).unionByName(self.mixed_groups(labels)).distinct())
        members = self.members(labels)
        heads = members.groupBy("gk").agg(F.min_by(F.struct(*members.columns), F.xxhash64(F.lit(number), "sk")).alias("h")).select("h.*")
        pairs = self.apart(groups.join(members.alias("a"), F.col("ga") == F.col("a.gk")).join(heads.alias("b"), F.col("gb") == F.col("b.gk")))
        best = pairs.groupBy("a").agg(F.min(F.struct("differ", "b", "an", "bn")).alias("v"))
        return materialize(best.select("a", "v.b", "v.an", "v.bn"), "jaccard_near")

    def rest(self, labels: DataFrame) -> DataFrame:
        """All pairs from long lists of members of different components that the filters let through."""
        lists = self.lists(labels)
        # two labels that differ: one of them at least is not the list's top one, whichever that is
        top = lists.groupBy("token").agg(F.max_by("label", F.struct("size", "label")).alias("top"), F.min("label").alias("lo"),
                                         F.max("label").alias("hi")).where("lo <> hi").select("token", "top")
        fewer = lists.join(top, "token").where(F.col("label") != F.col("top"))
        once = (F.col("y.label") == F.col("x.top")) | (F.col("x.gk") < F.col("y.gk"))
        groups = (fewer.alias("x").join(lists.alias("y"), F.col("x.token") == F.col("y.token"))
                  .where((F.col("x.label") != F.col("y.label")) & once & self.met("x", "y"))
                  .select(F.col("x.gk").alias("ga"), F.col("y.gk").alias("gb")).unionByName(self.mixed_groups(labels)).distinct())
        return materialize(self.pairs(groups, labels).select("a", "b", "an", "bn"), "jaccard_rest")

    def tokens(self, pairs: DataFrame) -> DataFrame:
        """sk, tokens: the whole set of every set in the pairs."""
        k = self.rule.k
        asked = pairs.select(F.col("a").alias("sk")).unionByName(pairs.select(F.col("b").alias("sk"))).distinct()
        place = F.concat_ws(":", F.col("place.doc_id").cast("string"), "place.tk")
        asked = materialize(self.sets.join(asked, "sk", "left_semi").select("sk", place.alias("key"), _slot(place).alias("slot")), "jaccard_asked")
        # a mask of fixed size, so that other texts are not shuffled; what it lets through in vain, the join drops
        mask = asked.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask"))
        key = F.concat_ws(":", F.col("doc_id").cast("string"), text_key(F.col("text")))
        texts = self.docs.select("text", key.alias("key")).withColumn("slot", _slot(F.col("key"))).withColumn("word", F.shiftright("slot", 6))
        texts = texts.join(F.broadcast(mask), "word").where(F.expr("(shiftright(mask, cast(slot & 63 as int)) & 1) = 1")).select("key", "text")
        texts = texts.join(asked.select("sk", "key").hint("merge"), "key").groupBy("key").agg(F.first("sk").alias("sk"), F.first("text").alias("text"))

        def run(batches):
            for batch in slices(batches):
                codes, first = _sets(batch.column("text"), k)
                yield pa.RecordBatch.from_arrays([batch.column("sk"), pa.ListArray.from_arrays(
                    pa.array(first, pa.int32()), pa.array(codes.view(np.int64), pa.int64()))], ["sk", "tokens"])

        return materialize(texts.select("sk", "text").mapInArrow(run, "sk binary, tokens array<long>"), "jaccard_tokens")

    def verify(self, pairs: DataFrame, tokens: DataFrame) -> DataFrame:
        """The linked ones among pairs a, b, an, bn."""
        sides = (pairs.join(tokens.select(F.col("sk").alias("a"), F.col("tokens").alias("ta")), "a")
                 .join(tokens.select(F.col("sk").alias("b"), F.col("tokens").alias("tb")), "b"))
        linked = F.size(F.array_intersect("ta", "tb")) >= self.rule.overlap("an", "bn")
        return materialize(sides.where(linked).select("a", "b"), "jaccard_links")

    def run(self) -> DataFrame:
        """sk, comp: the component of every set that has links."""
        pairs, labels = self.short(), None
        for number in range(ROUNDS):
            pairs = pairs.unionByName(self.near(number, labels))
            labels = self.labels(pairs)
        # Taking all of these for links, whatever passes the filters with anything is in a pair: as one of them, or with
        # some other component. So no later step asks for another set.
        pairs = materialize(pairs.unionByName(self.rest(labels)).distinct(), "jaccard_pairs")
        tokens = self.tokens(pairs)
        links = self.verify(pairs, tokens)
        more = materialize(self.rest(self.labels(links)).join(pairs, ["a", "b"], "left_anti"), "jaccard_more")
        links = links.unionByName(self.verify(more, tokens))
        return self.labels(links)


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, tk, n, class of every document; class is null for empty sets."""
    join = Join(docs, rule)
    roots = join.run().select("sk", "comp")
    return join.rows.select("doc_id", "tk", "n", "sk").join(roots, "sk", "left").select(
        "doc_id", "tk", "n", F.when(F.col("n") > 0, F.coalesce("comp", "sk")).alias("class"))


def report(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links reach."""
    rows = materialize(classes(docs, rule), "jaccard_documents")
    least = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """The documents with the columns they had, of each component only the first by doc_id, of repeated rows one.
    Documents with empty sets all stay."""
    rows = classes(docs, rule)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tk")
    first = rows.where("class is not null").groupBy("class").agg(F.min(place).alias("p")).select(
        F.col("p.doc_id").alias("d"), F.col("p.tk").alias("t"), F.lit(True).alias("once"))
    empty = rows.where("class is null").select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), F.lit(False).alias("once")).distinct()
    keep = materialize(first.unionByName(empty), "jaccard_kept")
    names = docs.columns
    at = docs.select(F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("row"),
                     docs["doc_id"].alias("i"), text_key(docs["text"]).alias("k"))
    kept = at.join(keep, F.col("i").eqNullSafe(F.col("d")) & (F.col("k") == F.col("t")))
    single = kept.where("once").groupBy("i", "k").agg(F.first("row").alias("row")).select("row")
    return single.unionByName(kept.where(~F.col("once")).select("row")).select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
