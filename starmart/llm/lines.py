"""Line dedup: lines that spread over many sites are boilerplate; one copy of each stays.

A line's key is a hash of it without leading and trailing space. Every key gets a HyperLogLog sketch of the sites
(sources) it stands on; sketches of a key merge by aggregation. A key whose estimate is clearly below MIN_SITES
is left alone, one clearly above is boilerplate, and one near the threshold has its sites counted exactly. Of a
boilerplate line the place with the smallest (doc_id, line number) stays; all other places
are removed, whatever their site.

Lines end with "\\n". Blank lines are never removed. A null source is no site, but lines of such documents are removed like others. A null doc_id comes last in the
order of places. Repeated rows (same doc_id and text) are the same document and lose the same lines. A null text stays null;
a text that loses all its lines becomes empty. Extra columns are kept as they are; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import fresh, text_key
from starmart.session import materialize

MIN_SITES = 5            # a line on as many different sites is boilerplate
SKETCH_BITS = 10         # 1024 registers: about 3 % standard error
MARGIN = 0.2             # estimates within this share of the threshold are counted exactly


def places(docs: DataFrame) -> DataFrame:
    """doc_id, text key, source, line number (from 0) and line key of every line that is not blank."""
    lines = docs.select("doc_id", "source", text_key(F.col("text")).alias("tk"), F.posexplode(F.split("text", "\n", -1)).alias("line", "value"))
    bare = F.trim(F.regexp_replace("value", r"[\t\r\x0b\x0c]", " "))
    return lines.where(bare != "").select("doc_id", "tk", "source", "line", F.xxhash64(bare).alias("key"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """key, sites of the lines that stand on at least min_sites different sites; sites is exact near the threshold."""
    spread = lines.groupBy("key").agg(F.hll_sketch_agg("source", SKETCH_BITS).alias("sketch"))
    spread = materialize(spread.select("key", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - MARGIN)),
                         "line_spread")
    near = spread.where(F.col("sites") <= min_sites * (1 + MARGIN)).select("key")
    exact = lines.join(near, "key").select("key", "source").distinct().groupBy("key").agg(F.count("source").alias("sites"))
    return spread.where(F.col("sites") > min_sites * (1 + MARGIN)).unionByName(exact.where(F.col("sites") >= min_sites))


def removals(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, tk, lines: the numbers of the lines that each document loses."""
    lines = places(docs)
    spread = materialize(boilerplate(lines, min_sites), "boilerplate")
    # of repeated rows one is enough
    at = materialize(lines.join(spread.select("key"), "key").select("key", "doc_id", "tk", "line").distinct(), "line_places")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tk", "line")
    kept = at.groupBy("key").agg(F.min(place).alias("kept"))
    return (at.join(kept, "key").where(place != F.col("kept"))
            .groupBy("doc_id", "tk").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with the columns they had, without the lines they lose; `lines_removed` counts those."""
    names = docs.columns
    at = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], docs["doc_id"].alias("d"), text_key(docs["text"]).alias("t"))
    lost = removals(docs, min_sites).alias("lost")
    text = f"c{names.index('text')}"
    left = F.array_join(F.transform(
        F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                 lambda s: ~F.array_contains("lost.lines", s["i"])), lambda s: s["x"]), "\n")
    return (at.join(lost, F.col("d").eqNullSafe(F.col("lost.doc_id")) & (F.col("t") == F.col("lost.tk")), "left")
            .select(*[(F.when(F.col("lost.lines").isNull(), F.col(text)).otherwise(left) if c == "text" else F.col(f"c{i}")).alias(c)
                      for i, c in enumerate(names)],
                    F.coalesce(F.size("lost.lines"), F.lit(0)).cast("long").alias(fresh(docs, "lines_removed"))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (blank ones too), n_removed, text of every document."""
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    out = dedup(docs.select("doc_id", "source", "text", n_lines.alias("n_lines")))
    return out.select("doc_id", "n_lines", F.col("lines_removed").alias("n_removed"), "text")
