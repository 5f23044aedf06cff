"""URL filters: rules first, logistic regression on hashed character n-grams for what no rule fits.

A rule is a host, a path and a verdict. It fits its host and all subdomains if the url's path starts
with the rule's; the longest fitting one wins. The labelled urls for training are a small table
url, verdict; by default the one of `labelled_urls`, made of known words of unwanted and of ordinary
sites. Features are all 2- to 4-letter pieces of the host
and of the path, hashed; pieces that touch an end carry a mark. The model is fitted and applied by
Spark's own machine learning, on JVM side.

A url that is null or has no "://" has an empty host and path and fits no rule; the model judges it
by its features alone (there are none). Without any labelled url, or with one verdict only, the model
gives that verdict, or allow. Repeated urls are judged alike; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.session import scratch_path

# Fixed values of the contract: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
HASHED = 1 << 15
PIECES = (2, 3, 4)


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^/?#]*([^?#]*)", 1)


def fitting_rule(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits the columns host and path, and its verdict; null if none."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = (F.concat(F.lit("."), F.col("host")).endswith(f".{h}")) & F.col("path").startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    name, verdict = fitting_rule(rules)
    return pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).select(
        "*", name.alias("rule"), verdict.alias("ruled"))


def pieces(host: Column, path: Column) -> Column:
    """All pieces of PIECES letters of host and path; h and p keep the two apart, ^ and $ mark the ends."""
    def of(kind: str, text: Column, n: int) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        places = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(kind), F.substring(marked, i, F.lit(n))))
    parts = [F.when(F.length(text) > 0, of(kind, text, n)).otherwise(F.array().cast("array<string>"))
             for n in PIECES for kind, text in (("h", host), ("p", path))]
    return F.concat(*parts)


def fit(labelled: DataFrame) -> PipelineModel | str:
    """url, verdict -> a model, or the only verdict there is."""
    rows = labelled.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                           (F.col("verdict") == "block").cast("double").alias("label")).where("label is not null")
    kinds = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return "block" if kinds == [1.0] else "allow"
    steps = [HashingTF(inputCol="pieces", outputCol="features", numFeatures=HASHED, binary=True),
             LogisticRegression(regParam=1e-3, maxIter=50)]
    fitted = Pipeline(stages=steps).fit(rows.withColumn("pieces", pieces(F.col("host"), F.col("path"))))
    # A fitted model keeps its training summary and with it the session, which not every session can send to tasks; a read one does not.
    folder = scratch_path(labelled.sparkSession, "url-model")
    fitted.write().save(folder)
    return PipelineModel.load(folder)


# The labelled table is made of these words, as site names and as sections.
UNWANTED = "casino bets betting poker jackpot slots lottery pills pharmacy viagra cialis adult porn xxx sex escort loans payday " \
           "replica spam spams farm ads adserver banner track tracker tracking click clicks popup malware warez torrent crack keygen " \
           "win winner prize free cheap discount".split()
ORDINARY = "news weather library museum school college research science history music garden travel recipes kitchen sports health " \
           "science maps forum wiki docs blog books letters journal archive gallery market city river mountain theatre radio " \
           "answers nature space energy water people culture teacher student paper notes stories letter reader".split()
ENDS = ("com", "net", "org", "info")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, verdict: pairs of words as sites over all ends and languages, a few thousand small rows."""
    def words(of, name):
        return spark.createDataFrame([(w,) for w in dict.fromkeys(of)], f"{name} string")

    def sites(first, second, verdict):
        ends = F.array(*[F.lit(e) for e in ENDS])
        tongues = F.array(*[F.lit(x) for x in ("en", "de", "fr", "es")])
        pairs = words(first, "a").withColumn("b", F.explode(F.array(*[F.lit(w) for w in dict.fromkeys(second)])))
        mark = F.pmod(F.xxhash64("a", "b"), F.lit(4)).cast("int")
        join = F.element_at(F.array(F.lit("-"), F.lit(""), F.lit("."), F.lit("-")), mark + 1)
        return pairs.where("a <> b").select(F.concat(
            F.lit("http://"), "a", join, "b", F.lit("."), F.element_at(ends, mark + 1), F.lit("/"),
            F.element_at(tongues, F.pmod(F.xxhash64("b", "a"), F.lit(4)).cast("int") + 1), F.lit("/"),
            F.pmod(F.xxhash64("a"), F.lit(99999)).cast("string")).alias("url"), F.lit(verdict).alias("verdict"))

    return sites(UNWANTED, UNWANTED[::4] + ORDINARY[::8], "block").unionByName(sites(ORDINARY, ORDINARY, "allow"))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block: the rule's verdict, else the model's."""
    model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    rows = judged_by_rules(pages, rules)
    if isinstance(model, str):
        p_block = rows.withColumn("p_block", F.lit(float(model == "block")))
    else:
        p_block = model.transform(rows.withColumn("pieces", pieces(F.col("host"), F.col("path")))).withColumn(
            "p_block", vector_to_array("probability")[1])
    return p_block.select("page_id", "host", "path", "rule",
                          F.coalesce("ruled", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                          F.round("p_block", 6).alias("p_block"))
