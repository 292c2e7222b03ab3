"""URL filters: fixed rules, and gradient-boosted trees on lexical features for the rest.

Rules are (host, path, verdict).  A rule fits its host and every subdomain of it, if the
url's path starts with the rule's path; the longest rule (host and path together) wins.
Urls that a rule decides are the labelled urls: the trees learn from a bounded sample of
them (``train_rows`` distinct urls, the smallest by a hash of the url, each once) and judge the others.

Features are lexical and computed by SQL functions: lengths, depth, digit ratio,
character entropy, parameter count, label counts, and for the last label and the last two
labels of the host how often the sample blocks them (smoothed).  The suffix
statistics have at most ``train_rows`` rows, a bound on what is broadcast.

Defined results: null urls and urls without ``://`` have an empty host and path
and no rule.  Without a labelled sample of both verdicts the
method answers with the verdict of the sample's only class, or ``allow`` if there is no
sample.  Repeated rows stay.  Empty table: empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Fixed values of the contract: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
FEATURES = ("url_len", "host_len", "path_len", "depth", "digit_ratio", "entropy", "params", "labels", "dashes",
            "https", "tld_rate", "site_rate")
TRAIN_ROWS = 20_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + F.lit(1), F.length(after) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # later ones go in front
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, host, path, rule, rule_verdict)."""
    host, path = host_and_path(F.coalesce(F.col("url"), F.lit("")))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def lexical(rows: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    shares = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(
        F.length(c) > 0, (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n).otherwise(F.lit(0.0)))
    labels = F.split(F.regexp_replace("host", r":[0-9]*$", ""), r"\.")

    def count(of: Column, c: str) -> Column:
        return (F.length(of) - F.length(F.replace(of, F.lit(c), F.lit("")))).cast("double")

    return rows.select(
        "*",
        F.length(url).cast("double").alias("url_len"), F.length("host").cast("double").alias("host_len"),
        F.length("path").cast("double").alias("path_len"), count(F.col("path"), "/").alias("depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / n).alias("digit_ratio"),
        F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))).alias("entropy"),
        (count(url, "=") + count(url, "&")).alias("params"), F.size(labels).cast("double").alias("labels"),
        (count(url, "-") + count(url, "_")).alias("dashes"), F.startswith(url, F.lit("https")).cast("double").alias("https"),
        F.element_at(labels, -1).alias("tld"),
        F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".").alias("site"))


def judge_urls(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, rounds: int = 12, depth: int = 4) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the trees' probability of ``block``; null for ruled urls)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = judged_by_rules(pages, rules)
    labelled = rows.filter(F.col("rule").isNotNull()).select(
        "url", "host", "path", (F.col("rule_verdict") == "block").cast("double").alias("label")).distinct()
    sample = written(lexical(labelled.orderBy(F.xxhash64("url"), "url").limit(train_rows)), "urls")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}  # two classes at most

    def verdict(method: Column) -> Column:
        return F.coalesce(F.col("rule_verdict"), method).alias("verdict")

    if len(counts) < 2:
        only = "block" if 1.0 in counts else "allow"
        return rows.select("page_id", "host", "path", "rule", verdict(F.lit(only)), F.lit(None).cast("double").alias("score"))

    mean = counts[1.0] / sum(counts.values())

    def rates(key: str, name: str) -> DataFrame:
        return F.broadcast(sample.groupBy(key).agg(
            ((F.sum("label") + F.lit(5 * mean)) / (F.count(F.lit(1)) + F.lit(5.0))).alias(name)))

    def featured(x: DataFrame) -> DataFrame:
        x = x.join(rates("tld", "tld_rate"), "tld", "left").join(rates("site", "site_rate"), "site", "left")
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
            x.fillna(mean, ["tld_rate", "site_rate"]))

    model = GBTClassifier(labelCol="label", maxIter=rounds, maxDepth=depth, seed=7).fit(featured(sample))
    ruled = rows.filter(F.col("rule").isNotNull()).select(
        "page_id", "host", "path", "rule", F.col("rule_verdict").alias("verdict"), F.lit(None).cast("double").alias("score"))
    scored = (model.transform(featured(lexical(rows.filter(F.col("rule").isNull()))))
              .select("page_id", "host", "path", "rule", vector_to_array("probability")[1].alias("score")))
    scored = scored.select("page_id", "host", "path", "rule",
                           F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict"), "score")
    return ruled.unionByName(scored)
