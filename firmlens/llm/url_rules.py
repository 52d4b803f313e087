"""URL filtering: listed domain rules first, mined association rules for the rest.

FP-growth mines combinations of URL tokens (host labels, path segments, query keys) over the
labelled pages, with the label as one more item. Combinations that imply a verdict with enough support and confidence
are rules. Each rule is indexed under its rarest token only; a URL looks up its tokens and
checks the rest of a rule's combination.

DataFrame functions and Spark ML's FP-growth only; no Python code on the executors.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import stored

MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.9
DEFAULT = "allow"

# The listed rules (verdict, host, path)
LISTED = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _SPLIT, 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: ``h:`` host labels, ``p:`` path segments, ``q:`` query keys."""

    def marked(mark: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))

    query = F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&")
    keys = F.transform(query, lambda kv: F.substring_index(kv, "=", 1))
    return F.array_distinct(
        F.concat(marked("h:", F.split(host(url), r"\.")), marked("p:", F.split(path(url), "/")), marked("q:", keys))
    )


def listed_rule(host_col: Column, path_col: Column, rules: tuple = LISTED) -> Column:
    """The longest listed rule that fits, as ``rule`` and ``verdict``; null if none does. A rule
    fits its host and all subdomains, if the path starts with the rule's. The list is an
    expression: meant for short lists."""
    kind = "struct<rule:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Index of rules: ``token`` (the rarest of the combination), ``needs`` (the combination),
    ``verdict``, ``confidence``, ``support``; from ``labelled(tokens, label)``. No rows: no rules."""
    spark = labelled.sparkSession
    if labelled.isEmpty():
        return spark.createDataFrame([], "token string, needs array<string>, verdict string, confidence double, support double")
    mark = "verdict:"
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(mark), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = stored(
        model.associationRules.where(F.col("consequent")[0].startswith(mark)).select(
            F.array_sort("antecedent").alias("needs"), F.substring_index(F.col("consequent")[0], ":", -1).alias("verdict"),
            "confidence", "support",
        ),
        "url_rules",
    )
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (
        rules.select("needs", F.explode("needs").alias("token")).join(single, "token")
        .groupBy("needs").agg(F.min(F.struct("freq", "token"))["token"].alias("token"))
    )
    return stored(rules.join(rarest, "needs").select("token", "needs", "verdict", "confidence", "support"), "url_rule_index")


def mined_verdicts(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``url, mined``: the verdict of the best fitting rule (most confidence, then support, then
    tokens; ``block`` before ``allow``) for every distinct non-null URL that one fits."""
    tokens = urls.where("url IS NOT NULL").distinct().withColumn("tokens", url_tokens(F.col("url")))
    return (
        tokens.select("url", "tokens", F.explode_outer("tokens").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("needs", "tokens")) == 0)
        .groupBy("url")
        .agg(F.max(F.struct("confidence", "support", F.size("needs").alias("size"), "verdict"))["verdict"].alias("mined"))
    )


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple = LISTED, **limits: float) -> DataFrame:
    """``pages`` packed as ``doc`` (a struct of all its columns) with ``host``, ``path``, ``rule`` (the listed
    rule, or null) and ``verdict``: the listed rule's, else the mined one's, else ``allow``.

    The labels that rules are mined from are the listed rules' verdicts. Null URLs, and
    URLs without ``://``, have an empty host and path, and no listed rule fits them. Every row is returned.
    """
    value = F.col(f"doc.`{url}`").cast("string")
    named = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("doc")).select(
        "doc", value.alias("url"), host(value).alias("host"), path(value).alias("path")
    )
    judged = named.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules))
    labelled = judged.where("listed IS NOT NULL").select(url_tokens(F.col("url")).alias("tokens"), F.col("listed.verdict").alias("label"))
    index = mine_rules(labelled, **limits)
    open_ = judged.where("listed IS NULL AND url IS NOT NULL")
    mined = open_.join(mined_verdicts(open_.select("url"), index), "url", "left")
    rest = judged.where("listed IS NOT NULL OR url IS NULL").withColumn("mined", F.lit(None).cast("string"))
    return mined.unionByName(rest).select(
        "doc", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined", F.lit(DEFAULT)).alias("verdict"),
    )
