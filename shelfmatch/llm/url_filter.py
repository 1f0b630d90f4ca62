"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the URLs without a rule.

Features: length, path depth, digit ratio, character entropy, number of parameters, hyphens, host labels, and suffix
statistics (the smoothed share of blocked URLs under the host's last label and last two labels).  The labelled URLs are split in two
folds by a hash of the URL; a labelled URL gets the statistics of the other fold, so never its own label, and one
without a label those of both.  The trees are trained on the URLs that a rule judges: a sample of about ``SAMPLE`` of them,
drawn by a hash of URL and page_id at a rate that follows from their count, is the documented bound of the training; suffix
statistics count all labelled URLs.  A suffix may hold any share of the rows (`heat.join_counted`).  Everything is DataFrame functions and Spark ML.

Defined results: null or scheme-less URLs have an empty host and path, no rule, and go to the trees; with no
labelled URL, or labels of one kind only, the trees' verdict is that kind (allow if there is none); an empty table gives an
empty table; every row gives one row; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import prepare, stored, table
from shelfmatch.llm.heat import join_counted

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
SAMPLE = 20_000
TREES, DEPTH, SEED = 8, 4, 7
#: Labelled URLs of average verdict that are added to each suffix's counts.
PRIOR = 20
FEATURES = ("length", "path_length", "depth", "digit_ratio", "entropy", "n_params", "n_hyphens", "n_labels", "suffix1", "suffix2")


def host_and_path(url: Column) -> dict[str, Column]:
    """Host (A-Z in lower case) and path; empty where the URL is null or holds no `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return {"host": F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase),
            "path": F.regexp_extract(url, pattern, 2)}


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    chars = F.filter(F.split(url, ""), lambda c: c != "")
    # a character's share of the URL, once for each place it stands at
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - (
        (n - F.length(F.replace(url, c, F.lit("")))) / n) * F.log2((n - F.length(F.replace(url, c, F.lit("")))) / n))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "length": F.length(url), "path_length": F.length(path), "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "digit_ratio": (n - F.length(F.translate(url, string.digits, ""))) / n, "entropy": entropy,
        "n_params": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "n_hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))),
        "n_labels": F.size(F.split(host, r"\.")),
    }


def _with_suffix_shares(urls: DataFrame, rate: float) -> DataFrame:
    """``urls`` with suffix1 and suffix2, the smoothed shares of blocked ones among the labelled URLs of a suffix."""
    fold = F.pmod(F.xxhash64("url", F.lit(SEED + 1)), F.lit(2))
    urls = urls.withColumn("fold", F.when(F.col("rule").isNotNull(), fold))
    for k in (1, 2):
        key, sums = f"suffix_{k}", []
        for f in (0, 1):
            mine = F.col("fold") == f
            sums += [F.count(F.when(mine, 1)).alias(f"n{f}"), F.count(F.when(mine & (F.col("verdict") == "block"), 1)).alias(f"blocked{f}")]
        counts = stored(urls.groupBy(key).agg(F.count("*").alias("n"), *sums), "suffixes")
        used = [F.when(F.coalesce(F.col("fold") != f, F.lit(True)), F.col(c + str(f))).otherwise(0) for c in ("blocked", "n") for f in (0, 1)]
        share = (used[0] + used[1] + PRIOR * rate) / (used[2] + used[3] + PRIOR)
        urls = join_counted(urls, counts, [key]).withColumn(f"suffix{k}", share).drop("n", "n0", "n1", "blocked0", "blocked1")
    return urls


def scored(pages: DataFrame, rules: dict[str, str] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, label (the rule's verdict), drawn (in the training sample), score (the trees' probability of block;
    null if the labels are of one kind, given in ``only``)."""
    prepare(pages.sparkSession)
    urls = pages.select("page_id", "url").withColumns(host_and_path(F.col("url")))
    urls = urls.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, what in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(what)).otherwise(verdict)
    urls = urls.withColumns({"verdict": verdict, "suffix_1": _suffix(F.col("host"), 1), "suffix_2": _suffix(F.col("host"), 2)})

    blocked = F.count(F.when(F.col("verdict") == "block", 1))
    total = urls.where(F.col("rule").isNotNull()).agg(F.count("*").alias("n"), blocked.alias("blocked")).first()
    kept = ["page_id", "host", "path", "rule", F.col("verdict").alias("label")]
    if total["blocked"] in (0, total["n"]):
        only = "block" if total["blocked"] else "allow"
        return urls.select(*kept, F.lit(False).alias("drawn"), F.lit(None).cast("double").alias("score"), F.lit(only).alias("only"))

    features = _with_suffix_shares(urls, total["blocked"] / total["n"]).withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
    # a rate that keeps about `sample` labelled rows, drawn by hash, so by value and not by place
    keep = min(1.0, sample / total["n"])
    chance = F.pmod(F.xxhash64("url", "page_id", F.lit(SEED)), F.lit(1 << 30)) < int(keep * (1 << 30))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features.withColumn("drawn", F.col("rule").isNotNull() & chance))
    training = stored(vectors.where("drawn").select("page_id", "features", (F.col("verdict") == "block").cast("double").alias("label"))
                      .repartition(1).sortWithinPartitions("page_id"), "url-training")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=SEED, cacheNodeIds=False).fit(training)
    from pyspark.ml.functions import vector_to_array

    return model.transform(vectors).select(*kept, "drawn", vector_to_array("probability")[1].alias("score"), F.lit(None).cast("string").alias("only"))


def judged(pages: DataFrame, rules: dict[str, str] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block; null where a rule judges)."""
    trees = F.coalesce("only", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return scored(pages, rules, sample).select("page_id", "host", "path", "rule", F.coalesce("label", trees).alias("verdict"),
                                               F.when(F.col("rule").isNull(), F.col("score")).alias("score"))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
