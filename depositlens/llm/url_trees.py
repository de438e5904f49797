"""URL filter: rules by host and path first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones. The trees see nothing that names a rule, only lexical features:
lengths, depth, share of digits, entropy of the characters, numbers of parameters and of other marks, and the share of blocked
URLs among the labelled ones with the same host suffix. The suffix statistic counts all labelled rows; the trees are fitted by
Spark on at most ``SAMPLE_ROWS`` different labelled URLs, each with the weight of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depositlens.llm.common import forget, lower_az, settle

ALLOW, BLOCK = "allow", "block"
SAMPLE_ROWS = 20_000
SAMPLE_BITS = 24
SAMPLE_CLASSES = 1 << SAMPLE_BITS
SAMPLE_SPARE = 1.2
PRIOR_ROWS = 10


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)

FEATURES = [
    "url_length", "host_length", "path_length", "query_length", "host_labels", "path_depth", "digit_ratio", "path_digits",
    "letters_ratio", "entropy", "parameters", "hyphens", "dots", "percents", "has_fragment", "is_https", "suffix_blocked",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_az(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """(rule, verdict) of the longest fitting rule, the first given of equal ones; NULL if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda rule: len(rule.host + rule.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        own = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, own).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.greatest(F.length(text), F.lit(1))
    characters = F.split(text, "")
    share = lambda c: F.size(F.filter(characters, lambda x: x == c)) / size
    bits = lambda total, c: total - share(c) * F.log2(share(c))
    return F.aggregate(F.array_distinct(F.filter(characters, lambda c: c != "")), F.lit(0.0), bits)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def with_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the lexical features but for the suffix statistic, and ``suffix``."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    columns = {
        "url_length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "query_length": F.length(query),
        "host_labels": F.size(F.split("host", r"\.")),
        "path_depth": _count(F.col("path"), "/[^/]+"),
        "digit_ratio": _count(url, "[0-9]") / size,
        "path_digits": _count(F.col("path"), "[0-9]"),
        "letters_ratio": _count(url, "[A-Za-z]") / size,
        "entropy": _entropy(url),
        "parameters": F.when(query == "", F.lit(0.0)).otherwise(_count(query, "&") + 1),
        "hyphens": _count(url, "-"),
        "dots": _count(url, r"\."),
        "percents": _count(url, "%"),
        "has_fragment": F.contains(url, F.lit("#")),
        "is_https": F.startswith(url, F.lit("https")),
    }
    features = {name: column.cast("double") for name, column in columns.items()}
    return urls.withColumns(features | {"suffix": F.substring_index("host", ".", -1)})


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(suffix, n, blocked, urls) over all labelled rows, written once: rows, blocked rows and about how many different URLs."""
    counted = with_features(labelled).groupBy("suffix").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("verdict") == BLOCK).alias("blocked"),
        F.approx_count_distinct("url").alias("urls"),
    )
    return settle(counted, "suffixes")


def bounded_sample(labelled: DataFrame, rows: int, distinct: int) -> DataFrame:
    """At most ``rows`` different labelled URLs with ``n``, how many rows each has: the first by a hash of the URL, written once.

    ``distinct`` is about how many there are; only classes of the hash that will be needed are grouped.
    """
    hashed = F.xxhash64("url")
    classes = SAMPLE_CLASSES if distinct <= rows else max(1, math.ceil(SAMPLE_CLASSES * SAMPLE_SPARE * rows / distinct))
    chosen = labelled.where(F.shiftrightunsigned(hashed, 64 - SAMPLE_BITS) < classes)
    counted = chosen.groupBy("url", "host", "path", "verdict").agg(F.count("*").cast("double").alias("n"))
    return settle(counted.orderBy(hashed, "url").limit(rows), "urls")


class UrlModel(NamedTuple):
    """Rows and blocked rows by host suffix, the blocked share over all, and the trees (None: one verdict only)."""

    suffixes: DataFrame
    prior: float
    trees: GBTClassificationModel | None


def _with_suffix_share(urls: DataFrame, suffixes: DataFrame, prior: float) -> DataFrame:
    """``suffix_blocked``: the blocked share among all labelled rows of the suffix, drawn to that of all by ten rows.

    The join carries no hint: Spark broadcasts the written table while its size is below the session's threshold.
    """
    share = ((F.col("blocked") + prior * PRIOR_ROWS) / (F.col("n") + PRIOR_ROWS)).alias("suffix_blocked")
    known = urls.join(suffixes.select("suffix", share), "suffix", "left")
    return known.withColumn("suffix_blocked", F.coalesce("suffix_blocked", F.lit(prior)))


def _vectors(urls: DataFrame, model_input: str = "lexical") -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol=model_input).transform(urls)


def train(labelled: DataFrame, rows: int = SAMPLE_ROWS, trees: int = 12, depth: int = 4) -> UrlModel:
    """Fit on ``labelled`` (url, host, path, verdict): statistics over all rows, the trees on at most ``rows`` different URLs, weighted by their rows."""
    columns = labelled.select("url", "host", "path", "verdict")
    suffixes = suffix_counts(columns)
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("urls").alias("urls")).first()
    prior = total.blocked / total.n if total.n else 0.0
    if prior in (0.0, 1.0):
        return UrlModel(suffixes, prior, None)
    sample = bounded_sample(columns, rows, total.urls)
    ready = _with_suffix_share(with_features(sample), suffixes, prior).withColumn(
        "label", (F.col("verdict") == BLOCK).cast("double")
    )
    fit = GBTClassifier(
        featuresCol="lexical", weightCol="weight", maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3, seed=7
    )
    model = fit.fit(_vectors(ready).select("lexical", "label", F.col("n").alias("weight")).repartition(4))
    forget(sample)
    return UrlModel(suffixes, prior, model)


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule (NULL if none fits), verdict and ``score`` (the trees' probability of
    blocking; NULL under a rule).

    A URL that is NULL or has no ``://`` has an empty host and path, fits no rule and is judged by the trees. If
    the labelled URLs have one verdict only it goes to all others; without any labelled URL that is ``allow``.
    Repeated rows stay rows; an empty table gives no rows. Other columns are not read.
    """
    urls = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    parsed = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = parsed.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).select(
        "id", "url", "host", "path", "fit.rule", "fit.verdict"
    )
    model = train(ruled.where("rule IS NOT NULL"), sample_rows)
    out = [F.col("id").alias(id_col), "host", "path", "rule"]
    if model.trees is None:
        forget(model.suffixes)
        score = F.when(F.col("rule").isNull(), F.lit(model.prior))
        other = F.lit(BLOCK if model.prior == 1.0 else ALLOW)
        return ruled.select(*out, F.coalesce("verdict", other).alias("verdict"), score.alias("score"))
    scored = model.trees.transform(_vectors(_with_suffix_share(with_features(ruled), model.suffixes, model.prior)))
    other = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
    probability = F.when(F.col("rule").isNull(), F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*out, F.coalesce("verdict", other).alias("verdict"), probability.alias("score"))
