"""URL filters: host and path rules, and gradient-boosted trees on lexical
features for the URLs that no rule fits.

All of it is DataFrame operations and Spark's own tree learner.  The trees
are fitted on a bounded sample of labelled URLs (``MAX_PER_LABEL`` of each
label, those with the smallest hashes); everything else reads all rows.

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no rule and is judged on its features like any other; with
URLs of one label only (or none) nothing can be learned and URLs without
a rule are allowed; repeated rows are judged alike; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

#: Host words that label a URL for training.  They are no features: the
#: trees see lengths, counts and ratios only.
SEED_WORDS = ("ads", "adult", "bets", "casino", "click", "farm", "loan", "pills", "poker", "porn", "prize", "spam",
              "track", "win")

MAX_PER_LABEL = 2000
TREES, DEPTH, SEED = 20, 4, 11

FEATURES = ("url_chars", "host_chars", "path_chars", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio",
            "host_hyphens", "host_entropy", "path_entropy", "n_params", "has_fragment", "host_vowel_ratio",
            "suffix_share")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a (rule, verdict) struct or null.
    ``rules``: a list short enough for one expression."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is asked first
        here = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fits = F.when(here, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(fits)
    return fits


def _entropy(s: Column) -> Column:
    n = F.char_length(s)

    def part(c: Column) -> Column:
        p = (n - F.char_length(F.replace(s, c, F.lit("")))) / n
        return -p * F.log2(p)

    return F.aggregate(F.transform(F.array_distinct(F.split(s, "")), lambda c: F.when(c != "", part(c)).otherwise(0.0)),
                       F.lit(0.0), lambda a, b: a + b)


def _count(s: Column, pattern: str) -> Column:
    return F.char_length(s) - F.char_length(F.regexp_replace(s, pattern, ""))


def with_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, uf_host, uf_path) with the lexical features.  The
    suffix statistics count all rows."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("uf_host"), F.col("uf_path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    ratio = lambda part, s: F.coalesce(_count(s, part) / F.nullif(F.char_length(s), F.lit(0)), F.lit(0.0))
    out = urls.withColumns({
        "url_chars": F.char_length(url), "host_chars": F.char_length(host), "path_chars": F.char_length(path),
        "host_depth": _count(host, "[.]"), "path_depth": _count(path, "/"),
        "digit_ratio": ratio("[0-9]", url), "host_digit_ratio": ratio("[0-9]", host),
        "host_hyphens": _count(host, "-"), "host_entropy": _entropy(host), "path_entropy": _entropy(path),
        "n_params": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "has_fragment": url.contains("#").cast("int"), "host_vowel_ratio": ratio("[aeiou]", host),
        "uf_suffix": F.substring_index(host, ".", -1)})
    per = urls.select(F.substring_index("uf_host", ".", -1).alias("uf_suffix")).groupBy("uf_suffix").agg(
        F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n")).collect()[0][0] or 1
    per = common.rekeyed(per, ["uf_suffix"], "s_").select("s_uf_suffix", (F.col("n") / total).alias("suffix_share"))
    return common.rekeyed(out, ["uf_suffix"], "s_").join(per, "s_uf_suffix").drop("s_uf_suffix", "uf_suffix")


def seed_label(host: Column, words: tuple[str, ...] = SEED_WORDS) -> Column:
    """1 where a part of the host is a seed word."""
    return host.rlike(r"(^|[.-])(" + "|".join(words) + r")([.-]|$)").cast("int")


def training_sample(labelled: DataFrame, per_label: int = MAX_PER_LABEL) -> DataFrame:
    """At most ``per_label`` rows of each label (1 block, 0 allow)."""
    order = F.xxhash64(F.lit(SEED), F.col("url"))
    parts = [labelled.where(F.col("uf_label") == v).orderBy(order, "url").limit(per_label) for v in (0, 1)]
    return common.written(parts[0].unionByName(parts[1]).coalesce(1), "url-train")


def fit(labelled: DataFrame, per_label: int = MAX_PER_LABEL) -> GBTClassificationModel | None:
    """Trees from rows with FEATURES and ``uf_label``; None unless both
    labels occur."""
    rows = training_sample(labelled.select("url", "uf_label", *FEATURES), per_label)
    if len(rows.select("uf_label").distinct().collect()) < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows)
    return GBTClassifier(labelCol="uf_label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH,
                         seed=SEED).fit(vectors)


def block_share(rows: DataFrame, model: GBTClassificationModel | None) -> DataFrame:
    """``rows`` with ``uf_block``, the model's share for blocking."""
    if model is None:
        return rows.withColumn("uf_block", F.lit(0.0))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows)
    return model.transform(vectors).withColumn("uf_block", vector_to_array("probability")[1])


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, block_share) per row.

    ``labelled``: (url, label) rows with label 1 for block; by default the
    URLs of ``pages`` labelled by their hosts' seed words.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("uf_host"), path_of(F.col("url")).alias("uf_path"))
    featured = with_features(rows)
    if labelled is None:
        train = featured.where(F.col("uf_host") != "").withColumn("uf_label", seed_label(F.col("uf_host")))
    else:
        train = with_features(labelled.select("url", F.col("label").cast("int").alias("uf_label"),
                                              host_of(F.col("url")).alias("uf_host"),
                                              path_of(F.col("url")).alias("uf_path")))
    judged = block_share(featured, fit(train))
    rule = fitting_rule(F.col("uf_host"), F.col("uf_path"), rules)
    model_says = F.when(F.col("uf_block") > 0.5, "block").otherwise("allow")
    return judged.select("page_id", "url", F.col("uf_host").alias("host"), F.col("uf_path").alias("path"),
                         rule["rule"].alias("rule"), F.coalesce(rule["verdict"], model_says).alias("verdict"),
                         F.col("uf_block").alias("block_share"))


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, one row per page."""
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")
