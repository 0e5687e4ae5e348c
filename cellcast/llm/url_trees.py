"""URL filter: host and path rules, then gradient-boosted trees on lexical features for the other URLs.

The trees learn from labelled URLs and see only what the URL itself says: lengths, depth, digit ratio,
character entropy, parameter counts and statistics of the host's suffix. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters counted one by one for the entropy; all others count as one more symbol.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
MAX_RULES = 1000
FEATURES = [
    "url_length", "host_length", "path_length", "longest_label", "depth", "labels", "hyphens", "digit_ratio",
    "entropy", "parameters", "query_length", "has_fragment", "is_https", "suffix_log_count", "suffix_block_rate",
]


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str  # with its leading slash

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query); all empty without `://`. The path and query may be empty."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def match_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, action) of the longest rule that fits, null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character over ALPHABET and one symbol for the rest; one pass of the text per symbol."""
    n = F.length(text)
    letters = F.array(*[F.lit(c) for c in ALPHABET])
    counts = F.transform(letters, lambda c: n - F.length(F.replace(text, c)))
    other = n - F.aggregate(counts, F.lit(0), lambda a, b: a + b)
    share = lambda k: k / n
    bits = F.aggregate(F.concat(counts, F.array(other)), F.lit(0.0), lambda a, k: a - F.when(k > 0, share(k) * F.log2(share(k))).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def suffix(host: Column) -> Column:
    """The host's last two labels (`example.com`), or the host if it has no dot."""
    return F.substring_index(host, ".", -2)


def lexical_features(urls: DataFrame) -> DataFrame:
    """Adds host, path, _suffix and the lexical columns of FEATURES to (key, url)."""
    host, path, query = url_parts(F.col("url"))
    df = urls.withColumns({"host": host, "path": path, "_query": query, "_url": F.coalesce("url", F.lit(""))})
    low = lower_ascii(F.col("_url"))
    count = lambda c, text: (F.length(c) - F.length(F.replace(c, F.lit(text)))).cast("double")
    digits = F.length("_url") - F.length(F.translate("_url", "0123456789", ""))
    labels = F.split("host", r"\.")
    return df.withColumns(
        {
            "url_length": F.length("_url").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "longest_label": F.aggregate(labels, F.lit(0), lambda a, x: F.greatest(a, F.length(x))).cast("double"),
            "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
            "labels": F.size(labels).cast("double"),
            "hyphens": count(F.col("host"), "-"),
            "digit_ratio": F.when(F.length("_url") > 0, digits / F.length("_url")).otherwise(0.0),
            "entropy": entropy(low),
            "parameters": F.when(F.col("_query") == "", 0.0).otherwise(count(F.col("_query"), "&") + 1),
            "query_length": F.length("_query").cast("double"),
            "has_fragment": F.contains("_url", F.lit("#")).cast("double"),
            "is_https": F.startswith(low, F.lit("https://")).cast("double"),
            "_suffix": suffix(F.col("host")),
        }
    ).drop("_query", "_url")


def suffix_statistics(df: DataFrame) -> DataFrame:
    """(_suffix, log of the number of URLs, number of blocked and of labelled ones) over all URLs.

    Counted with map-side sums, so a suffix that holds most URLs costs no more than another.
    """
    return df.groupBy("_suffix").agg(
        F.log1p(F.count(F.lit(1))).alias("suffix_log_count"), F.count_if(F.col("label") == 1.0).alias("_blocked"), F.count("label").alias("_known")
    )


def with_suffixes(df: DataFrame, stats: DataFrame) -> DataFrame:
    """`df` with its suffix's count and smoothed share of blocked URLs; a labelled row's own label is left out of the share."""
    # suffixes are never null; a hot one is left to adaptive execution, which splits its partition
    joined = df.join(stats, "_suffix", "left")
    own, mine = (F.col("label").isNotNull(), F.col("label") == 1.0) if "label" in df.columns else (F.lit(False), F.lit(False))
    number = lambda c: F.when(c, 1).otherwise(0)
    rate = (F.col("_blocked") - number(mine) + 1.0) / (F.col("_known") - number(own) + 2.0)
    return joined.withColumn("suffix_block_rate", rate).drop("_blocked", "_known")


@dataclass
class UrlModel:
    """Trees, or a constant share of blocked URLs where the labels do not have both classes."""

    trees: GBTClassificationModel | None
    constant: float

    def probability(self, df: DataFrame) -> DataFrame:
        if self.trees is None:
            return df.withColumn("block_probability", F.lit(self.constant))
        ready = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep").transform(df)
        out = self.trees.transform(ready).withColumn("block_probability", vector_to_array("probability")[1])
        return out.drop("_features", "rawPrediction", "probability", "prediction")


def fit_url_trees(labelled: DataFrame, max_rows: int = 20_000, rounds: int = 20, depth: int = 4, seed: int = 7) -> UrlModel:
    """Boosted trees on at most `max_rows` labelled rows (label 1: block), those with the smallest hash of key and URL."""
    n = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    if len(n) < 2:
        return UrlModel(None, float(next(iter(n), 0.0)))
    rows = labelled.orderBy(F.xxhash64("key", "url")).limit(max_rows)
    # both classes weigh the same: rules or labels rarely have the shares of the URLs they are meant for
    rows = rows.withColumn("_weight", F.when(F.col("label") == 1.0, total / (2.0 * n[1.0])).otherwise(total / (2.0 * n[0.0])))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep").transform(rows).select("_features", "label", "_weight")
    ready = ready.repartition(4).cache()
    try:
        if ready.select("label").distinct().count() < 2:
            return UrlModel(None, n.get(1.0, 0) / total)
        trees = GBTClassifier(
            featuresCol="_features", labelCol="label", weightCol="_weight",
            maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=seed, cacheNodeIds=False, maxMemoryInMB=64, checkpointInterval=-1,
        ).fit(ready)
    finally:
        ready.unpersist()
    return UrlModel(trees, 0.0)


def judge_urls(urls: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", labels: DataFrame | None = None, **fit) -> DataFrame:
    """(key, host, path, rule, verdict, block_probability) of every row.

    A rule's verdict stands. URLs no rule fits are blocked if the trees give 0.5 or more. The trees learn
    from `labels` (url, blocked boolean), or else from the URLs that the rules settle. Null and empty
    URLs have an empty host and path, and are judged too; repeated rows give a row each; without any
    label of a kind, the other kind is the verdict, and without any at all the verdict is allow.
    """
    rows = lexical_features(urls.select(F.col(key).alias("key"), F.col(url).alias("url")))
    rows = rows.withColumn("_hit", match_rule(F.col("host"), F.col("path"), rules))
    if labels is None:
        known = rows.withColumn("label", F.when(F.col("_hit").isNotNull(), (F.col("_hit.action") == "block").cast("double")))
        counted = known
    else:
        given = lexical_features(labels.where("blocked IS NOT NULL").select(F.col("url").alias("key"), "url", F.col("blocked").cast("double").alias("label")))
        known = given
        counted = rows.select("_suffix", F.lit(None).cast("double").alias("label")).unionByName(given.select("_suffix", "label"))
    stats = suffix_statistics(counted)
    model = fit_url_trees(with_suffixes(known.where("label IS NOT NULL"), stats), **fit)
    judged = model.probability(with_suffixes(rows, stats))
    verdict = F.coalesce("_hit.action", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow"))
    return judged.select(F.col("key").alias(key), "host", "path", F.col("_hit.rule").alias("rule"), verdict.alias("verdict"), "block_probability")
