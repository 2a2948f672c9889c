"""URL filters: host rules, and gradient-boosted trees on lexical features for what no rule covers.

All of it is DataFrame functions and Spark ML, which runs in the JVM: no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, pick, spread_join, table

#: The contract's rules.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Suffixes (a short text and three numbers each) that are broadcast at most.
MAX_BROADCAST = 100_000
_ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case; empty for null or without "://"."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *_ASCII)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits: its host is the host or a parent of it, its path a prefix."""
    fits = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        ok = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        fits = F.when(ok, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(fits)
    return fits


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers of a URL that need nothing but its text."""
    n = F.length(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda acc, c: acc - F.when((c != "") & (share(c) > 0), share(c) * F.log2(share(c))).otherwise(0.0))
    suffix = F.substring_index(host, ".", -1)
    return {
        "f_length": n.cast("double"), "f_host_length": F.length(host).cast("double"), "f_path_length": F.length(path).cast("double"), "f_depth": count(path, r"/[^/]"), "f_labels": count(host, r"\."),
        "f_digits": F.when(n > 0, count(url, "[0-9]") / n).otherwise(0.0), "f_host_digits": count(host, "[0-9]"), "f_hyphens": count(host, "-"), "f_entropy": F.coalesce(entropy, F.lit(0.0)), "f_parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "f_fragment": url.contains("#").cast("double"), "f_secure": url.startswith("https:").cast("double"), "f_page": path.rlike(r"\.[A-Za-z0-9]+$").cast("double"), "f_suffix_length": F.length(suffix).cast("double"),
    }


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labels: DataFrame | None = None, max_training: int = 50_000, trees: int = 10, depth: int = 4, seed: int = 7) -> DataFrame:
    """A row per row of pages (page_id, url): page_id, host, path, rule, verdict, block_probability.

    A rule's verdict stands.  For other URLs boosted trees judge, trained on labelled URLs: `labels` (url, verdict)
    if given, else the URLs that a rule decides.  Training takes the max_training labelled URLs with the smallest
    hashes, a bound of the classifier only; the suffix statistics it uses (how many of all pages a host suffix has
    and their mean path depth) are counted over all pages.  If the labels have one class or none, the more common
    one ("allow" without labels) is the verdict.

    Null URLs and URLs without "://" have empty host and path and no rule, and get the trees' verdict; repeated rows
    give a row each; an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col("url"), F.lit(""))

    def described(df: DataFrame) -> DataFrame:
        df = df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        df = df.withColumns({"fit": rule_for(F.col("host"), F.col("path"), rules), "suffix": F.substring_index("host", ".", -1)})
        return df.withColumns(lexical_features(url, F.col("host"), F.col("path")))

    rows = described(pick(pages, page_id="long", url="string"))
    stats = kept(rows.groupBy("suffix").agg(F.count("*").alias("pages"), F.log1p(F.count("*")).alias("f_suffix_pages"), F.avg("f_depth").alias("f_suffix_depth")))
    few = stats.count() <= MAX_BROADCAST
    known = described(pick(labels, url="string", verdict="string")).withColumn("known", F.col("verdict")) if labels is not None else rows.withColumn("known", F.col("fit.verdict"))
    known = known.where(F.col("known").isin("allow", "block"))
    # whether a label says block or allow must not come from the rule's own words only, so hosts' names are no feature
    inputs = [*(c for c in rows.columns if c.startswith("f_")), "f_suffix_pages", "f_suffix_depth"]
    some = known.withColumn("h", F.xxhash64("url", F.lit(seed))).orderBy("h", "url").limit(max_training)
    learn = some.join(F.broadcast(stats) if few else stats, "suffix", "left").na.fill(0.0, inputs).select(*inputs, (F.col("known") == "block").cast("double").alias("label"))
    vectors = VectorAssembler(inputCols=inputs, outputCol="features")
    learn = vectors.transform(learn).select("features", "label").persist()
    classes = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    if len(classes) == 2:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.3).fit(learn)
        model.setRawPredictionCol("raw").setProbabilityCol("probability").setPredictionCol("predicted")
        # every row's suffix is counted; a suffix can have most of the rows, so they are not dealt by it
        counted = rows.join(F.broadcast(stats), "suffix") if few else spread_join(rows, stats, "suffix", "pages", "url", "page_id")
        judged = model.transform(vectors.transform(counted)).withColumn("block_probability", vector_to_array("probability")[1])
    else:
        judged = rows.withColumn("block_probability", F.lit(float(next(iter(classes), 0.0))))
    learn.unpersist()
    verdict = F.coalesce("fit.verdict", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "block_probability")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
