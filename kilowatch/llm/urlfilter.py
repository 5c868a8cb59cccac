"""URL filter: path rules first, gradient-boosted trees on lexical features for the rest.

The features are length, depth, digit ratio, character entropy, number of parameters and, from the
labelled URLs, the smoothed block rate and the share of the host's suffix (its last two labels) and
of its last label. All features are DataFrame expressions; training and scoring are MLlib.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.llm.common import bounded_sample, stored

# Labelled URLs that train the trees, at most: the first in hash order. The suffix statistics come
# from these rows alone, so the tables that are broadcast have no more rows than this.
MAX_LABELLED = 20_000
FEATURES = ["f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_rate2", "f_share2", "f_rate1", "f_share1"]

Rule = tuple[str, str]  # (allow or block, host/path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null. Rules are a short list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def suffix_of(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(url: Column, path: Column) -> dict[str, Column]:
    """Features of the URL's own characters; a null URL counts as empty."""
    u = F.coalesce(url, F.lit(""))
    n = F.char_length(u)
    chars = F.array_distinct(F.split(u, ""))
    counts = F.transform(chars, lambda c: n - F.char_length(F.replace(u, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0), lambda acc, k: acc + F.when(k > 0, k * F.log2(k.cast("double"))).otherwise(0.0))
    return {
        "f_length": n.cast("double"),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "f_digits": F.when(n > 0, F.regexp_count(u, F.lit("[0-9]")) / n).otherwise(0.0),
        "f_entropy": F.when(n > 0, F.log2(n.cast("double")) - bits / n).otherwise(0.0),
        "f_params": F.regexp_count(F.regexp_extract(u, r"\?([^#]*)", 1), F.lit("[^&]+")).cast("double"),
    }


def _suffix_stats(labelled: DataFrame, labels: int, total: int, rate: float) -> DataFrame:
    return labelled.groupBy(suffix_of(F.col("host"), labels).alias(f"suffix{labels}")).agg(
        ((F.sum("label") + 4.0 * rate) / (F.count(F.lit(1)) + 4.0)).alias(f"f_rate{labels}"),
        (F.count(F.lit(1)) / total).alias(f"f_share{labels}"),
    )


def _with_suffixes(rows: DataFrame, stats: dict[int, DataFrame], rate: float) -> DataFrame:
    for k, table in stats.items():
        rows = rows.withColumn(f"suffix{k}", suffix_of(F.col("host"), k))
        rows = rows.join(F.broadcast(table), f"suffix{k}", "left").na.fill({f"f_rate{k}": rate, f"f_share{k}": 0.0})
    return rows


def judge(rows: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED, trees: int = 10, depth: int = 4, seed: int = 7) -> DataFrame:
    """``rows`` (url, host, path and any others) with ``p_block`` and ``verdict`` of the trees.

    ``labelled`` has url, host, path and label (1 block, 0 allow). Without labelled rows, or with
    one class only, there is nothing to learn: every row gets that class, or ``allow``.
    Names that start with ``f_`` or ``suffix`` must be free in ``rows``.
    """
    picked = labelled.select("url", "host", "path", F.col("label").cast("double").alias("label")).dropDuplicates()
    picked = bounded_sample(picked, max_labelled, ["url", "label"])
    picked = stored(picked.withColumns(lexical(F.col("url"), F.col("path"))), "labelled")
    total, blocked = picked.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if blocked in (0, total):
        p = float(total > 0 and blocked == total)
        return rows.withColumn("p_block", F.lit(p)).withColumn("verdict", F.lit("block" if p else "allow"))
    rate = blocked / total
    stats = {k: _suffix_stats(picked, k, total, rate) for k in (1, 2)}
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="f_vector")
    train = vectors.transform(_with_suffixes(picked, stats, rate)).select("label", "f_vector")
    model = GBTClassifier(
        labelCol="label", featuresCol="f_vector", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed,
    ).fit(train.coalesce(1))  # at most max_labelled narrow rows
    ready = _with_suffixes(rows.withColumns(lexical(F.col("url"), F.col("path"))), stats, rate)
    margin = _ensemble(model)
    scored = ready.withColumn("p_block", 1.0 / (1.0 + F.exp(-2.0 * margin)))
    return scored.select(*rows.columns, "p_block", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow").alias("verdict"))


def _ensemble(model) -> Column:
    """The fitted trees as one SQL expression: no vectors, no user function when scoring."""

    def branch(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        feature = F.col(FEATURES[split.featureIndex()])
        return F.when(feature <= float(split.threshold()), branch(node.leftChild())).otherwise(branch(node.rightChild()))

    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        margin = margin + branch(tree._call_java("rootNode")) * float(weight)
    return margin


def filter_urls(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, **options) -> DataFrame:
    """Verdict for every row of ``pages`` (page_id, url; other columns are not read).

    Columns: page_id, host, path, rule (null where none fits), verdict, p_block (null under a rule).
    URLs under a rule train the trees, unless other labelled URLs (url, label) are given. Null or
    odd URLs have empty host and path, and are judged like any other.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = rows.where("hit is not null").select(
            "url", "host", "path", (F.col("hit.verdict") == "block").cast("int").alias("label")
        )
    else:
        known = labelled.select("url", host_of(url).alias("host"), path_of(url).alias("path"), "label")
    judged = judge(rows, known, **options)
    return judged.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", "verdict").alias("verdict"),
        F.when(F.col("hit").isNull(), F.col("p_block")).alias("p_block"),
    )
