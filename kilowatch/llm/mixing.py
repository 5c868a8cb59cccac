"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree of levels (domain, language, source). Each node divides its budget
among its children by weight; a child that holds less than its share gives what it lacks back to its
siblings first. Only what a whole subtree cannot hold reaches the parent's siblings, since a child
never gets more than its subtree can hold. A leaf then takes whole epochs of its documents and, in the
order of a seeded hash, a prefix of one more epoch.

Budgets are whole numbers, so any engine gets the same ones. The leaf table has one row per source. The
documents of all prefixes are laid out in order by a range exchange and cut into buckets of neighbours
before any running total, so a leaf of any size is spread over many tasks, and so are rows of one id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatch.llm.common import free_name, matching_rows, stored
from kilowatch.llm.tokenpack import with_token_counts

BUCKET_BITS = 14  # a bucket has 2**14 documents at most
LEVELS = ("domain", "lang", "source")


def _node_weight(path: Sequence[Column], weights: Mapping[tuple, int]) -> Column:
    """Weight of a node: of its whole path, else of its last name at any place ("*", name), else 1."""
    found: Column | None = None
    for key, weight in sorted(weights.items(), key=lambda kv: (kv[0][0] != "*", len(kv[0])), reverse=True):
        if key[0] == "*":
            fits = path[-1] == key[1] if key[2] == len(path) else None
        else:
            fits = None
            if len(key) == len(path):
                fits = path[0] == key[0]
                for column, name in zip(path[1:], key[1:]):
                    fits = fits & (column == name)
        if fits is not None:
            found = F.when(fits, weight) if found is None else found.when(fits, weight)
    return F.lit(1) if found is None else found.otherwise(1)


def pour(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``share`` of each child of a node's ``budget``; children have ``cap`` and ``weight``.

    In the order of capacity per weight the first children are full; the others share the rest by
    weight, rounded down.
    """
    order = Window.partitionBy(*parent).orderBy("fullness", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*parent)
    big = "decimal(38,0)"
    df = children.withColumn("fullness", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    df = df.withColumn("fullness", F.coalesce("fullness", F.lit(float("inf"))))
    df = df.withColumn("caps", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    df = df.withColumn("weights", F.sum("weight").over(onward))
    fits = (F.col("budget") - F.col("caps")).cast(big) * F.col("weight") >= F.col("cap").cast(big) * F.col("weights")
    df = df.withColumn("full", F.min((fits & (F.col("weight") > 0)).cast("int")).over(upto) == 1)
    df = df.withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
    df = df.withColumn("left", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole), F.lit(0)))
    divided = F.expr("(cast(rest as decimal(38,0)) * weight) div cast(left as decimal(38,0))")
    share = F.when(F.col("full"), F.col("cap")).when(F.col("left") > 0, divided).otherwise(0)
    return df.withColumn("share", share.cast("long"))


def leaf_budgets(leaves: DataFrame, budget: Column | int, weights: Mapping[tuple, int], epochs: int) -> DataFrame:
    """``leaves`` (the levels, tokens) with ``budget``: tokens that the leaf is to give."""
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    root = leaves.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("cap"))
    node = root.select(F.lit(0).alias("root"), F.least(F.lit(budget).cast("long"), F.col("cap")).alias("budget"))
    keys = ["root"]
    for depth in range(1, len(LEVELS) + 1):
        path = list(LEVELS[:depth])
        children = leaves.withColumn("root", F.lit(0)).groupBy("root", *path).agg(F.sum("cap").alias("cap"))
        children = children.withColumn("weight", _node_weight([F.col(c) for c in path], weights).cast("long"))
        poured = pour(children.join(node, keys), keys, path[-1])
        keys = ["root", *path]
        node = poured.select(*keys, F.col("share").alias("budget"))
    return leaves.drop("cap").join(node.drop("root"), list(LEVELS))


def mix(
    docs: DataFrame, domain: Column, tokens: Column, weights: Mapping[tuple, int],
    percent: int = 60, budget: int | None = None, epochs: int = 2, seed: int = 11, also: Sequence[str] = (),
) -> DataFrame:
    """The documents to train on: doc_id, domain, lang, source, epoch, n_tokens; one row per use.

    ``docs`` has doc_id, lang, source and what ``domain`` and ``tokens`` read; other columns are not
    read. The budget is ``budget`` tokens or ``percent`` of all. ``weights`` map paths, such as
    ("web",) or ("web", "en"), or any node of a name at a level, ("*", "en", 2), to whole numbers;
    nodes that are not named weigh 1. No document is used more than ``epochs`` times. Within a leaf
    the document that crosses the budget is still taken, as documents are not cut.

    A null name of a level counts as the empty name and a null token count as 0; documents without
    tokens come with whole epochs and wherever they stand before the end of a prefix. Rows of one
    doc_id follow each other in an epoch; equal rows are interchangeable. Columns named in ``also``
    are returned too.
    """
    rows = docs.select(
        "doc_id", *also, domain.alias("domain"), "lang", "source", F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens")
    ).na.fill("", list(LEVELS))
    rows = stored(rows, "sized")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    leaves = stored(leaves, "leaves")
    if budget is None:
        total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        budget = total * percent // 100
    plan = leaf_budgets(leaves, budget, weights, epochs)
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("int"))
    plan = plan.withColumn("prefix", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = stored(plan, "mixing-plan")
    planned = rows.join(plan.select(*LEVELS, "whole", "prefix"), list(LEVELS))
    columns = ["doc_id", *LEVELS, "epoch", "n_tokens", *also]
    entire = planned.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    part = planned.where("prefix > 0").withColumns({"order": order, "tie": F.monotonically_increasing_id()})
    place = [*LEVELS, "order", "doc_id", "n_tokens", *also, "tie"]
    part = part.repartitionByRange(*place).sortWithinPartitions(*place).drop("order", "tie")
    part = part.withColumn("place", F.monotonically_increasing_id())
    part = stored(part.withColumn("bucket", F.shiftright("place", BUCKET_BITS)), "prefix-rows")
    keys = [*LEVELS, "bucket"]
    sums = part.groupBy(*keys).agg(F.sum("n_tokens").alias("sum"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, F.coalesce(F.sum("sum").over(running), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begun = part.join(starts, keys).where("start < prefix")
    begun = begun.withColumn("at", F.col("start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    taken = begun.where("at < prefix").withColumn("epoch", F.col("whole"))
    return entire.select(columns).union(taken.select(columns))


def mixed_rows(
    docs: DataFrame, domain: Column, tokens: Column | str, weights: Mapping[tuple, int], **options
) -> DataFrame:
    """The rows of ``docs``, all columns, that one epoch at most takes.

    ``tokens`` is an expression, or the file of a tokenizer, with which whole texts are then counted
    once. Rows are numbered and stored first, so that each follows the decision for itself, also where
    ids are null or repeated.
    """
    number, size = free_name(docs, "mixing_row"), free_name(docs, "mixing_tokens")
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    if isinstance(tokens, str):
        numbered, tokens = with_token_counts(numbered, tokens, size), F.col(size)
    rows = stored(numbered, "numbered")
    chosen = mix(rows, domain, tokens, weights, epochs=1, also=[number], **options)
    return matching_rows(rows, number, stored(chosen.select(number), "mixed")).select(*docs.columns)


# Parameters of the registered query and the pipeline.
DOMAINS = {
    "web": [f"src{i}" for i in range(0, 7)], "reference": [f"src{i}" for i in range(7, 14)],
    "forum": [f"src{i}" for i in range(14, 20)],
}
WEIGHTS = {
    ("web",): 5, ("reference",): 3, ("forum",): 2, ("other",): 1,
    ("*", "en", 2): 5, ("*", "de", 2): 2, ("*", "fr", 2): 2, ("web", "es"): 3,
    ("web", "en", "src0"): 3, ("reference", "en", "src7"): 2,
}


def domain_of(source: Column) -> Column:
    found = F.lit("other")
    for name, sources in DOMAINS.items():
        found = F.when(source.isin(sources), name).otherwise(found)
    return found


def estimated_tokens(text: Column) -> Column:
    """A quarter of the UTF-8 bytes, rounded up."""
    return F.ceil(F.octet_length(text) / 4)


def oracle(epochs: int = 2, percent: int = 60, seed: int = 11) -> str:
    def case(items, other: str) -> str:
        return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in items) + f" ELSE {other} END"

    domain = case([(f"source IN ({', '.join(repr(s) for s in names)})", repr(d)) for d, names in DOMAINS.items()], "'other'")

    def weight(depth: int) -> str:
        exact = [(" AND ".join(f"{c} = {n!r}" for c, n in zip(LEVELS, k)), w) for k, w in WEIGHTS.items() if k[0] != "*" and len(k) == depth]
        named = [(f"{LEVELS[depth - 1]} = {k[1]!r}", w) for k, w in WEIGHTS.items() if k[0] == "*" and k[2] == depth]
        return case(exact + named, "1")

    ctes = [f"""s AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  coalesce((octet_length(encode(text)) + 3) // 4, 0)::BIGINT AS n_tokens FROM documents)""",
        "leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM s GROUP BY ALL)",
        f"n0 AS (SELECT 0 AS root, least(sum(tokens) * {percent} // 100, sum(tokens) * {epochs})::HUGEINT AS budget FROM leaves)"]
    keys = ["root"]
    for depth in range(1, len(LEVELS) + 1):
        path = ", ".join(LEVELS[:depth])
        by = ", ".join(keys)
        ctes.append(f"""c{depth} AS (SELECT *, cap / weight::DOUBLE AS fullness FROM (
  SELECT 0 AS root, {path}, (sum(tokens) * {epochs})::HUGEINT AS cap, ({weight(depth)})::HUGEINT AS weight
  FROM leaves GROUP BY {path}) JOIN n{depth - 1} USING ({by})),
a{depth} AS (SELECT *,
  (budget - coalesce(sum(cap) OVER (PARTITION BY {by} ORDER BY fullness, {LEVELS[depth - 1]}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
  >= cap * sum(weight) OVER (PARTITION BY {by} ORDER BY fullness, {LEVELS[depth - 1]}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fits FROM c{depth}),
b{depth} AS (SELECT *, bool_and(fits) OVER (PARTITION BY {by} ORDER BY fullness, {LEVELS[depth - 1]}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM a{depth}),
n{depth} AS (SELECT root, {path}, CASE WHEN filled THEN cap ELSE
  (budget - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY {by}), 0)) * weight
  // (sum(weight) FILTER (NOT filled) OVER (PARTITION BY {by}))::HUGEINT END::HUGEINT AS budget FROM b{depth})""")
        keys.append(LEVELS[depth - 1])
    levels = ", ".join(LEVELS)
    ctes.append(f"""plan AS (SELECT {levels}, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
  budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS prefix FROM leaves JOIN n3 USING ({levels})),
p AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY {levels}
    ORDER BY md5('{seed}|' || whole::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM s JOIN plan USING ({levels}))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, {levels}, e.epoch::INTEGER AS epoch, n_tokens FROM p, range(0, {epochs}) e(epoch) WHERE e.epoch < whole
UNION ALL SELECT doc_id, {levels}, whole::INTEGER AS epoch, n_tokens FROM p WHERE start < prefix"""
