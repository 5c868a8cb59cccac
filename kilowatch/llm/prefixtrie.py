"""Prefix trie of conversations by collapsing whole sequences first.

A sequence of turns is named by an exclusive-or of 128-bit hashes of (position, turn). Such a name needs no
order and no list in one place: it is an aggregate, merged before the shuffle, and the name of every prefix
is a running exclusive-or. So no task ever holds a whole conversation, however many turns it has.

1. Turns are numbered over a range exchange; a conversation that spans several ranges is put together
   from the counts of its ranges.
2. Identical conversations collapse into one weighted sequence, with the list of their ids. From here on
   only one representative of each sequence is expanded into prefixes.
3. A sequence that is a proper prefix of another is dropped by an anti-join; the rest are the leaves.
4. The weighted prefixes are aggregated to nodes. What a subtree saves needs no descent: a sequence of
   weight n with ``rem`` words from a node on adds n * rem, less the words that it is the first to hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatch.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 1024  # turns of one conversation that are accumulated in one task
KEY = ["s1", "s2", "depth"]
CHUNKS = "s1 long, s2 long, depth long, first long, ids string"
ENDS = "s1 long, s2 long, depth long, ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame) -> DataFrame:
    """Turns with their position from 1: conv_id, part, pos, digest, words.

    In order of ``turn`` (null first); turns of equal number by the MD5 of role and text, so that the order
    is defined and equal rows are interchangeable. A null role or text is empty; rows without conv_id
    belong to no conversation. Only digests travel.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = ["conv_id", "turn", "digest", "tie"]
    ordered = (
        conversations.where("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn",
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
            F.monotonically_increasing_id().alias("tie"),
        )
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    placed = stored(
        ordered.select(
            "conv_id", "digest", "words", F.spark_partition_id().alias("part"),
            F.expr("monotonically_increasing_id() & 8589934591").alias("at"),  # place inside the range
        ),
        "turns",
    )
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # A long conversation has a run in every range, so its rows do not meet in one task.
    return placed.join(runs, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "digest", "words"
    )


def rebuilt(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Turns of every rebuilt conversation, and one row of position 0 for each: conv_id, pos, words, a, b.

    Conversation c opens with the first h turns of conversation c - c % family (all if it has fewer, none
    if it is absent) and goes on with its own turns after its first h; h = crc32 of the decimal c, modulo
    ``most``. ``a`` and ``b`` are the two halves of the hash of a turn at its position.
    """
    turns = stored(numbered(conversations), "numbered")
    runs = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    own = runs.groupBy("conv_id").agg(F.sum("n").alias("own"))
    kin = (F.col("conv_id") - F.col("conv_id") % family).alias("kin")
    opens = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).alias("h")
    bases = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("kin"), F.col("own").alias("kin_own"))
    convs = own.select("conv_id", kin, opens).join(bases, "kin", "left").select(
        "conv_id", "kin", "h", F.least("h", F.coalesce("kin_own", F.lit(0))).alias("m")
    )
    heads = turns.where((F.col("pos") < most) & (F.col("conv_id") % family == 0)).select(
        F.col("conv_id").alias("kin"), "pos", "digest", "words"
    )
    shared = convs.join(heads, "kin").where("pos <= h").select("conv_id", "pos", "digest", "words")
    shifts = runs.select("conv_id", "part").join(convs, "conv_id").select("conv_id", "part", "h", "m")
    kept = turns.join(shifts, ["conv_id", "part"]).where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "words"
    )
    zero = F.lit(0).cast("long")
    root = own.select("conv_id", zero.alias("pos"), zero.alias("words"), zero.alias("a"), zero.alias("b"))
    hashed = shared.unionByName(kept).select(
        "conv_id", "pos", "words", F.xxhash64("pos", "digest").alias("a"),
        F.xxhash64("digest", F.lit(1), "pos").alias("b"),
    )
    return hashed.unionByName(root)


def _per_block(sequences: DataFrame) -> DataFrame:
    """One row per block of turns of a sequence, so that a join with its turns has no hot key."""
    last = F.floor(F.col("depth") / BLOCK)
    return sequences.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).cast("long").alias("block")


def _prefixes(turns: DataFrame, groups: DataFrame) -> DataFrame:
    """Every prefix of every sequence: its name (p1, p2), that of its parent (q1, q2), its last turn's
    words, and the words of the sequence from that turn on (rem)."""
    rows = turns.select("*", _block()).join(_per_block(groups.drop("s1", "s2")), ["conv_id", "block"])
    w = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {"x1": F.bit_xor("a").over(w), "x2": F.bit_xor("b").over(w), "sum_in": F.sum("words").over(w)}
    )
    totals = turns.select("*", _block()).join(
        _per_block(groups.where(F.col("depth") >= BLOCK).select("conv_id", "depth")), ["conv_id", "block"]
    ).groupBy("conv_id", "block").agg(
        F.bit_xor("a").alias("y1"), F.bit_xor("b").alias("y2"), F.sum("words").alias("sum_before")
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "conv_id", "block", F.bit_xor("y1").over(earlier).alias("y1"), F.bit_xor("y2").over(earlier).alias("y2"),
        F.sum("sum_before").over(earlier).alias("sum_before"),
    ).where("block > 0")
    none = F.lit(0)
    out = rows.join(carry, ["conv_id", "block"], "left").withColumns({
        "p1": F.col("x1").bitwiseXOR(F.coalesce("y1", none)), "p2": F.col("x2").bitwiseXOR(F.coalesce("y2", none)),
        "through": F.col("sum_in") + F.coalesce("sum_before", none),
    })
    return out.select(
        "conv_id", "block", "pos", "words", "p1", "p2", F.col("p1").bitwiseXOR(F.col("a")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("b")).alias("q2"), F.col("depth").alias("turns"), "n_convs",
        (F.col("total") - F.col("through") + F.col("words")).alias("rem"),
    )


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of ids of one sequence as text; rows come by sequence and id."""
    for batch in batches:
        keys = batch[KEY].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(batch)]
        ids = batch["conv_id"].tolist()
        out = batch.iloc[bounds[:-1]][KEY].reset_index(drop=True) if len(batch) else batch[KEY]
        spans = list(zip(bounds, bounds[1:])) if len(batch) else []
        yield out.assign(
            first=[ids[lo] for lo, _ in spans], ids=[",".join(map(str, ids[lo:hi])) for lo, hi in spans]
        )


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash per sequence, fed chunk by chunk; rows come by sequence and first id."""
    key, state = None, None
    for batch in batches:
        done = []
        for s1, s2, depth, ids in zip(batch["s1"], batch["s2"], batch["depth"], batch["ids"]):
            if (s1, s2, depth) != key:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (s1, s2, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
    if key:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])


def end_hashes(sequences: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of each sequence, comma-joined.

    The ids of a common sequence are joined to chunks over a range exchange first; the task that hashes
    them, in which order matters, reads chunks one after the other and holds none but the current.
    """
    order = [*KEY, "conv_id"]
    chunks = sequences.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_chunks, CHUNKS)
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInPandas(_digests, ENDS)


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over rows of conv_id, pos, words, a, b as ``rebuilt`` gives them.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turns = stored(turns, "rebuilt")
    sequences = stored(
        turns.groupBy("conv_id").agg(
            F.bit_xor("a").alias("s1"), F.bit_xor("b").alias("s2"), F.max("pos").alias("depth"),
            F.sum("words").alias("total"),
        ),
        "sequences",
    )
    groups = stored(
        sequences.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("total").alias("total")
        ),
        "groups",
    )
    prefixes = stored(_prefixes(turns, groups), "prefixes")
    proper = prefixes.where("pos < turns").select(F.col("p1").alias("s1"), F.col("p2").alias("s2"), F.col("pos").alias("depth"))
    leaves = groups.join(proper.distinct(), KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    # The words that a sequence is the first to hold: those of the nodes whose smallest member it represents.
    owned = (
        prefixes.groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.max("words").alias("words"))
        .groupBy("conv_id").agg(F.sum("words").alias("owned"))
    )
    facts = groups.select("conv_id", "depth").join(leaves, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", "depth", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("owned", F.lit(0)).alias("owned")
    )
    saved = F.col("n_convs") * F.col("rem") - F.least("owned", "rem")
    nodes = stored(
        prefixes.join(_per_block(facts).drop("depth"), ["conv_id", "block"])
        .groupBy(F.col("pos").alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2"), "q1", "q2")
        .agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("leaf").cast("long").alias("n_leaves"), F.sum(saved).alias("saved_tokens"),
        ),
        "nodes",
    )
    below = nodes.where("depth > 0").select(
        F.col("q1").alias("s1"), F.col("q2").alias("s2"), (F.col("depth") - 1).alias("depth")
    )
    children = below.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(
        F.col("s1").alias("q1"), F.col("s2").alias("q2"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(children, KEY, "left").join(end_hashes(sequences), KEY, "left")
        .join(parents, ["q1", "q2", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """The trie of all rebuilt conversations; see ``numbered``, ``rebuilt`` and ``trie``.

    ``conversations`` has conv_id, turn, role and text; other columns are not read. Repeated rows are turns
    of their own. An empty table has no node; otherwise the root has depth 0 and a null parent. Two
    different sequences would be taken for one only if 128 bits of hash agree.
    """
    return trie(rebuilt(conversations, family, most))


def oracle() -> str:
    digits = "list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: unicode(substr(conv_id::VARCHAR, i, 1))::BIGINT)"
    byte = "list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(acc, b))"
    crc = f"xor(list_reduce({digits}, lambda acc, b: {byte}, 4294967295::BIGINT), 4294967295)"
    return rf"""
WITH t AS (
  SELECT conv_id, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS turn, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(turn ORDER BY p) AS turns, {crc} % 4 AS h FROM t GROUP BY conv_id
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20
), p AS (
  SELECT conv_id, len(turns) AS len, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r
), k AS (
  SELECT conv_id, len, depth, turns[1:depth] AS pre, turns[1:depth - 1] AS above FROM p
), n AS (
  SELECT pre, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    max(len) = depth AS leaf, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
      FILTER (WHERE len = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(pre[-1].x, '[^\x20\x09-\x0D]+')) END AS words
  FROM k GROUP BY pre, depth
)
SELECT a.conv_id, a.depth, u.conv_id AS parent_conv_id, a.n_convs,
  (SELECT count(*) FROM n b WHERE b.depth = a.depth + 1 AND b.above = a.pre) AS n_children,
  s.n_leaves, s.saved_tokens, a.ends_sha256
FROM n a LEFT JOIN n u ON a.depth > 0 AND u.depth = a.depth - 1 AND u.pre = a.above
JOIN (
  SELECT x.pre, x.depth, count(*) FILTER (WHERE y.leaf) AS n_leaves,
    sum((y.n_convs - 1) * y.words)::BIGINT AS saved_tokens
  FROM n x JOIN n y ON y.depth >= x.depth AND y.pre[1:x.depth] = x.pre GROUP BY x.pre, x.depth
) s ON s.pre = a.pre AND s.depth = a.depth"""
