"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Row numbers 0 … N-1 follow the order of the given columns. A Feistel network over the residues of
``a * b >= N`` (``a`` and ``b`` near the square root of N) permutes them; a result of N or more is
permuted again until it falls below N (cycle walking), which keeps it a permutation of 0 … N-1.
The permuted number ``p`` gives shard ``p % shards`` and slot ``p // shards``, so shards differ by
one row at most, slots have no gap, and both can be computed from a row number alone, without the
data (``locate``), as can the row number from shard and slot (``row_number_at``).

Everything on the main path is DataFrame functions. Nothing depends on how often a text occurs:
copies are dealt like other rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.llm.common import row_shares, stored

ROUNDS = 6
# Parameters of the round function, a multiplicative mix in 31 bits: products stay below 2^63.
MASK = 0x7FFFFFFF
MULTIPLIERS = (0x2C1B3C6D, 0x297A2D39)


def sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def walk_limit(n: int) -> int:
    """Permutations that one row may need.

    Fewer than ``a`` numbers of the domain are not below n, so ``a`` steps always suffice. For
    large n a walk of k steps has probability near n^(-k/2): the limit leaves less than 2^-120.
    """
    a, _ = sides(n)
    return max(1, min(a, math.ceil(240 / math.log2(n)) if n > 2 else 2))


def round_keys(seed: int) -> list[int]:
    keys, state = [], (seed * 2654435761 + 97) & MASK
    for _ in range(ROUNDS):
        state = mix(state + 0x1234567)
        keys.append(state)
    return keys


def mix(x: int) -> int:
    x &= MASK
    for m in MULTIPLIERS:
        x = ((x ^ (x >> 15)) * m) & MASK
    return x ^ (x >> 13)


def _mix(x: Column) -> Column:
    x = x.bitwiseAND(F.lit(MASK))
    for m in MULTIPLIERS:
        x = (x.bitwiseXOR(F.shiftright(x, 15)) * F.lit(m).cast("long")).bitwiseAND(F.lit(MASK))
    return x.bitwiseXOR(F.shiftright(x, 13))


def permute_once(x: int, a: int, b: int, keys: list[int]) -> int:
    left, right = x // b, x % b
    for i, k in enumerate(keys):
        if i % 2:
            right = (right + mix(left + k)) % b
        else:
            left = (left + mix(right + k)) % a
    return left * b + right


def unpermute_once(x: int, a: int, b: int, keys: list[int]) -> int:
    left, right = x // b, x % b
    for i, k in reversed(list(enumerate(keys))):
        if i % 2:
            right = (right - mix(left + k)) % b
        else:
            left = (left - mix(right + k)) % a
    return left * b + right


def locate(row_number: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number, without the data."""
    (a, b), keys = sides(n), round_keys(seed)
    x = permute_once(row_number, a, b, keys)
    while x >= n:
        x = permute_once(x, a, b, keys)
    return x % shards, x // shards


def row_number_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Row number that stands at a slot; the inverse of ``locate``."""
    (a, b), keys = sides(n), round_keys(seed)
    x = unpermute_once(slot * shards + shard, a, b, keys)
    while x >= n:
        x = unpermute_once(x, a, b, keys)
    return x


def permuted(x: Column, n: int, seed: int) -> Column:
    """The permutation as a column. A row past the walk limit fails the job rather than go wrong."""
    (a, b), keys = sides(n), round_keys(seed)

    def once(v: Column) -> Column:
        # An array element carries the pair, so that each round is one fold step of plain numbers.
        pair = F.struct(F.floor(v / b).cast("long").alias("l"), F.pmod(v, F.lit(b).cast("long")).alias("r"))
        steps = F.array(*[F.lit(k).cast("long") for k in keys])

        def step(acc: Column, i: Column) -> Column:
            key = F.element_at(steps, i + 1)
            left = F.when(i % 2 == 0, F.pmod(acc["l"] + _mix(acc["r"] + key), F.lit(a).cast("long"))).otherwise(acc["l"])
            right = F.when(i % 2 == 1, F.pmod(acc["r"] + _mix(acc["l"] + key), F.lit(b).cast("long"))).otherwise(acc["r"])
            return F.struct(left.alias("l"), right.alias("r"))

        return F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, step,
            lambda acc: acc["l"] * F.lit(b).cast("long") + acc["r"],
        )

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(walk_limit(n))), x.cast("long"),
        lambda acc, i: F.when((i == 1) | (acc >= n), once(acc)).otherwise(acc),
    )
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit("cycle walk exceeded its limit")).cast("long")
    )


def number_rows(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Gapless global ``row_number`` from 0 in the given order, and the number of rows.

    A range exchange sorts the rows into partitions, whose sizes give the first number of each.
    Equal rows, however many, are spread over partitions by their place in the input. Send only the
    columns that are needed: all of them are shuffled and stored once.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    keys = [names[df.columns.index(c)] for c in order]
    ranged = (
        df.toDF(*names).withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
        .drop("tie").withColumn("at", F.monotonically_increasing_id())
    )
    rows = stored(ranged, "numbered").withColumn("part", F.shiftright("at", 33))
    sizes = stored(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "part-sizes")
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.join(F.broadcast(row_shares(sizes, "part", "n")), "part").select(
        *[F.col(c).alias(o) for c, o in zip(names, df.columns)],
        (F.col("before") + inside).alias("row_number"),
    )
    return numbered, n


def shard_rows(df: DataFrame, order: list[str], shards: int = 8, seed: int = 20) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot`` (these names must be free in ``df``).

    Nulls in order columns come first; equal rows are numbered in any order, which no result shows.
    An empty table gives an empty result.
    """
    rows, n = number_rows(df, order)
    p = permuted(F.col("row_number"), n, seed)
    return rows.withColumn("permuted", p).select(
        *rows.columns,
        (F.col("permuted") % shards).cast("int").alias("shard"),
        F.floor(F.col("permuted") / shards).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard, files in slot order; a shard of any size is split over many tasks."""
    block = F.floor(F.col("slot") / rows_per_file)
    (
        sharded.withColumn("_block", block).repartition("shard", "_block")
        .sortWithinPartitions("shard", "slot").drop("_block")
        .write.partitionBy("shard").mode("overwrite").parquet(path)
    )


def document_shards(docs: DataFrame, shards: int = 8, seed: int = 20) -> DataFrame:
    """Shard and slot of every document by ``doc_id``, with size and checksum of its text.

    A null text counts as empty; a null ``doc_id`` sorts first. Other columns of ``docs`` are not
    read. Law ``rows``: shard counts are at most one apart.
    """
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = shard_rows(slim, ["doc_id", "text_crc32", "size"], shards, seed)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
