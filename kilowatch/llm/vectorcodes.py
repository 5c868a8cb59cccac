"""Vector codes: each part of a vector by the number of its nearest codebook entry.

Codebooks are refined by Lloyd rounds with the adaptive bounds of Drake and Hamerly. For each part of each
vector the state keeps an upper bound of the distance to its own entry, the ``b`` next closest entries
with lower bounds in ascending order, and one outer bound for all others. When the entries have moved,
the bounds follow; where the upper bound is below the first lower bound the assignment stands unread.
Otherwise only the entries in front of the first lower bound above it are compared, and all of them only
if the outer bound fails. The bounds are float32 and kept on the safe side; whatever they leave open is
decided on exact integers, ties to the lower index. ``b`` is adapted after every round to what it needed.

State is stored between rounds, in tiles of some thousand vectors: a round is one pass over the tiles,
without a shuffle, and a lost executor costs its tiles of one round. The sums that move the codebook are
exact integers, kept with each tile and added by Spark. The driver holds the codebook and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilowatch.llm.common import BROADCAST_IDS, stored

TILE_ROWS = 4096  # vectors of a tile
CHUNK_ROWS = 512  # vectors whose distances to all entries are in memory at once
LIMIT = 1 << 26  # components beyond it are held there: products and sums stay exact in 64 bits
STATE = "matrix binary, code binary, upper binary, near binary, lower binary, b int, sums array<long>, needed array<long>"


def valid(column: str) -> F.Column:
    """Neither null nor with a null, NaN or infinite component."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad


def first_entries(vectors: DataFrame, parts: int, entries: int, scale: float) -> np.ndarray | None:
    """Integer codebooks (part, entry, position) of the rows of smallest vec_id, or None without any row.

    At most ``entries`` rows come to the driver. Rows of equal vec_id follow their components; rows
    without vec_id come last.
    """
    rows = (
        vectors.where(valid("embedding") & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
        .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    )
    if not rows:
        return None
    dim = len(rows[0]["embedding"])
    own = np.array([r["embedding"] for r in rows if len(r["embedding"]) == dim])
    return integers(own, scale).reshape(len(own), parts, dim // parts).transpose(1, 0, 2).copy()


def integers(m: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(np.floor(scale * m), -LIMIT, LIMIT).astype(np.int64)


# --- distances and bounds of one part ---------------------------------------------------------


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to all entries."""
    d = (x * x).sum(1)[:, None] + (book * book).sum(1)[None, :]
    if max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0))) ** 2 * x.shape[1] < 2**50:
        return d - 2 * (x.astype(np.float64) @ book.T.astype(np.float64)).astype(np.int64)
    return d - 2 * (x @ book.T)


def _above(d: np.ndarray) -> np.ndarray:
    return np.nextafter(d.astype(np.float32), np.float32(np.inf))


def _below(d: np.ndarray) -> np.ndarray:
    return np.nextafter(d.astype(np.float32), np.float32(-np.inf))


class PartState:
    """Assignments and bounds of one part of the vectors of a tile."""

    def __init__(self, code: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray):
        self.code, self.upper, self.near, self.lower = code, upper, near, lower

    @classmethod
    def empty(cls, n: int, b: int) -> PartState:
        return cls(np.zeros(n, np.uint8), np.zeros(n, np.float32), np.zeros((n, b), np.uint8), np.zeros((n, b + 1), np.float32))

    def compare_all(self, x: np.ndarray, book: np.ndarray, at: np.ndarray) -> None:
        """Exact assignment and fresh bounds of the vectors ``at``."""
        b, k = self.near.shape[1], len(book)
        for lo in range(0, len(at), CHUNK_ROWS):
            some = at[lo : lo + CHUNK_ROWS]
            d = squared(x[some], book)
            order = np.argsort(d, axis=1, kind="stable")[:, : b + 2]  # of equal distances the lower index first
            found = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
            self.code[some], self.upper[some] = order[:, 0], _above(found[:, 0])
            have = min(b, k - 1)
            self.near[some[:, None], np.arange(have)] = order[:, 1 : 1 + have]
            self.lower[some] = np.inf  # where there is no such entry
            ends = min(b + 1, k - 1)
            self.lower[some[:, None], np.arange(ends)] = _below(found[:, 1 : 1 + ends])

    def follow(self, moved: np.ndarray) -> None:
        """Bounds after the entries have moved by at most ``moved``; lower bounds are ordered anew."""
        self.upper = _above(self.upper.astype(np.float64) + moved[self.code])
        steps = np.concatenate([moved[self.near], np.full((len(self.code), 1), moved.max(initial=0.0))], axis=1)
        lower = _below(self.lower.astype(np.float64) - steps)
        self.lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1].copy()

    def assign(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Nearest entries under the bounds. Returns how many vectors needed 0, 1, ... listed entries, or all."""
        b = self.near.shape[1]
        needed = np.zeros(b + 2, np.int64)
        open_ = np.flatnonzero(self.upper >= self.lower[:, 0])
        needed[0] = len(x) - len(open_)
        if not len(open_):
            return needed
        own = ((x[open_] - book[self.code[open_]]) ** 2).sum(1)
        self.upper[open_] = _above(np.sqrt(own.astype(np.float64)))
        z = (self.lower[open_] <= self.upper[open_][:, None]).sum(1)  # ordered, so these stand in front
        needed += np.bincount(z, minlength=b + 2)
        listed = (z > 0) & (z <= b)
        at, most = open_[listed], int(z[listed].max(initial=0))
        if len(at):
            self._compare_listed(x, book, at, own[listed], z[listed], most)
        self.compare_all(x, book, open_[z == b + 1])
        return needed

    def _compare_listed(self, x, book, at, own, z, most) -> None:
        """The first ``z`` listed entries against the own one, exactly; the later ones keep their bounds."""
        rows = np.arange(len(at))[:, None]
        cand = np.concatenate([self.code[at][:, None], self.near[at, :most]], axis=1).astype(np.int64)
        d = ((x[at][:, None, :] - book[cand]) ** 2).sum(2)
        d[:, 0] = own
        unread = np.arange(most + 1)[None, :] > z[:, None]
        # By distance, then index; unread entries stay behind in their order.
        order = np.lexsort((np.where(unread, np.arange(most + 1)[None, :], cand), np.where(unread, np.int64(2**62), d)), axis=1)
        cand, d, unread = cand[rows, order], d[rows, order], unread[rows, order]
        dist = np.sqrt(d.astype(np.float64))
        self.code[at], self.upper[at] = cand[:, 0], _above(dist[:, 0])
        kept = self.lower[at, :most]
        self.near[at, :most] = cand[:, 1:]
        fresh = np.where(unread[:, 1:], kept, _below(dist[:, 1:]))
        bounds = np.concatenate([fresh, self.lower[at, most:]], axis=1)
        self.lower[at] = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]

    def narrow(self, b: int) -> None:
        """Keep ``b`` listed entries; the next bound becomes the outer one."""
        if b < self.near.shape[1]:
            self.near, self.lower = self.near[:, :b].copy(), self.lower[:, : b + 1].copy()


# --- tiles -------------------------------------------------------------------------------------


def _arrow(fields: list[T.StructField]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(fields))


def _pack(x: np.ndarray, states: list[PartState], books: np.ndarray, needed: np.ndarray) -> dict:
    parts, k, width = books.shape
    cut = x.reshape(len(x), parts, width)
    codes = np.stack([s.code for s in states], axis=1) if len(states) else np.zeros((len(x), 0), np.uint8)
    place = codes.astype(np.int64) + np.arange(parts) * k
    counts = np.bincount(place.ravel(), minlength=parts * k)
    # Sums of a tile are below 2**53, so doubles hold them exactly.
    sums = np.stack([np.bincount(place.ravel(), cut[:, :, j].ravel(), parts * k) for j in range(width)], axis=1)
    small = np.abs(x).max(initial=0) < 2**15
    return {
        "matrix": x.astype("<i2" if small else "<i4").tobytes(), "code": codes.tobytes(),
        "upper": np.stack([s.upper for s in states]).tobytes(), "near": np.stack([s.near for s in states]).tobytes(),
        "lower": np.stack([s.lower for s in states]).tobytes(), "b": states[0].near.shape[1],
        "sums": np.concatenate([counts, sums.astype(np.int64).ravel()]).tolist(), "needed": needed.tolist(),
    }


def _unpack(row: dict, n: int, books: np.ndarray) -> tuple[np.ndarray, list[PartState]]:
    parts, _, width = books.shape
    wide = len(row["matrix"]) == 4 * n * parts * width
    x = np.frombuffer(row["matrix"], "<i4" if wide else "<i2").astype(np.int64).reshape(n, parts * width)
    b = row["b"]
    code = np.frombuffer(row["code"], np.uint8).reshape(n, parts).T
    upper = np.frombuffer(row["upper"], np.float32).reshape(parts, n)
    near = np.frombuffer(row["near"], np.uint8).reshape(parts, n, b)
    lower = np.frombuffer(row["lower"], np.float32).reshape(parts, n, b + 1)
    return x, [PartState(code[p].copy(), upper[p].copy(), near[p].copy(), lower[p].copy()) for p in range(parts)]


def _first_tiles(batches: Iterator[pa.RecordBatch], books: np.ndarray, scale: float, b: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tiles of the vectors as they come, assigned to the first codebooks by full comparison."""
    parts, _, width = books.shape
    dim, held, size = parts * width, [], 0

    def tile() -> pa.RecordBatch:
        x = np.concatenate([m for _, m in held])
        rest = pa.Table.from_batches([r for r, _ in held])
        states = [PartState.empty(len(x), b) for _ in range(parts)]
        for p, state in enumerate(states):
            state.compare_all(x[:, p * width : (p + 1) * width], books[p], np.arange(len(x)))
        row = _pack(x, states, books, np.zeros(0, np.int64))
        row |= {name: rest.column(name).to_pylist() for name in rest.column_names}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        v = batch.column("embedding")
        lengths = np.asarray(v.value_lengths().fill_null(-1))
        values = np.asarray(v.flatten().fill_null(float("nan")))  # a null component is as bad as a NaN
        starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
        rows = np.flatnonzero(lengths == dim)
        m = values[starts[rows][:, None] + np.arange(dim)] if len(rows) else np.zeros((0, dim))
        fine = np.isfinite(m).all(axis=1)
        rows, m = rows[fine], integers(m[fine], scale)
        rest = batch.drop_columns(["embedding"]).take(pa.array(rows))
        for lo in range(0, len(rows), TILE_ROWS):
            if size + len(m[lo : lo + TILE_ROWS]) > TILE_ROWS:
                yield tile()
                held, size = [], 0
            held.append((rest.slice(lo, TILE_ROWS), m[lo : lo + TILE_ROWS]))
            size += len(held[-1][1])
    if size:
        yield tile()


def _next_tiles(batches: Iterator[pa.RecordBatch], books: np.ndarray, moved: np.ndarray, b: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for batch in batches:
        for row in batch.to_pylist():
            x, states = _unpack(row, len(row["vec_id"]), books)
            needed = np.zeros(b + 2, np.int64)
            for p, state in enumerate(states):
                state.narrow(b)
                state.follow(moved[p])
                needed += state.assign(x[:, p * width : (p + 1) * width], books[p])
            row |= _pack(x, states, books, needed)
            yield pa.RecordBatch.from_pylist([row], schema=schema)


def _codes(batches: Iterator[pa.RecordBatch], books: np.ndarray, names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per vector: its code and the squared error over all parts."""
    parts, _, width = books.shape
    for batch in batches:
        for row in batch.to_pylist():
            x, states = _unpack(row, len(row["vec_id"]), books)
            codes = np.stack([s.code for s in states], axis=1)
            gap = x.reshape(len(x), parts, width) - books[np.arange(parts)[None, :], codes]
            hexed = codes.tobytes().hex()
            text = [hexed[i : i + 2 * parts] for i in range(0, len(hexed), 2 * parts)]
            columns = {name: row[name] for name in names} | {"code": text, "error": (gap**2).sum(axis=(1, 2)).tolist()}
            yield pa.RecordBatch.from_pydict(columns, schema=schema)


# --- public ------------------------------------------------------------------------------------


def refined(books: np.ndarray, tiles: DataFrame) -> np.ndarray:
    """Each entry as the floor of the mean of its parts; unused entries stay. Sums come as one row per
    number of the codebook."""
    rows = tiles.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value")).collect()
    parts, k, width = books.shape
    flat = np.zeros(parts * k * (1 + width), np.int64)
    for at, value in rows:
        flat[at] = value
    counts, sums = flat[: parts * k].reshape(parts, k, 1), flat[parts * k :].reshape(parts, k, width)
    return np.where(counts > 0, sums // np.maximum(counts, 1), books)


def adapted(b: int, tiles: DataFrame, spare: float = 0.02) -> int:
    """The fewest listed entries with which at most a share ``spare`` more of the parts had needed all."""
    needed = [0] * (b + 2)
    for at, value in tiles.select(F.posexplode("needed").alias("at", "value")).groupBy("at").agg(F.sum("value")).collect():
        needed[at] = value
    listed, over = sum(needed), 0
    while b > 1 and over + needed[b] <= spare * listed:
        over += needed[b]
        b -= 1
    return b


def encode(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0,
    b: int | None = None,
) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all vectors, and the codebooks (part, entry, position), None if there are no vectors.

    ``vectors`` has vec_id, embedding and, if wanted, label. Columns: vec_id, label, code (two hex digits
    a part), error. Components become floor(scale * x). The codebooks start as the ``entries`` vectors
    of smallest vec_id (at most 256; all vectors if there are fewer) and are refined ``rounds`` times.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do those whose
    length differs from that of the smallest valid vec_id or cannot be cut into equal parts. Rows without
    vec_id are encoded; they open a codebook only after all others. Repeated rows each count. Components
    beyond 2**26 in size after scaling are held there.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    names = [c for c in ("vec_id", "label") if c in vectors.columns]
    vectors = vectors.select(*[F.col("vec_id").cast("long").alias("vec_id") if c == "vec_id" else c for c in names],
                             F.col("embedding").cast("array<double>").alias("embedding"))
    fields = [vectors.schema[c] for c in names]
    out = [*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    books = first_entries(vectors, parts, entries, scale)
    if books is None:
        return spark.createDataFrame([], T.StructType(out)), None
    lists = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in fields]
    state = T.StructType([*lists, *T._parse_datatype_string(STATE).fields])
    arrow_state, arrow_out = _arrow(state.fields), _arrow(out)
    b = max(1, min(b or books.shape[1] // 8, books.shape[1]))
    first = books
    tiles = stored(vectors.mapInArrow(lambda it: _first_tiles(it, first, scale, b, arrow_state), state), "codes-0")
    for turn in range(1, rounds + 1):
        before, books = books, refined(books, tiles)
        moved = np.sqrt(((books - before) ** 2).sum(axis=2).astype(np.float64))
        fewer = b if turn == 1 else adapted(b, tiles)
        tiles = stored(_moved(tiles, books, moved, fewer, arrow_state, state), f"codes-{turn}")
        b = fewer
    final = books
    return tiles.mapInArrow(lambda it: _codes(it, final, names, arrow_out), T.StructType(out)), books


def _moved(tiles: DataFrame, books: np.ndarray, moved: np.ndarray, b: int, arrow: pa.Schema, state: T.StructType) -> DataFrame:
    return tiles.mapInArrow(lambda it: _next_tiles(it, books, moved, b, arrow), state)


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, decimal and comma-joined, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error (error over equal labels, nulls together), codebooks_sha256."""
    codes, books = encode(vectors, **settings)
    digest = "" if books is None else codebook_digest(books)
    codes = stored(codes, "vector-codes")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    # Few labels travel to the rows; many are met by a shuffle, where hot ones are split at run time.
    few = sums.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    met = codes.join(F.broadcast(sums) if few else sums, codes["label"].eqNullSafe(sums["of"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Full comparison in SQL, one pair of tables per round."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x, len(embedding) // {parts} AS w
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT r, vec_id, label, p, x[p * w + 1:(p + 1) * w] AS x FROM v, range({parts}) t(p)
), c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM s WHERE r <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, label, p, x, d.e, d.d FROM (
    SELECT s.r, s.vec_id, s.label, s.p, s.x, min(struct_pack(
      d := list_sum(list_transform(list_zip(s.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := c.e)) AS d
    FROM s JOIN c{i} c ON c.p = s.p GROUP BY ALL))""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT p, e, list(m ORDER BY j) AS x FROM (
    SELECT p, e, j, floor(sum(x[j])::DOUBLE / count(*))::BIGINT AS m
    FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS j FROM a{i}) GROUP BY p, e, j) GROUP BY p, e
), c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.p = c.p AND m.e = c.e)""")
    last = f"""
f AS (
  SELECT r, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY r, vec_id, label
), h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM f, h"""
    return "WITH" + ",".join([*steps, last])
