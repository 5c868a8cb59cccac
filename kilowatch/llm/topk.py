"""Exact top-k inner-product search by tiled matrix products.

Vectors are packed into tiles (ids and one matrix of small integers) where they are read, without a
shuffle, and stored once. The queries are picked out of the tiles into query tiles and dealt over
parts. Every part of the queries meets every run of tiles in one task, which reads both where they
lie: nothing is copied once per block of queries. The product of two tiles is computed block by
block and compared at once with the k-th best score that each query has so far, so a task keeps k
candidates of each of its queries. The runs are so few that one merge takes all lists of a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilowatch.llm.common import stored, tidy

TILE_ROWS = 4096  # candidates of a tile: 0.5 MB at 64 dimensions
QUERY_ROWS = 4096  # queries of a tile
TILE_VALUES = 2**18  # components of a tile: fewer rows if vectors are long
PART_ROWS = 32768  # queries of a task
LIST_ROWS = 2**20  # candidates that a task keeps for its queries
PAIRS = 2**29  # pairs of a task, about, unless there are FAN runs already
FAN = 32  # lists of a query that one merge takes
BLOCK = (256, 1024)  # queries and candidates of one product: 1 MB
GROUP_TILES = 16  # tiles of a Parquet row group, which is read at once
BATCH_BYTES = 2**23  # of tiles that are sent to Python at once
TILE = "rids binary, ids binary, matrix binary, dim int, n int, largest double, queries int"
TILE_ARROW = pa.schema([
    ("rids", pa.binary()), ("ids", pa.binary()), ("matrix", pa.binary()), ("dim", pa.int32()),
    ("n", pa.int32()), ("largest", pa.float64()), ("queries", pa.int32()),
])
LIST = "rid long, query_id long, vec_id long, score long"


def _pack(rids, ids, matrix: np.ndarray, every: int) -> dict:
    rids, ids = np.asarray(rids, "<i8"), np.asarray(ids, "<i8")
    order = np.lexsort((rids, ids))
    largest = float(np.abs(matrix).max(initial=0.0))
    return {
        "rids": rids[order].tobytes(), "ids": ids[order].tobytes(),
        "matrix": np.ascontiguousarray(matrix[order], _kind(largest)).tobytes(), "dim": matrix.shape[1],
        "n": len(ids), "largest": largest, "queries": int((ids % every == 0).sum()),
    }


def _kind(largest: float) -> str:
    """How the components of a tile are stored."""
    return "<i2" if largest < 2**15 else "<f8"


def _unpack(t: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(t["ids"], "<i8")
    matrix = np.frombuffer(t["matrix"], _kind(t["largest"])).reshape(len(ids), t["dim"])
    return np.frombuffer(t["rids"], "<i8"), ids, matrix


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the batches; binaries are not copied."""
    for batch in batches:
        columns = [(name, batch.column(name)) for name in batch.schema.names]
        for i in range(batch.num_rows):
            yield {
                name: c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for name, c in columns
            }


class _Packer:
    """Rows as they come, one run per vector length, given back as tiles of at most ``most`` rows."""

    def __init__(self, most: int, every: int):
        self.most, self.every = most, every
        self.held: dict[int, list] = {}

    def add(self, rids, ids, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
        dim = matrix.shape[1]
        self.held.setdefault(dim, []).append((rids, ids, matrix))
        most = max(1, min(self.most, TILE_VALUES // max(dim, 1)))
        if sum(len(x[1]) for x in self.held[dim]) >= most:
            rids, ids, matrix = self._joined(dim)
            full = len(ids) - len(ids) % most
            for s in range(0, full, most):
                yield self._tile(rids[s : s + most], ids[s : s + most], matrix[s : s + most])
            if full < len(ids):
                self.held[dim] = [(rids[full:], ids[full:], matrix[full:])]

    def rest(self) -> Iterator[pa.RecordBatch]:
        for dim in list(self.held):
            yield self._tile(*self._joined(dim))

    def _joined(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rids, ids, matrix = zip(*self.held.pop(dim))
        return np.concatenate(rids), np.concatenate(ids), np.vstack(matrix)

    def _tile(self, rids, ids, matrix) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([_pack(rids, ids, matrix, self.every)], TILE_ARROW)


def tiles_of(batches: Iterator[pa.RecordBatch], scale: float, every: int) -> Iterator[pa.RecordBatch]:
    """Tiles of the rows as they come, one run per vector length; invalid vectors are left out."""
    packer = _Packer(TILE_ROWS, every)
    for batch in batches:
        rids, ids, vectors = (batch.column(c) for c in ("rid", "vec_id", "embedding"))
        there = vectors.is_valid().to_numpy(zero_copy_only=False)
        rids, ids = rids.to_numpy()[there], ids.to_numpy()[there]
        lengths = pc.list_value_length(vectors.filter(pa.array(there))).to_numpy()
        # A null component becomes NaN.
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == dim)
            if len(own) == len(lengths):
                x = flat.reshape(len(own), dim)
            else:
                x = flat[starts[own][:, None] + np.arange(dim)]
            ok = np.isfinite(x).all(axis=1)
            if ok.any():
                yield from packer.add(rids[own[ok]], ids[own[ok]], np.floor(scale * x[ok]))
    yield from packer.rest()


def _queries_in(batches: Iterator[pa.RecordBatch], every: int, most: int) -> Iterator[pa.RecordBatch]:
    """Query tiles of at most ``most`` rows; a candidate tile holds few of them."""
    packer = _Packer(most, every)
    for t in _rows(batches):
        rids, ids, m = _unpack(t)
        q = ids % every == 0
        yield from packer.add(rids[q], ids[q], m[q].astype(np.float64))
    yield from packer.rest()


def products(q: np.ndarray, c: np.ndarray, largest: float) -> np.ndarray:
    """Exact integer products as int64. The bound on any partial sum picks the arithmetic."""
    kind = _arithmetic(largest, q.shape[1])
    if kind is not None:
        return (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
    # Rare: Python integers, held at the limits of a long.
    to_int = np.vectorize(int, otypes=[object])
    exact = to_int(q) @ to_int(c).T if q.size and c.size else np.zeros((len(q), len(c)), object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _arithmetic(largest: float, dim: int) -> type | None:
    """The floats that hold any partial sum of a product exactly, if any do."""
    bound = largest * max(1, dim)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else None


def best_of(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and positions of the k best of each row: by score, then place; ``own`` takes no part.

    Tiles are ordered by id, so the place breaks ties as the smaller id does.
    """
    n = scores.shape[1]
    places = np.arange(n - 1, -1, -1)
    low = np.iinfo(np.int64).min
    if scores.size and max(-int(scores.min()), int(scores.max())) < 2**62 // n:
        key = np.where(own, low, scores * n + places)  # no two alike in a row
        if n > k:
            top = np.argpartition(key, n - k, axis=1)[:, n - k :]
        else:
            top = np.broadcast_to(np.arange(n), key.shape)
        rows = np.repeat(np.arange(len(key)), top.shape[1])
        at = top.ravel()
        free = ~own[rows, at]
        return rows[free], at[free]
    rows, at = [], []
    for i in range(len(scores)):
        free = np.flatnonzero(~own[i])
        best = sorted(free, key=lambda j: (-int(scores[i, j]), j))[:k]
        rows += [i] * len(best)
        at += best
    return np.array(rows, int), np.array(at, int)


class Shortlist:
    """The k best candidates so far of each query of a tile.

    New ones are put aside and merged when there are as many as queries; until then the k-th best
    known is a little low, which lets more through and loses none.
    """

    def __init__(self, rids: np.ndarray, ids: np.ndarray, k: int):
        self.rids, self.ids, self.k = rids.copy(), ids.copy(), k
        self.low = np.full(len(ids), -np.inf)  # the k-th best score, as a float; below all if there are fewer
        self.last = np.zeros(len(ids), np.int64)  # and its id
        self.rows, self.scores, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.aside: list[tuple] = []
        self.waiting = 0

    def add(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        self.aside.append((rows, scores, found))
        self.waiting += len(rows)
        if self.waiting >= len(self.ids):
            self.merge()

    def merge(self) -> None:
        rows, scores, found = (np.concatenate(x) for x in zip((self.rows, self.scores, self.found), *self.aside))
        order = np.lexsort((found, ~scores, rows))
        rows, scores, found = rows[order], scores[order], found[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(self.ids)))[rows]
        full, kept = rank == self.k - 1, rank < self.k
        self.low[rows[full]], self.last[rows[full]] = scores[full], found[full]
        self.rows, self.scores, self.found = rows[kept], scores[kept], found[kept]
        self.aside, self.waiting = [], 0

    def offer(self, q: np.ndarray, rids: np.ndarray, ids: np.ndarray, c: np.ndarray, largest: float) -> None:
        """Meet the candidates of a tile, which are ordered by id."""
        kind = _arithmetic(largest, q.shape[1])
        if kind is not None:
            q, c, room = q.astype(kind), c.astype(kind), np.empty(BLOCK, kind)
        for s in range(0, len(ids), BLOCK[1]):
            there = slice(s, s + BLOCK[1])
            for r in range(0, len(q), BLOCK[0]):
                some = q[r : r + BLOCK[0]]
                if kind is None:
                    self._best(r + np.arange(len(some)), products(some, c[there], largest), rids[there], ids[there])
                else:
                    scores = room[: len(some), : len(ids[there])]
                    self._block(r, np.matmul(some, c[there].T, out=scores), rids[there], ids[there])

    def _block(self, r: int, scores: np.ndarray, rids: np.ndarray, ids: np.ndarray) -> None:
        """Candidates that reach the k-th best; with equal scores only if none here has a smaller id."""
        end = r + len(scores)
        low = (self.low[r:end] + (ids[0] >= self.last[r:end])).astype(scores.dtype)
        rows = np.flatnonzero(scores.max(axis=1) >= low)
        if not len(rows):
            return
        scores = scores[rows]
        reach = scores >= low[rows, None]
        if np.count_nonzero(reach) > 8 * self.k * len(rows):
            self._best(r + rows, scores.astype(np.int64), rids, ids)
            return
        i, j = np.divmod(np.flatnonzero(reach), len(ids))
        free = self.rids[r + rows[i]] != rids[j]
        i, j = i[free], j[free]
        self.add(r + rows[i], scores[i, j].astype(np.int64), ids[j])

    def _best(self, rows: np.ndarray, scores: np.ndarray, rids: np.ndarray, ids: np.ndarray) -> None:
        i, j = best_of(scores, self.rids[rows][:, None] == rids[None, :], self.k)
        self.add(rows[i], scores[i, j], ids[j])

    def result(self) -> pa.RecordBatch:
        self.merge()
        lists = (self.rids[self.rows], self.ids[self.rows], self.found, self.scores)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in lists], ["rid", "query_id", "vec_id", "score"])


def _multiply(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best k of each query among all candidates that come; one list per query."""
    lists: dict[bytes, Shortlist] = {}
    for t in _rows(batches):
        rids, ids, c = _unpack(t)
        q_rids, q_ids, q = _unpack({x[2:]: v for x, v in t.items() if x.startswith("q_")})
        tile = q_rids[:1].tobytes()
        if tile not in lists:
            lists[tile] = Shortlist(q_rids, q_ids, k)
        lists[tile].offer(q, rids, ids, c, t["largest"] * t["q_largest"])
    for one in lists.values():
        yield one.result()


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0) -> DataFrame:
    """The ``k`` best other rows for each row whose ``vec_id`` is divisible by ``every``.

    ``vectors`` has vec_id and embedding; other columns are not read. Components become
    floor(scale * x); the score is their integer inner product; ties go to the smaller vec_id.
    Columns: query_id, rank (from 1), vec_id, score. A query with fewer than k candidates gets all.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
    without vec_id. Vectors of another length are no candidates. Of repeated rows each is a query
    and a candidate of its own. Scores beyond a long are held at its limits.
    """
    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    slim = vectors.where("vec_id is not null").select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    tiles = stored(
        slim.mapInArrow(lambda it: tidy(tiles_of(it, scale, every)), TILE), "vector-tiles",
        **{"parquet.block.row.count.limit": GROUP_TILES},
    )
    rows, asked = tiles.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "queries")]).first()
    most = max(1, min(QUERY_ROWS, LIST_ROWS // max(k, 1)))
    n_parts = max(1, -(-asked // max(most, min(PART_ROWS, LIST_ROWS // max(k, 1)))))
    n_runs = max(1, min(FAN, -(-rows * asked // (PAIRS * n_parts))))
    parts = (
        tiles.where("queries > 0").coalesce(max(1, -(-asked // (4 * QUERY_ROWS))))
        .mapInArrow(lambda it: tidy(_queries_in(it, every, most)), TILE)
        .select(*[F.col(c).alias(f"q_{c}") for c in ("rids", "ids", "matrix", "dim", "largest")])
        .repartition(n_parts)
    )
    runs = tiles.select("rids", "ids", "matrix", "dim", "largest").coalesce(n_runs)
    # Each pair of a run and a part is a task. Without the hint the few queries could be broadcast, and the
    # equality would send every row of one length to one task.
    pairs = runs.join(parts.hint("shuffle_replicate_nl"), F.col("q_dim") == F.col("dim"))
    lists = pairs.mapInArrow(lambda it: tidy(_multiply(it, k)), LIST)
    best = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
