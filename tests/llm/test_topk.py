import math
import random

import numpy as np
import pyarrow.dataset as ds
import pytest

from kilowatch.llm import topk
from kilowatch.session import scratch_made
from tests.llm.fixtures import with_clashes

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice((-1.0, -0.5, 0.25, 0.5, 1.0)) for _ in range(3)]) for i in range(400)]  # many ties
    rows += [(50, None), (51, [None, 1.0, 2.0]), (100, [float("nan"), 0.0, 0.0]), (52, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
             (150, [0.5, 0.5, 0.5]), (1000, [1.0, 2.0]), (1001, [3.0, -2.0])]
    df = with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(5), "rank", "score", "rid", "list", "block", "dim")
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert got == brute(rows)


def test_several_query_blocks_and_merging_levels(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "FAN", 3)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    df = spark.createDataFrame([(i, [float(np.float32(x)) for x in v], 0) for i, v in rows], VECTORS)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = sorted(map(tuple, topk.top_k(df, k=7, every=10).collect()))
    assert got == brute(rows, 7, 10)


def small(monkeypatch, **more):
    for name, value in ({"TILE_ROWS": 16, "QUERY_ROWS": 8, "PART_ROWS": 16, "PAIRS": 1, "FAN": 3, "BLOCK": (4, 8), "GROUP_TILES": 2} | more).items():
        monkeypatch.setattr(topk, name, value)


def brute_held(rows, k, every):
    """Like brute, over finite vectors, with scores held at the limits of a long before they are ranked."""
    ok, out = [(i, [math.floor(256 * x) for x in v]) for i, v in rows], []
    for a, (i, q) in enumerate(ok):
        if i % every == 0:
            scored = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, v)))), j) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q)]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_tiles_are_read_where_they_lie(spark, monkeypatch):
    # Tiles that were copied once per block of queries, and read a whole file at once, ran out of memory at 15 million vectors.
    small(monkeypatch)
    df = spark.createDataFrame([(i, [float(i % 7), 1.0], 0) for i in range(300)], VECTORS).coalesce(2)
    found = topk.top_k(df, every=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "SortMergeJoin" not in plan
    (path,) = [x for x in scratch_made() if "vector-tiles" in x][-1:]
    groups = [g.num_rows for f in ds.dataset(path, format="parquet").get_fragments() for g in f.row_groups]
    assert sum(groups) >= 300 / 16 and max(groups) <= 2
    assert found.count() == 75 * 5


@pytest.mark.parametrize("sizes", [[1], [2**12], [2**22], [2**52], [1, 2**8, 2**22, 2**52]])
@pytest.mark.parametrize("step", [1, -1, 7])
def test_ties_over_runs_and_parts(spark, monkeypatch, sizes, step):
    small(monkeypatch)
    rng = random.Random(step)
    rows = [((i * step) % 211, [sizes[i * len(sizes) // 211] * rng.choice((-1.0, 0.5, 1.0)) for _ in range(3)]) for i in range(211)]
    rows += rows[::5] + [(400 + i, [float(sizes[-1]), 1.0]) for i in range(60)] + [(600 + i, []) for i in range(20)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int").coalesce(3)
    assert sorted(map(tuple, topk.top_k(df, k=4, every=3).collect())) == brute_held(rows, 4, 3)


def test_lists_that_equal_scores_fill(spark, monkeypatch):
    small(monkeypatch, BLOCK=(4, 64), TILE_ROWS=64)
    rows = [(i, [1.0, 1.0]) for i in range(500)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).coalesce(1)
    assert sorted(map(tuple, topk.top_k(df, k=1, every=20).collect())) == brute(rows, 1, 20)


def test_few_rows_and_none(spark):
    assert topk.top_k(spark.createDataFrame([], VECTORS)).collect() == []
    one = spark.createDataFrame([(0, [1.0], 0)], VECTORS)
    assert topk.top_k(one).collect() == []
    twice = spark.createDataFrame([(0, [1.0], 0)] * 2, VECTORS)
    assert sorted(map(tuple, topk.top_k(twice).collect())) == [(0, 1, 0, 65536)] * 2


@pytest.mark.parametrize("size", [1, 2**14, 2**30, 2**60])
def test_products_are_exact(size):
    rng = np.random.default_rng(1)
    q, c = (np.floor(rng.uniform(-size, size, (5, 6))) for _ in range(2))
    exact = [[max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(x, y)))) for y in c] for x in q]
    assert topk.products(q, c, float(np.abs(q).max()) * float(np.abs(c).max())).tolist() == exact
