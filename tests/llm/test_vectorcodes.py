import math
import random

import numpy as np
import pytest

from kilowatch.llm import vectorcodes
from kilowatch.llm.vectorcodes import PartState
from tests.llm.fixtures import frame, with_clashes

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds, scale=256):
    """Codes, errors and codebooks by full comparison in plain Python integers."""
    ok = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v) and v and len(v) % parts == 0]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(ok[0][1])
    width = dim // parts
    first = [r for r in ok[:entries] if len(r[1]) == dim]
    ok = [r for r in ok if len(r[1]) == dim]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in ok]
    books = [[list(v[p * width : (p + 1) * width]) for _, v, _ in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        codes = [[nearest(x[p], books[p])[1] for p in range(parts)] for x in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [x[p] for x, c in zip(cut, codes) if c[p] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    out = []
    for (i, _, lab), x in zip(ok, cut):
        found = [nearest(x[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return sorted(out, key=repr), books


def rows_of(seed, n, dim, values=None):
    rng = random.Random(seed)
    draw = (lambda: rng.choice(values)) if values else (lambda: rng.gauss(0, 0.3))
    return [(i, [draw() for _ in range(dim)], rng.choice((0, 1, 1, 1, None))) for i in rng.sample(range(-50, 5 * n), n)]


ODD = [(3000, None, 1), (3001, [None] * 8, 1), (3002, [float("nan")] * 8, 1), (3003, [float("inf")] + [0.0] * 7, 1),
       (3004, [1.0] * 7, 0), (3005, [], 0), (3006, [1.0] * 16, 0), (None, [0.1] * 8, 2), (None, [0.1] * 8, 2)]


@pytest.mark.parametrize("seed,values,b", [(1, None, None), (2, (-0.01, 0.0, 0.004, 0.01, 0.5), 1), (3, None, 3)])
def test_against_brute_force(spark, monkeypatch, seed, values, b):
    monkeypatch.setattr(vectorcodes, "TILE_ROWS", 50)
    monkeypatch.setattr(vectorcodes, "CHUNK_ROWS", 7)
    rows = rows_of(seed, 300, 8, values) + ODD
    rows += rows[:40]  # repeated rows
    df = with_clashes(frame(spark, rows, VECTORS), "code", "error", "matrix", "b", "at").repartition(3)
    codes, books = vectorcodes.encode(df, parts=4, entries=20, rounds=4, b=b)
    want, want_books = brute(rows, 4, 20, 4)
    assert books.tolist() == want_books
    assert sorted((tuple(r) for r in codes.select("vec_id", "label", "code", "error").collect()), key=repr) == want


def test_report_and_label_sums(spark):
    rows = rows_of(4, 120, 8)
    got = vectorcodes.code_report(frame(spark, rows, VECTORS), parts=2, entries=5, rounds=2).collect()
    want, books = brute(rows, 2, 5, 2)
    sums = {}
    for _, lab, _, e in want:
        sums[lab] = sums.get(lab, 0) + e
    digest = vectorcodes.codebook_digest(np.array(books))
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == sorted(
        (i, c, e, sums[lab], digest) for i, lab, c, e in want
    )


def test_few_vectors_and_none(spark):
    assert vectorcodes.code_report(frame(spark, [], VECTORS)).collect() == []
    codes, books = vectorcodes.encode(frame(spark, [(5, [0.5, 0.25], 0)] * 2, VECTORS), parts=2, entries=64)
    assert sorted(r["error"] for r in codes.collect()) == [0, 0] and books.shape == (2, 2, 1)
    with pytest.raises(ValueError):
        vectorcodes.encode(frame(spark, [], VECTORS), entries=257)


def test_great_components_are_held(spark):
    rows = [(0, [1e300, 0.0], 0), (1, [-1e300, 0.0], 0), (2, [1e5, 3.0], 0)]
    codes, books = vectorcodes.encode(frame(spark, rows, VECTORS), parts=1, entries=2, rounds=1)
    assert abs(int(books.max())) <= vectorcodes.LIMIT and codes.count() == 3


def test_bounds_hold_and_save_comparisons():
    """After every move the bounds enclose the true distances, and most assignments need no list."""
    rng = np.random.default_rng(5)
    x = rng.integers(-100, 100, (3000, 4))
    book = x[:64].copy()
    state = PartState.empty(len(x), 6)
    state.compare_all(x, book, np.arange(len(x)))
    shares = []
    for _ in range(6):
        new = np.array([x[state.code == k].mean(axis=0) // 1 if (state.code == k).any() else book[k] for k in range(64)]).astype(np.int64)
        moved = np.sqrt(((new - book) ** 2).sum(axis=1).astype(float))
        book = new
        state.follow(moved)
        true = np.sqrt(((x[:, None, :] - book[None]) ** 2).sum(axis=2))
        rows = np.arange(len(x))
        assert (state.upper >= true[rows, state.code]).all()
        listed = np.take_along_axis(true, state.near.astype(int), 1)
        assert (state.lower[:, :-1] <= listed).all() and (np.diff(state.lower, axis=1) >= 0).all()
        others = true.copy()
        others[rows, state.code] = np.inf
        np.put_along_axis(others, state.near.astype(int), np.inf, 1)
        assert (state.lower[:, -1] <= others.min(axis=1)).all()
        needed = state.assign(x, book)
        assert (state.code == np.argmin(true, axis=1)).all() and needed.sum() == len(x)
        shares.append(needed[-1] / len(x))
    assert shares[-1] < 0.2


def test_list_length_adapts(spark):
    needed = [(list(v),) for v in ([900, 60, 20, 0, 0, 5], [900, 60, 20, 1, 0, 5])]
    tiles = spark.createDataFrame(needed, "needed array<long>")
    assert vectorcodes.adapted(4, tiles) == 2  # three listed entries helped one part only
    assert vectorcodes.adapted(4, tiles, spare=0.0) == 3
