import hashlib
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kilowatch.llm import mixing
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import frame, with_clashes


def columns():
    return mixing.domain_of(F.col("source")), mixing.estimated_tokens(F.col("text"))


def poured(budget, children):
    """name -> share: fill in turns, each turn dividing what is left among those not yet full."""
    share, open_, left = {}, dict(children), budget
    while open_:
        total = sum(w for _, w in open_.values())
        full = [n for n, (cap, w) in open_.items() if w and Fraction(left * w, total) >= cap]
        if not full:
            share |= {n: left * w // total if total else 0 for n, (_, w) in open_.items()}
            break
        for n in full:
            share[n] = open_[n][0]
        left -= sum(open_.pop(n)[0] for n in full)
    return share


def weight(path):
    exact = mixing.WEIGHTS.get(path)
    return exact if exact is not None else mixing.WEIGHTS.get(("*", path[-1], len(path)), 1)


def brute(rows, percent, epochs, seed=11, size=lambda text: -(-len(text.encode()) // 4)):
    leaves = {}
    for doc_id, text, lang, source in rows:
        domain = next((d for d, names in mixing.DOMAINS.items() if source in names), "other")
        n = size(text) if text is not None else 0
        leaves.setdefault((domain, lang or "", source or ""), []).append((doc_id, n))
    caps = {leaf: epochs * sum(n for _, n in docs) for leaf, docs in leaves.items()}
    total = sum(caps.values()) // epochs
    budgets = {(): min(total * percent // 100, total * epochs)}
    for depth in (1, 2, 3):
        children = {}
        for leaf, cap in caps.items():
            children[leaf[:depth]] = children.get(leaf[:depth], 0) + cap
        for node in {c[:-1] for c in children}:
            budgets |= poured(budgets[node], {c: (cap, weight(c)) for c, cap in children.items() if c[:-1] == node})
    out = []
    for leaf, docs in leaves.items():
        tokens, budget = sum(n for _, n in docs), budgets[leaf]
        whole = budget // tokens if tokens else 0
        prefix, at = budget - whole * tokens, 0
        out += [(d, *leaf, e, n) for e in range(whole) for d, n in docs]
        keyed = sorted((hashlib.md5(f"{seed}|{whole}|{'' if d is None else d}".encode()).hexdigest(), d is not None, d or 0, n) for d, n in docs)
        for _, present, d, n in keyed:
            if at < prefix:
                out.append((d if present else None, *leaf, whole, n))
            at += n
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent,epochs", [(60, 2), (60, 1), (100, 1), (170, 2), (300, 2), (0, 1)])
def test_against_brute_force(spark, percent, epochs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_BITS", 3)  # many buckets
    docs = table(spark, SF_DIR, "documents")
    got = mixing.mix(docs, *columns(), mixing.WEIGHTS, percent=percent, epochs=epochs)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, percent, epochs)


def test_random_trees(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.choice((0, 1, 5, 40, 400)), rng.choice(("en", "en", "es", None)), f"src{rng.choice((0, 0, 0, 3, 8, 25))}") for i in range(300)]
    rows += [(None, "y" * 9, None, None), (7, None, "en", "src0"), (8, "z", "en", "src0"), (8, "z", "en", "src0")]
    df = with_clashes(frame(spark, [(*r, None) for r in rows]), "domain", "budget", "cap", "epoch", "bucket", "order", "weight")
    for percent in (20, 60, 150):
        got = mixing.mix(df, *columns(), mixing.WEIGHTS, percent=percent)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, percent, 2)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(i, "x" * 400, "en", "src0") for i in range(10)] + [(100 + i, "x" * 400, "en", "src1") for i in range(100)]
    rows += [(300 + i, "x" * 400, "en", "src7") for i in range(200)]
    df = frame(spark, [(*r, None) for r in rows])
    got = mixing.mix(df, *columns(), {("web",): 1, ("reference",): 1}, budget=12_000, epochs=1)
    used = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert used == {"src0": 1000, "src1": 5000, "src7": 6000}


def test_empty_and_rows(spark):
    empty = frame(spark, [])
    assert mixing.mix(empty, *columns(), mixing.WEIGHTS).collect() == []
    docs = table(spark, SF_DIR, "documents")
    left = mixing.mixed_rows(docs, *columns(), mixing.WEIGHTS, percent=50)
    assert left.columns == docs.columns and 0 < left.count() < docs.count()
    assert mixing.mixed_rows(empty, *columns(), mixing.WEIGHTS).collect() == []


def test_mixed_rows_without_own_ids(spark):
    rows = [(None if i % 3 == 0 else i // 2, "x" * (4 + i), "en", f"src{i % 9}") for i in range(120)]
    docs = with_clashes(frame(spark, [(*r, i) for i, r in enumerate(rows)]), "mixing_row", "epoch")
    for percent in (0, 40, 100):
        chosen = mixing.mix(docs, *columns(), mixing.WEIGHTS, percent=percent, epochs=1)
        left = mixing.mixed_rows(docs, *columns(), mixing.WEIGHTS, percent=percent)
        assert left.columns == docs.columns
        size = mixing.estimated_tokens(F.col("text"))
        got = left.select("doc_id", "source", size.cast("long").alias("n_tokens"), "n_chars").collect()
        assert len({r["n_chars"] for r in got}) == len(got)
        assert sorted((r[0], r[1], r[2]) for r in got if r[0] is not None) == sorted(tuple(r) for r in chosen.where("doc_id is not null").select("doc_id", "source", "n_tokens").collect())
        assert sorted(tuple(r)[1:3] for r in got if r[0] is None) == sorted(tuple(r) for r in chosen.where("doc_id is null").select("source", "n_tokens").collect())
    assert len(got) == len(rows)


def test_rows_of_one_id_spread(spark, monkeypatch):
    """A third of all rows, or all, with one id, or none: no bucket has more than its share."""
    monkeypatch.setattr(mixing, "BUCKET_BITS", 5)
    kept = []
    monkeypatch.setattr(mixing, "stored", lambda df, name, write=mixing.stored: (kept.append((name, write(df, name))), kept[-1][1])[1])
    rows = [(7 if i % 2 else None, "x" * (4 + i % 9), "en", "src0") for i in range(2000)]
    got = mixing.mix(frame(spark, [(*r, None) for r in rows]), *columns(), mixing.WEIGHTS, percent=50, epochs=1)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 50, 1)
    (part,) = [df for name, df in kept if name == "prefix-rows"]
    sizes = [r["count"] for r in part.groupBy("bucket").count().collect()]
    assert max(sizes) <= 32 and len(sizes) >= 60


def test_mixing_by_real_tokens(spark):
    from tests.llm.fixtures import TOKENIZER
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    docs = table(spark, SF_DIR, "documents")
    left = mixing.mixed_rows(docs, mixing.domain_of(F.col("source")), TOKENIZER, mixing.WEIGHTS, percent=40)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    want = brute(rows, 40, 1, size=lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in want)
