import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilowatch.llm import neardup
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import DOCUMENTS, documents, frame, prose, with_clashes


def shingles(text, size):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[i:] for i in range(size)]))


def brute(rows, size, percent=80):
    """(doc_id, n, component, kept) by comparing all pairs of documents; ids are unique."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def edited(rng, text, share):
    words = text.split()
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 120), rng.choice(("en", "de", "fr"))) for _ in range(60)]
    base = prose(rng, 150)
    texts += [edited(rng, base, rng.choice((0.0, 0.01, 0.03, 0.05, 0.08, 0.12))) for _ in range(80)]
    texts += [edited(rng, texts[-1], 0.02) for _ in range(20)]
    passage = prose(rng, 30)
    texts += [f"{prose(rng, 15)} {passage} {prose(rng, 15)}" for _ in range(30)]
    texts += ["the of", "the of and", "THE Of", "the", "the ", None, "", " \n\t", "É of", "é of", "the of and to", "of the of the of the"]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in (3, 5, 5, 9, 9, 40, 40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size,seed", [(2, 1), (5, 2)])
def test_against_brute_force(spark, size, seed):
    texts = corpus(seed)
    df = with_clashes(documents(spark, texts), "n", "fp1", "rep", "root", "kept", "component_id", "value", "matching_id")
    got = sorted(map(tuple, neardup.near_duplicates(df.repartition(4), size).collect()))
    assert got == brute(list(enumerate(texts)), size)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    texts = corpus(5)
    got = sorted(map(tuple, neardup.near_duplicates(documents(spark, texts), 2).collect()))
    assert got == brute(list(enumerate(texts)), 2)


def test_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, neardup.near_duplicates(docs, 2).collect())) == brute(rows, 2)


def test_nulls_repeated_ids_and_empty_table(spark):
    assert neardup.near_duplicates(frame(spark, [])).collect() == []
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(None, a), (3, a), (3, a), (2, a), (7, b), (3, b), (9, None), (8, "")]
    df = frame(spark, [(i, t, None, None, None) for i, t in rows])
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()), key=str)
    want = [(None, None, True), (3, 2, False), (3, 2, False), (3, 2, False), (2, 2, True), (7, 2, False), (9, 9, True), (8, 8, True)]
    assert got == sorted(want, key=str)


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60) for _ in range(5)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(10 + i, t.upper(), "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[0]] * 3 + [(20, None, None, None, None), (None, "x", None, None, None)]
    left = neardup.without_near_duplicates(frame(spark, rows))
    assert left.columns == [c.split()[0] for c in DOCUMENTS.split(", ")]
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([0, 1, 2, 3, 4, 20, None], key=str)


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(-(2**62), 2**62, 3000))
    rng.shuffle(pool)
    a = np.sort(pool[:1000])
    for shared in (1000, 900, 500, 0):
        b = np.sort(np.concatenate([pool[:shared], pool[1000 : 2000 - shared]]))
        estimate = neardup._Block([1], [a], 64).estimates(b)[0]
        assert abs(estimate - shared / (2000 - shared)) < 0.2


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 98)], "a long, b long")
    got = {r["node"]: r["root"] for r in neardup.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 99: 98, 100: 98}


def links_of_group(spark, n):
    """Links that a group of n near copies gives, edits at different places, and what they connect."""
    rng = random.Random(n)
    base = prose(rng, 300)
    texts = [edited(rng, base, 0.03) for _ in range(n)]
    docs = documents(spark, texts).select("doc_id", "text").repartition(6)
    signed = docs.repartition(6).mapInPandas(lambda it: neardup._signatures(it, 2, neardup.K), neardup.SIGNATURE)
    sketches = neardup.stored(signed.select(F.col("doc_id").alias("rep"), "n", "sketch"), "sketches")
    links = neardup.stored(neardup.linked_pairs(sketches, docs, 2, 80, neardup.K, False), "links")
    return links.count(), texts, {(min(a, b), max(a, b)) for a, b in links.collect()}


def test_links_grow_with_the_group_not_its_square(spark):
    small, texts, links = links_of_group(spark, 200)
    sets = [shingles(t, 2) for t in texts]
    # Every link given is one, and together they connect what all links connect.
    linked = {(i, j) for j in range(200) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert links <= linked

    def parts(pairs):
        root = list(range(200))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        return [find(i) == find(0) for i in range(200)], len({find(i) for i in range(200)})

    assert parts(links) == parts(linked)
    large, _, _ = links_of_group(spark, 800)
    # A document meets the hubs of the few lists it is in; all links would be some 150 a document.
    assert small <= 10 * 200 and large <= 10 * 800
