import math
import random
import zlib
from collections import Counter

import numpy as np

from kilowatch.llm import langid
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import VOCABULARY, documents, frame, prose, with_clashes

PIECES = ["a", "b", "ab", "▁", "▁a", "ba", "aba"]


def all_ways(word, p):
    """Sum over all segmentations, one by one."""

    def rest(i):
        if i == len(word):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(word) + 1):
            piece = word[i:j]
            if piece in PIECES:
                total += p[PIECES.index(piece)] * rest(j)
            elif j == i + 1:
                total += p[len(PIECES)] * rest(j)
        return total

    return rest(0)


def test_forward_sums_all_segmentations():
    p = np.random.default_rng(0).random((len(PIECES) + 2, 3))
    p[-1] = 0
    lattice = langid.Lattice(PIECES)
    words = ["a", "ab", "abab", "abcba", "bbbbabababaabab", "x", "ba", "xyzzy"]
    for at, numbers in lattice.of(words):
        got = langid.forward(numbers, p)
        for row, i in zip(got, at):
            assert np.allclose(row, [math.log(all_ways("▁" + words[i], p[:, g])) for g in range(3)])


def test_no_underflow_in_long_words():
    lattice = langid.Lattice(PIECES)
    p = np.full((len(PIECES) + 2, 2), 1e-6)
    p[-1] = 0
    (_, numbers), = lattice.of(["ab" * 3000])
    assert np.isfinite(langid.forward(numbers, p)).all()


def test_learning_raises_the_likelihood():
    counts = Counter({"abab": 5, "ba": 3, "aab": 2})
    words, weights = list(counts), np.array(list(counts.values()), float)
    groups = list(langid.Lattice(PIECES).of(words))

    def likelihood(p):
        return sum(float((weights[at] * langid.forward(n, p[:, None])[:, 0]).sum()) for at, n in groups)

    models = [langid.learn({"x": counts}, PIECES, rounds)["p"][:, 0] for rounds in (1, 2, 5)]
    values = [likelihood(p) for p in models]
    assert values == sorted(values) and abs(models[0].sum() - 1) < 1e-9


def test_accuracy_on_held_out_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    got = langid.identify(docs, langid.train(docs, VOCABULARY)).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(got) == len(lang)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(r["accepted"] for r in got)


def test_sample_is_bounded_and_blind_to_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 30, lang), lang, "s", 1) for i in range(200) for lang in [rng.choice(("en", "de", "fr"))]]
    held = [(i, "zz " * 50, "xx", "s", 1) for i in range(200, 400) if zlib.crc32(str(i).encode()) % 4 == 2]
    model = langid.train(frame(spark, rows + held), VOCABULARY, per_language=10)
    assert model["languages"] == ["de", "en", "fr"]


def test_texts_without_language(spark):
    rng = random.Random(2)
    docs = documents(spark, [prose(rng, 200) for _ in range(20)])
    model = langid.train(docs, VOCABULARY)
    texts = [None, "", "12 34 !!", "½ ²", "xqzkj wvvq zzkx qqpw xjkz vvbn qwxz kkjh " * 5, "日本語", prose(rng, 5), "a" * 5000, prose(rng, 30_000)]
    df = with_clashes(documents(spark, texts), "lang_pred", "score", "accepted", "held_out", "n_words")
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert [got[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and all(got[i]["score"] == 0 for i in range(4))
    assert [got[i]["accepted"] for i in range(5)] == [False] * 5
    assert got[4]["lang_pred"] == "en" and got[6]["accepted"] and got[8]["accepted"]
    left = langid.accepted_rows(df, model)
    assert left.schema == df.schema and {r["doc_id"] for r in left.collect()} == {i for i in got if got[i]["accepted"]}


def test_nothing_learned_and_empty_table(spark):
    docs = frame(spark, [(1, "some text", None, None, None), (None, "more", None, None, None), (1, "some text", None, None, None)])
    model = langid.train(docs, VOCABULARY)
    assert [r["lang_pred"] for r in langid.identify(docs, model).collect()] == ["und"] * 3
    assert langid.identify(frame(spark, []), langid.train(frame(spark, []), VOCABULARY)).collect() == []


def test_long_words_cost_in_proportion():
    """Runs of many thousand letters are scored whole, and one twice as long takes no four times the work."""
    import time

    pieces = ["a", "c", "g", "t", "ac", "gt", "\u2581a"]
    rng = random.Random(1)
    model = langid.learn({"x": Counter({"acgt": 3, "gta": 2}), "y": Counter({"ttt": 3})}, pieces)
    lattice, seconds = langid.Lattice(pieces), []
    for n in (10_000, 40_000):
        word = "".join(rng.choice("acgt") for _ in range(n))
        began = time.process_time()
        ((_, numbers),) = lattice.of([word])
        score = langid.forward(numbers, model["p"])
        seconds.append(time.process_time() - began)
        assert np.isfinite(score).all()
    assert seconds[1] < 10 * seconds[0]
