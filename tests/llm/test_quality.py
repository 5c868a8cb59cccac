import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kilowatch.llm import quality
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import DOCUMENTS, documents, frame, prose, with_clashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed by loops."""
    text = text or ""
    words, seen, dup = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n)


def corpus():
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 300), rng.choice(("en", "de", "fr"))) + "." for _ in range(60)]
    line = prose(rng, 9)
    texts += ["\n".join([line] * n + [prose(rng, 5)]) for n in (1, 2, 3, 30)]
    passage = prose(rng, 12)
    texts += [f"{passage} {prose(rng, n)} {passage}" for n in (1, 5, 100)]
    texts += [" ".join(["a"] * n) for n in (1, 7, 8, 9, 10, 40)] + [" ".join("ab" * n) for n in (4, 8, 9, 20)]
    texts += [None, "", " \n\t ", "\r\n\r\n", "a\n\na\n \na\r\na", "x" * 5000, "# $ | < > & % *", "wörter\x0bund\x0cmehr ganz", "1 2 3 4a é 5"]
    texts += [prose(rng, 20_000)]
    return texts


def test_base_against_loops(spark):
    texts = corpus()
    df = with_clashes(documents(spark, texts), "words", "lines", "n_words", "kept", "quality", "length").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.judged(df).select(*BASE).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def loop_em(rows, rounds=quality.ROUNDS):
    """The model by plain loops over single texts: (votes, base_failed) in, Model out."""
    k, m, texts = len(quality.RULES), quality.START, [v for v, failed in rows if not failed]
    w = max(quality.PRIOR_SHARE * len(texts), 1.0)

    def p_of(votes, m):
        odds = math.log(m.prior / (1 - m.prior))
        for j, v in enumerate(votes):
            if v == 1:
                odds += math.log(m.good[j] / (1 - m.bad[j]))
            elif v == 0:
                odds += math.log((1 - m.good[j]) / m.bad[j])
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds if texts else 0):
        p = [p_of(v, m) for v in texts]
        good, bad = [], []
        for j in range(k):
            g1, g0 = (sum(x for x, v in zip(p, texts) if v[j] == s) for s in (1, 0))
            b1, b0 = (sum(1 - x for x, v in zip(p, texts) if v[j] == s) for s in (1, 0))
            good.append((g1 + w * quality.START.good[j]) / (g1 + g0 + w))
            bad.append(max((b0 + w * quality.START.bad[j]) / (b1 + b0 + w), 1 - good[-1]))
        m = quality.Model((sum(p) + w * quality.START.prior) / (len(texts) + w), good, bad)
    return m, [p_of(v, m) for v, _ in rows]


def test_model_against_loops(spark):
    rows = quality.judged(table(spark, SF_DIR, "documents")).collect()
    votes = [([r[f"v_{n}"] for n in quality.NAMES], r["base_failed"]) for r in rows]
    _, want = loop_em(votes)
    assert [r["quality"] for r in rows] == pytest.approx(want, abs=1e-9)
    assert [r["kept"] for r in rows] == [not r["base_failed"] and p >= 0.5 for r, p in zip(rows, want)]


def test_votes_and_abstentions(spark):
    def votes(text):
        r = quality.judged(documents(spark, [text])).first()
        return {n: r[f"v_{n}"] for n in quality.NAMES}

    rng = random.Random(3)
    assert set(votes("").values()) == {None}
    good = votes(". ".join(prose(rng, 12) for _ in range(10)) + ".")
    assert {good[n] for n in ("length", "symbols", "duplicate_lines", "repeats", "letters", "sentences", "capitals")} == {1}
    shouting = votes(prose(rng, 100).upper())
    assert shouting["capitals"] == 0 and shouting["sentences"] == 0
    assert votes(" | ".join(prose(rng, 1) for _ in range(60)))["symbols"] == 0
    assert votes(prose(rng, 30))["length"] is None


def test_agrees_with_labels(spark):
    """No label was seen: on labelled texts that pass the base, the verdict and the label rarely differ."""
    judged = quality.judged(table(spark, "/root/testdata/sf0.01", "documents")).withColumnRenamed("quality", "posterior")
    rows = judged.join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("not base_failed").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(junk) <= 0.15 * len(junk)


def test_null_ids_repeats_and_empty(spark):
    rng = random.Random(1)
    text = ". ".join(prose(rng, 12) for _ in range(10)) + "."
    rows = [(None, text, None, None, None), (1, text, "en", "s", 1), (1, text, "en", "s", 1), (1, "junk", "en", "s", 1), (2, None, None, None, None)]
    df = frame(spark, rows, DOCUMENTS).withColumn("quality", F.lit("clash"))
    assert sorted((r["doc_id"], r["kept"]) for r in quality.quality_rules(df).where("doc_id is not null").collect()) == [(1, False), (1, True), (1, True), (2, False)]
    assert sorted(str(r["doc_id"]) for r in quality.accepted(df).collect()) == ["1", "1", "None"]
    assert quality.quality_rules(frame(spark, [], DOCUMENTS)).collect() == []


def test_plan_has_no_python(spark):
    plan = quality.quality_rules(table(spark, SF_DIR, "documents"))._jdf.queryExecution().executedPlan().toString()
    measures = quality.measured(table(spark, SF_DIR, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan + measures for word in ("Python", "Pandas", "Arrow", "Exchange"))
