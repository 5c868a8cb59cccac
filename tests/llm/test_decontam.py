import random

from kilowatch.llm import decontam
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import documents, frame, prose, with_clashes

ITEMS = "item_id long, text string"


def distance(text, pattern):
    """Least edit distance of the pattern to any part of the text, by the full table."""
    row, best = list(range(len(pattern) + 1)), len(pattern)
    for ch in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != ch)))
        row, best = new, min(best, new[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(1500):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))
        masks = {}
        for i, ch in enumerate(p):
            masks[ch] = masks.get(ch, 0) | 1 << i
        hit = decontam.myers(t, masks, len(p), len(p))
        assert (hit[0] if hit else len(p)) == distance(t, p)
        assert decontam.myers(t, masks, len(p), distance(t, p) - 1) is None


def test_normal_form_and_origins():
    for text in ["", "  a--B  c!!", "İstanbul, x.. É\n\nq", "é", "..a..", "A\tb"]:
        norm = decontam.normalised(text)
        if norm:
            at = decontam.origins(text)
            assert len(at) == len(norm)
            assert all(norm[i] == " " or text[at[i]].lower()[:1] in (norm[i], norm[i - 1]) for i in range(len(norm)))
    assert decontam.normalised(" A, b!\nC ") == " a b c " and decontam.normalised("...") == ""


def corrupt(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice(("", "q", text[i] + "z")) + text[i + 1 :]
    return text


def test_against_brute_force(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randint(2, 25))) for i in range(12)] + [(12, "be"), (13, None), (14, "!!"), (15, None)]
    texts = []
    for _ in range(60):
        item = rng.choice(items[:12])[1]
        texts.append(f"{prose(rng, 20)} {corrupt(rng, item, rng.randint(0, 12))} {prose(rng, 20)}")
    texts += [items[0][1].upper(), items[1][1].replace(" ", ",\n "), "to be", "tobe", None, "", items[2][1] + " " + items[3][1]]
    found = decontam.Items([r for r in items if r[1]], 0.07)
    want = set()
    for d, text in enumerate(texts):
        norm = decontam.normalised(text)
        for item_id, pattern, budget, _ in found.items:
            k = distance(norm, pattern) if norm else budget + 1
            if k <= budget:
                want.add((d, item_id, k))
    docs = with_clashes(documents(spark, texts), "item_id", "distance", "start", "passage")
    hits = decontam.benchmark_hits(docs, spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in hits} == want and len(hits) == len(want)
    for r in hits:
        assert texts[r["doc_id"]][r["start"] : r["end"]] == r["passage"]
        pattern = next(p for i, p, _, _ in found.items if i == r["item_id"])
        assert distance(pattern, decontam.normalised(r["passage"]).strip()) <= r["distance"] + 2


def test_a_large_benchmark_takes_several_passes(spark, monkeypatch):
    docs, items = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    once = sorted(map(tuple, decontam.benchmark_hits(docs, items).collect()))
    monkeypatch.setattr(decontam, "PASS_BYTES", 1500)
    assert once and sorted(map(tuple, decontam.benchmark_hits(docs, items).collect())) == once


def test_verbatim_items_are_found(spark):
    docs, items = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    hits = {(r["doc_id"], r["item_id"]) for r in decontam.benchmark_hits(docs, items).collect()}
    verbatim = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if i["text"] in d["text"]}
    assert verbatim <= hits
    left = decontam.without_benchmark(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in hits})


def test_empty_tables_nulls_and_repeated_rows(spark):
    none = spark.createDataFrame([], ITEMS)
    docs = frame(spark, [(None, "the very passage of the test", None, None, None)] + [(4, "the very passage of the test", "en", "s", 1)] * 3)
    assert decontam.benchmark_hits(docs, none).collect() == []
    assert decontam.benchmark_hits(frame(spark, []), none).collect() == []
    items = spark.createDataFrame([(None, "Very passage, of the test")] * 2, ITEMS)
    assert decontam.benchmark_hits(docs, items).count() == 8
    assert decontam.without_benchmark(docs, items).collect() == []  # each holds an item, the row without id too
