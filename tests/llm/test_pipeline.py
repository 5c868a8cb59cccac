import random

from tokenizers import Tokenizer

import corpus_pipeline
from kilowatch.llm import decontam
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import DOCUMENTS, TOKENIZER, frame, prose
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_neardup import brute as deduplicated
from tests.llm.test_tokenpack import expected


def through(spark, docs):
    """What each stage returns, the result of one being the input of the next."""
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs)
    return out


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_files"]


def test_each_stage_against_plain_python(spark):
    docs = table(spark, SF_DIR, "documents")
    extra = [(10_001, "123 456 !!", "en", "src0", 10), (10_002, None, None, None, None)]
    docs = docs.unionByName(frame(spark, extra))
    first, second, third, fourth, last = through(spark, docs)
    text = {r["doc_id"]: r for r in docs.collect()}

    def ids(df):
        return sorted(r["doc_id"] for r in df.collect())

    assert all(df.columns == docs.columns for df in (first, second, third, fourth))
    assert ids(first) == sorted(set(text) - {10_001, 10_002})
    assert ids(second) == [i for i, _, _, kept in deduplicated([(i, text[i]["text"]) for i in ids(first)], 5) if kept]
    items = decontam.Items([(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()], decontam.ERROR_RATE)
    assert ids(third) == [i for i in ids(second) if not items.occurrences(decontam.normalised(text[i]["text"]))]
    rows = [(i, text[i]["text"], text[i]["lang"], text[i]["source"]) for i in ids(third)]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    chosen = mixed(rows, 60, 1, size=lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids))
    assert ids(fourth) == sorted(r[0] for r in chosen)
    assert sorted(map(tuple, last.collect())) == expected([(i, text[i]["text"]) for i in ids(fourth)])


def test_run_equals_its_stages(spark):
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, through(spark, docs)[-1].collect()))


def test_nulls_copies_and_empty(spark):
    rng = random.Random(1)
    text = prose(rng, 80)
    rows = [(i, text, "en", "src0", 1) for i in range(5)] + [(None, prose(rng, 50), None, None, None), (2, text, "en", "src0", 1)]
    stages = through(spark, frame(spark, rows))
    assert sorted((r["doc_id"] for r in stages[1].collect()), key=str) == [0, None]
    # Rows without id are copies, and leaks, like any others.
    item = max((r["text"] for r in table(spark, SF_DIR, "benchmark").collect()), key=len)
    other = [(None, text, "en", "src0", 1), (9, text, "en", "src0", 1), (None, f"{prose(rng, 30)} {item} {prose(rng, 30)}", "en", "src0", 1)]
    stages = through(spark, frame(spark, [*other, other[0], (None, prose(rng, 50), None, None, None)]))
    assert sorted((str(r["doc_id"]) for r in stages[1].collect())) == ["9", "None", "None"]
    assert sorted((str(r["doc_id"]) for r in stages[2].collect())) == ["9", "None"]
    assert all(df.count() == 0 for df in through(spark, spark.createDataFrame([], DOCUMENTS)))
