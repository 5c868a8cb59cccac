import zlib
from collections import Counter

import pytest

from kilowatch.llm import sharding
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import DOCUMENTS, documents, frame, with_clashes


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_one_to_one(n):
    places = [sharding.locate(i, n, 4, seed=3) for i in range(n)]
    assert len(set(places)) == n
    assert all(0 <= shard + 4 * slot < n for shard, slot in places)
    assert [sharding.row_number_at(s, t, n, 4, seed=3) for s, t in places] == list(range(n))


def test_walk_limit_is_enough():
    for n in range(1, 400):
        (a, b), keys, longest = sharding.sides(n), sharding.round_keys(1), 0
        for x in range(n):
            steps, y = 1, sharding.permute_once(x, a, b, keys)
            while y >= n:
                steps, y = steps + 1, sharding.permute_once(y, a, b, keys)
            longest = max(longest, steps)
        assert longest <= sharding.walk_limit(n)


def test_column_equals_plain_python(spark):
    docs = table(spark, SF_DIR, "documents")
    got = sharding.document_shards(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    n = len(texts)
    assert sorted(r["row_number"] for r in got) == list(range(n))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["row_number"])] == sorted(texts)
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["shard"], r["slot"]) == sharding.locate(r["row_number"], n, 8, 20)
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_counts_slots_nulls_and_copies(spark):
    docs = frame(spark, [(None, None, None, None, None)] + [(5, "same", "en", "s", 4)] * 60 + [(i, "x" * i, "en", "s", i) for i in range(40)])
    got = sharding.document_shards(with_clashes(docs, "shard", "slot", "size", "tie", "part", "at", "before")).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 101 and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(counts[shard]))
    assert [r["size"] for r in got if r["doc_id"] is None] == [1]


def test_empty_and_repeatable(spark):
    assert sharding.document_shards(frame(spark, [])).collect() == []
    docs = documents(spark, [f"text {i}" for i in range(50)])
    first, second = (sorted(map(tuple, sharding.document_shards(d).collect())) for d in (docs, docs.repartition(7)))
    assert first == second


def test_written_shards(spark, tmp_path):
    docs = documents(spark, [f"text {i}" for i in range(50)])
    sharded = sharding.shard_rows(docs.select("doc_id", "text"), ["doc_id"], shards=3)
    sharding.write_shards(sharded, str(tmp_path / "s"), rows_per_file=5)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((int(r["shard"]), r["slot"], r["text"]) for r in back.collect()) == sorted((r["shard"], r["slot"], r["text"]) for r in sharded.collect())
    assert DOCUMENTS.startswith("doc_id")
