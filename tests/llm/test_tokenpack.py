import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kilowatch.llm import tokenpack
from kilowatch.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.fixtures import TOKENIZER, documents, frame, with_clashes


@pytest.mark.parametrize("width", [1, 3, 7, 8, 12, 16, 17, 20, 31])
def test_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 500)
    payload = tokenpack.pack(ids, width)
    assert len(payload) == -(-500 * width // 8)
    assert tokenpack.unpack(payload, width, 0, 500).tolist() == ids.tolist()
    assert tokenpack.unpack(payload, width, 123, 77).tolist() == ids[123:200].tolist()
    assert tokenpack._pack_fast(ids, width) == payload
    assert tokenpack._unpack_fast(payload, width, 3, 90).tolist() == ids[3:93].tolist()


def test_no_id_is_cut():
    with pytest.raises(ValueError):
        tokenpack.pack(np.array([8]), 3)
    assert [tokenpack.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_encoder_equals_the_tokenizer(monkeypatch):
    rng = random.Random(4)
    parts = ["a", "é", " ", "  ", "\n", "'", "s", "'s", "1", "²", ",", ".", "a.", "!", "\t", " ", "日", "😀", "<|", "|>", "endoftext", "\x1f", "İ", "ß"]
    texts = ["", " ", "a b", "of.\nThe end,", "a\n\nb c", "<|endoftext|> a", "a <|endoftext|>b", "don't they'll 's"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    want = [e.ids for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]
    encoder = tokenpack.Encoder(TOKENIZER)
    monkeypatch.setattr(tokenpack, "CACHE_WORDS", 50)  # forgets often
    for lo in range(0, len(texts), 700):
        ids, sizes = encoder.encode(pa.array(texts[lo : lo + 700]))
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == want[lo : lo + 700]


def expected(rows, end_id=2):
    tokenizer, out, start = Tokenizer.from_file(TOKENIZER), [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_given_documents(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    tokenpack.write_tokens(docs.repartition(6), str(tmp_path / "t"), TOKENIZER)
    got = sorted(map(tuple, tokenpack.read_documents(spark, str(tmp_path / "t")).collect()))
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_blocks_ranges_and_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenpack, "BLOCK_IDS", 16)
    monkeypatch.setattr(tokenpack, "SLICE_BYTES", 40)
    texts = ["word " * (i % 9) + "end" for i in range(60)] + [None, "", "x " * 3000]
    docs = with_clashes(documents(spark, texts), "part", "start", "hash", "tie", "payload")
    path = str(tmp_path / "t")
    tokenpack.write_tokens(docs, path, TOKENIZER)
    rows = sorted(tokenpack.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r["doc_id"])
    assert [tuple(r)[:4] for r in rows] == expected(list(enumerate(texts)))
    everything = [i for r in rows for i in r["ids"]]
    blocks = tokenpack.read_blocks(spark, path).collect()
    assert all(b["width"] == 16 and len(b["payload"]) == 2 * b["n_ids"] for b in blocks) and len(blocks) > 10
    got = sorted(map(tuple, tokenpack.read_range(spark, path, 37, 400).collect()))
    assert got == [(p, everything[p]) for p in range(37, 437)]


def test_repeated_rows_null_ids_and_empty_table(spark, tmp_path):
    path = str(tmp_path / "e")
    tokenpack.write_tokens(frame(spark, []), path, TOKENIZER)
    assert tokenpack.read_documents(spark, path).collect() == []
    rows = [(1, "same text", "en", "s", 9)] * 30 + [(1, "other", "en", "s", 5), (None, "no id", None, None, None)]
    path = str(tmp_path / "r")
    tokenpack.write_tokens(frame(spark, rows).repartition(5), path, TOKENIZER)
    got = sorted(tokenpack.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == 32 and got[0]["doc_id"] is None
    for a, b in zip(got, got[1:]):
        assert b["start"] == a["start"] + a["n_tokens"]


def test_table_of_strings():
    """Keys tell strings apart by every byte, length and kind; the older half goes, the rest stays."""
    strings = ["", "a", "b", "ab", "ba", "aa", "a\x00", "\x00a", "é" * 300, "日本"]
    keys = {tuple(k) for salt in (0, 1) for k in tokenpack.string_keys(pa.array(strings), salt).tolist()}
    assert len(keys) == 2 * len(strings)
    assert tokenpack.string_keys(pa.array(["x", *strings])[1:]).tolist() == tokenpack.string_keys(pa.array(strings)).tolist()
    table = tokenpack.IdTable(np.uint16)
    rng = random.Random(1)
    kept = {}
    for turn in range(30):
        new = [f"w{turn}-{i}" for i in range(50)]
        ids = [[rng.randrange(2**16) for _ in range(rng.randint(0, 4))] for _ in new]
        kept.update(zip(new, ids))
        numbers = table.add(tokenpack.string_keys(pa.array(new)), np.array(sum(ids, []), np.uint32), np.array([len(x) for x in ids]))
        assert table.get(numbers).tolist() == sum(ids, [])
        if turn == 20:
            table.drop_older_half()
    names = list(kept)
    found = table.find(tokenpack.string_keys(pa.array(names)))
    assert (found[-900:] >= 0).all() and (found[:500] < 0).all()
    for name, n in zip(names, found):
        if n >= 0:
            assert table.get(np.array([n])).tolist() == kept[name]


def test_long_words_and_cut_tables(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(tokenpack, "LONG_WORD", 12)
    monkeypatch.setattr(tokenpack, "CACHE_IDS", 300)
    letters = ["abc", "de", "é", "ü.", ",\n", "!", "12", "\nZ", "#$", "'s"]
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    want = [e.ids for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]
    encoder = tokenpack.Encoder(TOKENIZER)
    for lo in range(0, len(texts), 37):
        ids, sizes = encoder.encode(pa.array(texts[lo : lo + 37]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want[lo : lo + 37]
