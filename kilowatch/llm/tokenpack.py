"""Token files: ids in the fewest bits that hold the vocabulary, in blocks with known offsets.

A token table is a folder of Parquet files, one row per block:

  part       range of documents, ascending by doc_id
  start      ids of the part before this block
  n_ids      ids in the block
  width      bits of an id
  payload    the ids, ``width`` bits each, most significant bit first, zero bits up to a byte
  doc_ids    documents of the block in order; doc_starts: where each begins inside the block

Blocks hold whole documents, so any block, document or id range can be unpacked by itself with numpy:
id ``i`` stands at bit ``i * width``. The width follows from the vocabulary, so no id is ever cut.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatch.llm.common import row_shares, tidy, worker_cache

BLOCK_IDS = 1 << 16  # ids after which a block is closed
SLICE_BYTES = 2 << 20  # text that is encoded at once
CACHE_WORDS = 1_000_000  # strings whose ids one Python worker remembers, in some 35 bytes each
CACHE_IDS = 4 * CACHE_WORDS
MARKS = ".,;:!?%*#&$"  # punctuation that starts a new piece after a letter
LONG_WORD = 256  # bytes from which a string is not remembered
BLOCKS = "start long, n_ids long, width int, payload binary, doc_ids array<long>, doc_starts array<long>"
ARROW_BLOCKS = pa.schema([
    ("start", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("payload", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
])


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, most significant bit first."""
    ids = np.asarray(ids, dtype=np.uint32)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {ids.max()} needs more than {width} bits")
    octets = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    bits = np.unpackbits(octets, axis=1)[:, 32 - width :]
    return np.packbits(bits.ravel()).tobytes()


def unpack(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from the ``start``-th on; reads only the bytes that hold them."""
    first, last = start * width, (start + n) * width
    octets = np.frombuffer(payload, np.uint8, count=-(-last // 8) - first // 8, offset=first // 8)
    bits = np.unpackbits(octets)[first % 8 :][: n * width].reshape(n, width)
    out = np.zeros((n, 32), np.uint8)
    out[:, 32 - width :] = bits
    return np.packbits(out, axis=1).view(">u4").ravel().astype(np.uint32)


def _pack_fast(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(">u2").tobytes() if width == 16 else pack(ids, width)


def _unpack_fast(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    if width == 16:  # the same bits, without taking them apart
        return np.frombuffer(payload, ">u2", count=n, offset=2 * start).astype(np.uint32)
    return unpack(payload, width, start, n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i] … starts[i] + lengths[i] - 1 of all i, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def tails(strings: pa.Array, heads: pa.Array) -> pa.Array:
    """What follows ``heads``, the start of each string."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset :][: len(strings) + 1]
    lengths, cut = np.diff(offsets), np.asarray(pc.binary_length(heads), np.int64)
    octets = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    data = octets[ragged(offsets[:-1] + cut, lengths - cut)]
    ends = np.concatenate([[0], np.cumsum(lengths - cut)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(strings), pa.py_buffer(ends), pa.py_buffer(data))


def _multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers, one per position of a byte."""
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(m)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def string_keys(strings: pa.Array, salt: int = 0) -> np.ndarray:
    """Two 64-bit hash values per string, as columns; both name it."""
    if len(strings) == 0:
        return np.zeros((0, 2), np.uint64)
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset :][: len(strings) + 1]
    lengths = np.diff(offsets)
    octets = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
    starts = offsets[:-1] - offsets[0]
    out = np.zeros((len(strings), 2), np.uint64)
    full = np.flatnonzero(lengths)
    if len(full):
        at = np.arange(len(octets)) - np.repeat(starts, lengths)
        for column in (0, 1):
            out[full, column] = np.add.reduceat(octets * _multipliers(int(lengths.max()), column)[at], starts[full])
    return out + (lengths.astype(np.uint64) + np.uint64(salt << 32))[:, None] * np.uint64(0xD6E8FEB86659FD93)


class IdTable:
    """The ids of many strings, by number, and the numbers by the strings' keys, in plain arrays."""

    def __init__(self, dtype):
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # keys, ordered by the first
        self.numbers = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, dtype), 0

    def __len__(self) -> int:
        return len(self.lengths)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the strings; -1 if unknown."""
        if not len(self.first):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.first, keys[:, 0]), len(self.first) - 1)
        same = (self.first[at] == keys[:, 0]) & (self.second[at] == keys[:, 1])
        return np.where(same, self.numbers[at], -1).astype(np.int64)

    def add(self, keys: np.ndarray | None, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of new entries; without keys they are found by number only, until ``cut``."""
        first, end = len(self.lengths), self.used + len(ids)
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(end - len(self.pool), len(self.pool) // 2), self.pool.dtype)])
        self.pool[self.used : end] = ids
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.used = end
        numbers = np.arange(first, first + len(lengths))
        if keys is not None:
            self._index(
                np.concatenate([self.first, keys[:, 0]]), np.concatenate([self.second, keys[:, 1]]),
                np.concatenate([self.numbers, numbers.astype(np.int32)]),
            )
        return numbers

    def _index(self, first: np.ndarray, second: np.ndarray, numbers: np.ndarray) -> None:
        order = np.argsort(first, kind="stable")
        self.first, self.second, self.numbers = first[order], second[order], numbers[order]

    def get(self, numbers: np.ndarray) -> np.ndarray:
        return self.pool[ragged(self.starts[numbers], self.lengths[numbers].astype(np.int64))]

    def cut(self, size: int) -> None:
        """Forget the entries from number ``size`` on, which have no keys."""
        if size < len(self):
            self.used = int(self.starts[size])
            self.starts, self.lengths = self.starts[:size], self.lengths[:size]

    def drop_older_half(self) -> None:
        gone = len(self) // 2
        ids, lengths = self.get(np.arange(gone, len(self))), self.lengths[gone:].copy()
        kept = self.numbers >= gone
        first, second, numbers = self.first[kept], self.second[kept], self.numbers[kept] - gone
        self.__init__(self.pool.dtype)
        self.add(None, ids, lengths)
        self._index(first, second, numbers)


def parts_of(word: str) -> list[tuple[str, bool]]:
    """Strings that may be encoded apart, which make up the word with a space before it.

    The tokenizer's pattern always starts a new piece at a lone line end, and at punctuation (no
    apostrophe) after a letter. True stands with a string that needs a space before it.
    """
    out = []
    for i, line in enumerate(word.split("\n")):
        if not line or line[0].isspace() or line[-1].isspace():
            return [(word, True)]
        base = line.rstrip(MARKS)
        apart = len(base) < len(line) and base[-1:].isalpha()
        out.append(("\n" + (base if apart else line), False) if i else (base if apart else line, True))
        if apart:
            out.append((line[len(base) :], False))
    return out


class Encoder:
    """Whole texts to ids, with the ids of words kept by the Python worker.

    The tokenizer's pattern always starts a new piece at a single space between two other
    characters, so a text falls into words, each with its leading space, that are encoded apart and
    once. A text with other white space at such a place, or with the opening of a special token, is
    encoded as one. A full table forgets the older half of its words.
    """

    def __init__(self, path: str):
        self.cache = worker_cache(f"ids:{path}")
        if "tokenizer" not in self.cache:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores have tasks of their own
            self.cache["tokenizer"] = tokenizer = Tokenizer.from_file(path)
            self.cache["line_end"] = tokenizer.encode("\n", add_special_tokens=False).ids
            small = tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
            self.cache["table"] = IdTable(np.uint16 if small else np.uint32)

    def _raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings and their number for each, a few thousand strings at a time."""
        ids: list[np.ndarray] = [np.zeros(0, np.uint32)]
        lengths: list[int] = []
        for lo in range(0, len(texts), 2048):
            some = [e.ids for e in self.cache["tokenizer"].encode_batch_fast(texts[lo : lo + 2048], add_special_tokens=False)]
            sizes = list(map(len, some))
            ids.append(np.fromiter(chain.from_iterable(some), np.uint32, sum(sizes)))
            lengths += sizes
        return np.concatenate(ids), np.array(lengths, np.int64)

    def _lines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for strings of printable characters, with a line end between them for speed."""
        if len(self.cache["line_end"]) != 1:
            return self._raw(texts)
        ids, _ = self._raw(["\n".join(texts[lo : lo + 50]) + "\n" for lo in range(0, len(texts), 50)])
        ends = np.flatnonzero(ids == self.cache["line_end"][0])
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learned(self, strings: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new strings, with a space before each if ``spaced``; none for odd words."""
        if not spaced:
            return self._raw(strings.to_pylist())
        if not len(strings):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # Words that are lines of letters with punctuation behind them, which is nearly all, are taken
        # apart in columns: letters are learned once, whatever follows them.
        split = pc.split_pattern(strings.cast(pa.large_string()), "\n")
        bounds, lines = np.asarray(split.offsets, np.int64), split.flatten()
        stems = pc.utf8_rtrim(lines, characters=MARKS)
        marks = tails(lines, stems)
        letters = np.asarray(pc.utf8_is_alpha(stems))
        plain = np.logical_and.reduceat(letters, bounds[:-1])
        marked = np.asarray(pc.binary_length(marks)) > 0
        alone = plain & (np.diff(bounds) == 1) & ~marked[bounds[:-1]]
        clear, apart, rest = np.flatnonzero(alone), np.flatnonzero(plain & ~alone), np.flatnonzero(~plain)
        lengths = np.zeros(len(strings), np.int64)
        pieces = [(clear, *self._lines([" " + w for w in strings.take(pa.array(clear)).to_pylist()]))]
        if len(apart):
            counts = np.diff(bounds)[apart]
            at = ragged(bounds[:-1][apart], counts)
            first = np.zeros(len(at), bool)
            first[np.cumsum(counts) - counts] = True
            own = stems.take(pa.array(at))
            numbers = np.full((len(at), 2), -1, np.int64)  # of the letters, of the marks behind them
            numbers[first, 0] = self._distinct(own.filter(pa.array(first)), True)
            line_end, none = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
            later = pc.binary_join_element_wise(line_end, own.filter(pa.array(~first)), none)
            numbers[~first, 0] = self._distinct(later, False)
            numbers[marked[at], 1] = self._distinct(marks.take(pa.array(at[marked[at]])), False)
            pieces.append((apart, *self._composed(numbers.ravel(), 2 * counts)))
        if len(rest):
            pieces += self._others(strings.take(pa.array(rest)).to_pylist(), rest)
        for places, _, sizes in pieces:
            lengths[places] = sizes
        out = np.zeros(int(lengths.sum()), np.uint32)
        starts = np.cumsum(lengths) - lengths
        for places, ids, sizes in pieces:
            out[ragged(starts[places], sizes)] = ids
        return out, lengths

    def _others(self, texts: list[str], places: np.ndarray) -> list[tuple]:
        """The same for words with digits, apostrophes or anything else: (places, ids, sizes)."""
        whole, split, parts = [], [], []
        for i, w in enumerate(texts):
            if w and not w[0].isspace() and not w[-1].isspace() and "<|" not in w:
                found = parts_of(w)
                if len(found) == 1:
                    whole.append(i)
                else:
                    split.append(i)
                    parts.append(found)
        pieces = [(places[whole], *self._raw([" " + texts[i] for i in whole]))]
        if split:
            flat = [p for found in parts for p in found]
            numbers = np.zeros(len(flat), np.int64)
            for kind in (True, False):
                at = [i for i, p in enumerate(flat) if p[1] == kind]
                numbers[at] = self._distinct(pa.array([flat[i][0] for i in at], pa.large_string()), kind)
            pieces.append((places[split], *self._composed(numbers, np.fromiter(map(len, parts), np.int64, len(parts)))))
        return pieces

    def _distinct(self, strings: pa.Array, spaced: bool) -> np.ndarray:
        """Numbers of strings of which some may be equal."""
        if not len(strings):
            return np.zeros(0, np.int64)
        found = strings.dictionary_encode()
        return self._numbers(found.dictionary, spaced)[np.asarray(found.indices)]

    def _composed(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings made of ``counts`` parts each; a part of number -1 is none."""
        table, taken = self.cache["table"], numbers >= 0
        sizes = np.where(taken, table.lengths[numbers], 0).astype(np.int64)
        return table.get(numbers[taken]), np.add.reduceat(sizes, np.cumsum(counts) - counts)

    def _numbers(self, strings: pa.Array, spaced: bool = True) -> np.ndarray:
        """Numbers of distinct strings in the table; new ones are learned."""
        table, keys = self.cache["table"], string_keys(strings, 0 if spaced else 1)
        numbers = table.find(keys)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            ids, lengths = self._learned(strings.take(pa.array(new)), spaced)
            numbers[new] = table.add(keys[new], ids, lengths)
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number for each text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        table = self.cache["table"]
        if len(table) > CACHE_WORDS or table.used > CACHE_IDS:
            table.drop_older_half()
        split = pc.split_pattern(texts, " ")
        bounds = np.asarray(split.offsets, np.int64)
        found = split.flatten().dictionary_encode()
        unique, at = found.dictionary, np.asarray(found.indices)
        short = np.asarray(pc.less(pc.binary_length(unique), LONG_WORD))
        numbers = np.zeros(len(unique), np.int64)
        numbers[short] = self._numbers(unique.filter(pa.array(short)))
        long = self._learned(unique.filter(pa.array(~short)), True)  # seen once, most likely
        size = len(table)  # what is added from here on is not remembered
        numbers[~short] = table.add(None, *long)
        odd = table.lengths[numbers] == 0
        # The first word of a text has no space before it; a text with an odd word is encoded whole.
        firsts = bounds[:-1]
        heads = unique.take(pa.array(at[firsts])).to_pylist()
        words = numbers[at]
        apart = odd[at]
        apart[firsts] = odd[at[firsts]]
        for i in np.flatnonzero(np.logical_or.reduceat(apart, firsts)):
            words[bounds[i] : bounds[i + 1]] = -1
            heads[i] = texts[int(i)].as_py()
        words[firsts] = table.add(None, *self._raw(heads))
        out, sizes = self._composed(words, np.diff(bounds))
        table.cut(size)
        return out, sizes


def _slices(batches: Iterator[pa.RecordBatch], column: int | str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about SLICE_BYTES of text."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)), np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_BYTES, "right"))
            yield batch.slice(lo, max(hi, lo + 1) - lo)
            lo = max(hi, lo + 1)


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, width: int) -> Iterator[pa.RecordBatch]:
    encoder, start = Encoder(path), 0
    ids, sizes, docs = np.zeros(0, np.uint32), np.zeros(0, np.int64), []

    def block(ids: np.ndarray, sizes: np.ndarray, docs: list) -> pa.RecordBatch:
        nonlocal start
        row = {
            "start": start, "n_ids": len(ids), "width": width, "payload": _pack_fast(ids, width),
            "doc_ids": docs, "doc_starts": (np.cumsum(sizes) - sizes).tolist(),
        }
        start += len(ids)
        return pa.RecordBatch.from_pylist([row], schema=ARROW_BLOCKS)

    for batch in _slices(batches):
        more, n = encoder.encode(batch.column("text"))
        if end_id is not None:
            ended = np.full(len(more) + len(n), end_id, np.uint32)
            ended[np.arange(len(more)) + np.repeat(np.arange(len(n)), n)] = more
            more, n = ended, n + 1
        ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, n])
        docs += batch.column("doc_id").to_pylist()
        ends, lo = np.cumsum(sizes), 0
        while lo < len(sizes):
            before = int(ends[lo - 1]) if lo else 0
            hi = int(np.searchsorted(ends, before + BLOCK_IDS, "left")) + 1  # the document that fills it
            if hi > len(sizes):
                break
            yield block(ids[before : ends[hi - 1]], sizes[lo:hi], docs[lo:hi])
            lo = hi
        ids, sizes, docs = ids[int(ends[lo - 1]) if lo else 0 :], sizes[lo:], docs[lo:]
    if len(sizes):
        yield block(ids, sizes, docs)


def _counted(batches: Iterator[pa.RecordBatch], path: str, at: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        names = [*batch.schema.names, "n"]
        text = pc.fill_null(batch.column(at), "")
        batch = pa.RecordBatch.from_arrays([*batch.columns, text], names=[*names[:-1], "text_"])
        for some in _slices(iter([batch]), len(batch.columns) - 1):
            sizes = encoder.encode(some.column(some.num_columns - 1))[1]
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(sizes, pa.int64())], names=names)


def with_token_counts(docs: DataFrame, tokenizer: str, name: str) -> DataFrame:
    """The rows, all columns, with the number of ids of their whole text as ``name``; a null text has none."""
    at, schema = docs.columns.index("text"), docs.withColumn(name, F.lit(0).cast("long")).schema
    return docs.mapInArrow(lambda it: tidy(_counted(it, tokenizer, at)), schema)


def vocabulary_size(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2) -> None:
    """Encode every whole text and write the token table in ascending ``doc_id`` order.

    ``docs`` has doc_id and text; other columns are not read. A null text counts as empty; a null
    doc_id sorts first; rows of one doc_id follow the hash of their text, and equal rows are
    interchangeable, so many of them spread over several parts. Every worker needs the tokenizer
    file at the same path.
    """
    width = bits_for(max(vocabulary_size(tokenizer), (end_id or 0) + 1))
    text = F.coalesce(docs["text"], F.lit(""))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "hash", "tie").sortWithinPartitions("doc_id", "hash", "tie")
        .select("doc_id", "text")
    )
    blocks = ordered.mapInArrow(lambda it: tidy(_blocks(it, tokenizer, end_id, width)), BLOCKS)
    blocks.select(F.spark_partition_id().alias("part"), "*").write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``block_start``: ids of all documents before the block."""
    blocks = spark.read.schema("part int, " + BLOCKS).parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return blocks.join(F.broadcast(row_shares(sizes, "part", "n")), "part").withColumn(
        "block_start", F.col("before") + F.col("start")
    )


def _documents(batches: Iterator[pd.DataFrame], with_ids: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for b in batch.itertuples():
            ids = _unpack_fast(b.payload, b.width, 0, b.n_ids).astype("<u4")
            raw = memoryview(ids.tobytes())
            starts = np.asarray(b.doc_starts, np.int64)
            ends = np.append(starts[1:], b.n_ids)
            out = {
                "doc_id": pd.array([None if pd.isna(d) else int(d) for d in b.doc_ids], dtype="Int64"),
                "start": b.block_start + starts, "n_tokens": ends - starts,
                "ids_crc32": [zlib.crc32(raw[4 * lo : 4 * hi]) for lo, hi in zip(starts, ends)],
            }
            if with_ids:
                out["ids"] = [ids[lo:hi].astype(np.int64) for lo, hi in zip(starts, ends)]
            yield pd.DataFrame(out)


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked, ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    blocks = read_blocks(spark, path).select("block_start", "n_ids", "width", "payload", "doc_ids", "doc_starts")
    return blocks.mapInPandas(lambda it: tidy(_documents(it, with_ids)), schema)


def read_range(spark: SparkSession, path: str, start: int, n: int) -> DataFrame:
    """Ids ``start`` to ``start + n - 1`` of the whole corpus as rows (position, id)."""

    def cut(batches):
        for batch in batches:
            for b in batch.itertuples():
                lo = max(start - b.block_start, 0)
                hi = min(start + n - b.block_start, b.n_ids)
                if hi > lo:
                    at = b.block_start + np.arange(lo, hi)
                    yield pd.DataFrame({"position": at, "id": unpack(b.payload, b.width, lo, hi - lo).astype(np.int64)})

    touched = read_blocks(spark, path).where(
        (F.col("block_start") < start + n) & (F.col("block_start") + F.col("n_ids") > start)
    )
    return touched.select("block_start", "n_ids", "width", "payload").mapInPandas(cut, "position long, id long")
