"""Language of a text by unigram pieces, marginalised over segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is
the sum over all ways to cut it into pieces, which the forward algorithm computes; a text's is the
product over its words. The piece probabilities are learned by expectation maximisation over the
same segmentations (forward and backward). A background model in which all pieces are alike tells
texts that look like none of the languages.

Words are runs of letters, lower-cased. Their scores are remembered by the Python worker.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatch.llm.common import stored, tidy, worker_cache

DOCS_PER_LANGUAGE = 500  # labelled documents that train one language, at most
LANGUAGES = 500  # languages to learn from, at most
LONGEST_LEARNED = 64  # letters of a word to learn from, at most
ROUNDS = 3
SMOOTHING = 0.1  # added to the expected count of every piece
CACHE_WORDS = 200_000
RUN_CHARS = 1_000_000  # characters of texts that are scored at once
REJECT_NATS = 10.0  # evidence for the background from which a text is rejected
WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"  # stands before a word in the vocabulary


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def has_letter(text: str | None) -> bool:
    return any(ch.isalpha() for ch in text or "")


def read_vocabulary(path: str) -> list[str]:
    """Pieces of a SentencePiece file, without control, byte and unknown pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    return [sp.id_to_piece(i) for i in ids if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]


class Lattice:
    """All pieces of words: for each place and length the piece's number.

    Number V is the unknown piece, one character that no piece covers; V + 1 is no piece at all.
    """

    def __init__(self, pieces: list[str]):
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        # Pieces are found by a 64-bit polynomial of their characters, many at a time.
        values = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            for code in map(ord, piece):
                values[i] = self._longer(values[i : i + 1], np.uint64(code))[0]
        self.order = np.argsort(values)
        self.values = values[self.order]

    @staticmethod
    def _longer(value: np.ndarray, code) -> np.ndarray:
        value = (value + code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return value ^ (value >> np.uint64(32))

    def of(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions in ``words``, piece numbers [word, place, length - 1]) per word length."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for length, at in by_length.items():
            n = length + 1
            step = max(1, 4_000_000 // (n * self.longest))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                yield np.array(part), self._numbers([MARK + words[i] for i in part], n)

    def _numbers(self, words: list[str], n: int) -> np.ndarray:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.reshape(len(words), n).astype(np.uint64)
        k = min(self.longest, n)
        out = np.full((len(words), n, k), self.none, np.int32)
        value = np.zeros_like(codes)
        for length in range(1, k + 1):
            value = self._longer(value[:, : n - length + 1], codes[:, length - 1 :])
            if len(self.values):
                at = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
                out[:, : n - length + 1, length - 1] = np.where(self.values[at] == value, self.order[at], self.none)
        single = out[:, :, 0]
        single[single == self.none] = self.unknown
        return out


def forward(numbers: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log probability of each word (row) in each model (column of ``p``, whose last row is 0)."""
    words, n, k = numbers.shape
    ahead = [np.ones((words, p.shape[1]))]
    scale = np.zeros((words, p.shape[1]))
    for j in range(1, n + 1):
        total = np.zeros((words, p.shape[1]))
        for length in range(1, min(k, j) + 1):
            total += ahead[j - length] * p[numbers[:, j - length, length - 1]]
        ahead.append(total)
        if j % 8 == 0:  # keep the last sums away from underflow
            most = np.maximum.reduce(ahead[max(0, j - k + 1) :])
            most[most == 0] = 1.0
            for i in range(max(0, j - k + 1), j + 1):
                ahead[i] = ahead[i] / most
            scale += np.log(most)
            for i in range(max(0, j - k - 7), max(0, j - k + 1)):  # needed no more since the last time
                ahead[i] = None
    return np.log(ahead[n]) + scale


def expected_counts(numbers: np.ndarray, weights: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected pieces of weighted words under one model ``p`` (forward and backward sums)."""
    words, n, k = numbers.shape
    boost = np.exp(3.0)  # per character, against underflow; it cancels
    ahead, behind = np.zeros((n + 1, words)), np.zeros((n + 1, words))
    ahead[0] = behind[n] = 1.0
    prob = [[p[numbers[:, i, j]] * boost ** (j + 1) for j in range(min(k, n - i))] for i in range(n)]
    for j in range(1, n + 1):
        for length in range(1, min(k, j) + 1):
            ahead[j] += ahead[j - length] * prob[j - length][length - 1]
    for i in range(n - 1, -1, -1):
        for length in range(1, min(k, n - i) + 1):
            behind[i] += behind[i + length] * prob[i][length - 1]
    factor = np.where(ahead[n] > 0, weights / np.where(ahead[n] > 0, ahead[n], 1.0), 0.0)
    counts = np.zeros(len(p))
    for i in range(n):
        for j in range(min(k, n - i)):
            share = ahead[i] * prob[i][j] * behind[i + j + 1] * factor
            counts += np.bincount(numbers[:, i, j], weights=share, minlength=len(p))
    return counts


def learn(counts: dict[str, Counter], pieces: list[str], rounds: int = ROUNDS) -> dict:
    """The model: languages in order, and piece probabilities [piece, language], background last."""
    lattice, languages = Lattice(pieces), sorted(counts)
    size = len(pieces) + 2
    columns = []
    for language in languages:
        words = [w for w in counts[language] if len(w) <= LONGEST_LEARNED]
        weights = np.array([counts[language][w] for w in words], float)
        groups = [(numbers, weights[at]) for at, numbers in lattice.of(words)]
        p = np.full(size, 1.0 / (size - 1))
        p[-1] = 0.0
        for _ in range(rounds):
            c = sum((expected_counts(numbers, w, p) for numbers, w in groups), np.zeros(size)) + SMOOTHING
            c[-1] = 0.0
            p = c / c.sum()
        columns.append(p)
    background = np.full(size, 1.0 / (size - 1))
    background[-1] = 0.0
    return {"languages": languages, "pieces": pieces, "p": np.stack([*columns, background], axis=1)}


class Scorer:
    def __init__(self, model: dict, key: str):
        self.languages, self.p = model["languages"], model["p"]
        self.cache = worker_cache(f"language:{key}")
        if "lattice" not in self.cache:
            self.cache.clear()
            self.cache["lattice"] = Lattice(model["pieces"])
            self._forget()

    def _forget(self) -> None:
        self.cache["rows"], self.cache["scores"] = {}, np.zeros((1024, self.p.shape[1]))

    def _learn_scores(self, split: list[list[str]]) -> None:
        rows = self.cache["rows"]
        new = list(set().union(*split).difference(rows))
        if new:
            first = len(rows)
            rows.update(zip(new, range(first, first + len(new))))
            scores = self.cache["scores"]
            if len(rows) > len(scores):
                scores = self.cache["scores"] = np.concatenate([scores, np.zeros((len(rows), scores.shape[1]))])
            for at, numbers in self.cache["lattice"].of(new):
                scores[first + at] = forward(numbers, self.p)

    def predict(self, texts: list[str | None]) -> tuple[list, list, list, list]:
        """(language, score, words, accepted) of each text."""
        out: tuple[list, list, list, list] = ([], [], [], [])
        lo = size = 0
        for hi, text in enumerate(texts, 1):
            size += len(text or "")
            if size >= RUN_CHARS or hi == len(texts):
                for column, more in zip(out, self._predict(texts[lo:hi])):
                    column += more
                lo, size = hi, 0
        return out

    def _predict(self, texts: list[str | None]) -> tuple[list, list, list, list]:
        if len(self.cache["rows"]) > CACHE_WORDS:
            self._forget()
        split = [words_of(text) for text in texts]
        self._learn_scores(split)
        languages, scores, sizes, accepted = [], [], [], []
        for text, words in zip(texts, split):
            known = words and (words[0].isalpha() or has_letter(text))
            if not known or not self.languages:
                languages.append("und")
                scores.append(0.0)
                sizes.append(len(words))
                accepted.append(False)
                continue
            at = np.fromiter(map(self.cache["rows"].__getitem__, words), np.int64, len(words))
            total = self.cache["scores"][at].sum(axis=0)
            best = int(np.argmax(total[:-1]))
            languages.append(self.languages[best])
            scores.append(float(1.0 / np.exp(total[:-1] - total[best]).sum()))
            sizes.append(len(words))
            accepted.append(bool(total[-1] - total[best] < REJECT_NATS))
        return languages, scores, sizes, accepted


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            found = Counter()
            for text in texts:
                found.update(words_of(text))
            yield pd.DataFrame({"lang": lang, "word": list(found), "n": list(found.values())})


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, vocabulary: str, per_language: int = DOCS_PER_LANGUAGE, languages: int = LANGUAGES) -> dict:
    """Learn from whole texts with a language that are not held out.

    The sample is bounded: the ``languages`` that most documents have, and of each at most
    ``per_language`` documents, the first in the order of a hash; a cut on that hash bounds what is
    shuffled. What reaches the driver is the word counts of these. Words of more than LONGEST_LEARNED
    letters are scored like any other but not learned from.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(languages)
    order = F.xxhash64("doc_id")
    unit = F.pmod(order, F.lit(1 << 30)) / (1 << 30)
    near = labelled.select("doc_id", "lang", "text").join(F.broadcast(stored(sizes, "language-sizes")), "lang").where(
        unit < 1.5 * per_language / F.col("rows")
    )
    picked = near.select(
        "lang", "text", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id")).alias("r")
    ).where(F.col("r") <= per_language)
    words = picked.select("lang", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        _count_words, "lang string, word string, n long"
    )
    counts: dict[str, Counter] = {}
    for row in words.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(row["lang"], Counter())[row["word"]] = row["n"]
    return learn(counts, read_vocabulary(vocabulary))


def _added(batches: Iterator[pa.RecordBatch], sent, key: str) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(sent.value, key)
    for batch in batches:
        languages, scores, sizes, accepted = scorer.predict(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
             pa.array(sizes, pa.int64()), pa.array(accepted, pa.bool_())],
            ["doc_id", "lang_pred", "score", "n_words", "accepted"],
        )


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score, n_words, accepted.

    ``docs`` has doc_id and text; other columns are not read. ``score`` is the probability of the
    language among the learned ones. Texts that are null or have no letter get ``und``, 0 and are not
    accepted; so do all texts when no language was learned. A text is not accepted either where the
    background explains it far better than any language. Equal scores go to the first language in
    alphabetical order; repeated rows are judged each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = str(hash(model["p"].tobytes()))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = slim.mapInArrow(
        lambda it: tidy(_added(it, sent, key)), "doc_id long, lang_pred string, score double, n_words long, accepted boolean"
    )
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words", "accepted")


def accepted_rows(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is accepted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key, at = str(hash(model["p"].tobytes())), docs.columns.index("text")

    def kept(batches):
        scorer = Scorer(sent.value, key)
        for batch in batches:
            yield batch.filter(pa.array(scorer.predict(batch.column(at).to_pylist())[3], pa.bool_()))

    return docs.mapInArrow(lambda it: tidy(kept(it)), docs.schema)
