"""Small tables for the operators' tests."""

from __future__ import annotations

import random

import public_tokenizers

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou".split(),
    "de": "en er ch ei un sch ge ung ein auf ü ä ß keit zu ver lich nicht".split(),
    "fr": "es le ent que ais é è ê ou eau eux tion oi la ch".split(),
}


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words)


def frame(spark, rows, schema=DOCUMENTS):
    return spark.createDataFrame(rows, schema)


def documents(spark, texts, **columns):
    """Documents with ids from 0; further columns by name."""
    lang, source = columns.get("lang", "en"), columns.get("source", "src0")
    return frame(spark, [(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)])


def with_clashes(df, *names):
    """The same rows with further columns of the names that an operator uses or returns."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(n) for n in names if n not in df.columns])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
