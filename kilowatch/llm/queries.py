"""One registered query per operator, over the whole given tables, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kilowatch.llm import licences, mixing, prefixtrie, quality, vectorcodes
from kilowatch.llm.common import table
from kilowatch.session import scratch_path

# Rules of the URL query: verdict and host/path.
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    from kilowatch.llm.langid import identify, train

    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs, vocabulary_file()))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by 2-word shingles at 80 percent."""
    from kilowatch.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot, size and checksum of every document."""
    from kilowatch.llm.sharding import document_shards

    return document_shards(table(spark, sf_dir, "documents"), shards=8)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page by rules, or else by trees trained on the pages under a rule."""
    from kilowatch.llm.urlfilter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every 50th vector."""
    from kilowatch.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for 60 percent of all tokens at the target weights, two epochs at most."""
    from pyspark.sql import functions as F

    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.domain_of(F.col("source")), mixing.estimated_tokens(F.col("text")), mixing.WEIGHTS)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document as read back from the token files."""
    from kilowatch.llm.tokenpack import read_documents, write_tokens

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=2)
    return read_documents(spark, path)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from kilowatch.llm.htmltext import main_text, train

    pages = table(spark, sf_dir, "pages")
    return main_text(pages, train(pages))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document, within the edit budget."""
    from kilowatch.llm.decontam import benchmark_hits

    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences and licence sentences of every document."""
    from kilowatch.llm.licences import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict for every document."""
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector in 16 parts of 64 entries, refined twice."""
    return vectorcodes.code_report(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_sharding": op3_sharding,
    "op4_url_filter": op4_url_filter,
    "op5_topk_search": op5_topk_search,
    "op6_mixing": op6_mixing,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_license_scan": op9_license_scan,
    "op10_main_text": op10_main_text,
    "op11_quality_rules": op11_quality_rules,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES = {
    "op6_mixing": mixing.oracle(),
    "op9_license_scan": licences.oracle(),
    "op11_quality_rules": quality.oracle(),
    "op12_vector_codes": vectorcodes.oracle(),
    "op13_conversation_trie": prefixtrie.oracle(),
    "op5_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.f, c.f)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
