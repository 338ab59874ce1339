"""The queries of this folder, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, embed_dedup, langid, lexical_search, ngram_join, rank_bpe, runs, secrets, sharding, substring_dedup, token_counts, url_filter
from .base import table

#: The vocabularies of op4, op5 and op11, by their names in the installed package of public tokenizers.
BPE_FILE, UNIGRAM_FILE, RANK_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BPE_FILE))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(UNIGRAM_FILE))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles")


def op11_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(RANK_FILE))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_sharding,
        op3_secret_scan,
        op4_bpe_round_trip,
        op5_token_counts,
        op6_language_id,
        op7_substring_dedup,
        op8_url_filter,
        op9_embedding_near_dedup,
        op10_decontamination,
        op11_rank_queue_bpe,
        op12_lexical_search,
        op13_periodic_runs,
    )
}
ORACLES = {"op1_ngram_jaccard_join": ngram_join.SQL, "op7_substring_dedup": substring_dedup.SQL, "op8_url_filter": url_filter.sql(), "op9_embedding_near_dedup": embed_dedup.SQL, "op12_lexical_search": lexical_search.SQL, "op13_periodic_runs": runs.SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
