"""From raw documents to a training corpus: language, near duplicates, benchmark leaks, secrets, tokens.

Stages judge rows, not ids: a null id, or one that several texts have, changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.llm import bpe, decontaminate, langid, ngram_join, secrets
from tomeworks.llm.base import discard, stash, table
from tomeworks.llm.registry import BPE_FILE, tokenizer_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell: those it calls `und` go. Learns from the stage's own input."""
    return langid.known(docs, langid.fit(docs.select("doc_id", "text", "lang").where(~langid.held_out(F.col("doc_id")))))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return ngram_join.one_row_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and n_chars of the text that is left."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, tokenizer_path(BPE_FILE))


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("bpe", encode),
]
#: Stages use models and tokenizers that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        docs, read = stash(stage(spark, docs, sf_dir), "snappy"), docs
        if n:
            discard(read)
    return STAGES[-1][1](spark, docs, sf_dir)
