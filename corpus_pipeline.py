"""From documents to token ids: quality, exact copies, near copies, mixing, encoding.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe, common, exact_dedup, mixing, ngram_join, quality
from tallyloom.llm.common import remove_tables, table, written
from tallyloom.llm.queries import vocabulary_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Its evidence is fitted on labelled documents of this stage's input.
    Null and empty texts are judged like any other; without labels of both kinds all rows stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null as empty) the row with the largest id stays, null ids last; of its repeats one."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays; null and empty texts and null ids link nothing and stay."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; texts without words aren't taken; null sources are one source."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and token ids of each document of the mix, repeats included, and the digest of the text that the ids
    decode to. Null texts have no ids; an empty mix stays empty."""
    rows = docs.select("doc_id", "source", "text")
    coded = bpe.encode_column(rows, vocabulary_path(), decoded_col="decoded_sha256")
    return coded.selectExpr("doc_id", "source", "cast(size(token_ids) as long) as n_tokens", "token_ids", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express the classifier and the encoding; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage has written for itself goes once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before = len(common.made)
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        remove_tables(spark, since=before - (k > 0), but=1)
    return STAGES[-1][1](spark, docs, sf_dir)
