"""The corpus operators as queries over whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, hard_negatives, license_scan, line_dedup, merkle, mixing, ngram_join, quality, secrets_scan, telephony, url_filter, warc
from .common import table
from .oracles import ORACLES

RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]
#: Hosts that are blocked, with their subdomains, where no rule fits: enough for several levels of the cascade.
LISTED_HOSTS = ["spam-farm.example.org", "spam-farm.example.net", *(f"spam{k}.example.org" for k in range(3000))]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES, LISTED_HOSTS)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.find_secrets(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digest(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.media_digest(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every line with a word takes part; only blank lines stay whatever comes before.
    rows = line_dedup.removed_lines(table(spark, sf_dir, "documents"), least_words=1)
    return rows.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_groups(exact_dedup.with_digest(docs), carry=("text_sha256",))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), anchors=F.col("vec_id") % 50 == 0)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_secret_scan, op3_mixing, op4_bpe, op5_media, op6_quality, op7_ngram_join, op8_license_scan, op9_line_dedup, op10_exact_dedup, op11_hard_negatives, op12_warc, op13_merkle_manifest)
}

ORACLE_SQL: dict[str, str] = {k: v for k, v in ORACLES.items() if k in QUERIES}
