"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bitmap, bits_for, broadcast_if_small, maybe_in, whole_text, written

PREFIX_CHARS = 512


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, filter_bits: int | None = None) -> DataFrame:
    """docs with the columns dd_len, dd_prefix and dd_full.

    The first pass counts lengths. Only rows whose length occurs twice get a hash of their first characters (dd_prefix),
    and only rows whose (length, prefix hash) occurs twice get the SHA-256 of the whole text (dd_full); both are null
    otherwise. What survives reaches the next pass as a bitmap with 16 bits for each survivor, up to a fixed size; a bit
    set by chance costs one more hash and changes no result."""
    text = whole_text(text_col)  # lower-casing A-Z changes no length
    rows = docs.select("*", F.length(text).alias("dd_len"))
    lengths = written(rows.groupBy("dd_len").count().filter("count > 1").select("dd_len"), "dedup-lengths")
    bits = filter_bits or bits_for(lengths.count())
    rows = maybe_in(rows, F.col("dd_len"), bitmap(lengths, "dd_len", bits), bits, "dd_two")
    start = F.xxhash64(ascii_lower(F.substring(text, 1, prefix_chars)))
    rows = rows.withColumn("dd_prefix", F.when(F.col("dd_two"), start)).drop("dd_two")
    pair = F.struct("dd_len", "dd_prefix")
    pairs = rows.filter("dd_prefix is not null").groupBy("dd_len", "dd_prefix").count().filter("count > 1").select(pair.alias("k"))
    pairs = written(pairs, "dedup-prefixes")
    bits = filter_bits or bits_for(pairs.count())
    rows = maybe_in(rows, pair, bitmap(pairs, "k", bits), bits, "dd_maybe")
    full = F.when(F.col("dd_prefix").isNotNull() & F.col("dd_maybe"), F.sha2(ascii_lower(text), 256))
    return rows.withColumn("dd_full", full).drop("dd_maybe")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), **how) -> DataFrame:
    """One row per row of docs: id, keep_id (largest id of the equal texts), group_size, kept, and the columns in carry.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text. Repeated rows of one id count
    in group_size and are all kept or all dropped. Null ids rank below all others; a group of null ids only keeps them.
    An empty table gives an empty result. Other columns of docs, whatever their names, play no part."""
    docs = docs.select(F.col(id_col).alias("dd_id"), F.col(text_col).alias("dd_text"), *(F.col(c).alias(f"dd_c_{c}") for c in carry))
    rows = refine(docs, "dd_id", "dd_text", **how).drop("dd_text")
    rows = written(rows, "dedup-rows")
    groups = copies_of(rows, "dd_id")
    # A key for every row, so that rows without copies spread in a join by shuffle; large groups are split by Spark there.
    rows = rows.withColumn("dd_key", F.coalesce("dd_full", F.concat(F.lit("-"), F.coalesce("dd_prefix", "dd_len").cast("string"))))
    out = rows.join(groups, F.col("dd_key") == F.col("g_full"), "left")
    keep = F.when(F.col("g_size").isNull(), F.col("dd_id")).otherwise(F.col("g_keep"))
    return out.select(
        F.col("dd_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("g_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("dd_id")).alias("kept"),
        *(F.col(f"dd_c_{c}").alias(c) for c in carry),
    )


def copies_of(rows: DataFrame, id_col: str) -> DataFrame:
    """g_full, g_keep (largest id) and g_size of the groups of more than one row; copies meet as partial results."""
    groups = rows.filter("dd_full is not null").groupBy("dd_full").agg(F.max(id_col).alias("g_keep"), F.count(F.lit(1)).alias("g_size")).filter("g_size > 1")
    return broadcast_if_small(written(groups.withColumnRenamed("dd_full", "g_full"), "dedup-groups"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without exact copies: of equal texts the row with the largest id stays, and of that row's repeats one.

    Null and empty texts are equal; null ids rank below all others; an empty table gives an empty result; all columns
    stay. Texts cross the network only for repeats of one id, or if there are very many groups of copies."""
    columns = docs.columns
    plain = docs.select(*(F.col(c).alias(f"dd_c{k}") for k, c in enumerate(columns)), F.col(id_col).alias("dd_id"))
    rows = refine(plain, "dd_id", f"dd_c{columns.index(text_col)}", **how)
    groups = copies_of(written(rows.filter("dd_full is not null").select("dd_id", "dd_full"), "dedup-copies"), "dd_id")
    key = F.coalesce("dd_full", F.concat(F.lit("-"), F.coalesce("dd_prefix", "dd_len").cast("string")))
    rows = rows.withColumn("dd_key", key).join(groups, F.col("dd_key") == F.col("g_full"), "left")
    alone = rows.filter("g_full is null")
    kept = rows.filter(F.col("g_full").isNotNull() & F.col("dd_id").eqNullSafe(F.col("g_keep"))).dropDuplicates(["g_full"])
    return alone.unionByName(kept).select(*(F.col(f"dd_c{k}").alias(c) for k, c in enumerate(columns)))


def with_digest(docs: DataFrame, text_col: str = "text", name: str = "text_sha256") -> DataFrame:
    """docs with the SHA-256 of each normalised text, for results that report it for single texts too."""
    return docs.withColumn(name, F.sha2(ascii_lower(whole_text(text_col)), 256))
