"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, whole_text, word_count, written

#: Symbols that lower a document's quality weight. Fixed values.
SYMBOLS = "!#$%&*|@^~<>{}[]\\"
MOST_REPEATS = 3
ROWS_A_BIN = 20_000


def quality_weight(text: Column) -> Column:
    """0.25 to 1: the share of characters that aren't symbols."""
    clean, n = F.length(F.translate(text, SYMBOLS, "")), F.length(text)
    return F.when(n == 0, F.lit(0.25)).otherwise(F.lit(0.25) + F.lit(0.75) * (clean.cast("double") / n.cast("double")))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from a hash of seed and key, the same in every run: 52 bits, offset by half."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, pattern: tuple[int, ...] = (1, 2, 3), repeats: int = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """source, source_size, target: sources by code point, null last, weigh pattern over and over and share the given
    part of all sizes. A target stops at repeats times its source's size; the rest fills the others by weight.

    sizes has a row for each source; the closed form walks sources by the level at which they are full."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(order) - 1
    weight = F.get(F.array(*map(F.lit, pattern)), k % len(pattern))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    t = t.withColumn("total", F.sum("source_size").over(every) * F.lit(share)).withColumn("weights", F.sum("weight").over(every))
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    t = t.withColumn("full", F.col("cap") / F.col("weight") <= F.col("level")).withColumn("rank", F.row_number().over(full))
    t = t.withColumn("common", F.min_by("level", F.when(~F.col("full"), F.col("rank"))).over(every)).withColumn("last", F.min(F.when(~F.col("full"), F.col("rank"))).over(every))
    capped = F.col("last").isNull() | (F.col("rank") < F.col("last"))
    return t.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("common") * F.col("weight")).alias("target"))


def selected(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, pattern: tuple[int, ...], share: float, weight: Column | None) -> DataFrame:
    """m_id, source, size, key, source_size, target, epochs and last (whether the last, partial epoch takes the row)."""
    rows = written(keyed(docs, id_col, text_col, source_col, seed, weight), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    bins = F.greatest(F.lit(16), F.ceil(F.sum("source_rows").over(Window.partitionBy()) / ROWS_A_BIN)).cast("long")
    goal = targets(sizes, pattern, MOST_REPEATS, share).join(sizes.select(F.col("source").alias("s2"), bins.alias("bins")), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goal = broadcast_if_small(goal.withColumnRenamed("source", "g_source"))
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
    rows = rows.withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * F.col("bins")).cast("long"))
    offsets = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.withColumn("offset", F.coalesce(F.sum("bin_size").over(upto), F.lit(0))).select(F.col("source").alias("o_source"), F.col("bin").alias("o_bin"), "offset")
    inside = Window.partitionBy("source", "bin").orderBy("key", "m_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bin") == F.col("o_bin")))
    last = (F.col("offset") + F.col("before")) + F.col("size") / 2 <= F.col("rest")
    return rows.select("m_id", "source", "size", "key", "source_size", "target", "epochs", last.alias("last"))


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, weight: Column | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """m_id, source, size and the exponential key of each row, and the columns in carry as c_0, c_1, ..."""
    text = whole_text("m_text")
    w = quality_weight(text) if weight is None else weight
    rows = docs.select(F.col(id_col).alias("m_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("m_text"), *(F.col(c).alias(f"c_{k}") for k, c in enumerate(carry)))
    key = -F.log(uniform(F.col("m_id"), seed)) / w
    return rows.select("m_id", "source", word_count(text).alias("size"), key.alias("key"), *(f"c_{k}" for k in range(len(carry))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, pattern: tuple[int, ...] = (1, 2, 3), share: float = 1.0, weight: Column | None = None) -> DataFrame:
    """One row per row of docs: id, size (words), source_size, target, how many words the mix takes of it, and how often.

    A source that must give more than it has is taken in whole epochs; of the last epoch the documents with the smallest
    keys -ln(u) / weight are taken until the running sum of sizes comes nearest to the rest. Sums run in two steps, over
    bins of the key's range and within a bin, so a source of any size spreads over many tasks.
    Null text has size 0 and is never taken; null sources are one source; repeated rows of one id stand side by side
    (equal keys, ordered by size) and are taken each for itself. Extra columns are ignored; an empty table gives an
    empty result. weight is an expression over m_text, the text."""
    rows = selected(docs, id_col, text_col, source_col, seed, pattern, share, weight)
    times = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("epochs") + F.col("last").cast("long"))
    return rows.select(F.col("m_id").alias(id_col), "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), times.cast("long").alias("times"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, pattern: tuple[int, ...] = (1, 2, 3), share: float = 1.0, weight: Column | None = None) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, with their columns.

    What mix() selects of a source ends at one place in the order of keys. So the texts don't move: each row compares
    itself with its source's place. Rows with one id, size and key are taken together."""
    rows = selected(docs, id_col, text_col, source_col, seed, pattern, share, weight)
    place = F.struct("key", "m_id", "size")
    ends = rows.groupBy("source").agg(F.max("epochs").alias("epochs"), F.max(F.when(F.col("last"), place)).alias("end"))
    ends = broadcast_if_small(written(ends, "mix-ends").withColumnRenamed("source", "e_source"))
    all_ = keyed(docs, id_col, text_col, source_col, seed, weight, tuple(docs.columns)).join(ends, F.col("source").eqNullSafe(F.col("e_source")))
    times = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("epochs") + F.coalesce(place <= F.col("end"), F.lit(False)).cast("long"))
    copies = all_.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("long"), times)).otherwise(F.array().cast("array<bigint>"))))
    return copies.select(*(F.col(f"c_{k}").alias(c) for k, c in enumerate(docs.columns)))
