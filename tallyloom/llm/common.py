"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

#: Bits in one row of Spark's built-in bitmaps.
BITMAP_ROW = 32768


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def whole_text(name: str = "text") -> Column:
    """The text column, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a session on one machine may do without one and gets a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Paths of the tables written so far, in order.
made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, so that a lost executor costs no recomputation.

    The shuffle files behind it are no longer needed; a collection of the driver's garbage lets Spark remove them. Tables
    stay for the results that read them, until remove_tables()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tallyloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    made.append(path)
    del df
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def remove_tables(spark: SparkSession, since: int = 0, but: int = 0, names: tuple[str, ...] | None = None) -> None:
    """Removes the tables written since a number of them, but for the last few; of certain names only, if they are given.
    Nothing may read them any more."""
    end = len(made) - but
    going = [path for path in made[since:end] if names is None or path.rsplit("/", 1)[-1].rsplit("-", 1)[0] in names]
    for path in going:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    made[since:end] = [path for path in made[since:end] if path not in going]


def relieve_executors(spark: SparkSession) -> None:
    """Has executors collect their garbage before Python workers need room beside them. A heap that has grown keeps its
    memory until a full collection; the workers' memory isn't part of it, so both together can pass an executor's limit.
    An executor that gets no task of this small job just keeps what it has."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


#: Bytes of an Arrow batch, as far as rows are smaller. Spark counts rows only unless told, so long texts would add up.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of bytes in an Arrow batch to BATCH_BYTES; a lower one stays."""
    now = spark.conf.get(BATCH_SETTING).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:  # with another unit it is replaced
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Returns freed memory to the machine. Workers outlive their tasks, and allocators keep what was freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow in batches of bounded bytes, whose tasks give their memory back."""
    bound_batches(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The set of hashed keys as a table of at most bits / 32768 rows of 4 KB: its size doesn't depend on the keys."""
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    return (
        keys.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / BITMAP_ROW).cast("long").alias("bm_row"))
        .agg(F.bitmap_construct_agg(F.col("at") % BITMAP_ROW).alias("bm_bits"))
    )


#: The largest bitmap that is broadcast: 16 MB. Beyond it more keys pass by chance, which costs work and no result.
MOST_BITS = 1 << 27


def bits_for(keys: int) -> int:
    """Bits of a bitmap of so many keys: 16 for each, a power of two, within bounds."""
    return min(MOST_BITS, max(BITMAP_ROW, 1 << (16 * max(keys, 1) - 1).bit_length()))


def maybe_in(df: DataFrame, key: Column, members: DataFrame, bits: int, flag: str) -> DataFrame:
    """Adds the boolean column flag: false only if key isn't in the bitmap's set. No shuffle of df. A bitmap's row is turned
    into 512 numbers once, so that a look-up is an element and a bit of it."""
    half = lambda at: F.conv(F.hex(F.substring("bm_bits", at, F.lit(4))), 16, 10).cast("long")
    words = F.transform(F.sequence(F.lit(1), F.lit(BITMAP_ROW // 8 - 7), F.lit(8)), lambda at: F.shiftleft(half(at), 32).bitwiseOR(half(at + 4)))
    df = df.withColumn("bm_at", F.pmod(F.xxhash64(key), F.lit(bits))).withColumn("bm_row", F.floor(F.col("bm_at") / BITMAP_ROW).cast("long"))
    bit = F.col("bm_at").bitwiseAND(F.lit(BITMAP_ROW - 1))
    place = (56 - bit.bitwiseAND(F.lit(56)) + bit.bitwiseAND(F.lit(7))).cast("int")  # a number's first byte is its highest
    return (
        df.join(F.broadcast(members.select("bm_row", words.alias("bm_words"))), "bm_row", "left")
        .withColumn(flag, F.coalesce(F.getbit(F.get("bm_words", F.shiftright(bit, 6).cast("int")), place) == 1, F.lit(False)))
        .drop("bm_at", "bm_row", "bm_words")
    )


def row_count_at_most(df: DataFrame, most: int) -> bool:
    return df.limit(most + 1).count() <= most


def broadcast_if_small(df: DataFrame, most: int = 50_000) -> DataFrame:
    """df with a broadcast hint if it has at most so many (narrow) rows; otherwise Spark joins by shuffle."""
    return F.broadcast(df) if row_count_at_most(df, most) else df


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
