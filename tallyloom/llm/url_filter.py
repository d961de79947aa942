"""URL filters by a cascade of Bloom filters over the corpus's own keys."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BITMAP_ROW, ascii_lower, written

#: A level with more bytes than this isn't sent to executors; the build stops and says so.
MOST_BYTES = 256 << 20


@dataclass(frozen=True)
class Rule:
    host: str  # the host itself or a parent domain of it
    path: str  # a prefix of the path
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """Behind the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """All keys a rule that fits could have, longest first: every parent domain with every path prefix of those lengths.

    A key holds host and path apart, so that no other split of the same letters equals it."""
    labels = F.split(host, "\\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, path_lengths)), lambda n: n <= F.length(path))
    pairs = F.flatten(F.transform(parents, lambda h: F.transform(fitting, lambda n: F.struct(
        (-F.length(h) - n).alias("order"), (-F.length(h)).alias("host_order"), F.concat(h, F.lit("\n"), F.substr(path, F.lit(1), n)).alias("key")))))
    return F.transform(F.array_sort(pairs), lambda p: p["key"])


@dataclass
class Level:
    bits: int
    hashes: int
    words: np.ndarray  # uint8

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in positions(h, self.bits, self.hashes):
            out &= self.words[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
        return out


def positions(h: np.ndarray, bits: int, hashes: int) -> Iterator[np.ndarray]:
    """Double hashing on the two halves of a 64-bit hash."""
    h = h.view(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    for k in range(hashes):
        yield ((a + np.uint64(k) * b) % np.uint64(bits)).astype(np.int64)


def level_of(keys: DataFrame, n: int, bits_per_key: float, seed: int) -> Level:
    """A Bloom filter of n keys, built on the executors as bitmap rows; the driver gets the finished bits only."""
    bits = BITMAP_ROW * max(1, math.ceil(n * bits_per_key / BITMAP_ROW))
    if bits // 8 > MOST_BYTES:
        raise ValueError(f"a level of {bits // 8} bytes is over the bound of {MOST_BYTES}")
    hashes = max(1, round(bits / max(n, 1) * math.log(2))) if n else 1
    hashes = min(hashes, 12)

    def bit_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column(0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*positions(h, bits, hashes), np.zeros(0, np.int64)]))], names=["at"])

    at = keys.select(hashed(F.col("key"), seed).alias("h")).mapInArrow(bit_positions, "at long")
    rows = at.groupBy(F.floor(F.col("at") / BITMAP_ROW).cast("long").alias("r")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP_ROW).alias("b")).collect()
    words = np.zeros(bits // 8, np.uint8)
    for r in rows:
        words[r.r * BITMAP_ROW // 8 : (r.r + 1) * BITMAP_ROW // 8] = np.frombuffer(r.b, np.uint8)
    return Level(bits, hashes, words)


def hashed(key: Column, seed: int) -> Column:
    """Each level hashes anew."""
    return F.xxhash64(F.lit(seed), key)


def all_hashed(keys: str, seed: int) -> Column:
    return F.transform(keys, lambda key: hashed(key, seed))


class Cascade:
    """Exact membership of a listed set within a universe. Level 0 holds the listed keys, level 1 those unlisted keys of
    the universe that level 0 lets through, level 2 the listed ones that level 1 lets through, and so on until a level
    lets none through. Beyond the universe it answers like a Bloom filter."""

    def __init__(self, levels: list[Level]) -> None:
        self.levels = levels

    def has(self, hashes: list[np.ndarray]) -> np.ndarray:
        """hashes: for each level the keys' hashes. The first level that a key fails decides."""
        n = len(hashes[0]) if hashes else 0
        if not self.levels:
            return np.zeros(n, bool)
        out, open_ = np.zeros(n, bool), np.ones(n, bool)
        for k, level in enumerate(self.levels):
            inside = level.has(hashes[k])
            out[open_ & ~inside] = k % 2 == 1
            open_ &= inside
        out[open_] = len(self.levels) % 2 == 1
        return out


def contains_udf(spark: SparkSession, cascade: Cascade):
    shipped = spark.sparkContext.broadcast(cascade)

    def run(*hashes):
        import pandas as pd

        c = shipped.value
        lists = [x.to_numpy() for x in hashes]
        sizes = np.fromiter((0 if x is None else len(x) for x in lists[0]), np.int64, len(lists[0]))
        flat = [np.concatenate([np.asarray(x, np.int64) for x in xs if x is not None and len(x)] or [np.zeros(0, np.int64)]) for xs in lists]
        member = c.has(flat)
        ends = np.cumsum(sizes)
        hit = np.flatnonzero(member)
        first = np.searchsorted(hit, ends - sizes)
        at = np.where(first < len(hit), hit[np.minimum(first, max(len(hit) - 1, 0))] if len(hit) else 0, 1 << 60)
        return pd.Series(np.where(at < ends, at - (ends - sizes), -1), dtype="int32")

    return F.pandas_udf(run, "int")


def build(keys: DataFrame, bits_per_key: float = 10) -> Cascade:
    """keys: each key of the universe once, as key, and whether it is listed, as listed. Levels go on until one lets none
    of the other side through. What a level lets through is written, so each level reads the keys of one side only."""
    spark = keys.sparkSession
    wanted, other, levels = keys.filter("listed").select("key"), keys.filter("not listed").select("key"), []
    for k in count():
        n = wanted.count()
        if n == 0:
            return Cascade(levels)
        level = level_of(wanted, n, bits_per_key, k)
        levels.append(level)
        through = other.filter(contains_level(spark, level)(hashed(F.col("key"), k)))
        wanted, other = written(through, "url-level"), wanted


def contains_level(spark: SparkSession, level: Level):
    shipped = spark.sparkContext.broadcast(level)

    def run(h):
        import pandas as pd

        return pd.Series(shipped.value.has(h.to_numpy(np.int64)))

    return F.pandas_udf(run, "boolean")


def judge(pages: DataFrame, rules: list[Rule], listed_hosts: list[str] = (), id_col: str = "page_id", url_col: str = "url", bits_per_key: float = 10) -> DataFrame:
    """id, host, path, rule, verdict and by_list for every row of pages.

    The longest fitting rule decides, of equal lengths the one of the longer host. Without one, a url is blocked if its
    host or a parent domain is in listed_hosts (by_list is then true), else allowed. Null urls and urls without :// have
    an empty host and path and are allowed. Null ids and repeated rows stay as they are; extra columns are ignored; an
    empty table gives an empty result."""
    spark = pages.sparkSession
    by_key = {f"{r.host}\n{r.path}": r for r in rules}
    if len(by_key) < len(rules):
        raise ValueError("two rules for one host and path")
    listed = {f"{h}\n" for h in listed_hosts}
    lengths = sorted({len(r.path) for r in rules} | {0})
    df = pages.select(F.col(id_col).alias("u_id"), F.col(url_col).cast("string").alias("u_url"))
    df = df.select("u_id", host_of(F.col("u_url")).alias("u_host"), path_of(F.col("u_url")).alias("u_path"))
    df = df.withColumn("u_keys", keys_of(F.col("u_host"), F.col("u_path"), lengths))
    members = {"u_allow": {k for k, r in by_key.items() if r.verdict == "allow"}, "u_block": {k for k, r in by_key.items() if r.verdict == "block"}, "u_list": listed}
    # One row a key, with a flag for each list: listed keys and the corpus's keys meet in one aggregation, not in joins.
    flags = [(k, *(k in keys for keys in members.values())) for k in sorted(set().union(*members.values()))]
    known = spark.createDataFrame(flags, "key string, " + ", ".join(f"{name} boolean" for name in members))
    universe = df.select(F.explode("u_keys").alias("key"), *(F.lit(False).alias(name) for name in members))
    universe = written(universe.union(known).groupBy("key").agg(*(F.max(name).alias(name) for name in members)), "url-keys")
    for name in members:
        cascade = build(universe.select("key", F.col(name).alias("listed")), bits_per_key)
        if cascade.levels:
            hashes = [all_hashed("u_keys", k) for k in range(len(cascade.levels))]
            df = df.withColumn(name, contains_udf(spark, cascade)(*hashes))
        else:
            df = df.withColumn(name, F.lit(-1))
    allow, block = F.col("u_allow"), F.col("u_block")
    first = F.when(allow < 0, block).when(block < 0, allow).otherwise(F.least(allow, block))
    rule = F.when(first >= 0, F.replace(F.get("u_keys", first), F.lit("\n"), F.lit("")))
    by_list = (first < 0) & (F.col("u_list") >= 0)
    verdict = F.when(first >= 0, F.when(first == allow, "allow").otherwise("block")).otherwise(F.when(by_list, "block").otherwise("allow"))
    return df.select(F.col("u_id").alias(id_col), F.col("u_host").alias("host"), F.col("u_path").alias("path"), rule.alias("rule"), verdict.alias("verdict"), by_list.alias("by_list"))
