"""Upload batches: files in their order, as many to a batch as limits of bytes and files allow.

A batch ends where the next file would pass a limit, so each begins where the one before it ends: a chain through all files.
The chain is followed in blocks at once. Where a batch that begins at a file ends is known from sums of sizes, at most MOST_FILES
files on. So a block is entered at one of its first MOST_FILES files; for each of these it tells where the chain leaves it and
after how many batches. These small maps, chained, give each block its entry, and each block numbers its own files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.places import in_order
from ..registry import query
from ..sources import storage
from .publish import SYNC_SQL, sync_plan, sync_tables

#: Files of a block. An entry's map holds one number in BLOCK / MOST_FILES of them.
BLOCK = 100_000


def ends(sizes: np.ndarray, own: int, most_bytes: int, most_files: int) -> np.ndarray:
    """For each of the first `own` files: the first one that a batch beginning at it can't take. A file over the limit is a
    batch of its own."""
    upto = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(own)
    by_bytes = np.searchsorted(upto, upto[:own] + most_bytes, side="right") - 1
    return np.minimum(np.maximum(by_bytes, at + 1), np.minimum(at + most_files, len(sizes)))


def exits(end: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a chain entered at each of the first files leaves the block, and after how many batches: jumps are doubled
    until none stays within."""
    own = len(end)
    at, n = np.concatenate([end, np.arange(own, end.max(initial=own) + 1)]), np.concatenate([np.ones(own, np.int64), np.zeros(end.max(initial=own) + 1 - own, np.int64)])
    while (at[:own] < own).any():
        n, at = n + n[at], at[at]
    return at[: min(entries, own)], n[: min(entries, own)]


def batches(spark: SparkSession, files: DataFrame, most_bytes: int, most_files: int, block: int = BLOCK) -> DataFrame:
    """files: path, bytes (both not null, paths differ). path, bytes and batch, from 0, in the order of paths."""

    def written(df: DataFrame) -> DataFrame:
        path = storage.work_folder(spark, "batches")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    block = max(block, most_files)
    rows = in_order(files.select("path", F.col("bytes").cast("long").alias("bytes")), ["path"], "bytes", written).drop("before")
    rows = written(rows.withColumn("block", F.call_function("div", F.col("pos"), F.lit(block))))
    # The next block's first files are seen by a block as well, since its last batches may take them.
    halo = rows.filter((F.col("block") > 0) & (F.col("pos") % block < most_files)).withColumn("block", F.col("block") - 1)
    seen = rows.unionByName(halo)

    def ordered(table: pa.Table) -> tuple[pa.Table, int, np.ndarray]:
        table = table.sort_by("pos")
        first = table.column("block")[0].as_py() * block
        own = int((table.column("pos").to_numpy() < first + block).sum())
        return table, own, ends(table.column("bytes").to_numpy(), own, most_bytes, most_files)

    def of_block(table: pa.Table) -> pa.Table:
        table, own, end = ordered(table)
        leave, n = exits(end, most_files)
        return pa.table({"block": [table.column("block")[0].as_py()], "own": [own], "leave": [leave.tolist()], "n": [n.tolist()]}, schema=MAPS)

    maps = seen.groupBy("block").applyInArrow(of_block, "block long, own long, leave array<long>, n array<long>").orderBy("block").collect()  # MOST_FILES numbers a block
    entry, number, begins = 0, 0, {}
    for m in maps:
        begins[m["block"]] = entry, number
        entry, number = m["leave"][entry] - m["own"], number + m["n"][entry]

    def numbered(table: pa.Table) -> pa.Table:
        table, own, end = ordered(table)
        at, n = begins[table.column("block")[0].as_py()]
        first = np.zeros(own, np.int64)
        while at < own:
            first[at] = 1
            at = end[at]
        batch = n - 1 + np.cumsum(first)
        return pa.table({"path": table.column("path").slice(0, own), "bytes": table.column("bytes").slice(0, own), "batch": pa.array(batch, pa.int64())})

    return seen.groupBy("block").applyInArrow(numbered, "path string, bytes long, batch long")


MAPS = pa.schema([("block", pa.int64()), ("own", pa.int64()), ("leave", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])
#: Limits of the query's batches.
MOST_BYTES, MOST_FILES = 60_000, 40


@query(f"""with recursive {SYNC_SQL}, u as (select m.path, (length(m.path) * 37 + ('0x' || substr(m.hash, 1, 4))::bigint % 4000)::bigint as bytes from mine m left join hub h on h.path = m.path where m.path <> 'readme.md' and (h.path is null or m.hash <> h.hash)),
o as (select *, row_number() over (order by path) - 1 as pos, sum(bytes) over (order by path) as upto from u),
e as (select a.pos, max(b.pos) + 1 as next from o a join o b on b.pos between a.pos and a.pos + {MOST_FILES - 1} and (b.upto - a.upto + a.bytes <= {MOST_BYTES} or b.pos = a.pos) group by 1),
chain as (select 0::bigint as batch, 0::bigint as first, (select next from e where pos = 0) as next union all select batch + 1, e.pos, e.next from chain join e on e.pos = chain.next)
select path, bytes, batch from o join chain on pos >= first and pos < next""")
def sync_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be uploaded, in batches."""
    mine, hub = sync_tables(spark, sf_dir)
    new = sync_plan(mine, hub).filter("action = 'upload' and path <> 'readme.md'").select(F.col("path").alias("p"))
    size = F.length("path") * 37 + F.conv(F.substring("hash", 1, 4), 16, 10).cast("long") % 4000
    files = mine.join(new, F.col("path") == F.col("p"), "left_semi").select("path", size.cast("long").alias("bytes"))
    return batches(spark, files, MOST_BYTES, MOST_FILES)
