"""What a finished dataset needs: cleaned records, the card's configurations, images to make, and what to upload or delete."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import below, draw_sql, one_of
from ..registry import query
from ..sources import storage
from .dataset import KEYS_A_BIN, ROWS_A_SHARD, ROWS_SQL, SCANNED, SCANNED_SQL, rows_of
from ..functions.places import placed

#: Fields that serve the engine only and are left out of published records. Fixed values.
INTERNAL = ("doc_id", "source_lines", "status_key", "label_key", "product_id")


def empty(x: Column, kind: T.DataType) -> Column:
    """Whether a value says nothing: null, an empty text or list, or (by its fields) an empty record."""
    if isinstance(kind, T.StringType):
        return x.isNull() | (x == "")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return x.isNull() | (F.size(x) == 0)
    return x.isNull()


def cleaned(x: Column, kind: T.DataType) -> Column:
    """A value without internal fields and without empty ones, at any depth. In lists, members that are empty go before
    those inside are cleaned, so one that becomes empty then stays as an empty record."""
    if isinstance(kind, T.StructType):
        fields = [f for f in kind.fields if f.name not in INTERNAL]
        parts = {f.name: cleaned(x[f.name], f.dataType) for f in fields}
        record = F.struct(*(F.when(~vanishes(x[f.name], f.dataType), parts[f.name]).alias(f.name) for f in fields))
        return F.when(x.isNotNull(), record)
    if isinstance(kind, T.ArrayType):
        kept = F.filter(x, lambda e: ~empty(e, kind.elementType))
        return F.transform(kept, lambda e: cleaned(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_filter(x, lambda k, v: ~vanishes(v, kind.valueType) & ~k.isin(*INTERNAL))
    return F.when(~empty(x, kind), x)


def vanishes(x: Column, kind: T.DataType) -> Column:
    """Whether nothing is left of a value when it is cleaned."""
    if isinstance(kind, T.StructType):
        gone = x.isNull()
        inside = F.lit(True)
        for f in kind.fields:
            if f.name not in INTERNAL:
                inside = inside & vanishes(x[f.name], f.dataType)
        return gone | inside
    if isinstance(kind, T.ArrayType):
        return x.isNull() | (F.size(F.filter(x, lambda e: ~empty(e, kind.elementType))) == 0)
    if isinstance(kind, T.MapType):
        return x.isNull() | (F.size(F.map_filter(x, lambda k, v: ~vanishes(v, kind.valueType) & ~k.isin(*INTERNAL))) == 0)
    return empty(x, kind)


def clean_json(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with a record column as compact JSON, cleaned; fields that are null are left out."""
    return df.withColumn(name, F.to_json(cleaned(F.col(column), df.schema[column].dataType)))


@query("""with r as (select o_orderkey as okey, o_orderstatus as s, c_name, n_name, o_custkey % 5 = 0 as no_city, o_orderkey % 3 as notes from orders left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey)
select okey, '{"number":"N' || okey || '"' || case when c_name is null and (n_name is null or no_city) then '' else ',"bill_to":{' || concat_ws(',', '"name":"' || c_name || '"', case when not no_city then '"address":{"city":"' || n_name || '"}' end) || '}' end
  || case notes when 0 then '' when 1 then ',"notes":["a"]' else ',"notes":["a","b"]' end || case when s = 'P' then '' else ',"items":[{"sku":"x"}' || case when s = 'O' then ',{}' else '' end || ']' end || '}' as fields from r""")
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records of orders with empty and internal fields in many places, as published."""
    from ..sources.tables import read

    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey, "left").join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")  # 25 nations
    k, text = F.col("o_orderkey"), lambda x: F.lit(x).cast("string")
    city = F.when(F.col("o_custkey") % 5 != 0, F.col("n_name")).otherwise("")
    party = F.struct(F.col("c_name").alias("name"), text(None).alias("phone"), F.struct(text("").alias("line2"), city.alias("city")).alias("address"), k.alias("doc_id"))
    notes = F.slice(F.array(text("a"), text(""), text("b"), text(None)), 1, F.when(k % 3 == 0, 0).when(k % 3 == 1, 2).otherwise(4))
    item = lambda sku, shown: F.when(shown, F.struct(text(sku).alias("sku"), k.alias("product_id")))
    items = F.when(F.col("o_orderstatus") != "P", F.array(item("x", F.lit(True)), item("", F.col("o_orderstatus") == "O"), item("z", F.lit(False))))
    record = F.struct(F.concat(F.lit("N"), k).alias("number"), text("").alias("currency"), party.alias("bill_to"), notes.alias("notes"), items.alias("items"), k.alias("source_lines"))
    return clean_json(rows.select(k.alias("okey"), record.alias("record")), "record", "fields").select("okey", "fields")


SPLITS = ("train", "validation", "test")


@query(f"""with {ROWS_SQL}, have as (select distinct doc_type, split, {SCANNED_SQL} as scan from docs),
c as (select distinct config, split, path from (select 'all' as config, split, 'data/' || doc_type || '/' || split || '-*.parquet' as path from have union all select doc_type, split, 'data/' || doc_type || '/' || split || '-*.parquet' from have
  union all select 'scans', split, 'scans/' || doc_type || '/' || split || '-*.parquet' from have where scan))
select config, split, string_agg(path, ',' order by path) as paths, config = 'all' as is_default, case split when 'train' then 0 when 'validation' then 1 else 2 end as place from c group by 1, 2""")
def card_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configurations a dataset's card declares: all documents, each type, and images; of splits that exist only."""
    rows = rows_of(spark, sf_dir).groupBy("doc_type", "split").agg(F.bool_or(below(1000, "augment-select", F.col("okey")) < SCANNED).alias("scan"))
    path = lambda folder: F.concat(F.lit(f"{folder}/"), "doc_type", F.lit("/"), "split", F.lit("-*.parquet"))
    entry = lambda config, p: F.struct(config.alias("config"), p.alias("path"))
    each = F.filter(F.array(entry(F.lit("all"), path("data")), entry(F.col("doc_type"), path("data")), F.when(F.col("scan"), entry(F.lit("scans"), path("scans")))), lambda x: x.isNotNull())
    rows = rows.select("split", F.explode(each).alias("x")).groupBy("x.config", "split").agg(F.array_join(F.sort_array(F.collect_set("x.path")), ",").alias("paths"))  # a path for each type
    place = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split")) - 1
    return rows.select("config", "split", "paths", (F.col("config") == "all").alias("is_default"), place.cast("int").alias("place"))


def card_text(configs: DataFrame, counts: DataFrame, title: str) -> str:
    """The card of a dataset: its configurations as a YAML head, and a table of documents by type, most first.

    configs: rows of card_configs; counts: key, n. Both have a few rows for each type of document."""
    head, table = ["---", "configs:"], ["", f"# {title}", "", "| type | documents |", "|---|---|"]
    rows = sorted(configs.collect(), key=lambda r: (not r.is_default, r.config == "scans", r.config, r.place))
    seen = None
    for r in rows:
        if r.config != seen:
            head += [f"- config_name: {r.config}", *(["  default: true"] if r.is_default else []), "  data_files:"]
            seen = r.config
        head += [f"  - split: {r.split}", "    path:", *(f"    - {p}" for p in r.paths.split(","))]
    table += [f"| {r['key']} | {r.n:,} |" for r in sorted(counts.collect(), key=lambda r: (-r.n, r["key"]))]
    return "\n".join([*head, "---", *table]) + "\n"


@query(f"""with {ROWS_SQL} select okey, doc_type, split, (['scan', 'scan', 'photo'])[({draw_sql("profile", "okey")} % 3)::integer + 1] as profile from docs where {SCANNED_SQL}""")
def augment_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that get a degraded image, a fraction by a hash, and in which of the mixed profiles."""
    rows = rows_of(spark, sf_dir).filter(below(1000, "augment-select", F.col("okey")) < SCANNED)
    return rows.select("okey", "doc_type", "split", one_of(["scan", "scan", "photo"], "profile", F.col("okey")).alias("profile"))


def blob_id(data: Column) -> Column:
    """The hash that a version control system gives a file's content (bytes)."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(data)), "utf-8"), F.lit(b"\0"), data))


def sync_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """local and remote: path, hash. action of each path: upload (new or changed), skip (the same) or delete (gone)."""
    both = local.select("path", F.col("hash").alias("mine")).join(remote.select("path", F.col("hash").alias("theirs")), "path", "full")
    action = F.when(F.col("mine").isNull(), "delete").when(F.col("theirs").isNull() | (F.col("mine") != F.col("theirs")), "upload").otherwise("skip")
    return both.select("path", action.alias("action"))


def folders(path: Column) -> Column:
    """All folders above a path, the outermost first."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))).otherwise(F.array().cast("array<string>"))


def deletions(remote: DataFrame, stale: DataFrame) -> DataFrame:
    """What to delete so that the stale paths go: the outermost folders that hold nothing else, and the other files."""
    return outermost(remote.select("path").join(stale.select("path"), "path", "left_anti"), stale)


def outermost(kept: DataFrame, stale: DataFrame) -> DataFrame:
    """The same of the paths that stay and those that go. What can go above a file depends on its folder only, so folders are
    judged, not paths, and are written before files meet them: their files' size shows Spark whether they are few."""
    spark, own = stale.sparkSession, F.regexp_extract("path", "(?s)^.*/", 0)
    above = lambda df: df.select(own.alias("own")).distinct()
    all_of = folders(F.concat("own", F.lit("x")))
    needed = above(kept).select(F.explode(all_of).alias("needed")).distinct()
    each = above(stale).select("own", F.posexplode_outer(all_of).alias("depth", "folder")).join(needed, F.col("folder") == F.col("needed"), "left")
    free = each.groupBy("own").agg(F.min_by("folder", F.when(F.col("needed").isNull() & F.col("folder").isNotNull(), F.col("depth"))).alias("folder"))
    path = storage.work_folder(spark, "folders")
    free.write.parquet(path)
    free = spark.read.schema("own string, folder string").parquet(path)
    files = stale.select("path", own.alias("own")).join(free.filter("folder is null").select("own"), "own", "left_semi")
    return free.filter("folder is not null").select(F.col("folder").alias("path")).unionByName(files.select("path")).distinct()


SYNC_SQL = f"""{ROWS_SQL},
hub as (select 'data/' || doc_type || '/' || split || '/' || okey || '.json' as path, sha1('blob ' || length(total::varchar) || chr(1) || total) as hash from docs where okey % 7 <> 0
  union all select 'old/' || doc_type || '/' || okey || '.json', 'x' from docs where okey % 5 = 0 union all select 'readme.md', 'r'),
mine as (select 'data/' || doc_type || '/' || split || '/' || okey || '.json' as path, sha1('blob ' || length((case when okey % 11 = 0 then total + 1 else total end)::varchar) || chr(1) || (case when okey % 11 = 0 then total + 1 else total end)) as hash from docs where split <> 'test' and okey % 13 <> 0 union all select 'readme.md', 'r')"""


def sync_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k, held = F.col("okey"), storage.work_folder(spark, "records")
    rows_of(spark, sf_dir).select("okey", "doc_type", "split", "total").write.parquet(held)  # made once for both sides
    rows = spark.read.parquet(held)
    path = F.concat(F.lit("data/"), "doc_type", F.lit("/"), "split", F.lit("/"), "okey", F.lit(".json"))
    hash_ = lambda x: F.sha1(F.concat(F.lit("blob "), F.length(x), F.char(F.lit(1)), x))
    readme = spark.range(1).select(F.lit("readme.md").alias("path"), F.lit("r").alias("hash"))
    old = rows.filter(k % 5 == 0).select(F.concat(F.lit("old/"), "doc_type", F.lit("/"), "okey", F.lit(".json")).alias("path"), F.lit("x").alias("hash"))
    hub = rows.filter(k % 7 != 0).select(path.alias("path"), hash_(F.col("total").cast("string")).alias("hash")).unionByName(old).unionByName(readme)
    now = F.when(k % 11 == 0, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(18,2)").cast("string")
    mine = rows.filter((F.col("split") != "test") & (k % 13 != 0)).select(path.alias("path"), hash_(now).alias("hash")).unionByName(readme)
    return mine, hub


@query(f"""with {SYNC_SQL} select coalesce(m.path, h.path) as path, case when m.path is null then 'delete' when h.path is null or m.hash <> h.hash then 'upload' else 'skip' end as action from mine m full join hub h on h.path = m.path""")
def sync_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync_plan(*sync_tables(spark, sf_dir))


@query(f"""with {SYNC_SQL}, stale as (select path from hub where path not in (select path from mine)), kept as (select path from hub where path not in (select path from stale)),
f as (select path, i, array_to_string(string_split(path, '/')[1:i], '/') || '/' as folder from (select path, unnest(range(1, len(string_split(path, '/')))) as i from stale)),
free as (select path, arg_min(folder, i) as folder from f where not exists (select 1 from kept where starts_with(kept.path, folder)) group by 1)
select distinct coalesce(folder, s.path) as path from stale s left join free on free.path = s.path""")
def sync_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mine, hub = sync_tables(spark, sf_dir)
    return outermost(hub.join(mine, "path", "left_semi"), hub.join(mine, "path", "left_anti"))


ROWS_A_GROUP = 100


def write_shards(rows: DataFrame, path: str, key: str, metadata: dict[str, str] | None = None, rows_a_shard: int = ROWS_A_SHARD) -> DataFrame:
    """Parquet shards <type>/<split>-NNNNN.parquet of so many rows in the order of key, zstd, in small row groups, with
    metadata in their schema. Returns file and rows of each shard, once all are written.

    path may be of any file system that pyarrow knows by its scheme; without one it is in the session's default file system.
    It must be absent, empty or a dataset, which is replaced: each shard takes its place at once, by a move of a file that
    only its own attempt has written, and shards of an earlier run that this one didn't write go at the end."""
    spark = rows.sparkSession
    root = storage.guard(spark, path)
    placed_ = placed(rows, ["doc_type", "split"], F.floor(F.col(key) / KEYS_A_BIN), [F.col(key)])
    shards = placed_.withColumn("shard", F.floor((F.col("place") - 1) / rows_a_shard).cast("long")).drop("place")
    columns = rows.columns

    def save(keys: tuple, table: pa.Table) -> pa.Table:
        import pyarrow.parquet as pq

        kind, split, shard = (k.as_py() for k in keys)
        table = table.select(columns).sort_by(key)
        table = table.replace_schema_metadata({**(table.schema.metadata or {}), **{k.encode(): v.encode() for k, v in (metadata or {}).items()}})
        fs, folder = file_system(root)
        fs.create_dir(f"{folder}/{kind}", recursive=True)
        name = f"{kind}/{split}-{shard:05d}.parquet"
        own = f"{folder}/{kind}/.{split}-{shard:05d}.{uuid.uuid4().hex}"
        pq.write_table(table, own, filesystem=fs, compression="zstd", row_group_size=ROWS_A_GROUP)
        fs.move(own, f"{folder}/{name}")
        return pa.table({"file": [name], "n": pa.array([table.num_rows], pa.int64())})

    listed = storage.work_folder(spark, "shards")
    shards.groupBy("doc_type", "split", "shard").applyInArrow(save, "file string, n long").write.parquet(listed)
    made = spark.read.schema("file string, n long").parquet(listed)
    if storage.exists(spark, root):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select(F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("file"))
        found.join(made, "file", "left_anti").mapInArrow(lambda batches: removed(root, batches), "file string").write.format("noop").mode("overwrite").save()
    storage.create_new(spark, f"{root}/{storage.MARK}", "")
    return made


def file_system(root: str) -> tuple:
    """pyarrow's file system of a path with a scheme, and the path there."""
    import pyarrow.fs

    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(root)


def removed(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deletes files; one that another attempt has deleted is no error."""
    fs, folder = file_system(root)
    for b in batches:
        for name in b.column("file").to_pylist():
            try:
                fs.delete_file(f"{folder}/{name}")
            except FileNotFoundError:
                pass
        yield b


def json_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """doc_type, split and a line of JSON with exactly these columns; null or absent ones are empty texts."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns and not isinstance(rows.schema[c].dataType, T.NumericType) else (F.coalesce(F.col(c), F.lit(0)) if c in rows.columns else F.lit(""))
    return rows.select("doc_type", "split", F.to_json(F.struct(*(value(c).alias(c) for c in columns))).alias("value"))


def write_json_rows(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Lines of json_rows in folders by type and split. Replaces only what is a dataset, in the session's file system."""
    path = storage.guard(rows.sparkSession, path)
    json_rows(rows, columns).write.mode("overwrite").partitionBy("doc_type", "split").text(path)


def company_files(spark: SparkSession, path: str) -> DataFrame:
    """Company files (YAML or JSON), one in each folder: slug, locale, currency, sector, the party's name and country, and
    the whole as JSON. A file that can't be read gives a row with an error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        try:
            import yaml
        except ImportError:  # YAML needs its package; JSON doesn't
            yaml = None
        for b in batches:
            out = []
            for file, content in zip(b["path"], b["content"]):
                try:
                    body = bytes(content).decode()
                    data = json.loads(body) if file.endswith(".json") or yaml is None else yaml.safe_load(body)
                    party = data.get("party") or {}
                    out.append((data["slug"], data.get("locale"), data.get("currency"), data.get("sector"), party.get("name"), (party.get("address") or {}).get("country"), json.dumps(data, ensure_ascii=False, default=str), None))
                except Exception as e:  # any broken file is reported, with its place
                    out.append((file.rstrip("/").rsplit("/", 2)[-2], None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["slug", "locale", "currency", "sector", "name", "country", "fields", "error"], dtype=object)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "company.*").load(path).select("path", "content")
    return files.mapInPandas(parse, "slug string, locale string, currency string, sector string, name string, country string, fields string, error string")
