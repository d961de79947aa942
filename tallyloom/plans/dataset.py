"""The dataset's side: key fields, counters in one pass, merging of parts, shards, and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.draws import below, draw, draw_sql, one_of
from ..functions.places import placed
from ..operators.checks import WORDS_A_PAGE
from ..operators.documents import WITH_TOTALS, totals
from ..registry import query
from ..sources import storage
from ..sources.tables import read
from .planner import LAYOUTS, SPLITS_SQL, THEMES, splits

ROWS_A_SHARD = 5000
LINES_A_PAGE = 5
KEYS_A_BIN = 10_000


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: type, source, locale, company with sector and split, totals."""
    t = totals(spark, sf_dir)
    c = splits(spark, sf_dir)
    n = c.agg(F.max("company").alias("many"))
    rows = t.withColumn("many", n.scalar())
    rows = rows.withColumn("company", 1 + draw("company", F.col("okey")) % F.col("many")).drop("many")
    rows = rows.withColumn("doc_type", F.when(F.col("okey") % 3 == 0, "invoice").when(F.col("okey") % 3 == 1, "quote").otherwise("receipt"))
    rows = rows.withColumn("locale", F.when(F.col("region") == 3, "fr").otherwise("en")).withColumn("source", F.when(F.col("ckey") % 2 == 0, "shops").otherwise("others"))
    rows = rows.withColumn("pages", F.when(F.col("okey") % 50 != 0, F.ceil(F.col("items_count") / LINES_A_PAGE)).cast("long"))
    design = F.concat(one_of(list(LAYOUTS), "layout", F.col("company")), F.lit("/"), one_of(list(THEMES), "theme", F.col("company")))
    return rows.join(c.withColumnRenamed("company", "c"), F.col("company") == F.col("c")).drop("c").withColumn("design", design)


ROWS_SQL = f"""{WITH_TOTALS}, {SPLITS_SQL},
d as (select okey, 1 + {draw_sql("company", "okey")} % (select max(company) from companies) as company, case okey % 3 when 0 then 'invoice' when 1 then 'quote' else 'receipt' end as doc_type,
  case when region = 3 then 'fr' else 'en' end as locale, case when ckey % 2 = 0 then 'shops' else 'others' end as source, case when okey % 50 <> 0 then ceil(items_count / {LINES_A_PAGE}.0)::bigint end as pages,
  items_count, total, customer, nation, order_date from totals),
designs as (select company as d_company, ({list(LAYOUTS)})[({draw_sql("layout", "company")} % {len(LAYOUTS)})::integer + 1] || '/' || ({list(THEMES)})[({draw_sql("theme", "company")} % {len(THEMES)})::integer + 1] as design from companies),
docs as (select d.*, sector, split, design from d join splits on splits.company = d.company join designs on d_company = d.company)"""


@query(f"with {ROWS_SQL} select okey, doc_type, company, sector, split, locale, items_count, total, 'customer' as counterparty_role, customer as counterparty_name from docs")
def key_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first party that isn't the issuer, the total or else the strong money row of the summary, the item count."""
    rows = rows_of(spark, sf_dir)
    parties = F.array(F.struct(F.lit("issuer").alias("role"), F.col("company").cast("string").alias("name")), F.struct(F.lit("customer").alias("role"), F.col("customer").alias("name")))
    summary = F.array(F.struct(F.lit("units").alias("label"), F.col("units").cast("decimal(18,2)").alias("value"), F.lit("int").alias("fmt"), F.lit(False).alias("strong")),
                      F.struct(F.lit("total").alias("label"), F.col("total").alias("value"), F.lit("money").alias("fmt"), F.lit(True).alias("strong")))
    headline = F.get(F.filter(summary, lambda s: s["strong"] & (s["fmt"] == "money")), F.lit(0))["value"]
    value = F.coalesce(F.when(F.col("doc_type") != "receipt", F.col("total")), headline)
    other = F.get(F.filter(parties, lambda p: p["role"] != "issuer"), F.lit(0))
    return rows.select("okey", "doc_type", "company", "sector", "split", "locale", "items_count", value.alias("total"), other["role"].alias("counterparty_role"), other["name"].alias("counterparty_name"))


#: Shares of documents with a degraded image, in thousandths. Fixed value.
SCANNED = 300
SCANNED_SQL = f"{draw_sql('augment-select', 'okey')} % 1000 < {SCANNED}"
COUNTED = ("doc_type", "source", "locale", "design", "sector", "split")
SETS = (("doc_type",), ("source",), ("locale",), ("design",), ("sector",), ("split",), ("doc_type", "split"), ("doc_type", "source"), ("doc_type", "sector"), ())


@query(f"""with {ROWS_SQL} select {", ".join(f"coalesce({c}, '') as {c}" for c in COUNTED)}, count(*) as n, sum(items_count)::bigint as items, sum(coalesce(pages, 0))::bigint as pages, count(*) filter ({SCANNED_SQL}) as scans
from docs group by grouping sets ({", ".join(f"({', '.join(x)})" for x in SETS)})""")
def counters_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counters of the run, pages and scans from one pass."""
    scan = below(1000, "augment-select", F.col("okey")) < SCANNED
    rows = rows_of(spark, sf_dir).groupingSets([[F.col(c) for c in x] for x in SETS], *map(F.col, COUNTED))
    rows = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("items_count").cast("long").alias("items"), F.sum(F.coalesce("pages", F.lit(0))).cast("long").alias("pages"), F.count_if(scan).alias("scans"))
    return rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in COUNTED), "n", "items", "pages", "scans")


@query(f"""with {ROWS_SQL} select doc_type, count(*) filter (split = 'train') as train, count(*) filter (split = 'validation') as validation, count(*) filter (split = 'test') as test from docs group by 1""")
def split_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).groupBy("doc_type").pivot("split", ["train", "validation", "test"]).agg(F.count(F.lit(1))).na.fill(0)


@query(f"with {ROWS_SQL} select split, string_agg(distinct company::varchar, ',' order by company::varchar) as companies from docs group by 1")
def companies_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).groupBy("split").agg(F.array_join(F.sort_array(F.collect_set(F.col("company").cast("string"))), ",").alias("companies"))


PARTS = 4


def partials(rows: DataFrame, part: Column) -> tuple[DataFrame, DataFrame]:
    """What each part of a run knows of itself: (part, doc_type, split, n, value, pages) and (part, split, company)."""
    rows = rows.withColumn("part", part)
    counted = rows.groupBy("part", "doc_type", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("total").cast("decimal(18,2)").alias("value"), F.sum(F.coalesce("pages", F.lit(0))).cast("long").alias("pages"))
    return counted, rows.groupBy("part", "doc_type", "split", "company").agg(F.lit(1).alias("one")).drop("one")


def merged(counted: DataFrame, companies: DataFrame) -> DataFrame:
    """Partial statistics as those of the whole: sums of the parts' sums, and the union of their companies. Parts that
    happen to be equal each count; parts without companies count as well."""
    sums = counted.groupBy("doc_type", "split").agg(F.sum("n").alias("n"), F.sum("value").cast("decimal(18,2)").alias("value"), F.sum("pages").alias("pages"))
    names = companies.select("doc_type", "split", "company").distinct().groupBy(F.col("doc_type").alias("t"), F.col("split").alias("s")).agg(F.count("company").alias("c"))
    rows = sums.join(names, F.col("doc_type").eqNullSafe(F.col("t")) & F.col("split").eqNullSafe(F.col("s")), "left")
    return rows.select("doc_type", "split", "n", "value", "pages", F.coalesce("c", F.lit(0)).cast("long").alias("n_companies"))


@query(f"with {ROWS_SQL} select doc_type, split, count(*) as n, sum(total)::decimal(18,2) as value, sum(coalesce(pages, 0))::bigint as pages, count(distinct company) as n_companies from docs group by 1, 2")
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial statistics of four parts, merged: the same as those of the whole."""
    return merged(*partials(rows_of(spark, sf_dir), F.col("okey") % PARTS))


def back_filled(counters: DataFrame) -> DataFrame:
    """counters: part, counter, key, split, n. Older parts lack by_type_scan_split; one with a single type gets it from its
    scans."""
    known = counters.filter("counter = 'by_type_scan_split'").select(F.col("part").alias("k")).distinct()
    single = counters.filter("counter = 'by_type'").groupBy(F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("types"), F.max("key").alias("only")).filter("types = 1")
    scans = counters.filter("counter = 'scans'").join(known, F.col("part") == F.col("k"), "left_anti").join(single, F.col("part") == F.col("p"))
    return counters.unionByName(scans.select("part", F.lit("by_type_scan_split").alias("counter"), F.col("only").alias("key"), "split", "n"))


@query(f"""with {ROWS_SQL} select 'by_type' as counter, doc_type as key, '' as split, count(*) as n from docs group by 2 union all select 'scans', '', split, count(*) from docs where {SCANNED_SQL} group by 3
union all select 'by_type_scan_split', doc_type, split, count(*) from docs where {SCANNED_SQL} group by 2, 3""")
def merge_older_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run in parts by type, of which the first was made before scans were counted by type."""
    rows = rows_of(spark, sf_dir).withColumn("scan", below(1000, "augment-select", F.col("okey")) < SCANNED)
    of = lambda d, counter, key, split: d.groupBy(F.col("doc_type").alias("part"), key.alias("key"), split.alias("split")).agg(F.count(F.lit(1)).alias("n")).select("part", F.lit(counter).alias("counter"), "key", "split", "n")
    t, nothing = F.col("doc_type"), F.lit("")
    counters = of(rows, "by_type", t, nothing).unionByName(of(rows.filter("scan"), "scans", nothing, F.col("split"))).unionByName(of(rows.filter("scan and doc_type <> 'invoice'"), "by_type_scan_split", t, F.col("split")))
    return back_filled(counters).groupBy("counter", "key", "split").agg(F.sum("n").alias("n"))


@query(f"with {ROWS_SQL} select okey, doc_type, split, (row_number() over (partition by doc_type, split order by okey) - 1) // {ROWS_A_SHARD} as shard from docs")
def shard_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of a folder in the order of keys; bins of neighbouring keys count first."""
    rows = placed(rows_of(spark, sf_dir), ["doc_type", "split"], F.floor(F.col("okey") / KEYS_A_BIN), [F.col("okey")])
    return rows.select("okey", "doc_type", "split", F.floor((F.col("place") - 1) / ROWS_A_SHARD).cast("long").alias("shard"))


@query(f"with {ROWS_SQL} select doc_type, (count(*) * 34000)::bigint as generate_bytes, (count(*) * 24000)::bigint as export_bytes, (count(*) * 504000 // 10 * 3 // 10)::bigint as scan_bytes from docs group by 1")
def size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1))
    return rows_of(spark, sf_dir).groupBy("doc_type").agg((n * 34000).alias("generate_bytes"), (n * 24000).alias("export_bytes"), F.expr("count(1) * 504000 div 10 * 3 div 10").alias("scan_bytes"))


@query(f"with {ROWS_SQL} select okey, '{{\"number\":\"INV-' || okey || '\",\"total\":\"' || total || '\",\"items\":' || items_count || '}}' as extracted from docs where total > 0")
def gold_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals as strings, empty fields left out."""
    fields = F.struct(F.concat(F.lit("INV-"), "okey").alias("number"), F.col("total").cast("string").alias("total"), F.col("items_count").alias("items"), F.nullif(F.lit(""), F.lit("")).alias("notes"))
    return rows_of(spark, sf_dir).filter("total > 0").select("okey", F.to_json(fields).alias("extracted"))


@query(rf"""with w as (select doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') as ws from documents)
select doc_id, to_json(list_transform(ws, lambda x, i: {{'page': ((i - 1) // {WORDS_A_PAGE})::integer, 'text': x, 'bbox': [(10 * ((i - 1) % {WORDS_A_PAGE}))::double, 0::double, (10 * ((i - 1) % {WORDS_A_PAGE}) + 8)::double, 5::double]}}))::varchar as words from w""")
def words_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each text with their pages and boxes, as the JSON that lies beside a document."""
    return words_of(read(spark, sf_dir, "documents"))


def words_of(docs: DataFrame, words_a_page: int = WORDS_A_PAGE) -> DataFrame:
    """doc_id and words, a JSON array of page, text and bbox (four numbers); a null text has null words."""
    at = lambda i: (i % words_a_page * 10).cast("double")
    entry = lambda x, i: F.struct(F.floor(i / words_a_page).cast("int").alias("page"), x.alias("text"), F.array(at(i), F.lit(0.0), at(i) + 8, F.lit(5.0)).alias("bbox"))
    return docs.select("doc_id", F.to_json(F.transform(F.filter(F.split("text", "\\s+"), lambda x: x != ""), entry)).alias("words"))


def write_words(docs: DataFrame, path: str) -> None:
    """Lines of doc_id and words in a folder that is absent, empty or a dataset."""
    path = storage.guard(docs.sparkSession, path)
    words = words_of(docs)
    key = F.btrim(F.to_json(F.array("doc_id")), F.lit("[]"))
    line = F.concat(F.lit('{"doc_id":'), key, F.lit(',"words":'), F.coalesce("words", F.lit("null")), F.lit("}"))
    words.select(line.alias("value")).write.mode("overwrite").text(path)


def write_dataset(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """Folders by type and split; zstd shards of 5,000 rows, or lines of JSON. Replaces only what is a dataset: the
    folder must be empty, absent or hold an earlier commit's marker."""
    path = storage.guard(rows.sparkSession, path)
    w = rows.write.mode("overwrite").partitionBy("doc_type", "split").option("maxRecordsPerFile", ROWS_A_SHARD)
    w.option("compression", "zstd").parquet(path) if form == "parquet" else w.json(path)
