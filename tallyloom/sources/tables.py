"""Typed views of the input tables: the normalised records that documents are made from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import storage
from ..functions.draws import below, draw_sql
from ..functions.money import exact, half_up, line_total

#: Order of a document's lines. The line number repeats in these tables, so it isn't enough.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")

#: Currency and rate by region, source amounts being USD. Fixed values.
CURRENCIES = {0: ("USD", "1.00"), 1: ("USD", "1.00"), 2: ("GBP", "0.79"), 3: ("EUR", "0.92"), 4: ("USD", "1.00")}


class ByOrder(str):
    """A folder of tables whose lines and orders lie ready: joined with parts and customers, numbered, in buckets by order."""

    lines: DataFrame
    orders: DataFrame
    buckets: int


#: A bucket has about so many lines at most: a task makes and sorts all strings of a bucket, which are some thirty times as
#: many, and what doesn't fit in its memory goes to disk.
LINES_A_BUCKET = 50_000


def by_order(spark: SparkSession, sf_dir: str) -> ByOrder:
    """The folder for a query that needs the lines more than once. They are joined and dealt by order here; what is then
    computed for each order, by any of the views below, is joined and grouped where it lies."""
    # Spark looks for a use of buckets below unions only, and would read them as plain files where the use is above one.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    out = ByOrder(sf_dir)
    out.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-read(spark, sf_dir, "lineitem").count() // LINES_A_BUCKET))
    out.lines = storage.bucketed(_joined(spark, sf_dir, "left"), "lines", "okey", lambda rows: numbered(_priced(rows)), out.buckets)
    out.orders = storage.bucketed(_headers(spark, sf_dir), "orders", "okey", buckets=out.buckets)
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if isinstance(sf_dir, ByOrder) and name == "lineitem":
        return sf_dir.lines.select(F.col("okey").alias("l_orderkey"), F.col("part").alias("l_partkey"), F.col("supplier").alias("l_suppkey"), *LINE_ORDER[0:1], *LINE_ORDER[3:])
    if isinstance(sf_dir, ByOrder) and name == "orders":
        return sf_dir.orders.select(F.col("okey").alias("o_orderkey"), F.col("ckey").alias("o_custkey"), F.col("status").alias("o_orderstatus"), "o_orderdate")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Kilograms in a pound. Fixed value.
POUND = "0.45359237"


def weight_kg():
    """Weight of one piece, rounded half to even to grams. Products state pounds, grams or kilograms; a tenth none."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("decimal(12,3)")
    kg = F.when(k % 3 == 0, size * F.lit("1.1").cast("decimal(3,1)") * F.lit(POUND).cast("decimal(9,8)")).when(k % 3 == 1, size * 37 / 1000).otherwise(size * F.lit("0.25").cast("decimal(3,2)"))
    return F.when(k % 10 != 0, F.bround(kg.cast("decimal(24,8)"), 3).cast("decimal(12,3)"))


WEIGHT_SQL = f"""case when p_partkey % 10 <> 0 then round_even((case p_partkey % 3 when 0 then p_size * 1.1 * {POUND} when 1 then p_size * 37 / 1000.0::decimal(9,1) else p_size * 0.25 end)::decimal(24,8), 3)::decimal(12,3) end"""


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with exact prices: okey, part, supplier, qty, price, discount, tax_rate, line_total, line_gross."""
    if isinstance(sf_dir, ByOrder):
        return sf_dir.lines.filter("known").drop("known")
    return _priced(_joined(spark, sf_dir, "inner")).drop("known")


def _joined(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    """The lines with their parts, by a left join also those whose part isn't known."""
    l = read(spark, sf_dir, "lineitem")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    return l.join(p, l.l_partkey == p.p_partkey, how).select(F.col("l_orderkey").alias("okey"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), *p.columns, *LINE_ORDER[0:1], *LINE_ORDER[3:], "l_discount", "l_tax")


def _priced(lines: DataFrame) -> DataFrame:
    rows = lines.select(
        "okey", "part", "supplier", "p_name", "p_type", "p_brand", "p_size",
        *LINE_ORDER[0:1], *LINE_ORDER[3:], F.col("l_quantity").cast("int").alias("qty"),
        half_up(exact(F.col("p_retailprice"))).alias("price"),
        F.round(exact(F.col("l_discount")), 2).cast("decimal(5,2)").alias("discount"),
        F.round(exact(F.col("l_tax")), 2).cast("decimal(5,2)").alias("tax_rate"), weight_kg().alias("weight_kg"), F.col("p_partkey").isNotNull().alias("known"),
    )
    return rows.withColumn("line_total", line_total(F.col("price"), F.col("qty"), F.col("discount"))).withColumn("line_gross", half_up(F.col("price") * F.col("qty")))


def numbered(lines: DataFrame) -> DataFrame:
    """line_no within the order, in a total order up to identical rows. Lines of unknown parts, if they are there, are
    numbered for themselves."""
    if "line_no" in lines.columns:
        return lines
    w = Window.partitionBy("okey", *(["known"] if "known" in lines.columns else [])).orderBy("l_linenumber", "part", "supplier", "l_extendedprice", "l_quantity", "l_shipdate")
    return lines.withColumn("line_no", F.row_number().over(w))


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: dates, customer, nation, region, freight."""
    return (sf_dir.orders if isinstance(sf_dir, ByOrder) else _headers(spark, sf_dir)).drop("o_orderdate")


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    c = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")  # 25 nations
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("okey"), F.col("o_custkey").alias("ckey"), "o_orderdate", F.to_date("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"),
        F.col("c_name").alias("customer"), F.col("n_name").alias("nation"), F.col("n_regionkey").alias("region"), freight().alias("freight"))


def freight():
    return (below(10000, "freight", F.col("o_orderkey")) / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


LINES_SQL = f"""
select l_orderkey as okey, l_partkey as part, l_suppkey as supplier, p_name, p_type, p_brand, p_size, l_linenumber, l_extendedprice, l_quantity, l_shipdate,
  cast(l_quantity as integer) as qty, round(cast(cast(p_retailprice as varchar) as decimal(24,6)), 2)::decimal(18,2) as price,
  round(cast(cast(l_discount as varchar) as decimal(24,6)), 2)::decimal(5,2) as discount,
  round(cast(cast(l_tax as varchar) as decimal(24,6)), 2)::decimal(5,2) as tax_rate, {WEIGHT_SQL} as weight_kg
from lineitem join part on l_partkey = p_partkey"""

#: WITH items of the SQL twins: pl (priced lines), nl (numbered lines), oh (order headers).
WITH_LINES = f"""raw_lines as ({LINES_SQL}),
pl as (select *, round(price * qty * (1 - discount), 2)::decimal(18,2) as line_total, round(price * qty, 2)::decimal(18,2) as line_gross from raw_lines),
nl as (select *, row_number() over (partition by okey order by l_linenumber, part, supplier, l_extendedprice, l_quantity, l_shipdate) as line_no from pl)"""
WITH_ORDERS = f"""oh as (select o_orderkey as okey, o_custkey as ckey, cast(o_orderdate as date) as order_date, o_orderstatus as status, c_name as customer,
  n_name as nation, n_regionkey as region, ({draw_sql("freight", "o_orderkey")} % 10000 / 100.0)::decimal(18,2) as freight
  from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey)"""
