"""Planning: which records become documents, for which company, in which split. Hash-ordered windows, no random state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.draws import one_of
from ..functions.places import first_of
from ..registry import query
from ..sources.tables import read

#: Variants of documents and the filter on order status that stands for their source. Fixed values.
VARIANTS = (("invoice.a", "O"), ("invoice.b", "F"), ("invoice.c", "P"))
WANTED = 2000
VARIANTS_SQL = "(values ('invoice.a', 'O'), ('invoice.b', 'F'), ('invoice.c', 'P')) v(variant, status)"

CAPACITY_SQL = f"caps as (select variant, count(o_orderkey) as capacity from {VARIANTS_SQL} left join orders on o_orderstatus = status group by 1)"
ALLOCATE_SQL = f"""{CAPACITY_SQL},
slots as (select variant, capacity, unnest(range(1, least(capacity, {WANTED}) + 1)) as slot from caps),
ranked as (select variant, row_number() over (order by slot, variant) as place from slots),
base as (select variant, count(*) filter (place <= {WANTED}) as n from ranked group by 1),
left_over as (select greatest(0, {WANTED} - (select sum(capacity) from caps))::bigint as rest),
alloc as (select caps.variant, capacity, (coalesce(n, 0) + rest // (count(*) over ()) + case when row_number() over (order by capacity desc, caps.variant) <= rest % (count(*) over ()) then 1 else 0 end)::bigint as n
  from caps left join base on base.variant = caps.variant, left_over)"""


def variants(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(VARIANTS), "variant string, status string"))  # three rows


def capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("c"))
    return variants(spark).join(o, F.col("status") == F.col("o_orderstatus"), "left").select("variant", "status", F.coalesce("c", F.lit(0)).alias("capacity"))


def allocation(caps: DataFrame, wanted: int = WANTED) -> DataFrame:
    """Even shares capped by capacity, in closed form: slots in rounds over the variants, the first `wanted` of them.
    Beyond all capacities, the rest is spread evenly, with what is over going to the largest first."""
    everything = Window.partitionBy()
    slots = caps.select("variant", F.explode(F.when(F.col("capacity") > 0, F.sequence(F.lit(1).cast("long"), F.least("capacity", F.lit(wanted)))).otherwise(F.array().cast("array<bigint>"))).alias("slot"))
    base = slots.withColumn("place", F.row_number().over(Window.orderBy("slot", "variant"))).filter(F.col("place") <= wanted).groupBy(F.col("variant").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    rows = caps.join(base, F.col("variant") == F.col("v"), "left").drop("v")
    rest, many = F.greatest(F.lit(0), wanted - F.sum("capacity").over(everything)), F.count(F.lit(1)).over(everything)
    rows = rows.withColumn("rest", rest).withColumn("many", many).withColumn("turn", F.row_number().over(Window.orderBy(F.desc("capacity"), "variant")))
    n = F.coalesce("n", F.lit(0)) + F.floor(F.col("rest") / F.col("many")) + (F.col("turn") <= F.col("rest") % F.col("many")).cast("long")
    return rows.withColumn("n", n.cast("long")).drop("rest", "many", "turn")


@query(f"with {ALLOCATE_SQL} select variant, capacity, n from alloc")
def plan_allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation(capacities(spark, sf_dir)).select("variant", "capacity", "n")


def no_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """variant, cycle, okey: no record twice before all were taken once; then a new order."""
    a = F.broadcast(allocation(capacities(spark, sf_dir)).select("variant", "status", "capacity", "n"))  # a row for each variant
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(a, F.col("o_orderstatus") == F.col("status"))
    rows = rows.withColumn("cycle", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.col("capacity")))))
    # The draw is a hash; its first letters cut a variant of any size into bins in the same order.
    rows = rows.withColumn("drawn", F.sha1(F.concat_ws("|", F.lit("42"), "variant", "cycle", "o_orderkey")))
    # What is wanted of all variants together is a parameter; the bins that hold it are no more.
    rows = rows.withColumn("rest", F.col("n") - F.col("cycle") * F.col("capacity"))
    rows = first_of(rows, ["variant", "cycle"], F.substring("drawn", 1, 3), [F.col("drawn"), F.col("o_orderkey")], "rest")
    return rows.select("variant", "cycle", F.col("o_orderkey").alias("okey"), "place")


NO_REPEAT_SQL = f"""{ALLOCATE_SQL},
cycles as (select a.variant, status, capacity, n, unnest(range(0, (n - 1) // capacity + 1)) as cycle from alloc a join {VARIANTS_SQL} on v.variant = a.variant where capacity > 0 and n > 0),
drawn as (select variant, cycle, o_orderkey as okey, capacity, n, row_number() over (partition by variant, cycle order by sha1('42|' || variant || '|' || cycle || '|' || o_orderkey), o_orderkey) as place from cycles join orders on o_orderstatus = status),
jobs as (select variant, cycle, okey, place from drawn where cycle * capacity + place <= n)"""


@query(f"with {NO_REPEAT_SQL} select variant, cycle, okey from jobs")
def plan_no_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return no_repeat(spark, sf_dir).select("variant", "cycle", "okey")


LAYOUTS, THEMES = ("classic", "modern", "compact", "ledger"), ("plain", "warm", "slate")


@query(f"""with c as (select r_name as sector, s_suppkey as company, row_number() over (partition by r_name order by s_suppkey) - 1 as i, dense_rank() over (order by r_name) - 1 as n
  from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey),
p as (select r_name as sector, layout, theme, row_number() over (partition by r_name order by sha1('rebalance|42|' || r_name || '|' || layout || '|' || theme)) - 1 as k
  from region, (select unnest({list(LAYOUTS)}) as layout), (select unnest({list(THEMES)}) as theme))
select c.sector, company, layout, theme from c join p on p.sector = c.sector and k = (i + 5 * n) % 12""")
def rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company i of sector n gets place (i + 5n) mod k in the product of layouts and themes, shuffled for each sector."""
    rows = companies(spark, sf_dir)
    rows = rows.withColumn("i", F.row_number().over(Window.partitionBy("sector").orderBy("company")) - 1)
    sectors = rows.select("sector").distinct()  # a row for each sector, at most five
    ranked = F.broadcast(sectors.select(F.col("sector").alias("s"), (F.row_number().over(Window.orderBy("sector")) - 1).alias("n")))
    product = sectors.select(F.col("sector").alias("p"), F.explode(F.array(*map(F.lit, LAYOUTS))).alias("layout")).select("p", "layout", F.explode(F.array(*map(F.lit, THEMES))).alias("theme"))
    shuffled = F.row_number().over(Window.partitionBy("p").orderBy(F.sha1(F.concat_ws("|", F.lit("rebalance"), F.lit("42"), "p", "layout", "theme")))) - 1
    product = F.broadcast(product.withColumn("k", shuffled))  # twelve rows a sector
    rows = rows.join(ranked, F.col("sector") == F.col("s"))
    many = len(LAYOUTS) * len(THEMES)
    return rows.join(product, (F.col("sector") == F.col("p")) & ((F.col("i") + 5 * F.col("n")) % many == F.col("k"))).select("sector", "company", "layout", "theme")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as issuers, regions as sectors."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("sector"), F.col("s_suppkey").alias("company"))  # 25 and 5 rows


SPLITS_SQL = """companies as (select r_name as sector, s_suppkey as company from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey),
placed as (select *, row_number() over (partition by sector order by sha1('42:' || company), company) as place, count(*) over (partition by sector) as many from companies),
sized as (select *, case when many >= 3 then greatest(1, round_even((many * 0.1)::decimal(9,1), 0))::bigint else 0 end as held from placed),
splits as (select sector, company, case when place <= held then 'test' when place <= 2 * held then 'validation' else 'train' end as split from sized)"""


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test and validation companies of each sector by a stable hash order; sectors of fewer than three have none."""
    w = Window.partitionBy("sector")
    rows = companies(spark, sf_dir).withColumn("place", F.row_number().over(w.orderBy(F.sha1(F.concat_ws(":", F.lit("42"), "company")), "company"))).withColumn("many", F.count(F.lit(1)).over(w))
    held = F.when(F.col("many") >= 3, F.greatest(F.lit(1), F.bround((F.col("many") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(9,1)"), 0).cast("int"))).otherwise(0)
    return rows.select("sector", "company", F.when(F.col("place") <= held, "test").when(F.col("place") <= 2 * held, "validation").otherwise("train").alias("split"))


@query(f"with {SPLITS_SQL} select sector, company, split from splits")
def company_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits(spark, sf_dir)


@query(f"""with {NO_REPEAT_SQL} select variant, cycle, okey, substr(sha1(okey || '|' || variant || '|' || cycle || '|42'), 1, 16) as doc_id,
(['classic', 'modern', 'compact', 'ledger'])[(cast('0x' || substr(sha1('42|layout|' || okey || '|' || variant), 1, 8) as bigint) % 4)::integer + 1] as layout from jobs""")
def plan_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = no_repeat(spark, sf_dir)
    doc_id = F.substring(F.sha1(F.concat_ws("|", "okey", "variant", "cycle", F.lit("42"))), 1, 16)
    return rows.select("variant", "cycle", "okey", doc_id.alias("doc_id"), one_of(["classic", "modern", "compact", "ledger"], "layout", F.col("okey"), F.col("variant")).alias("layout"))


@query(f"""with {NO_REPEAT_SQL}, m as (select variant, case when exists (select 1 from lineitem where l_orderkey = okey) then 'ok' else 'failed' end as status from jobs)
select variant, count(*) filter (status = 'ok') as ok, count(*) filter (status = 'failed') as failed from m group by 1""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's outcome per variant: a record without lines fails and stops nothing."""
    l = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    rows = no_repeat(spark, sf_dir).join(l, F.col("okey") == F.col("k"), "left")
    return rows.groupBy("variant").agg(F.count("k").alias("ok"), F.count_if(F.col("k").isNull()).alias("failed"))


@query(f"with {NO_REPEAT_SQL} select variant, cycle, okey from jobs where not exists (select 1 from lineitem where l_orderkey = okey)")
def resume_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs that no committed output has, so that a second run does only these."""
    done = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return no_repeat(spark, sf_dir).join(done, F.col("okey") == F.col("k"), "left_anti").select("variant", "cycle", "okey")
