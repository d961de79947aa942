"""Scans, joins, key sets and checks: all keys at once instead of a lookup for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.money import half_even
from ..functions.places import placed
from ..registry import query
from ..sources.tables import WITH_LINES, WITH_ORDERS, numbered, order_headers, priced_lines, read


IDS_A_BIN = 10_000


@query("""select o_orderkey, cast(o_orderdate as date) as order_date, o_orderstatus from orders
where cast(o_orderdate as date) >= date '1998-01-01' and o_orderstatus in ('O', 'P') and o_orderkey % 7 = 0 and o_orderpriority <> ''""")
def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    o = o.filter((F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & F.col("o_orderstatus").isin("O", "P") & (F.col("o_orderkey") % 7 == 0) & (F.col("o_orderpriority") != ""))
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_orderstatus")


@query(f"with {WITH_LINES} select okey, line_no, part, p_name, p_type, qty, price, discount, tax_rate, line_total from nl")
def order_lines_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header, lines, products and categories of all orders."""
    return numbered(priced_lines(spark, sf_dir)).select("okey", "line_no", "part", "p_name", "p_type", "qty", "price", "discount", "tax_rate", "line_total")


@query(f"with {WITH_ORDERS} select okey, order_date, customer, nation, region, freight from oh")
def order_header_left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing customer or nation leaves nulls and no gap."""
    return order_headers(spark, sf_dir).select("okey", "order_date", "customer", "nation", "region", "freight")


@query("select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey)")
def accounts_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def orders_without_lines_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, l = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    return o.join(l, o.o_orderkey == l.l_orderkey, "left_anti").select("o_orderkey")


@query("select distinct l_orderkey || ':' || l_suppkey as purchase_key from lineitem where l_orderkey % 7 = 0")
def purchase_keys_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") % 7 == 0)
    return l.select("l_orderkey", "l_suppkey").distinct().select(F.concat_ws(":", "l_orderkey", "l_suppkey").alias("purchase_key"))


@query(f"""with {WITH_LINES} select okey || ':' || supplier as purchase_key, s_name as vendor, count(*) as n_lines, sum(qty)::bigint as units, sum(line_gross)::decimal(18,2) as amount
from pl join supplier on s_suppkey = supplier where okey % 7 = 0 group by all""")
def load_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one order and supplier, at the product's price and without discount."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("vendor"))
    rows = priced_lines(spark, sf_dir).filter(F.col("okey") % 7 == 0).groupBy("okey", "supplier").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("qty").cast("long").alias("units"), F.sum("line_gross").cast("decimal(18,2)").alias("amount"))
    return rows.join(s, F.col("supplier") == F.col("s_suppkey")).select(F.concat_ws(":", "okey", "supplier").alias("purchase_key"), "vendor", "n_lines", "units", "amount")


@query(f"""with {WITH_LINES}, {WITH_ORDERS} select oh.okey, ckey, order_date, round_even(sum(price * qty * (1 - discount)) + any_value(freight), 2)::decimal(18,2) as amount
from oh join pl on pl.okey = oh.okey group by oh.okey, ckey, order_date""")
def load_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of all accounts: the order's exact amount with freight, rounded half to even."""
    amount = F.sum((F.col("price") * F.col("qty") * (F.lit(1).cast("decimal(5,2)") - F.col("discount"))).cast("decimal(24,4)"))
    per_order = priced_lines(spark, sf_dir).groupBy(F.col("okey").alias("k")).agg(amount.alias("net"))
    rows = order_headers(spark, sf_dir).join(per_order, F.col("okey") == F.col("k"))
    return rows.select("okey", "ckey", "order_date", half_even((F.col("net") + F.col("freight")).cast("decimal(28,4)")).alias("amount"))


@query("""select case when grouping(p_brand) = 0 then 'brand:' || p_brand when grouping(p_type) = 0 then 'type:' || p_type else 'all' end as scope,
count(*) as n_parts, sum(p_size)::bigint as sizes from part group by grouping sets ((), (p_brand), (p_type))""")
def inventory_scope_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    rows = p.groupingSets([[], [F.col("p_brand")], [F.col("p_type")]], F.col("p_brand"), F.col("p_type")).agg(
        F.grouping("p_brand").alias("b"), F.grouping("p_type").alias("t"), F.count(F.lit(1)).alias("n_parts"), F.sum("p_size").cast("long").alias("sizes"))
    scope = F.when(F.col("b") == 0, F.concat(F.lit("brand:"), "p_brand")).when(F.col("t") == 0, F.concat(F.lit("type:"), "p_type")).otherwise("all")
    return rows.select(scope.alias("scope"), "n_parts", "sizes")


@query("select 'all' as key union all select distinct 'brand:' || p_brand from part union all select distinct 'type:' || p_type from part")
def inventory_keys_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    of = lambda kind, c: p.select(F.concat(F.lit(f"{kind}:"), c).alias("key")).distinct()
    return spark.range(1).select(F.lit("all").alias("key")).unionByName(of("brand", "p_brand")).unionByName(of("type", "p_type"))


@query("""select o_custkey, o_orderkey, cast(o_orderdate as date) as order_date from
(select *, row_number() over (partition by o_custkey order by (o_orderstatus = 'O') desc, o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""")
def latest_order_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders first, then the latest: the pattern of current departments and pay rates."""
    w = Window.partitionBy("o_custkey").orderBy((F.col("o_orderstatus") == "O").desc(), F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    return read(spark, sf_dir, "orders").withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@query("""select o_custkey, min(o_orderkey) as first_order, arg_min(o_orderstatus, o_orderkey) as first_status from orders group by 1""")
def first_related_min_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first related row by key, as for addresses, phones and tracking numbers."""
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"), F.min_by("o_orderstatus", "o_orderkey").alias("first_status"))


LAYOUTS, THEMES = ["classic", "modern", "compact", "ledger"], ["plain", "warm", "slate"]


@query("""select r_name as sector, layout, theme, row_number() over (partition by r_name order by layout, theme) - 1 as k, (select count(*) from supplier join nation on n_nationkey = s_nationkey where n_regionkey = r_regionkey) as companies
from region, (values ('classic'), ('modern'), ('compact'), ('ledger')) a(layout), (values ('plain'), ('warm'), ('slate')) b(theme)""")
def layout_theme_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product of two short constant lists for each sector, with the companies that are to be spread over it."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    by_region = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).groupBy(F.col("n_regionkey").alias("c_region")).agg(F.count(F.lit(1)).alias("c"))  # 25 nations
    rows = r.join(by_region, F.col("r_regionkey") == F.col("c_region"), "left")
    rows = rows.select(F.col("r_name").alias("sector"), F.coalesce("c", F.lit(0)).cast("long").alias("companies"), F.explode(F.array(*map(F.lit, LAYOUTS))).alias("layout")).select("*", F.explode(F.array(*map(F.lit, THEMES))).alias("theme"))
    return rows.withColumn("k", F.row_number().over(Window.partitionBy("sector").orderBy("layout", "theme")).cast("long") - 1)


@query(f"with {WITH_LINES} select okey, sum(line_total)::decimal(18,2) as subtotal from pl group by 1")
def order_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced_lines(spark, sf_dir).groupBy("okey").agg(F.sum("line_total").cast("decimal(18,2)").alias("subtotal"))


@query(f"""with {WITH_LINES}, {WITH_ORDERS} select oh.okey, order_date, customer, nation, s_name as supplier_name, line_no, p_name, qty, price, discount, line_total as extended_price
from nl join oh on oh.okey = nl.okey join supplier on s_suppkey = supplier""")
def invoice_lines_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denormalised view over five tables."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("supplier_name"))
    h = order_headers(spark, sf_dir).withColumnRenamed("okey", "h_key")
    rows = numbered(priced_lines(spark, sf_dir)).join(h, F.col("okey") == F.col("h_key")).join(s, F.col("supplier") == F.col("s_suppkey"))
    return rows.select("okey", "order_date", "customer", "nation", "supplier_name", "line_no", "p_name", "qty", "price", "discount", F.col("line_total").alias("extended_price"))


FOREIGN_KEYS = (("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
                ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey"))


@query(" union all ".join(f"select '{t}.{c}' as constraint_name, count(*) as violations from {t} where not exists (select 1 from {p} where {k} = {c})" for t, c, p, k in FOREIGN_KEYS))
def fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(t: str, c: str, p: str, k: str) -> DataFrame:
        a, b = read(spark, sf_dir, t), read(spark, sf_dir, p)
        return a.join(b, a[c] == b[k], "left_anti").agg(F.lit(f"{t}.{c}").alias("constraint_name"), F.count(F.lit(1)).alias("violations"))

    first, *rest = (of(*x) for x in FOREIGN_KEYS)
    for more in rest:
        first = first.unionByName(more)
    return first


LEAST_ROWS = {"region": 5, "nation": 25, "customer": 100, "orders": 1000, "lineitem": 5000}


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n_rows, count(*) >= {n} as enough from {t}" for t, n in LEAST_ROWS.items()))
def min_rows_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, *rest = (read(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) >= n).alias("enough")) for t, n in LEAST_ROWS.items())
    for more in rest:
        first = first.unionByName(more)
    return first


@query("""select 'only_customers' as part, n_nationkey as nation from nation where n_nationkey in (select c_nationkey from customer except select s_nationkey from supplier)
union all select 'both', n_nationkey from nation where n_nationkey in (select c_nationkey from customer intersect select s_nationkey from supplier)""")
def nation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set difference and intersection of key sets."""
    c = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return c.subtract(s).select(F.lit("only_customers").alias("part"), "nation").unionByName(c.intersect(s).select(F.lit("both").alias("part"), "nation"))


@query("""select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as integer), -1) as k, row_number() over (order by try_cast(json_extract_string(props, '$.k') as integer) asc nulls first, event_id) as pos
from events""")
def order_by_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric order over a number kept as text, as places; bins by that number and neighbouring ids count first."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = read(spark, sf_dir, "events").select("event_id", k.alias("n"))
    rows = placed(rows, [], F.struct("n", F.floor(F.col("event_id") / IDS_A_BIN).alias("b")), [F.col("event_id")], "pos")
    return rows.select("event_id", F.coalesce("n", F.lit(-1)).alias("k"), "pos")


@query("""with x as (select p_type, count(*) as n from part group by 1) select p_type, n, row_number() over (order by n desc, p_type) as place from x""")
def counts_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "p_type")).cast("long"))
