"""The thirteen documents, each computed for all its records at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.draws import below, chance, draw_sql, one_of
from ..functions.money import exact, half_even, half_up, tender
from ..functions.places import placed
from ..registry import query
from ..sources.tables import WITH_LINES, WITH_ORDERS, numbered, order_headers, priced_lines, read

MONEY = "decimal(18,2)"
zero = lambda: F.lit(0).cast(MONEY)


def add(*parts: Column) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out.cast(MONEY)


def total(c: str) -> Column:
    return F.sum(c).cast(MONEY)


@query(f"with {WITH_LINES} select okey, line_no, price, qty, discount, line_gross, line_total from nl")
def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(priced_lines(spark, sf_dir)).select("okey", "line_no", "price", "qty", "discount", "line_gross", "line_total")


TAX_SQL = "tr as (select okey, tax_rate, sum(line_total)::decimal(18,2) as base, round(sum(line_total)::decimal(18,2) * tax_rate, 2)::decimal(18,2) as amount from pl group by 1, 2)"
TOTALS_SQL = f"""{TAX_SQL},
sums as (select okey, sum(line_gross)::decimal(18,2) as gross, sum(line_total)::decimal(18,2) as subtotal, count(*) as items_count, sum(qty)::bigint as units from pl group by 1),
taxes as (select okey, sum(amount)::decimal(18,2) as tax_total from tr where tax_rate <> 0 group by 1),
totals as (select oh.okey, oh.ckey, oh.order_date, oh.customer, oh.nation, oh.region, items_count, units, gross, subtotal, (gross - subtotal)::decimal(18,2) as discount_total, freight,
  coalesce(tax_total, 0)::decimal(18,2) as tax_total, (subtotal + freight + coalesce(tax_total, 0))::decimal(18,2) as total
  from sums join oh on oh.okey = sums.okey left join taxes on taxes.okey = sums.okey)"""
WITH_TOTALS = f"{WITH_LINES}, {WITH_ORDERS}, {TOTALS_SQL}"


def tax_lines(lines: DataFrame) -> DataFrame:
    """okey, tax_rate, base, amount: each rate's tax is rounded before anything is summed."""
    rows = lines.groupBy("okey", "tax_rate").agg(total("line_total").alias("base"))
    return rows.withColumn("amount", half_up(F.col("base") * F.col("tax_rate")))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines. A first aggregation by order and rate feeds the one by order, so the lines are
    shuffled once, as partial sums."""
    lines = priced_lines(spark, sf_dir)
    by_rate = lines.groupBy("okey", "tax_rate").agg(total("line_gross").alias("g"), total("line_total").alias("s"), F.count(F.lit(1)).alias("n"), F.sum("qty").alias("u"))
    by_rate = by_rate.withColumn("tax", F.when(F.col("tax_rate") != 0, half_up(F.col("s") * F.col("tax_rate"))).otherwise(zero()))
    sums = by_rate.groupBy(F.col("okey").alias("k")).agg(total("g").alias("gross"), total("s").alias("subtotal"), total("tax").alias("tax_total"), F.sum("n").alias("items_count"), F.sum("u").cast("long").alias("units"))
    rows = order_headers(spark, sf_dir).join(sums, F.col("okey") == F.col("k")).drop("k", "status")
    rows = rows.withColumn("discount_total", add(F.col("gross"), -F.col("subtotal")))
    return rows.withColumn("total", add(F.col("subtotal"), F.col("freight"), F.col("tax_total")))


@query(f"with {WITH_LINES}, {TAX_SQL} select * from tr where tax_rate <> 0")
def tax_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tax_lines(priced_lines(spark, sf_dir)).filter("tax_rate <> 0")


@query(f"with {WITH_TOTALS} select okey, items_count, units, gross, subtotal, discount_total, freight, tax_total, total from totals")
def invoice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(spark, sf_dir).select("okey", "items_count", "units", "gross", "subtotal", "discount_total", "freight", "tax_total", "total")


@query(f"""with {WITH_TOTALS}, bases as (select okey as bkey, sum(price * qty * (1 - discount)) as base from pl group by 1),
given as (select totals.*, round_even((tax_total / base::decimal(24,4))::decimal(18,8), 4)::decimal(9,4) as rate from totals join bases on bkey = okey where base > 0),
kept as (select okey, sum(line_total)::decimal(18,2) as kept_total from nl where line_no <= 3 group by 1)
select g.okey, rate, items_count > 3 as sampled, kept_total, (case when items_count > 3 then round(kept_total * rate, 2) else tax_total end)::decimal(18,2) as given_tax from given g join kept k on k.okey = g.okey""")
def given_tax_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's tax where all lines are shown; where lines were sampled, its effective rate (on the sum of the lines
    before they are rounded) times what is shown."""
    net = (F.col("price") * F.col("qty") * (F.lit(1).cast("decimal(5,2)") - F.col("discount"))).cast("decimal(24,4)")
    bases = priced_lines(spark, sf_dir).groupBy(F.col("okey").alias("bkey")).agg(F.sum(net).cast("decimal(24,4)").alias("base")).filter("base > 0")
    t = totals(spark, sf_dir).join(bases, F.col("okey") == F.col("bkey"))
    t = t.withColumn("rate", F.bround((F.col("tax_total") / F.col("base")).cast("decimal(18,8)"), 4).cast("decimal(9,4)"))
    kept = numbered(priced_lines(spark, sf_dir)).filter("line_no <= 3").groupBy(F.col("okey").alias("k")).agg(total("line_total").alias("kept_total"))
    sampled = F.col("items_count") > 3
    given = F.when(sampled, half_up(F.col("kept_total") * F.col("rate"))).otherwise(F.col("tax_total")).cast(MONEY)
    return t.join(kept, F.col("okey") == F.col("k")).select("okey", "rate", sampled.alias("sampled"), "kept_total", given.alias("given_tax"))


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last ship date of each order."""
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("s_key")).agg(F.to_date(F.max("l_shipdate")).alias("ship_date"))


def issued() -> Column:
    """The ship date if there is one, not before the order; else the order date."""
    return F.coalesce(F.when(F.col("ship_date") >= F.col("order_date"), F.col("ship_date")), F.col("order_date"))


@query(f"""with {WITH_TOTALS}, s as (select l_orderkey, cast(max(l_shipdate) as date) as d from lineitem group by 1),
x as (select *, coalesce(case when d >= order_date then d end, order_date) as issue_date, ([15, 30, 30, 45, 60])[({draw_sql("terms", "okey")} % 5)::integer + 1] as days from totals left join s on l_orderkey = okey)
select okey, 'INV-' || lpad(okey::varchar, greatest(5, length(okey::varchar))::integer, '0') as number, issue_date, (issue_date + days::integer)::date as due_date,
  case when issue_date <> order_date then order_date end as shown_order_date, customer, total from x""")
def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issued on the ship date, without one on the order date. A last line shipped before the order is no ship date."""
    rows = totals(spark, sf_dir).join(shipped(spark, sf_dir), F.col("okey") == F.col("s_key"), "left")
    rows = rows.withColumn("issue_date", issued()).withColumn("days", one_of([15, 30, 30, 45, 60], "terms", F.col("okey")))
    return rows.select("okey", F.concat(F.lit("INV-"), text.padded(F.col("okey"), 5)).alias("number"), "issue_date", F.date_add("issue_date", F.col("days")).alias("due_date"),
                       F.when(F.col("issue_date") != F.col("order_date"), F.col("order_date")).alias("shown_order_date"), "customer", "total")


@query(f"""with {WITH_TOTALS}, x as (select *, (order_date - (3 + {draw_sql("lead", "okey")} % 19)::integer)::date as issue_date, ([15, 30, 30, 60])[({draw_sql("valid", "okey")} % 4)::integer + 1] as days from totals)
select okey, issue_date, (issue_date + days::integer)::date as valid_until, total from x""")
def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = totals(spark, sf_dir).withColumn("issue_date", F.date_sub("order_date", (3 + below(19, "lead", F.col("okey"))).cast("int")))
    return rows.select("okey", "issue_date", F.date_add("issue_date", one_of([15, 30, 30, 60], "valid", F.col("okey"))).alias("valid_until"), "total")


def sampled(lines: DataFrame, n: Column | int, tag: str) -> DataFrame:
    """At most n lines of each order by a hash, in their own order."""
    w = Window.partitionBy("okey").orderBy(F.sha1(F.concat_ws("|", F.lit(tag), "okey", "line_no")), "line_no")
    return lines.withColumn("pick", F.row_number().over(w)).filter(F.col("pick") <= n)


@query(f"""with {WITH_LINES}, x as (select *, row_number() over (partition by okey order by sha1('sample|' || okey || '|' || line_no), line_no) as pick from nl)
select okey, line_no, row_number() over (partition by okey order by line_no) as shown_no, pick from x where pick <= 3""")
def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampled(numbered(priced_lines(spark, sf_dir)), 3, "sample")
    return rows.select("okey", "line_no", F.row_number().over(Window.partitionBy("okey").orderBy("line_no")).alias("shown_no"), "pick")


CREDIT_SQL = f"""c_picked as (select *, row_number() over (partition by okey order by sha1('credit|' || okey || '|' || line_no), line_no) as pick, ([1, 1, 2, 3])[({draw_sql("credit_lines", "okey")} % 4)::integer + 1] as n,
  {draw_sql("reason", "okey")} % 5 as reason from nl),
c_parts as (select *, case when reason = 3 then qty else 1 + {draw_sql("part", "okey", "line_no")} % qty end as c_qty,
  case when reason = 3 then round(price * ([0.05, 0.1, 0.15])[({draw_sql("fraction", "okey", "line_no")} % 3)::integer + 1]::decimal(5,2), 2)::decimal(18,2) else price end as c_price from c_picked where pick <= n),
credited as (select *, round(c_price * c_qty * (1 - discount), 2)::decimal(18,2) as c_total from c_parts)"""


def credited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three lines of each order: part of the quantity goes back, or (reason price) part of the price, drawn for
    each line."""
    lines = numbered(priced_lines(spark, sf_dir)).withColumn("reason", below(5, "reason", F.col("okey")))
    rows = sampled(lines, one_of([1, 1, 2, 3], "credit_lines", F.col("okey")), "credit")
    price_only = F.col("reason") == 3
    qty = F.when(price_only, F.col("qty")).otherwise(1 + below(1 << 32, "part", F.col("okey"), F.col("line_no")) % F.col("qty"))
    fraction = F.get(F.array(*(F.lit(x).cast("decimal(5,2)") for x in ("0.05", "0.1", "0.15"))), below(3, "fraction", F.col("okey"), F.col("line_no")).cast("int"))
    rows = rows.withColumn("c_qty", qty.cast("long")).withColumn("c_price", F.when(price_only, half_up(F.col("price") * fraction)).otherwise(F.col("price")))
    return rows.withColumn("c_total", half_up(F.col("c_price") * F.col("c_qty") * (F.lit(1).cast("decimal(5,2)") - F.col("discount"))))


@query(f"""with {WITH_LINES}, {CREDIT_SQL} select okey, line_no, part, c_qty::bigint as quantity, c_price as unit_price, discount, tax_rate, c_total as line_total from credited""")
def credit_note_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = credited_lines(spark, sf_dir)
    return rows.select("okey", "line_no", "part", F.col("c_qty").alias("quantity"), F.col("c_price").alias("unit_price"), "discount", "tax_rate", F.col("c_total").alias("line_total"))


@query(f"""with {WITH_TOTALS}, {CREDIT_SQL}, r as (select okey, tax_rate, sum(c_total)::decimal(18,2) as base, count(*) as n from credited group by 1, 2),
s as (select okey, sum(n)::bigint as n_lines, sum(base)::decimal(18,2) as subtotal, sum(round(base * tax_rate, 2))::decimal(18,2) as own_tax from r group by 1),
bases as (select okey as b_key, sum(price * qty * (1 - discount))::decimal(24,4) as base from pl group by 1),
d as (select l_orderkey, cast(max(l_shipdate) as date) as d from lineitem group by 1),
taxed as (select s.*, t.ckey, t.order_date, (case when t.ckey % 2 <> 0 then own_tax when t.tax_total = 0 or base = 0 then 0 else round(s.subtotal * round_even((t.tax_total / base)::decimal(18,8), 4)::decimal(9,4), 2) end)::decimal(18,2) as tax
  from s join totals t on t.okey = s.okey join bases on b_key = s.okey)
select okey, 'INV-' || lpad(okey::varchar, greatest(5, length(okey::varchar))::integer, '0') as original_invoice, (coalesce(case when d >= order_date then d end, order_date) + (5 + {draw_sql("days_after", "okey")} % 41)::integer)::date as issue_date,
(['damaged', 'wrong_item', 'expired', 'price', 'return'])[({draw_sql("reason", "okey")} % 5)::integer + 1] as reason, n_lines, subtotal, tax as tax_total, (subtotal + tax)::decimal(18,2) as total from taxed left join d on l_orderkey = okey""")
def credit_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice it belongs to, some days after that, and its totals without freight. Where the source gives the tax, its
    effective rate on the whole order, to four places, is applied to what is credited, whether or not all lines are; else
    each rate is taxed for itself."""
    rows, k = credited_lines(spark, sf_dir), F.col("okey")
    by_rate = rows.groupBy("okey", "tax_rate").agg(total("c_total").alias("base"), F.count(F.lit(1)).alias("n"))
    by_rate = by_rate.withColumn("tax", half_up(F.col("base") * F.col("tax_rate")))
    out = by_rate.groupBy(k.alias("c_key")).agg(F.sum("n").alias("n_lines"), total("base").alias("c_subtotal"), total("tax").alias("own_tax"))
    net = (F.col("price") * F.col("qty") * (F.lit(1).cast("decimal(5,2)") - F.col("discount"))).cast("decimal(24,4)")
    bases = priced_lines(spark, sf_dir).groupBy(k.alias("b_key")).agg(F.sum(net).cast("decimal(24,4)").alias("source_base"))
    heads = totals(spark, sf_dir).select("okey", "ckey", "order_date", "tax_total")
    out = heads.join(out, k == F.col("c_key")).join(bases, k == F.col("b_key")).join(shipped(spark, sf_dir), k == F.col("s_key"), "left")
    tax = F.when(F.col("ckey") % 2 != 0, F.col("own_tax")).otherwise(given_part(F.col("c_subtotal"), F.col("tax_total"), F.col("source_base"))).cast(MONEY)
    issue = F.date_add(issued(), (5 + below(41, "days_after", k)).cast("int"))
    reason = one_of(["damaged", "wrong_item", "expired", "price", "return"], "reason", k)
    return out.select(k, F.concat(F.lit("INV-"), text.padded(k, 5)).alias("original_invoice"), issue.alias("issue_date"), reason.alias("reason"), "n_lines", F.col("c_subtotal").alias("subtotal"), tax.alias("tax_total"), add(F.col("c_subtotal"), tax).alias("total"))


def given_part(shown: Column, given: Column, base: Column) -> Column:
    """The tax on a part of an order whose tax is given: its effective rate on the order's lines before rounding, rounded
    half to even to four places, times the part. No tax, or none to relate it to, gives none."""
    rate = F.bround((given / F.nullif(base, F.lit(0))).cast("decimal(18,8)"), 4).cast("decimal(9,4)")
    return F.when((given == 0) | (base == 0), zero()).otherwise(half_up(shown * rate))


PACKED_SQL = f"""short as (select *, row_number() over (partition by okey order by sha1('short|' || okey || '|' || line_no), line_no) as pick from nl),
packed as (select *, case when pick = 1 and qty >= 2 and {draw_sql("backorder", "okey")} % 1000 < 200 then 1 + {draw_sql("missing", "okey")} % (qty - 1) else 0 end as back from short)"""


def packed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what is back-ordered: of one line in one order of five, if it has two pieces or more."""
    w = Window.partitionBy("okey").orderBy(F.sha1(F.concat_ws("|", F.lit("short"), "okey", "line_no")), "line_no")
    rows = numbered(priced_lines(spark, sf_dir)).withColumn("pick", F.row_number().over(w))
    short = (F.col("qty") >= 2) & chance(200, "backorder", F.col("okey")) & (F.col("pick") == 1)
    return rows.withColumn("back", F.when(short, 1 + below(1 << 32, "missing", F.col("okey")) % (F.col("qty") - 1)).otherwise(0).cast("long"))


@query(f"""with {WITH_LINES}, {PACKED_SQL} select okey, line_no, part, p_name, case when {draw_sql("show_unit", "okey")} % 1000 < 600 then 'EA' end as unit, qty::bigint as ordered, (qty - back)::bigint as shipped, back::bigint as backordered from packed""")
def packing_slip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.when(chance(600, "show_unit", F.col("okey")), F.lit("EA"))
    return packed_lines(spark, sf_dir).select("okey", "line_no", "part", "p_name", unit.alias("unit"), F.col("qty").cast("long").alias("ordered"), (F.col("qty") - F.col("back")).alias("shipped"), F.col("back").alias("backordered"))


@query(f"""with {WITH_LINES}, {PACKED_SQL}, y as (select *, ([6, 12, 24, 48])[({draw_sql("box", "okey")} % 4)::integer + 1] as box from packed)
select okey, sum(qty)::bigint as ordered, sum(qty - back)::bigint as shipped, sum(back)::bigint as backordered, greatest(1, ceil(sum(qty - back) / any_value(box)::double))::bigint as packages, round_even(sum(weight_kg * (qty - back))::decimal(18,3), 2)::decimal(18,2) as total_weight from y group by 1""")
def packing_slips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary; packages hold a drawn number of pieces, the weight is that of what is shipped."""
    out = packed_lines(spark, sf_dir).groupBy("okey").agg(F.sum("qty").cast("long").alias("ordered"), F.sum(F.col("qty") - F.col("back")).cast("long").alias("shipped"), F.sum("back").cast("long").alias("backordered"),
                                                          half_even(F.sum((F.col("weight_kg") * (F.col("qty") - F.col("back"))).cast("decimal(18,3)"))).alias("total_weight"))
    box = one_of([6, 12, 24, 48], "box", F.col("okey"))
    return out.withColumn("packages", F.greatest(F.lit(1), F.ceil(F.col("shipped") / box)).cast("long"))


@query(f"""with {WITH_LINES} select okey, line_no, part, p_name, qty::bigint as quantity, round_even((weight_kg * qty)::decimal(18,3), 2)::decimal(18,2) as line_weight, case when {draw_sql("show_values", "okey")} % 1000 < 600 then line_total end as declared_value from nl""")
def shipping_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights where the product's is known, values where the option shows them."""
    rows = numbered(priced_lines(spark, sf_dir))
    weight = half_even((F.col("weight_kg") * F.col("qty")).cast("decimal(18,3)"))
    return rows.select("okey", "line_no", "part", "p_name", F.col("qty").cast("long").alias("quantity"), weight.alias("line_weight"), F.when(chance(600, "show_values", F.col("okey")), F.col("line_total")).alias("declared_value"))


@query(f"""with {WITH_LINES}, {WITH_ORDERS}, x as (select okey, round_even(sum(weight_kg * qty)::decimal(18,3), 2)::decimal(18,2) as total_weight, sum(line_total)::decimal(18,2) as declared_value, sum(qty)::bigint as units from pl group by 1)
select oh.okey, units, greatest(1, ceil(units / ([6, 12, 24, 48])[({draw_sql("box", "oh.okey")} % 4)::integer + 1]::double))::bigint as packages, total_weight, declared_value,
(['freight_prepaid', 'freight_collect'])[({draw_sql("freight_terms", "oh.okey")} % 2)::integer + 1] as freight_terms, freight, (order_date + 1)::date as pickup, (order_date + 1 + ({draw_sql("transit", "oh.okey")} % 7 + 1)::integer)::date as deliver from x join oh on oh.okey = x.okey""")
def shipping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary. The weight is that of the products whose weight is known, null if none is."""
    weight = (F.col("weight_kg") * F.col("qty")).cast("decimal(18,3)")
    sums = priced_lines(spark, sf_dir).groupBy(F.col("okey").alias("k")).agg(half_even(F.sum(weight)).alias("total_weight"), total("line_total").alias("declared_value"), F.sum("qty").cast("long").alias("units"))
    rows = order_headers(spark, sf_dir).join(sums, F.col("okey") == F.col("k"))
    days = (below(7, "transit", F.col("okey")) + 2).cast("int")
    packages = F.greatest(F.lit(1), F.ceil(F.col("units") / one_of([6, 12, 24, 48], "box", F.col("okey")))).cast("long")
    return rows.select("okey", "units", packages.alias("packages"), "total_weight", "declared_value", one_of(["freight_prepaid", "freight_collect"], "freight_terms", F.col("okey")).alias("freight_terms"), "freight", F.date_add("order_date", 1).alias("pickup"), F.date_add("order_date", days).alias("deliver"))


@query(f"""with {WITH_LINES} select okey || ':' || supplier as purchase_key, count(*) as items_count, sum(line_gross)::decimal(18,2) as subtotal, round(sum(line_gross)::decimal(18,2) * 0.0825, 2)::decimal(18,2) as tax_total,
(sum(line_gross)::decimal(18,2) + round(sum(line_gross)::decimal(18,2) * 0.0825, 2))::decimal(18,2) as total, ([30, 45, 60])[({draw_sql("po_terms", "okey", "supplier")} % 3)::integer + 1] as payment_days from pl where okey % 7 = 0 group by okey, supplier""")
def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = priced_lines(spark, sf_dir).filter(F.col("okey") % 7 == 0).groupBy("okey", "supplier").agg(F.count(F.lit(1)).alias("items_count"), total("line_gross").alias("subtotal"))
    rows = rows.withColumn("tax_total", half_up(F.col("subtotal") * F.lit("0.0825").cast("decimal(5,4)")))
    return rows.select(F.concat_ws(":", "okey", "supplier").alias("purchase_key"), "items_count", "subtotal", "tax_total", add(F.col("subtotal"), F.col("tax_total")).alias("total"), one_of([30, 45, 60], "po_terms", F.col("okey"), F.col("supplier")).alias("payment_days"))


@query(f"""with {WITH_LINES} select okey || ':' || supplier as purchase_key, line_no, part, p_name, qty::bigint as quantity, price as unit_price, line_gross as line_total from nl where okey % 7 = 0""")
def purchase_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(priced_lines(spark, sf_dir)).filter("okey % 7 = 0")
    return rows.select(F.concat_ws(":", "okey", "supplier").alias("purchase_key"), "line_no", "part", "p_name", F.col("qty").cast("long").alias("quantity"), F.col("price").alias("unit_price"), F.col("line_gross").alias("line_total"))


RECEIVED_SQL = f"""received_lines as (select *, qty - rejected as accepted, qty - rejected as stocked from (select okey, line_no, part, p_name, supplier, qty, qty as received,
  case when {draw_sql("reject", "okey", "line_no")} % 1000 < 100 then least(qty, 1 + {draw_sql("rejected", "okey", "line_no")} % 3) else 0 end as rejected from nl where okey % 7 = 0))"""
PURCHASE_STATUS = {1: "pending", 2: "approved", 3: "rejected", 4: "complete"}
PURCHASES_SQL = f"""purchases as (select distinct okey, supplier, 1 + {draw_sql("po_status", "okey", "supplier")} % 4 as code from pl where okey % 7 = 0)"""


def received_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of purchases with what arrived, was rejected, accepted and stocked."""
    k, n = F.col("okey"), F.col("line_no")
    rejected = F.when(chance(100, "reject", k, n), F.least(F.col("qty").cast("long"), 1 + below(3, "rejected", k, n))).otherwise(0).cast("long")
    rows = numbered(priced_lines(spark, sf_dir)).filter("okey % 7 = 0").select("okey", "line_no", "part", "p_name", "supplier", "l_shipdate", F.col("qty").cast("long").alias("qty"), F.col("qty").cast("long").alias("received"), rejected.alias("rejected"))
    return rows.withColumn("accepted", F.col("received") - F.col("rejected")).withColumn("stocked", F.col("accepted"))


def purchase_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """okey, supplier, code (1 to 4) of each purchase."""
    rows = read(spark, sf_dir, "lineitem").filter("l_orderkey % 7 = 0").select(F.col("l_orderkey").alias("okey"), F.col("l_suppkey").alias("supplier")).distinct()
    return rows.withColumn("code", 1 + below(4, "po_status", F.col("okey"), F.col("supplier")))


@query(f"""with {WITH_LINES}, {PURCHASES_SQL} select okey || ':' || supplier as purchase_key, case code when 1 then 'pending' when 2 then 'approved' when 3 then 'rejected' when 4 then 'complete' else '' end as status, code = 4 as complete from purchases""")
def purchase_keys_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of purchases with their decoded status; notes of receipt are made of complete ones only."""
    status = F.coalesce(*(F.when(F.col("code") == k, v) for k, v in PURCHASE_STATUS.items()), F.lit(""))
    return purchase_status(spark, sf_dir).select(F.concat_ws(":", "okey", "supplier").alias("purchase_key"), status.alias("status"), (F.col("code") == 4).alias("complete"))


@query(f"""with {WITH_LINES}, {PURCHASES_SQL}, {RECEIVED_SQL} select r.okey || ':' || r.supplier as purchase_key, line_no, part, p_name, qty as ordered, received, rejected, accepted, stocked
from received_lines r join purchases p on p.okey = r.okey and p.supplier = r.supplier where code = 4""")
def goods_received_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = purchase_status(spark, sf_dir).filter("code = 4").select(F.col("okey").alias("k"), F.col("supplier").alias("s"))
    rows = received_lines(spark, sf_dir).join(done, (F.col("okey") == F.col("k")) & (F.col("supplier") == F.col("s")), "left_semi")
    return rows.select(F.concat_ws(":", "okey", "supplier").alias("purchase_key"), "line_no", "part", "p_name", F.col("qty").alias("ordered"), "received", "rejected", "accepted", "stocked")


@query(f"""with {WITH_LINES}, {WITH_ORDERS}, {PURCHASES_SQL}, {RECEIVED_SQL}, d as (select l_orderkey, l_suppkey, cast(max(l_shipdate) as date) as d from lineitem where l_orderkey % 7 = 0 group by 1, 2)
select r.okey || ':' || r.supplier as purchase_key, (any_value(case when d >= order_date then d else order_date end) + ({draw_sql("received_on", "r.okey", "r.supplier")} % 4)::integer)::date as received_on,
  sum(qty)::bigint as ordered, sum(received)::bigint as received, sum(rejected)::bigint as rejected, sum(accepted)::bigint as accepted
from received_lines r join purchases p on p.okey = r.okey and p.supplier = r.supplier join oh on oh.okey = r.okey join d on l_orderkey = r.okey and l_suppkey = r.supplier where code = 4 group by r.okey, r.supplier""")
def goods_received_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of complete purchases: received up to three days after the purchase was shipped, or after the order if no
    ship date follows it."""
    done = purchase_status(spark, sf_dir).filter("code = 4").select(F.col("okey").alias("k"), F.col("supplier").alias("s"))
    lines = received_lines(spark, sf_dir)
    out = lines.groupBy("okey", "supplier").agg(*(F.sum(c).cast("long").alias(n) for c, n in (("qty", "ordered"), ("received", "received"), ("rejected", "rejected"), ("accepted", "accepted"))), F.to_date(F.max("l_shipdate")).alias("ship_date"))
    out = out.join(done, (F.col("okey") == F.col("k")) & (F.col("supplier") == F.col("s")), "left_semi")
    out = out.join(order_headers(spark, sf_dir).select(F.col("okey").alias("hk"), "order_date"), F.col("okey") == F.col("hk"))
    on = F.date_add(issued(), below(4, "received_on", F.col("okey"), F.col("supplier")).cast("int"))
    return out.select(F.concat_ws(":", "okey", "supplier").alias("purchase_key"), on.alias("received_on"), "ordered", "received", "rejected", "accepted")


STOCK_SQL = f"""stock as (select p_partkey, p_name, p_brand, p_type, p_size, ({draw_sql("on_hand", "p_partkey")} % 60 * ({draw_sql("empty", "p_partkey")} % 10 > 0)::integer)::bigint as on_hand,
  ({draw_sql("on_order", "p_partkey")} % 40)::bigint as on_order, {draw_sql("discontinued", "p_partkey")} % 1000 < 50 as discontinued, round(cast(cast(p_retailprice as varchar) as decimal(24,6)), 2)::decimal(18,2) as unit_cost from part),
inventory as (select *, round(on_hand * unit_cost, 2)::decimal(18,2) as stock_value, case when discontinued then 'discontinued' when on_hand = 0 then 'out' when on_hand <= p_size then 'reorder' else 'ok' end as status from stock)"""


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with drawn stock. The order of the status ladder matters."""
    k = F.col("p_partkey")
    rows = read(spark, sf_dir, "part").select(
        k, "p_name", "p_brand", "p_type", "p_size", F.when(below(10, "empty", k) > 0, below(60, "on_hand", k)).otherwise(0).cast("long").alias("on_hand"), below(40, "on_order", k).alias("on_order"),
        chance(50, "discontinued", k).alias("discontinued"), half_up(exact(F.col("p_retailprice"))).alias("unit_cost"))
    status = F.when(F.col("discontinued"), "discontinued").when(F.col("on_hand") == 0, "out").when(F.col("on_hand") <= F.col("p_size"), "reorder").otherwise("ok")
    return rows.withColumn("stock_value", half_up(F.col("on_hand") * F.col("unit_cost"))).withColumn("status", status)


@query(f"with {STOCK_SQL} select p_partkey, on_hand, on_order, p_size as reorder_level, unit_cost, stock_value, status from inventory")
def inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock(spark, sf_dir).select("p_partkey", "on_hand", "on_order", F.col("p_size").alias("reorder_level"), "unit_cost", "stock_value", "status")


@query(f"""with {STOCK_SQL}, scoped as (select unnest(['all', 'brand:' || p_brand, 'type:' || p_type]) as scope, * from inventory)
select scope, count(*) as total_items, sum(on_hand)::bigint as total_units, count(*) filter (status in ('reorder', 'out')) as items_to_reorder, sum(stock_value)::decimal(18,2) as total_value from scoped group by 1""")
def inventory_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stock(spark, sf_dir).withColumn("scope", F.explode(F.array(F.lit("all"), F.concat(F.lit("brand:"), "p_brand"), F.concat(F.lit("type:"), "p_type"))))
    return rows.groupBy("scope").agg(F.count(F.lit(1)).alias("total_items"), F.sum("on_hand").alias("total_units"), F.count_if(F.col("status").isin("reorder", "out")).alias("items_to_reorder"), total("stock_value").alias("total_value"))


@query(f"""with {STOCK_SQL} select p_partkey, p_brand, coalesce(lag(p_type) over (partition by p_brand order by p_type, p_name, p_partkey) <> p_type, true) as new_group from inventory""")
def group_change_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group header stands where the group differs from the row before."""
    w = Window.partitionBy("p_brand").orderBy("p_type", "p_name", "p_partkey")
    return stock(spark, sf_dir).select("p_partkey", "p_brand", F.coalesce(F.lag("p_type").over(w) != F.col("p_type"), F.lit(True)).alias("new_group"))


@query("""with x as (select event_id, user_id, ts, round(cast(cast(value as varchar) as decimal(24,6)), 2)::decimal(18,2) as amount, ([0.99, 2.99, 4.99])[(event_id % 3)::integer + 1]::decimal(18,2) as rate from events where event_type = 'purchase'),
lines as (select event_id, 'rental' as line, least(rate, amount) as line_total from x union all select event_id, 'late fee', (amount - rate)::decimal(18,2) from x where amount > rate)
select event_id, line, line_total::decimal(18,2) as line_total from lines""")
def receipt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One or two lines for each payment: the rental at most at its rate, and a late fee only above it."""
    rows = read(spark, sf_dir, "events").filter("event_type = 'purchase'").select("event_id", half_up(exact(F.col("value"))).alias("amount"), F.get(F.array(*(F.lit(x).cast(MONEY) for x in ("0.99", "2.99", "4.99"))), (F.col("event_id") % 3).cast("int")).alias("rate"))
    rental = F.struct(F.lit("rental").alias("line"), F.least("rate", "amount").alias("line_total"))
    late = F.when(F.col("amount") > F.col("rate"), F.struct(F.lit("late fee").alias("line"), add(F.col("amount"), -F.col("rate")).alias("line_total")))
    each = F.filter(F.array(rental, late), lambda x: x.isNotNull())
    return rows.select("event_id", F.explode(each).alias("x")).select("event_id", "x.line", F.col("x.line_total").cast(MONEY).alias("line_total"))


@query("""select user_id, cast(ts as date) as day, count(*) as items_count, sum(round(cast(cast(value as varchar) as decimal(24,6)), 2))::decimal(18,2) as total, min(strftime(ts, '%H:%M')) as first_at from events where event_type = 'purchase' group by 1, 2""")
def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").filter("event_type = 'purchase'").withColumn("v", half_up(exact(F.col("value"))))
    return rows.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("items_count"), total("v").alias("total"), F.min(F.date_format("ts", "HH:mm")).alias("first_at"))


PAYMENTS_SQL = f"""slips as (select user_id, cast(ts as date) as day, sum(round(cast(cast(value as varchar) as decimal(24,6)), 2))::decimal(18,2) as total from events where event_type = 'purchase' group by 1, 2),
paid as (select *, user_id % 4 = 0 as online, {draw_sql("cash", "user_id", "day")} % 1000 < 400 and user_id % 4 <> 0 as cash, ([1, 5, 10, 20])[({draw_sql("step", "user_id", "day")} % 4)::integer + 1]::bigint as step from slips)"""


@query(f"""with {PAYMENTS_SQL}, c as (select *, (ceil(total / step) * step)::decimal(18,2) as tendered, (['Visa', 'Mastercard', 'Amex'])[({draw_sql("brand", "user_id", "day")} % 3)::integer + 1] || ' •••• ' || (1000 + {draw_sql("card", "user_id", "day")} % 9000) as card from paid)
select user_id, day, 1 as row_no, 'payment_method' as label, case when cash then 'Cash' else 'Card ' || card end as value from c
union all select user_id, day, 2, case when cash then 'amount_tendered' else 'amount_paid' end, (case when cash then tendered else total end)::varchar from c
union all select user_id, day, 3, 'change', (tendered - total)::decimal(18,2)::varchar from c where cash""")
def receipt_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash with change, never online, or a card."""
    rows, u, d = receipts(spark, sf_dir), F.col("user_id"), F.col("day")
    cash = chance(400, "cash", u, d) & (u % 4 != 0)
    rows = rows.withColumn("cash", cash).withColumn("tendered", tender(F.col("total"), one_of([1, 5, 10, 20], "step", u, d).cast("long")))
    card = F.concat(F.lit("Card "), one_of(["Visa", "Mastercard", "Amex"], "brand", u, d), F.lit(" •••• "), 1000 + below(9000, "card", u, d))
    row = lambda n, label, value: F.struct(F.lit(n).alias("row_no"), F.lit(label).alias("label"), value.cast("string").alias("value"))
    by_cash = F.array(row(1, "payment_method", F.lit("Cash")), row(2, "amount_tendered", F.col("tendered")), row(3, "change", add(F.col("tendered"), -F.col("total"))))
    return rows.select("user_id", "day", F.explode(F.when(F.col("cash"), by_cash).otherwise(F.array(row(1, "payment_method", card), row(2, "amount_paid", F.col("total"))))).alias("x")).select("user_id", "day", "x.*")


@query(f"""with {STOCK_SQL}, scoped as (select unnest(['all', 'brand:' || p_brand, 'type:' || p_type]) as scope, * from inventory),
drawn as (select *, row_number() over (partition by scope order by sha1('stock|' || scope || '|' || p_partkey), p_partkey) as pick, ([15, 25, 40, 60])[({draw_sql("inventory_items", "scope")} % 4)::integer + 1] as most from scoped),
shown as (select *, case when scope like 'type:%' then p_brand else p_type end as grp from drawn where pick <= most)
select scope, row_number() over (partition by scope order by grp, p_name, p_partkey) as row_no, p_partkey as sku, p_name as description, grp, coalesce(lag(grp) over (partition by scope order by grp, p_name, p_partkey) <> grp, true) as new_group,
  case when {draw_sql("show_location", "scope")} % 1000 < 600 then case when p_partkey % 9 = 0 then '' else chr(65 + (p_partkey % 6)::integer) || '-' || p_partkey % 30 end end as location, on_hand, on_order, p_size as reorder_level, unit_cost, stock_value, status from shown""")
def inventory_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the reports of all scopes, by group and name: at most a drawn number. A report of one type groups by
    brand, the others by type."""
    k = F.col("p_partkey")
    rows = stock(spark, sf_dir).withColumn("scope", F.explode(F.array(F.lit("all"), F.concat(F.lit("brand:"), "p_brand"), F.concat(F.lit("type:"), "p_type"))))
    rows = rows.withColumn("drawn", F.sha1(F.concat_ws("|", F.lit("stock"), "scope", k)))
    rows = placed(rows, ["scope"], F.substring("drawn", 1, 3), [F.col("drawn"), k], "pick").filter(F.col("pick") <= one_of([15, 25, 40, 60], "inventory_items", F.col("scope")))
    rows = rows.withColumn("grp", F.when(F.col("scope").startswith("type:"), F.col("p_brand")).otherwise(F.col("p_type")))
    w = Window.partitionBy("scope").orderBy("grp", "p_name", "p_partkey")  # sixty rows at most
    shelf = F.when(k % 9 == 0, "").otherwise(F.concat(F.char(65 + k % 6), F.lit("-"), k % 30))
    return rows.select("scope", F.row_number().over(w).cast("long").alias("row_no"), k.alias("sku"), F.col("p_name").alias("description"), "grp", F.coalesce(F.lag("grp").over(w) != F.col("grp"), F.lit(True)).alias("new_group"), F.when(chance(600, "show_location", F.col("scope")), shelf).alias("location"),
                       "on_hand", "on_order", F.col("p_size").alias("reorder_level"), "unit_cost", "stock_value", "status")


WORK_SQL = f"""operations as (select okey, line_no as operation, 'Cell ' || supplier as location, line_gross as planned_cost, round(cast(cast(l_extendedprice as varchar) as decimal(24,6)), 2)::decimal(18,2) as actual_cost, (qty * 0.25)::decimal(18,2) as hours,
  cast(l_shipdate as date) as planned_start, (cast(l_shipdate as date) + 3)::date as planned_end, (cast(l_shipdate as date) + ({draw_sql("late", "okey", "line_no")} % 3)::integer)::date as actual_start, (cast(l_shipdate as date) + ({draw_sql("late", "okey", "line_no")} % 3 + 2)::integer)::date as actual_end from nl),
work as (select okey, count(*) as operations, sum(hours)::decimal(18,2) as total_hours, sum(planned_cost)::decimal(18,2) as total_planned, sum(actual_cost)::decimal(18,2) as total_actual, (sum(actual_cost) - sum(planned_cost))::decimal(18,2) as variance from operations group by 1)"""


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routing of all work orders, numbered in order."""
    late = below(3, "late", F.col("okey"), F.col("line_no")).cast("int")
    day = F.to_date("l_shipdate")
    return numbered(priced_lines(spark, sf_dir)).select(
        "okey", F.col("line_no").alias("operation"), F.concat(F.lit("Cell "), "supplier").alias("location"), F.col("line_gross").alias("planned_cost"), half_up(exact(F.col("l_extendedprice"))).alias("actual_cost"), (F.col("qty") * F.lit("0.25").cast("decimal(3,2)")).cast(MONEY).alias("hours"),
        day.alias("planned_start"), F.date_add(day, 3).alias("planned_end"), F.date_add(day, late).alias("actual_start"), F.date_add(day, late + 2).alias("actual_end"))


@query(f"""with {WITH_LINES}, {WORK_SQL} select okey, operation, location, planned_start, planned_end, case when {draw_sql("show_actual_dates", "okey")} % 1000 < 600 then actual_start end as actual_start,
  case when {draw_sql("show_actual_dates", "okey")} % 1000 < 600 then actual_end end as actual_end, hours, planned_cost, actual_cost from operations""")
def work_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations in their order; actual dates where the option shows them."""
    shown = chance(600, "show_actual_dates", F.col("okey"))
    rows = operations(spark, sf_dir).withColumn("actual_start", F.when(shown, F.col("actual_start"))).withColumn("actual_end", F.when(shown, F.col("actual_end")))
    return rows.select("okey", "operation", "location", "planned_start", "planned_end", "actual_start", "actual_end", "hours", "planned_cost", "actual_cost")


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = priced_lines(spark, sf_dir).select("okey", F.col("line_gross").alias("planned"), half_up(exact(F.col("l_extendedprice"))).alias("actual"), (F.col("qty") * F.lit("0.25").cast("decimal(3,2)")).cast(MONEY).alias("hours"))
    out = rows.groupBy("okey").agg(F.count(F.lit(1)).alias("operations"), total("hours").alias("total_hours"), total("planned").alias("total_planned"), total("actual").alias("total_actual"))
    return out.withColumn("variance", add(F.col("total_actual"), -F.col("total_planned")))


#: Why pieces of a work order were scrapped. Fixed values.
SCRAP = ("Brake assembly not as ordered", "Drill size too large", "Paint process failed", "Trim length too short")


@query(f"""with {WITH_LINES}, {WORK_SQL}, q as (select okey, sum(qty)::bigint as order_qty from pl group by 1),
s as (select *, case when {draw_sql("scrap", "okey")} % 1000 < 80 then least(order_qty, 1 + {draw_sql("scrapped", "okey")} % 3) else 0 end as scrapped_qty from q)
select work.okey, 'WO-' || lpad(work.okey::varchar, greatest(6, length(work.okey::varchar))::integer, '0') as ref, order_qty, order_qty - scrapped_qty as stocked_qty, scrapped_qty, case when scrapped_qty > 0 then ({list(SCRAP)})[({draw_sql("scrap_reason", "work.okey")} % {len(SCRAP)})::integer + 1] end as scrap_reason,
operations, total_hours, total_planned, total_actual, variance from work join s on s.okey = work.okey""")
def work_order_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product's quantities, an optional scrap reason, and the sums."""
    k = F.col("okey")
    q = priced_lines(spark, sf_dir).groupBy(F.col("okey").alias("q_key")).agg(F.sum("qty").cast("long").alias("order_qty"))
    rows = work_orders(spark, sf_dir).join(q, k == F.col("q_key"))
    rows = rows.withColumn("scrapped_qty", F.when(chance(80, "scrap", k), F.least(F.col("order_qty"), 1 + below(3, "scrapped", k))).otherwise(0).cast("long"))
    reason = F.when(F.col("scrapped_qty") > 0, one_of(list(SCRAP), "scrap_reason", k))
    return rows.select(k, F.concat(F.lit("WO-"), text.padded(k, 6)).alias("ref"), "order_qty", (F.col("order_qty") - F.col("scrapped_qty")).alias("stocked_qty"), "scrapped_qty", reason.alias("scrap_reason"), "operations", "total_hours", "total_planned", "total_actual", "variance")


@query(f"""select s_suppkey as emp, (hired + 60 + ({draw_sql("issued", "s_suppkey")} % 300)::integer)::date as issue_date,
(['Dear', 'To'])[({draw_sql("greeting", "s_suppkey")} % 2)::integer + 1] || ' whom it may concern: ' || s_name || ' has worked here since ' || strftime(hired, '%Y-%m-%d') || '.' as letter
from (select *, (date '2000-01-01' + ({draw_sql("hired", "s_suppkey")} % 5000)::integer)::date as hired from supplier)""")
def employment_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = read(spark, sf_dir, "supplier").withColumn("hired", F.date_add(F.lit("2000-01-01").cast("date"), below(5000, "hired", k).cast("int")))
    letter = F.concat(one_of(["Dear", "To"], "greeting", k), F.lit(" whom it may concern: "), "s_name", F.lit(" has worked here since "), F.date_format("hired", "yyyy-MM-dd"), F.lit("."))
    return rows.select(k.alias("emp"), F.date_add("hired", (60 + below(300, "issued", k)).cast("int")).alias("issue_date"), letter.alias("letter"))
