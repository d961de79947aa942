"""Queries over the scalar helpers: rounding, numbers, dates, keys, masks and formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.money import convert, exact, half_even, half_up, tender
from ..registry import query
from ..sources.tables import CURRENCIES, WITH_LINES, WITH_ORDERS, order_headers, priced_lines, read

RATES_SQL = "(values " + ", ".join(f"({k}, '{c}', {r}::decimal(9,4))" for k, (c, r) in CURRENCIES.items()) + ") fx(region_key, currency, rate)"


def rates(spark: SparkSession) -> DataFrame:
    rows = [(k, c, r) for k, (c, r) in CURRENCIES.items()]
    return F.broadcast(spark.createDataFrame(rows, "region_key int, currency string, r string").select("region_key", "currency", F.col("r").cast("decimal(9,4)").alias("rate")))  # five rows


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(x, 2)::decimal(18,2) as up2, round_even(x, 2)::decimal(18,2) as even2, round_even(x, 3)::decimal(18,3) as even3, round(-x, 2)::decimal(18,2) as down2
from (select *, cast(cast(l_extendedprice as decimal(18,2)) / 8 as decimal(18,5)) as x from lineitem)""")
def rounding_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half up and half to even, on decimals only."""
    rows = read(spark, sf_dir, "lineitem").withColumn("x", (F.col("l_extendedprice").cast("decimal(18,2)") / 8).cast("decimal(18,5)"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", half_up(F.col("x")).alias("up2"), half_even(F.col("x")).alias("even2"), half_even(F.col("x"), 3).alias("even3"), half_up(-F.col("x")).alias("down2"))


@query(f"""with {WITH_LINES}, {WITH_ORDERS} select oh.okey, currency, round(sum(line_total) * any_value(rate), 2)::decimal(18,2) as amount
from oh join pl on pl.okey = oh.okey join {RATES_SQL} on region_key = region group by 1, 2""")
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = priced_lines(spark, sf_dir).groupBy(F.col("okey").alias("k")).agg(F.sum("line_total").cast("decimal(18,2)").alias("usd"))
    rows = order_headers(spark, sf_dir).join(totals, F.col("okey") == F.col("k")).join(rates(spark), F.col("region") == F.col("region_key"))
    return rows.select("okey", "currency", convert(F.col("usd"), F.col("rate")).alias("amount"))


@query("""select o_orderkey, 'INV-' || year(o_orderdate) || '-' || lpad(o_orderkey::varchar, greatest(5, length(o_orderkey::varchar))::integer, '0') as number_long,
'Q' || lpad((year(o_orderdate) % 100)::varchar, 2, '0') || '/' || lpad(o_orderkey::varchar, greatest(3, length(o_orderkey::varchar))::integer, '0') as number_short from orders""")
def doc_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, year = read(spark, sf_dir, "orders"), F.year("o_orderdate")
    return o.select("o_orderkey", F.concat(F.lit("INV-"), year, F.lit("-"), text.padded(F.col("o_orderkey"), 5)).alias("number_long"), F.concat(F.lit("Q"), text.padded(year % 100, 2), F.lit("/"), text.padded(F.col("o_orderkey"), 3)).alias("number_short"))


@query("select o_orderkey, substr(sha1(o_orderkey || '|invoice.' || o_orderstatus || '|' || o_custkey || '|42'), 1, 16) as doc_id, sha256(o_orderkey::varchar) as blob from orders")
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("|", "o_orderkey", F.concat(F.lit("invoice."), "o_orderstatus"), "o_custkey", F.lit("42"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.substring(F.sha1(key), 1, 16).alias("doc_id"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("blob"))


@query("""select o_orderkey, cast(o_orderdate + interval 19 year as date) as shifted, cast(o_orderdate as date) + 30 as due, cast(o_orderdate as date) - 14 as quoted,
date_diff('day', cast(o_orderdate as date), date '2001-12-31') as age, cast(date_trunc('month', o_orderdate) as date) as period_start, last_day(o_orderdate) as period_end,
cast(date_trunc('week', o_orderdate) as date) as week_start, cast(date_trunc('week', o_orderdate) as date) + 13 as fortnight_end from orders""")
def date_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift by years with 29 February clamped, due dates, ages, pay periods by month and by two weeks."""
    d = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date(F.col("o_orderdate") + F.make_ym_interval(F.lit(19), F.lit(0))).alias("shifted"), F.date_add(d, 30).alias("due"), F.date_sub(d, 14).alias("quoted"),
        F.datediff(F.lit("2001-12-31").cast("date"), d).cast("long").alias("age"), F.trunc(d, "MM").alias("period_start"), F.last_day(d).alias("period_end"), F.trunc(d, "week").alias("week_start"), F.date_add(F.trunc(d, "week"), 13).alias("fortnight_end"))


@query("""select event_id, strftime(ts, '%H:%M') as clock, cast(substr(replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.000'), 'T', ' '), 1, 19) as timestamp) as parsed from events""")
def timestamps_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("iso", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.'000'"))
    return e.select("event_id", F.date_format("ts", "HH:mm").alias("clock"), F.try_to_timestamp(F.replace(F.substring("iso", 1, 19), F.lit("T"), F.lit(" "))).cast("timestamp_ntz").alias("parsed"))


@query("""select c_custkey, case when c_custkey >= 1000 then '•••-••-' || right(c_custkey::varchar, 4) else c_custkey::varchar end as masked,
right(c_custkey || ':' || c_nationkey, 40) as raw_key, cast(right(c_custkey::varchar || c_nationkey::varchar, 9) as bigint) as digits_key,
cast('0x' || substr(sha1('segment:' || c_mktsegment), 1, 8) as bigint) % 1000000 as hashed_key from customer""")
def masks_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws(":", "c_custkey", "c_nationkey")
    return read(spark, sf_dir, "customer").select("c_custkey", text.masked(F.col("c_custkey").cast("string")).alias("masked"), key.alias("raw_key"), text.numeric_key(key).alias("digits_key"), text.numeric_key(F.concat(F.lit("segment:"), "c_mktsegment")).alias("hashed_key"))


@query("""select s_suppkey, s_name || case when s_suppkey % 3 = 0 then ' / Unit ' || s_suppkey else '' end || ' / ' || lpad(s_suppkey::varchar, 5, '0') || ' ' || n_name || case when n_regionkey in (0, 1) then ', ' || r_name else '' end || ' / ' || r_name as address
from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey""")
def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address lines without empty ones; the region stands only where it's asked for."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # 25 and 5 rows
    unit = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("Unit "), "s_suppkey")).otherwise("")
    region = F.when(F.col("n_regionkey").isin(0, 1), F.col("r_name")).otherwise("")
    return rows.select("s_suppkey", text.address_lines(F.col("s_name"), unit, text.padded(F.col("s_suppkey"), 5), F.col("n_name"), region, F.col("r_name")).alias("address"))


@query(f"""with x as (select o_orderkey, round(cast(cast(o_totalprice as varchar) as decimal(24,6)), 2)::decimal(18,2) as v, cast(o_orderdate as date) as d from orders)
select o_orderkey, '$' || format('{{:,.2f}}', v::double) as usd_en, replace(replace(format('{{:,.2f}}', v::double), ',', chr(8239)), '.', ',') || chr(160) || '€' as eur_fr,
monthname(d) || ' ' || day(d) || ', ' || year(d) as date_en,
day(d) || ' ' || (['{"', '".join(text.MONTHS["fr"])}'])[month(d)] || ' ' || year(d) as date_fr from x""")
def locale_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, d = half_up(exact(F.col("o_totalprice"))), F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select("o_orderkey", text.money(v, "en", "USD").alias("usd_en"), text.money(v, "fr", "EUR").alias("eur_fr"), text.long_date(d, "en").alias("date_en"), text.long_date(d, "fr").alias("date_fr"))


@query("""with x as (select distinct round(cast(cast(l_discount as varchar) as decimal(24,6)), 2)::decimal(5,2) as d from lineitem), y as (select d / 4 as r, d from x)
select d::decimal(5,2) as rate, (d * 100)::integer || '%' as whole_en, case when (d * 25) = floor(d * 25) then (d * 25)::integer::varchar else replace(round_even((d * 25)::decimal(9,2), 1)::decimal(9,1)::varchar, '.', ',') end || chr(160) || '%' as quarter_fr from x""")
def percent_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.round(exact(F.col("l_discount")), 2).cast("decimal(5,2)")
    rows = read(spark, sf_dir, "lineitem").select(d.alias("rate")).distinct()
    return rows.select("rate", text.percent(F.col("rate"), "en").alias("whole_en"), text.percent((F.col("rate") / 4).cast("decimal(9,4)"), "fr").alias("quarter_fr"))


@query(r"""select doc_id, coalesce(trim(regexp_replace(text, '[\s\x{00a0}\x{202f}]+', ' ', 'g')), '') = array_to_string(list_filter(regexp_split_to_array(text, '[\s\x{00a0}\x{202f}]+'), lambda x: x <> ''), ' ') as collapsed,
regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug,
case when length(text) <= 80 then text else regexp_replace(substr(text, 1, 80), '\s\S*\z', '') end as teaser from documents""")
def text_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    words = F.array_join(F.filter(F.split(t, text.WHITE), lambda x: x != ""), " ")
    return read(spark, sf_dir, "documents").select("doc_id", (text.clean(t) == words).alias("collapsed"), text.slug(t).alias("slug"), text.shorten(t, 80).alias("teaser"))


@query("""select event_id, total, step, (ceil(total / step) * step)::decimal(18,2) as tendered, (ceil(total / step) * step - total)::decimal(18,2) as change
from (select event_id, round(cast(cast(value as varchar) as decimal(24,6)), 2)::decimal(18,2) as total, ([1, 5, 10, 20])[(cast('0x' || substr(sha1('42|tender|' || event_id), 1, 8) as bigint) % 4)::integer + 1]::bigint as step from events where event_type = 'purchase')""")
def receipt_tender(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.draws import one_of

    rows = read(spark, sf_dir, "events").filter("event_type = 'purchase'").select("event_id", half_up(exact(F.col("value"))).alias("total"), one_of([1, 5, 10, 20], "tender", F.col("event_id")).cast("long").alias("step"))
    paid = tender(F.col("total"), F.col("step"))
    return rows.select("event_id", "total", "step", paid.alias("tendered"), (paid - F.col("total")).cast("decimal(18,2)").alias("change"))


@query("""select item_id, 'x' as tag, length(text)::bigint as a from benchmark""")
def tolerant_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON with a fence or chatter around it."""
    rows = read(spark, sf_dir, "benchmark").withColumn("answer", F.concat(F.lit('Sure:\n```json\n{"tag": "x", "a": '), F.length("text"), F.lit("}\n```\nDone.")))
    parsed = text.tolerant_json(F.col("answer"), "tag string, a bigint")
    return rows.select("item_id", parsed.tag.alias("tag"), parsed.a.alias("a"))


@query("""with b as (select doc_id, radians(((doc_id % 7) - 3)::double) as t, 1 + ((doc_id % 5) - 2) / 100.0::double as s, 10.0 * (doc_id % 13)::double as x0, 20.0 + (doc_id % 11)::double as y0 from documents),
c as (select doc_id, unnest([x0, x0 + 8, x0, x0 + 8]) as x, unnest([y0, y0, y0 + 5, y0 + 5]) as y, t, s from b),
m as (select doc_id, 300 + s * ((x - 300) * cos(t) - (y - 400) * sin(t)) + 2 as u, 400 + s * ((x - 300) * sin(t) + (y - 400) * cos(t)) - 1 as v from c)
select doc_id, round(min(u), 1) as left_x, round(min(v), 1) as top_y, round(max(u), 1) as right_x, round(max(v), 1) as bottom_y from m group by 1""")
def mapped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word boxes under rotation and scale about the page's centre and a shift: the box around the four mapped corners."""
    k = F.col("doc_id")
    rows = read(spark, sf_dir, "documents").select("doc_id", F.radians(((k % 7) - 3).cast("double")).alias("t"), (1 + ((k % 5) - 2) / F.lit(100.0)).alias("s"), (10.0 * (k % 13)).alias("x0"), (20.0 + (k % 11)).alias("y0"))
    corners = [(F.col("x0") + dx - 300, F.col("y0") + dy - 400) for dx, dy in ((0, 0), (8, 0), (0, 5), (8, 5))]
    us = [300 + F.col("s") * (x * F.cos("t") - y * F.sin("t")) + 2 for x, y in corners]
    vs = [400 + F.col("s") * (x * F.sin("t") + y * F.cos("t")) - 1 for x, y in corners]
    return rows.select("doc_id", F.round(F.least(*us), 1).alias("left_x"), F.round(F.least(*vs), 1).alias("top_y"), F.round(F.greatest(*us), 1).alias("right_x"), F.round(F.greatest(*vs), 1).alias("bottom_y"))


@query("""select source, n, case when n < 1000 then 'n<1K' when n < 10000 then '1K<n<10K' when n < 100000 then '10K<n<100K' else '100K<n' end as size_category from (select source, sum(n_chars)::bigint as n from documents group by 1)""")
def size_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("n"))
    n = F.col("n")
    return rows.select("source", "n", F.when(n < 1000, "n<1K").when(n < 10000, "1K<n<10K").when(n < 100000, "10K<n<100K").otherwise("100K<n").alias("size_category"))
