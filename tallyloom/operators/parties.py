"""People, customers and vendors as parties, and descriptions of products by language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.draws import chance, draw_sql, one_of
from ..registry import query
from ..sources.tables import WEIGHT_SQL, read, weight_kg

#: Countries whose regions stand in addresses, by number. Fixed values.
WITH_REGION = (1, 2, 24)


def either(*columns: Column | str) -> Column:
    """The first that is neither null nor empty; else the empty text."""
    return F.coalesce(*(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns), F.lit(""))


PERSON_SQL = """people as (select c_custkey as person, case when c_custkey % 11 <> 0 then split_part(c_name, '#', 1) end as first_name, case when c_custkey % 13 <> 0 then split_part(c_name, '#', 2) end as last_name from customer),
names as (select person, concat_ws(' ', nullif(first_name, ''), nullif(last_name, '')) as name from people),
emails as (select o_custkey as person, min(o_orderkey) as k from orders where o_orderstatus = 'O' group by 1),
phones as (select o_custkey as person, min(o_orderkey) as k from orders where o_orderstatus = 'F' group by 1),
contacts as (select n.person, name, case when e.k is not null then 'c' || n.person || '@mail' || e.k % 7 || '.example' else '' end as email, case when p.k is not null then '555-' || lpad(p.k::varchar, greatest(7, length(p.k::varchar))::integer, '0') else '' end as phone
  from names n left join emails e on e.person = n.person left join phones p on p.person = n.person)"""


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """person, name (the parts that are known), first email and first phone by key, empty where there is none."""
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    part = lambda n, every: F.when(F.col("c_custkey") % every != 0, F.nullif(F.split_part("c_name", F.lit("#"), F.lit(n)), F.lit("")))
    people = c.select(F.col("c_custkey").alias("person"), F.concat_ws(" ", part(1, 11), part(2, 13)).alias("name"))
    first = lambda status: F.min(F.when(F.col("o_orderstatus") == status, F.col("o_orderkey")))
    keys = o.groupBy(F.col("o_custkey").alias("k")).agg(first("O").alias("e"), first("F").alias("p"))
    email = F.concat(F.lit("c"), "person", F.lit("@mail"), F.col("e") % 7, F.lit(".example"))
    rows = people.join(keys, F.col("person") == F.col("k"), "left")
    return rows.select("person", "name", F.coalesce(email, F.lit("")).alias("email"), F.coalesce(F.concat(F.lit("555-"), text.padded(F.col("p"), 7)), F.lit("")).alias("phone"))


@query(f"with {PERSON_SQL} select person, name, email, phone from contacts")
def person_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contacts(spark, sf_dir)


CUSTOMER_SQL = f"""{PERSON_SQL},
buyers as (select c.c_custkey, c.c_nationkey, case when c_custkey % 3 = 0 then c_custkey % (select count(*) from supplier) end as store, case when c_custkey % 3 <> 0 or c_custkey % 2 = 0 then c_custkey end as person from customer c),
customers as (select b.c_custkey as ckey, case when store is not null then s_name else coalesce(p.name, '') end as name, case when store is not null then coalesce(p.name, '') else '' end as contact,
  case when store is null then coalesce(p.email, '') else '' end as email, case when store is null then coalesce(p.phone, '') else '' end as phone, store is null as b2c,
  'AW' || lpad(b.c_custkey::varchar, greatest(8, length(b.c_custkey::varchar))::integer, '0') as code, n_name as country, case when n_nationkey in (1, 2, 24) then r_name else '' end as region
  from buyers b left join supplier on s_suppkey = store left join contacts p on p.person = b.person join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shops under their own name with a contact, persons under theirs with mail and phone; b2c tells them apart. The
    region stands in addresses of a few countries only."""
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    stores = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    many = stores.agg(F.count(F.lit(1)).alias("many"))  # one row
    k = F.col("c_custkey")
    rows = c.join(F.broadcast(many)).withColumn("store", F.when(k % 3 == 0, k % F.col("many"))).withColumn("who", F.when((k % 3 != 0) | (k % 2 == 0), k))
    rows = rows.join(stores, F.col("store") == F.col("s_suppkey"), "left").join(contacts(spark, sf_dir).withColumnRenamed("name", "p_name"), F.col("who") == F.col("person"), "left")
    rows = rows.join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # 25 and 5 rows
    b2c, known = F.col("store").isNull(), lambda x: F.coalesce(x, F.lit(""))
    return rows.select(
        k.alias("ckey"), F.when(b2c, known("p_name")).otherwise(F.col("s_name")).alias("name"), F.when(b2c, "").otherwise(known("p_name")).alias("contact"), F.when(b2c, known("email")).otherwise("").alias("email"),
        F.when(b2c, known("phone")).otherwise("").alias("phone"), b2c.alias("b2c"), F.concat(F.lit("AW"), text.padded(k, 8)).alias("code"), F.col("n_name").alias("country"), F.when(F.col("n_nationkey").isin(*WITH_REGION), F.col("r_name")).otherwise("").alias("region"))


@query(f"with {CUSTOMER_SQL} select ckey, name, contact, email, phone, b2c, code, country, region from customers")
def customer_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir)


@query("select s_suppkey, s_name as name, 'V' || lpad(s_suppkey::varchar, greatest(4, length(s_suppkey::varchar))::integer, '0') as code, n_name as country from supplier left join nation on n_nationkey = s_nationkey")
def vendor_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select("s_suppkey", F.col("s_name").alias("name"), F.concat(F.lit("V"), text.padded(F.col("s_suppkey"), 4)).alias("code"), F.col("n_name").alias("country"))  # 25 nations


#: Carriers of shipments. Fixed values.
CARRIERS = ("XRQ - TRUCK GROUND", "ZY - EXPRESS", "OVERSEAS - DELUXE")


@query(f"""select o_orderkey, coalesce(arg_min('T' || lpad(floor(l_extendedprice)::bigint::varchar, 8, '0'), row(l_linenumber, l_partkey, l_suppkey, l_extendedprice)), '') as tracking,
  array_to_string(list_transform(regexp_extract_all(any_value(carrier), '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), '') as carrier
from (select *, ({list(CARRIERS)})[({draw_sql("carrier", "o_orderkey")} % 3)::integer + 1] as carrier from orders) left join lineitem on l_orderkey = o_orderkey group by 1""")
def carriers_and_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line's tracking number, empty without lines, and the carrier's name in title case."""
    l = read(spark, sf_dir, "lineitem")
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    first = l.groupBy("l_orderkey").agg(F.min_by(F.concat(F.lit("T"), F.lpad(F.floor("l_extendedprice").cast("long").cast("string"), 8, "0")), place).alias("t"))
    rows = read(spark, sf_dir, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select("o_orderkey", F.coalesce("t", F.lit("")).alias("tracking"), text.title(one_of(list(CARRIERS), "carrier", F.col("o_orderkey"))).alias("carrier"))


TEXTS_SQL = """cultures as (select p_partkey, unnest([{'c': 'en    ', 'd': case when p_partkey % 4 <> 1 then '  Fine ' || p_name end}, {'c': 'fr    ', 'd': case when p_partkey % 5 <> 1 then p_name || '  de ' || p_brand || ' ' end}, {'c': 'ar    ', 'd': p_type}]) as x from part),
kept as (select p_partkey, trim(x.c) as culture, trim(regexp_replace(x.d, '\\s+', ' ', 'g')) as description from cultures where x.d is not null and trim(x.c) in ('en', 'fr')),
described as (select p_partkey, max(case when culture = 'en' then description end) as en, max(case when culture = 'fr' then description end) as fr from kept group by 1)"""


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey and a map from language to description, of English and French only."""
    k = F.col("p_partkey")
    of = lambda c, d: F.struct(F.lit(c).alias("c"), d.alias("d"))
    stated = F.array(of("en    ", F.when(k % 4 != 1, F.concat(F.lit("  Fine "), "p_name"))), of("fr    ", F.when(k % 5 != 1, F.concat(F.col("p_name"), F.lit("  de "), F.col("p_brand"), F.lit(" ")))), of("ar    ", F.col("p_type")))
    rows = read(spark, sf_dir, "part").select(k, F.explode(stated).alias("x")).filter(F.col("x.d").isNotNull() & F.trim("x.c").isin("en", "fr"))
    entry = F.struct(F.trim("x.c").alias("key"), text.clean(F.col("x.d")).alias("value"))
    return rows.groupBy(k).agg(F.map_from_entries(F.collect_list(entry)).alias("details"))  # two entries a product at most


@query(f"with {TEXTS_SQL} select p_partkey, en, fr from described")
def product_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptions(spark, sf_dir).select("p_partkey", F.col("details")["en"].alias("en"), F.col("details")["fr"].alias("fr"))


@query(f"""with {TEXTS_SQL}, wanted as (select p_partkey, case when p_partkey % 3 = 0 then 'fr' else 'en' end as locale, p_name from part),
bank as (select p_partkey, locale, 'From the bank: ' || p_name as t from wanted where p_partkey % 2 = 1)
select w.p_partkey, w.locale, coalesce(case when w.locale = 'fr' then fr else en end, en, t, '') as details, case when (case when w.locale = 'fr' then fr else en end) is not null then 'own' when en is not null then 'en' when t is not null then 'bank' else 'none' end as found_in
from wanted w left join described d on d.p_partkey = w.p_partkey left join bank b on b.p_partkey = w.p_partkey""")
def product_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's text: in the document's language, else in English, else from the bank of texts, else none."""
    k = F.col("p_partkey")
    wanted = read(spark, sf_dir, "part").select(k, F.when(k % 3 == 0, "fr").otherwise("en").alias("locale"), "p_name")
    rows = wanted.join(descriptions(spark, sf_dir).withColumnRenamed("p_partkey", "d_key"), k == F.col("d_key"), "left")
    own, en = F.try_element_at("details", F.col("locale")), F.try_element_at("details", F.lit("en"))
    bank = F.when(k % 2 == 1, F.concat(F.lit("From the bank: "), "p_name"))
    where = F.when(own.isNotNull(), "own").when(en.isNotNull(), "en").when(bank.isNotNull(), "bank").otherwise("none")
    return rows.select(k, "locale", F.coalesce(own, en, bank, F.lit("")).alias("details"), where.alias("found_in"))


@query(f"select p_partkey, case p_partkey % 3 when 0 then 'LB' when 1 then 'G' else 'KG' end as unit, {WEIGHT_SQL} as weight_kg from part")
def product_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights in kilograms, whatever unit a product states."""
    unit = F.when(F.col("p_partkey") % 3 == 0, "LB").when(F.col("p_partkey") % 3 == 1, "G").otherwise("KG")
    return read(spark, sf_dir, "part").select("p_partkey", unit.alias("unit"), weight_kg().alias("weight_kg"))


@query(f"""with {CUSTOMER_SQL} select o_orderkey as okey, name as bill_to, case when b2c then '' else 'Dock ' || o_custkey % 5 || ', ' || country end as ship_to, case when not b2c and {draw_sql("show_ship_to", "o_orderkey")} % 1000 < 800 then true else false end as ship_to_shown from orders join customers on ckey = o_custkey""")
def order_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is billed and where goods go: shown if the option says so, and never for persons."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("okey"), "o_custkey")
    rows = o.join(customers(spark, sf_dir), F.col("o_custkey") == F.col("ckey"))
    dock = F.concat(F.lit("Dock "), F.col("o_custkey") % 5, F.lit(", "), "country")
    return rows.select("okey", F.col("name").alias("bill_to"), F.when(F.col("b2c"), "").otherwise(dock).alias("ship_to"), (~F.col("b2c") & chance(800, "show_ship_to", F.col("okey"))).alias("ship_to_shown"))


@query("""select o_custkey as ckey, o_orderkey as okey from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_custkey % 29 <> 3)""")
def orders_of_unknown_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows whose party isn't in the catalogue (here a part of the customers): a run with any of them stops."""
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer").filter("c_custkey % 29 <> 3")
    return o.join(c, o.o_custkey == c.c_custkey, "left_anti").select(F.col("o_custkey").alias("ckey"), F.col("o_orderkey").alias("okey"))
