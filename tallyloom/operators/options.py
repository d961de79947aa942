"""Options drawn for each document, and those that a company pins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.draws import below, chance, draw_sql, one_of
from ..functions.locales import LOCALES
from ..registry import query
from ..sources.tables import read


@dataclass(frozen=True)
class Flag:
    """True for so many of a thousand documents."""

    per_mille: int

    def drawn(self, tag: str, key: str) -> Column:
        return chance(self.per_mille, tag, F.col(key))

    def sql(self, tag: str, key: str) -> str:
        return f"{draw_sql(tag, key)} % 1000 < {self.per_mille}"


@dataclass(frozen=True)
class OneOf:
    values: tuple

    def drawn(self, tag: str, key: str) -> Column:
        out = one_of(list(self.values), tag, F.col(key))
        return out.cast("long") if isinstance(self.values[0], int) else out

    def sql(self, tag: str, key: str) -> str:
        kind = "::bigint" if isinstance(self.values[0], int) else ""
        return f"({list(self.values)})[({draw_sql(tag, key)} % {len(self.values)})::integer + 1]{kind}"


@dataclass(frozen=True)
class Between:
    low: int
    high: int

    def drawn(self, tag: str, key: str) -> Column:
        return self.low + below(self.high - self.low + 1, tag, F.col(key))

    def sql(self, tag: str, key: str) -> str:
        return f"{self.low} + {draw_sql(tag, key)} % {self.high - self.low + 1}"


#: What is drawn, by scope. Fixed values.
ALL_TYPES = {
    "show_discount": Flag(600), "show_tax_column": Flag(300), "show_notes": Flag(500), "show_contact": Flag(700), "show_bank": Flag(700), "show_ship_to": Flag(800),
    "show_signature": Flag(300), "show_item_details": Flag(400), "tax_mode": OneOf(("none", "single", "single", "multi")), "max_items": OneOf((3, 5, 8, 12, 12, 20, 40)),
}
ORDER_TYPES = {"show_po_ref": Flag(400), "show_salesperson": Flag(500), "show_order_id": Flag(700), "po_drawn": Between(1000, 99999)}
BY_TYPE = {
    "invoice": {"payment_days": OneOf((15, 30, 30, 45, 60)), "paid_stamp": Flag(150)},
    "quote": {"valid_days": OneOf((15, 30, 30, 60)), "lead_days": Between(3, 21)},
    "credit_note": {"reason": OneOf(("damaged", "wrong_item", "expired", "price", "return")), "days_after": Between(5, 45), "credit_lines": OneOf((1, 1, 2, 3))},
    "packing_slip": {"show_unit": Flag(600), "backorder": Flag(200), "box": OneOf((6, 12, 24, 48))},
    "shipping_order": {"show_values": Flag(600), "freight_terms": OneOf(("freight_prepaid", "freight_collect"))},
    "purchase_order": {"show_approver": Flag(500), "po_payment_days": OneOf((30, 45, 60))},
    "receipt": {"show_unit_price": Flag(500), "cash": Flag(400), "tender_step": OneOf((1, 5, 10, 20)), "card_brand": OneOf(("Visa", "Mastercard", "Amex"))},
    "work_order": {"show_actual_dates": Flag(600)},
    "account_statement": {"show_aging": Flag(700), "show_remittance": Flag(600), "pay_ratio": OneOf((500, 750, 900))},
    "inventory_report": {"show_location": Flag(600), "inventory_items": OneOf((15, 25, 40, 60)), "group_rows": Flag(700)},
    "goods_received_note": {"received_after": Between(0, 3)},
    "payslip": {"overtime_hours": OneOf((0, 0, 0, 4, 8, 12)), "bonus": Flag(150), "show_balances": Flag(600), "show_national_id": Flag(500), "pay_delay": Between(0, 4)},
    "employment_certificate": {"salutation": Between(0, 2), "body": Between(0, 2), "extra": Flag(600), "closing": Between(0, 1)},
}
#: Flags that companies may pin. Fixed values.
PINNABLE = ("show_bank", "show_contact", "show_signature", "show_tax_column", "show_discount", "show_item_details")
PINNED = 3
_places = "(select list_sort([{" + "}, {".join(f"'h': sha1('pin|' || company || '|{o}'), 'o': '{o}'" for o in PINNABLE) + f"}}])[1:{PINNED}])"
PINNED_SQL = ", ".join(f"case when len(list_filter({_places}, lambda x: x.o = '{o}')) > 0 then {draw_sql('pinned-' + o, 'company')} % 2 = 0 end as p_{o}" for o in PINNABLE)
DATE_FORMS = {code: tuple(locale.date_formats) for code, locale in LOCALES.items()}


def drawn(rows: DataFrame, key: str, options: dict) -> DataFrame:
    return rows.select(key, *(o.drawn(name, key).alias(name) for name, o in options.items()))


def listed(options: dict, key: str) -> str:
    return ", ".join(f"{o.sql(name, key)} as {name}" for name, o in options.items())


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("okey"))


@query(f"select o_orderkey as okey, {listed(ALL_TYPES, 'o_orderkey')} from orders")
def options_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn(orders(spark, sf_dir), "okey", ALL_TYPES)


@query(f"select o_orderkey as okey, {listed(ORDER_TYPES, 'o_orderkey')} from orders")
def options_order_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn(orders(spark, sf_dir), "okey", ORDER_TYPES)


ORDER_SCOPES = ("invoice", "quote", "credit_note", "packing_slip", "shipping_order", "work_order", "goods_received_note", "purchase_order", "receipt")
_order_options = {k: v for scope in ORDER_SCOPES for k, v in BY_TYPE[scope].items()}


@query(f"select o_orderkey as okey, {listed(_order_options, 'o_orderkey')} from orders")
def options_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of the types that are made from orders and purchases."""
    return drawn(orders(spark, sf_dir), "okey", _order_options)


_other = {scope: BY_TYPE[scope] for scope in ("account_statement", "inventory_report", "payslip", "employment_certificate")}
_statement, _inventory, _staff = _other["account_statement"], _other["inventory_report"], _other["payslip"] | _other["employment_certificate"]


@query(f"select c_custkey as ckey, {listed(_statement, 'c_custkey')} from customer")
def options_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ckey")), "ckey", _statement)


@query(f"select s_suppkey as emp, {listed(_staff, 's_suppkey')} from supplier")
def options_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("emp")), "emp", _staff)


@query(f"""select scope, {listed(_inventory, 'scope')}, (date '2016-01-01' + ({draw_sql("as_of", "scope")} % 2830)::integer)::date as as_of from (select distinct 'brand:' || p_brand as scope from part)""")
def options_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of reports, and their day within the source's range."""
    scopes = read(spark, sf_dir, "part").select(F.concat(F.lit("brand:"), "p_brand").alias("scope")).distinct()
    day = F.date_add(F.lit("2016-01-01").cast("date"), below(2830, "as_of", F.col("scope")).cast("int"))
    return drawn(scopes, "scope", _inventory).withColumn("as_of", day)


@query(f"""with o as (select o_orderkey as okey, {draw_sql("company", "o_orderkey")} % (select count(*) from supplier) as company, {listed({n: ALL_TYPES[n] for n in PINNABLE}, 'o_orderkey')} from orders),
p as (select s_suppkey as company, {PINNED_SQL.replace("company", "s_suppkey")} from supplier)
select okey, o.company, {", ".join(f"coalesce(p_{n}, {n}) as {n}" for n in PINNABLE)} from o join p on p.company = o.company""")
def options_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawn options under those that the document's company pins, three of the six: maps merged, the later one wins."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"))
    many = s.agg(F.count(F.lit(1)).alias("many"))  # one row
    # The flags in the order of a hash of company and flag: the first three are pinned.
    hashed = F.array_sort(F.array(*(F.struct(F.sha1(F.concat_ws("|", F.lit("pin"), "s", F.lit(n))).alias("h"), F.lit(n).alias("flag"), (below(2, f"pinned-{n}", F.col("s")) == 0).alias("value")) for n in PINNABLE)))
    pinned = s.select("s", F.map_from_entries(F.transform(F.slice(hashed, 1, PINNED), lambda x: F.struct(x["flag"], x["value"]))).alias("pinned"))
    rows = orders(spark, sf_dir).join(F.broadcast(many)).withColumn("company", below(1 << 32, "company", F.col("okey")) % F.col("many"))
    own = F.map_from_arrays(F.array(*map(F.lit, PINNABLE)), F.array(*(ALL_TYPES[n].drawn(n, "okey") for n in PINNABLE)))
    rows = rows.join(pinned, F.col("company") == F.col("s")).withColumn("own", own)
    merged = F.map_zip_with("own", "pinned", lambda _, drawn_, pinned_: F.coalesce(pinned_, drawn_))
    return rows.withColumn("merged", merged).select("okey", "company", *(F.col("merged")[n].alias(n) for n in PINNABLE))


_month = {locale: f"({text.MONTHS[locale]})[month(d)]" for locale in DATE_FORMS}


def form_sql(form: str, locale: str) -> str:
    m = _month[locale]
    parts = {"d": "day(d)", "dd": "lpad(day(d)::varchar, 2, '0')", "mm": "lpad(month(d)::varchar, 2, '0')", "yyyy": "year(d)", "month": m, "mon": f"substr({m}, 1, 3)"}
    return " || ".join(parts[p] if k % 2 else f"'{p}'" for k, p in enumerate(text.re.split(r"\{(\w+)\}", form)) if p)


@query(f"""with o as (select o_orderkey as okey, cast(o_orderdate as date) as d, {draw_sql("date_format", "o_orderkey")} as x from orders)
select okey, (case {" ".join(f"when x % {len(f)} = {k} then {form_sql(v, 'en')}" for f in (DATE_FORMS["en"],) for k, v in enumerate(f))} end) as date_en,
(case {" ".join(f"when x % {len(f)} = {k} then {form_sql(v, 'fr')}" for f in (DATE_FORMS["fr"],) for k, v in enumerate(f))} end) as date_fr from o""")
def printed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in the form that is drawn for the document, of those its locale has."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("okey"), F.to_date("o_orderdate").alias("d"))

    def printed(locale: str) -> Column:
        forms = DATE_FORMS[locale]
        which = below(len(forms), "date_format", F.col("okey"))
        return F.coalesce(*(F.when(which == k, text.dated(F.col("d"), form, locale)) for k, form in enumerate(forms)))

    return o.select("okey", printed("en").alias("date_en"), printed("fr").alias("date_fr"))
