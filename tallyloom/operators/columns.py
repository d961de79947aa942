"""Cells of documents from lists of columns: which are shown, where their values are, and how they are printed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.locales import LOCALES, Locale, by_locale
from ..registry import query
from ..sources.tables import by_order
from .documents import PACKED_SQL, packed_lines
from .options import ALL_TYPES, BY_TYPE
from .printed import PRINTED_SQL, modes, printed_lines


@dataclass(frozen=True)
class Shown:
    """A column: the path of its value (a.b is b of the struct or map a), its label's key, how it is printed, and the option
    that shows it, if it isn't always shown."""

    path: str
    label: str
    fmt: str = "text"
    option: str = ""


#: Columns by type. Fixed values.
COLUMNS = {
    "invoice": (
        Shown("sku", "sku"), Shown("description", "description"), Shown("quantity", "quantity", "int"), Shown("unit_price", "unit_price", "money"), Shown("discount_rate", "discount", "percent", "show_discount"),
        Shown("tax_rate", "tax_rate", "percent", "show_tax_column"), Shown("line_total", "line_total", "money"),
    ),
    "packing_slip": (
        Shown("sku", "sku"), Shown("description", "description"), Shown("unit", "unit", option="show_unit"), Shown("quantity", "ordered", "int"), Shown("extra.shipped", "shipped", "int"),
        Shown("extra.backordered", "backordered", "int", "has_backorder"),
    ),
}


def value_at(rows: DataFrame, path: str) -> Column:
    """The value at a path; null where the rows have no such field."""
    kind, at = rows.schema, None
    for name in path.split("."):
        if kind.typeName() == "map":
            at, kind = at[name], kind.valueType
        elif kind.typeName() == "struct" and name in kind.names:
            at, kind = F.col(name) if at is None else at[name], kind[name].dataType
        else:
            return F.lit(None).cast("string")
    return at


def label(key: str, locale: Locale) -> str:
    """A label's text in a locale; of keys without one, their words."""
    return locale.labels.get(key, key.replace("_", " ").title())


def cells(rows: DataFrame, columns: tuple[Shown, ...], locales: dict[str, Locale] | None = None) -> DataFrame:
    """rows (with locale and currency, and a boolean column for each option) with cells: label and value of the columns that
    the row's options show, in their order. Options that are null or absent hide; locales without a file give null."""

    def of(locale: Locale) -> Column:
        each = []
        for c in columns:
            entry = F.struct(F.lit(label(c.label, locale)).alias("label"), locale.shown(value_at(rows, c.path), c.fmt, F.col("currency")).alias("value"))
            each.append(F.when(value_at(rows, c.option), entry) if c.option and c.option in rows.columns else F.lit(None) if c.option else entry)
        return F.filter(F.array(*each), lambda x: x.isNotNull())

    return rows.withColumn("cells", by_locale(F.col("locale"), of, locales))


def joined(cells_: Column) -> Column:
    return F.array_join(F.transform(cells_, lambda c: F.concat_ws("=", c["label"], c["value"])), " | ")


def _cells_sql(document: str, paths: dict[str, str]) -> str:
    group = lambda x: f"(case locale when 'fr' then replace(replace({x}, ',', chr(8239)), '.', ',') else {x} end)"
    sign = "(case currency when 'EUR' then '€' when 'GBP' then '£' else '$' end)"

    def shown(fmt: str, x: str) -> str:
        two = group(f"format('{{:,.2f}}', {x}::double)")
        if fmt == "money":
            return f"case locale when 'fr' then {two} || chr(160) || {sign} else {sign} || {two} end"
        if fmt == "int":
            return group(f"format('{{:,}}', {x}::bigint)")
        if fmt == "percent":
            v = f"({x} * 100)::decimal(18,4)"
            n = f"case when {v} = floor({v}) then format('{{:,}}', {v}::bigint) else format('{{:,.1f}}', round_even({v}, 1)::double) end"
            return f"case when {x} = 0 then '–' else {group(n)} || case locale when 'fr' then chr(160) || '%' else '%' end end"
        return f"{x}::varchar"

    each = []
    for c in COLUMNS[document]:
        name = "case locale " + " ".join(f"when '{code}' then '{label(c.label, l)}'" for code, l in LOCALES.items()) + " end"
        cell = f"({name}) || '=' || coalesce({shown(c.fmt, paths.get(c.path, c.path))}, '')"
        each.append(f"case when {c.option} then {cell} end" if c.option else cell)
    return f"concat_ws(' | ', {', '.join(each)})"


@query(f"""with {PRINTED_SQL}, {PACKED_SQL}, m as (select okey as m_key, locale, currency, {ALL_TYPES["show_tax_column"].sql("show_tax_column", "okey")} as show_tax_column, {BY_TYPE["packing_slip"]["show_unit"].sql("show_unit", "okey")} as show_unit from modes),
i as (select p.*, locale, currency, show_tax_column, part as sku, p_name as description, qty as quantity, discount as discount_rate, rate as tax_rate from printed p join m on m_key = p.okey),
s as (select p.*, locale, currency, show_unit, part as sku, p_name as description, qty as quantity, 'EA' as unit, bool_or(back > 0) over (partition by okey) as has_backorder from packed p join m on m_key = p.okey)
select 'invoice' as document, okey, shown_no as row_no, {_cells_sql("invoice", {})} as cells from i
union all select 'packing_slip', okey, line_no, {_cells_sql("packing_slip", {"extra.shipped": "(qty - back)", "extra.backordered": "back"})} from s""")
def printed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of invoices and packing slips, cell by cell as printed."""
    sf_dir, k = by_order(spark, sf_dir), F.col("okey")
    m = modes(spark, sf_dir).select(k.alias("mode_key"), "locale", "currency", ALL_TYPES["show_tax_column"].drawn("show_tax_column", "okey").alias("show_tax_column"), BY_TYPE["packing_slip"]["show_unit"].drawn("show_unit", "okey").alias("show_unit"))
    lines = printed_lines(spark, sf_dir).join(m.drop("show_unit", "locale", "currency"), k == F.col("mode_key"))
    i = lines.select(k, F.col("shown_no").alias("row_no"), "locale", "currency", "show_discount", "show_tax_column", F.col("part").alias("sku"), F.col("p_name").alias("description"), F.col("qty").alias("quantity"), "unit_price", F.col("discount").alias("discount_rate"), F.col("rate").alias("tax_rate"), "line_total")
    short = packed_lines(spark, sf_dir).withColumn("has_backorder", F.bool_or(F.col("back") > 0).over(Window.partitionBy("okey")))
    short = short.join(m.drop("show_tax_column"), k == F.col("mode_key"))
    extra = F.struct((F.col("qty") - F.col("back")).alias("shipped"), F.col("back").alias("backordered"))
    s = short.select(k, F.col("line_no").cast("long").alias("row_no"), "locale", "currency", "show_unit", "has_backorder", F.col("part").alias("sku"), F.col("p_name").alias("description"), F.lit("EA").alias("unit"), F.col("qty").alias("quantity"), extra.alias("extra"))
    made = [cells(rows, COLUMNS[document]).select(F.lit(document).alias("document"), "okey", "row_no", joined(F.col("cells")).alias("cells")) for document, rows in (("invoice", i), ("packing_slip", s))]
    return made[0].unionByName(made[1])
