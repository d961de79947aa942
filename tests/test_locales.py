"""Locales from files, compiled formats, and cells from lists of columns."""

import decimal
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import locales, text
from tallyloom.operators import columns

D = decimal.Decimal


def dec(x):
    return F.lit(x).cast("decimal(18,4)")


def test_a_locale_from_a_file(spark, tmp_path):
    """Formats and separators of more than one character, unknown currencies, doubled braces."""
    months = [f"m{k:02d}onth" for k in range(1, 13)]
    (tmp_path / "xx.json").write_text(json.dumps({"code": "xx", "months": months, "decimal_sep": " point ", "group_sep": "", "currency_format": "{{{code}}} {amount}~{symbol}", "day_format": "{yy}.{mm}.{d} ({mon})", "labels": {"sku": "Ref"}, "texts": {"hi": "to {who}, {n:04d}"}}))
    got = locales.load(locales.FOLDER, tmp_path)
    assert set(got) == {"en", "fr", "xx"}
    x, d = got["xx"], F.lit("2031-05-07").cast("date")
    row = spark.range(1).select(
        x.number(dec("1234567.5")), x.number(dec("-1234.5"), 0), x.money(dec("5"), F.lit("JPY")), x.money(dec("5"), F.lit("CAD")), x.percent(dec("0.055")), x.date(d), x.date(F.lit(None).cast("date")), x.text("hi", who=F.lit(None).cast("string"), n=F.lit(7)))
    assert tuple(row.first()) == ("1234567 point 50", "-1234", "{JPY} 5 point 00~JPY", "{CAD} 5 point 00~CA$", "5 point 5 %", "31.05.7 (m05)", None, "to , 0007")
    (tmp_path / "yy.json").write_text(json.dumps({"code": "yy", "months": months[:3]}))
    with pytest.raises(ValueError):
        locales.load(tmp_path)


def test_signs_and_rates(spark):
    en, fr = locales.LOCALES["en"], locales.LOCALES["fr"]
    row = spark.range(1).select(en.money(dec("-1234.5"), F.lit("USD")), fr.money(dec("-1234.5"), F.lit("EUR")), en.percent(dec("0.2")), fr.percent(dec("0.0825")), text.long_date(F.lit("2020-08-03").cast("date"), "fr"))
    assert tuple(row.first()) == ("$-1,234.50", "-1 234,50 €", "20%", "8,2 %", "3 août 2020")


def test_cells(spark):
    rows = [("en", "USD", True, None, "a", 3, D("9.99"), D("0.100"), D("0"), D("26.97"), (2, 1)), ("fr", "EUR", False, True, None, 3, D("9.99"), D("0.1"), D("0.055"), D("26.97"), (None, None)), ("zz", "EUR", True, True, "b", 1, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "locale string, currency string, show_discount boolean, show_tax_column boolean, sku string, quantity int, unit_price decimal(18,2), discount_rate decimal(5,3), tax_rate decimal(5,3), line_total decimal(18,2), extra struct<shipped: int, other: int>")
    want = (columns.Shown("sku", "sku"), columns.Shown("quantity", "quantity", "int"), columns.Shown("discount_rate", "discount", "percent", "show_discount"), columns.Shown("tax_rate", "tax_rate", "percent", "show_tax_column"), columns.Shown("extra.shipped", "shipped", "int"),
            columns.Shown("extra.gone", "gone"), columns.Shown("line_total", "line_total", "money"), columns.Shown("sku", "never", option="no_such_option"))
    got = {r.locale: r.c for r in columns.cells(df, want).select("locale", columns.joined(F.col("cells")).alias("c")).collect()}
    assert got == {"en": "SKU=a | Quantity=3 | Discount=10% | Shipped=2 | Gone= | Line Total=$26.97", "fr": "Sku= | Quantité=3 | Tax Rate=5,5 % | Shipped= | Gone= | Montant=26,97 €", "zz": None}
    by_map = df.select("locale", "currency", F.create_map(F.lit("shipped"), F.lit(5)).alias("extra"))
    assert columns.cells(by_map, (columns.Shown("extra.shipped", "shipped", "int"),)).filter("locale = 'en'").first().cells[0].value == "5"
