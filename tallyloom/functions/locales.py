"""Locales read from files, and their formats compiled to column expressions.

A locale is a JSON file: separators, formats with names in braces, months, labels and texts. A format is taken apart once, on
the driver; what runs on the rows are built-in functions. Where rows differ in locale, each locale's expression stands in one
branch of a `when`."""

from __future__ import annotations

import json
import pathlib
import string
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDER = pathlib.Path(__file__).resolve().parent.parent / "locales"
#: What stands for a rate of nothing.
NO_RATE = "–"


def load_symbols(folder: pathlib.Path = FOLDER) -> dict[str, str]:
    return json.loads((folder / "symbols.json").read_text(encoding="utf-8"))


SYMBOLS = load_symbols()


def padded(x: Column, width: int) -> Column:
    """Zeros in front up to a width; longer numbers stay whole."""
    s = x.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def compiled(form: str, values: dict[str, Column]) -> Column:
    """A text with names in braces, each replaced by its column; null counts as empty. {name:06d} pads a whole number with
    zeros up to a width; doubled braces stand for one."""
    out = []
    for literal, name, spec, _ in string.Formatter().parse(form):
        out += [F.lit(literal)] * bool(literal)
        if name is not None:
            value = values[name].cast("string")
            out.append(F.coalesce(padded(value, int(spec[:-1])) if spec else value, F.lit("")))
    return F.concat(*out) if out else F.lit("")


def symbol_of(currency: Column) -> Column:
    """The sign of a currency; its code if it has none."""
    return F.coalesce(*(F.when(currency == c, s) for c, s in SYMBOLS.items()), currency)


@dataclass(frozen=True)
class Locale:
    code: str
    months: list[str]
    currency: str = "USD"
    decimal_sep: str = "."
    group_sep: str = ","
    currency_format: str = "{symbol}{amount}"
    percent_format: str = "{amount} %"
    day_format: str = "{yyyy}-{mm}-{dd}"
    date_formats: list[str] = field(default_factory=lambda: ["{yyyy}-{mm}-{dd}"])
    labels: dict[str, str] = field(default_factory=dict)
    texts: dict[str, str] = field(default_factory=dict)

    def number(self, x: Column, places: int = 2) -> Column:
        plain = F.format_number(x, places)
        if len(self.group_sep) == len(self.decimal_sep) == 1:
            return F.translate(plain, ",.", self.group_sep + self.decimal_sep)
        return F.replace(F.replace(F.replace(plain, F.lit("."), F.lit("\0")), F.lit(","), F.lit(self.group_sep)), F.lit("\0"), F.lit(self.decimal_sep))

    def money(self, x: Column, currency: Column) -> Column:
        return compiled(self.currency_format, {"symbol": symbol_of(currency), "amount": self.number(x), "code": currency})

    def percent(self, rate: Column) -> Column:
        """No decimal for whole per cents, one otherwise."""
        value = (rate * 100).cast("decimal(18,4)")
        amount = F.when(value == F.floor(value), self.number(value, 0)).otherwise(self.number(F.bround(value, 1), 1))
        return compiled(self.percent_format, {"amount": amount})

    def date(self, d: Column, form: str | None = None) -> Column:
        """A date in a form of d, dd, m, mm, yy, yyyy, month and mon (the month's first three letters)."""
        two = lambda x: F.lpad(x.cast("string"), 2, "0")
        name = F.get(F.array(*map(F.lit, self.months)), F.month(d) - 1)
        parts = {"d": F.dayofmonth(d), "dd": two(F.dayofmonth(d)), "m": F.month(d), "mm": two(F.month(d)), "yyyy": F.year(d), "yy": two(F.year(d) % 100), "month": name, "mon": F.substring(name, 1, 3)}
        return F.when(d.isNotNull(), compiled(form or self.day_format, parts))

    def text(self, name: str, **values: Column) -> Column:
        return compiled(self.texts[name], values)

    def shown(self, x: Column, fmt: str, currency: Column) -> Column:
        """A value as a cell shows it: text, int, number, money, percent or date; nothing for null and empty."""
        made = {"money": lambda: self.money(x, currency), "int": lambda: self.number(x, 0), "number": lambda: self.number(x), "date": lambda: self.date(x), "text": lambda: x.cast("string")}
        value = F.when(x == 0, NO_RATE).otherwise(self.percent(x)) if fmt == "percent" else made[fmt]()
        return F.coalesce(value, F.lit(""))


def load(*folders: pathlib.Path | str) -> dict[str, Locale]:
    """Locales of all folders by code; a later folder's replaces an earlier one's."""
    found = {}
    for folder in folders or (FOLDER,):
        for path in sorted(pathlib.Path(folder).glob("*.json")):
            data = json.loads(path.read_text(encoding="utf-8"))
            data.pop("_", None)  # a remark
            if "code" in data:
                if len(data["months"]) != 12:
                    raise ValueError(f"{path} has {len(data['months'])} months")
                found[data["code"]] = Locale(**data)
    return found


LOCALES = load()


def by_locale(code: Column, make: Callable[[Locale], Column], locales: dict[str, Locale] | None = None) -> Column:
    """make's expression for each row's locale; null for others."""
    return F.coalesce(*(F.when(code == c, make(l)) for c, l in (locales or LOCALES).items()))
