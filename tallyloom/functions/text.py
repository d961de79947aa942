"""Text, number and date formatting as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .locales import LOCALES, compiled, padded  # noqa: F401

#: White space that Java's \s lacks: no-break and narrow no-break space.
WHITE = "[\\s\\u00a0\\u202f]+"

MONTHS = {code: locale.months for code, locale in LOCALES.items()}


def clean(x: Column) -> Column:
    """White space collapsed, ends trimmed, null as empty."""
    return F.coalesce(F.trim(F.regexp_replace(x, WHITE, " ")), F.lit(""))


#: Letters that fold to others when case is ignored, beyond lower-casing. Fixed values.
FOLDED = {"ß": "ss", "ς": "σ"}


def norm(x: Column) -> Column:
    """For comparison: plain spaces and hyphens, no white space between a hyphen and a word behind it, case folded."""
    plain = F.regexp_replace(F.coalesce(x, F.lit("")), "\\u2011", "-")
    joined = F.regexp_replace(plain, f"(?U)-{WHITE}(?=\\w)", "-")
    out = F.lower(F.trim(F.regexp_replace(joined, WHITE, " ")))
    for letter, folded in FOLDED.items():
        out = F.replace(out, F.lit(letter), F.lit(folded))
    return out


def squash(x: Column) -> Column:
    """norm without any white space, for words that a layout splits elsewhere."""
    return F.regexp_replace(norm(x), " ", "")


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def shorten(x: Column, most: int) -> Column:
    """At most so many characters, without a last partial word."""
    cut = F.regexp_replace(F.substring(x, 1, most), "\\s\\S*\\z", "")
    return F.when(F.length(x) <= most, x).otherwise(cut)


#: What stands for hidden digits. Fixed value.
MASK = "•••-••-"


def masked(x: Column) -> Column:
    """All but the last four digits hidden; fewer than four digits stay as they are."""
    digits = F.regexp_replace(x, "[^0-9]", "")
    return F.when(F.length(digits) >= 4, F.concat(F.lit(MASK), F.right(digits, F.lit(4)))).otherwise(x)


def numeric_key(x: Column) -> Column:
    """A number for a key: its last nine digits if it has only digits, colons and hyphens, else a hash below a million."""
    digits = F.right(F.regexp_replace(x, "[^0-9]", ""), F.lit(9)).cast("long")
    hashed = F.conv(F.substring(F.sha1(x), 1, 8), 16, 10).cast("long") % 1_000_000
    return F.when(x.rlike("^[0-9:-]*[0-9][0-9:-]*$"), digits).otherwise(hashed)


def address_lines(line1: Column, line2: Column, postal: Column, city: Column, region: Column, country: Column) -> Column:
    """The lines of an address that aren't empty, joined by a slash."""
    place = F.concat_ws(", ", F.nullif(F.concat_ws(" ", F.nullif(postal, F.lit("")), F.nullif(city, F.lit(""))), F.lit("")), F.nullif(region, F.lit("")))
    return F.concat_ws(" / ", *(F.nullif(x, F.lit("")) for x in (line1, line2, place, country)))


def number(x: Column, locale: str, places: int = 2) -> Column:
    return LOCALES[locale].number(x, places)


def money(x: Column, locale: str, currency: str) -> Column:
    return LOCALES[locale].money(x, F.lit(currency))


def percent(rate: Column, locale: str) -> Column:
    """No decimal for whole per cents, one otherwise."""
    return LOCALES[locale].percent(rate)


def title(x: Column) -> Column:
    """Words capitalised, and letters behind anything that isn't a letter as well: o'brien 2nd gives O'Brien 2Nd."""
    parts = F.regexp_extract_all(x, F.lit("(\\p{L}+|[^\\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))), "")


def labelled(key: Column) -> Column:
    """The text of a label that has no translation: words of its key, capitalised."""
    return title(F.replace(key, F.lit("_"), F.lit(" ")))


def long_date(d: Column, locale: str) -> Column:
    """Day, month's name and year, in the locale's order."""
    return LOCALES[locale].date(d)


def dated(d: Column, form: str, locale: str) -> Column:
    """A date in a form of d, dd, m, mm, yy, yyyy, month and mon (the month's first three letters) in braces."""
    return LOCALES[locale].date(d, form)


def filled(form: str, **values: Column) -> Column:
    """A text with names in braces, each replaced by its column; null counts as empty."""
    return compiled(form, values)


def tolerant_json(x: Column, schema: str) -> Column:
    """The JSON object in a text that may have fences or chatter around it; null if there is none. With an array schema,
    the array."""
    opened, closed = ("\\[", "\\]") if schema.lower().startswith("array") else ("\\{", "\\}")
    return F.from_json(F.regexp_extract(x, f"(?s)({opened}.*{closed})", 1), schema)
