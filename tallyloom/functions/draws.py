"""Draws that every run and every engine repeats: hashes of seed, tag and key instead of random numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def draw(tag: str, *key: Column, seed: int = SEED) -> Column:
    """A whole number from 0 below 2**32."""
    return F.conv(F.substring(F.sha1(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *(k.cast("string") for k in key))), 1, 8), 16, 10).cast("long")


def below(n: int, tag: str, *key: Column) -> Column:
    return draw(tag, *key) % n


def one_of(values: list, tag: str, *key: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), below(len(values), tag, *key).cast("int"))


def chance(per_mille: int, tag: str, *key: Column) -> Column:
    return below(1000, tag, *key) < per_mille


def draw_sql(tag: str, *key: str, seed: int = SEED) -> str:
    """The same draw for DuckDB."""
    parts = " || '|' || ".join(f"cast({k} as varchar)" for k in key)
    return f"cast('0x' || substr(sha1('{seed}|{tag}|' || {parts}), 1, 8) as bigint)"
