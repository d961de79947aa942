"""Contracts of the tables: types, keys and conditions of their columns, and sources by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import query
from .tables import read


@dataclass(frozen=True)
class Contract:
    """Column types, a unique key, columns that must not be null, conditions (SQL) that hold in each row, and references:
    a column, and the table and column that hold its values."""

    types: dict[str, str]
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    checks: tuple[str, ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()

    def ddl(self, name: str) -> str:
        """CREATE TABLE with all of it."""
        rows = [f"{c} {t}{' NOT NULL' * (c in self.required)}" for c, t in self.types.items()]
        rows += [f"PRIMARY KEY ({', '.join(self.key)})"] * bool(self.key)
        rows += [f"FOREIGN KEY ({c}) REFERENCES {t} ({k})" for c, t, k in self.references] + [f"CHECK ({check})" for check in self.checks]
        return f"CREATE TABLE {name} (\n  " + ",\n  ".join(rows) + "\n)"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T._parse_datatype_string(t), c not in self.required) for c, t in self.types.items()])


CONTRACTS = {
    "region": Contract({"r_regionkey": "int", "r_name": "string"}, ("r_regionkey",), ("r_regionkey", "r_name")),
    "nation": Contract({"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"}, ("n_nationkey",), ("n_nationkey", "n_name"), ("n_regionkey >= 0",), (("n_regionkey", "region", "r_regionkey"),)),
    "customer": Contract({"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}, ("c_custkey",), ("c_custkey", "c_name"), ("c_acctbal >= 0", "length(c_name) <= 40"), (("c_nationkey", "nation", "n_nationkey"),)),
    "supplier": Contract({"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}, ("s_suppkey",), ("s_suppkey", "s_name"), ("s_acctbal >= 0",), (("s_nationkey", "nation", "n_nationkey"),)),
    "part": Contract({"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"}, ("p_partkey",), ("p_partkey", "p_name"), ("p_retailprice >= 0", "p_size > 0")),
    "orders": Contract({"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}, ("o_orderkey",), ("o_orderkey", "o_custkey"), ("o_totalprice >= 0", "o_orderstatus in ('O', 'F', 'P')"), (("o_custkey", "customer", "c_custkey"),)),
    "lineitem": Contract({"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
                         ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_partkey"), ("l_quantity > 0", "l_discount >= 0 and l_discount <= 1", "l_extendedprice >= 0"), (("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey"))),
    "events": Contract({"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}, ("event_id",), ("event_id", "ts"), ("event_type in ('view', 'click', 'purchase', 'signup')",)),
}


def violations(df: DataFrame, name: str, contract: Contract) -> DataFrame:
    """table_name, rule and how many rows (for the key: how many rows too many) break it; all rules from one pass and one
    aggregation by key. A condition that is null for a row holds."""
    rules = [(f"{c} is missing", F.count_if(F.lit(True)) if c not in df.columns else None) for c in contract.types]
    rules = [(rule, c) for rule, c in rules if c is not None]
    known = dict(df.dtypes)
    rules += [(f"{c} is {known[c]}, not {t}", F.count(F.lit(1))) for c, t in contract.types.items() if c in known and known[c] != t]
    rules += [(f"{c} is null", F.count_if(F.col(c).isNull())) for c in contract.required]
    rules += [(check, F.count_if(~F.coalesce(F.expr(check), F.lit(True)))) for check in contract.checks]
    sums = df.agg(*(c.alias(f"r{k}") for k, (_, c) in enumerate(rules)))
    each = F.array(*(F.struct(F.lit(rule).alias("rule"), F.col(f"r{k}").cast("long").alias("violations")) for k, (rule, _) in enumerate(rules)))
    out = sums.select(F.lit(name).alias("table_name"), F.inline(each))
    if not contract.key:
        return out
    over = df.groupBy(*contract.key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("violations"))
    return out.unionByName(over.select(F.lit(name).alias("table_name"), F.lit(f"{', '.join(contract.key)} is unique").alias("rule"), "violations"))


def _sql() -> str:
    parts = []
    for name, c in CONTRACTS.items():
        parts += [f"select '{name}' as table_name, '{column} is null' as rule, count(*) as violations from {name} where {column} is null" for column in c.required]
        quoted = [(check, check.replace("'", "''")) for check in c.checks]
        parts += [f"select '{name}', '{text}', count(*) from {name} where not ({check})" for check, text in quoted]
        parts.append(f"select '{name}', '{', '.join(c.key)} is unique', coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from {name} group by {', '.join(c.key)})")
    return " union all ".join(parts)


@query(_sql())
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables against their contracts."""
    return reduce(DataFrame.unionByName, (violations(read(spark, sf_dir, name), name, c) for name, c in CONTRACTS.items()))


def broken_references(tables: Callable[[str], DataFrame], contracts: dict[str, Contract]) -> DataFrame:
    """table_name, rule, violations and one value of each reference: how many rows point at nothing. Nulls point nowhere and
    are no violation."""
    out = []
    for name, contract in contracts.items():
        for column, parent, key in contract.references:
            rows = tables(name).select(F.col(column).alias("v")).filter("v is not null").join(tables(parent).select(F.col(key).alias("k")), F.col("v") == F.col("k"), "left_anti")
            out.append(rows.agg(F.lit(name).alias("table_name"), F.lit(f"{column} is in {parent}").alias("rule"), F.count(F.lit(1)).alias("violations"), F.min("v").cast("string").alias("example")))
    return reduce(DataFrame.unionByName, out)


@query(" union all ".join(f"select '{t}' as table_name, '{c} is in {p}' as rule, count(*) as violations, min({c})::varchar as example from {t} where {c} is not null and not exists (select 1 from {p} where {k} = {c})" for t, x in CONTRACTS.items() for c, p, k in x.references))
def reference_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All references of the contracts, with what breaks them."""
    return broken_references(lambda name: read(spark, sf_dir, name), CONTRACTS)


EXACT = {"region": 5, "nation": 25}


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n_rows, {n}::bigint as expected, count(*) = {n} as exact from {t}" for t, n in EXACT.items()))
def count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that must have an exact number of rows."""
    one = lambda t, n: read(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(n).cast("long").alias("expected"), (F.count(F.lit(1)) == n).alias("exact"))
    return reduce(DataFrame.unionByName, (one(t, n) for t, n in EXACT.items()))


class Source:
    """A place that tables come from. A plug-in gives its own way to read one."""

    def __init__(self, name: str, path: str, tables: tuple[str, ...], load: Callable[[SparkSession, str, str], DataFrame] = read) -> None:
        self.name, self.path, self.tables, self.load = name, path, tables, load

    def table(self, spark: SparkSession, table: str) -> DataFrame:
        if table not in self.tables:
            raise KeyError(f"{self.name} has no table {table}")
        return self.load(spark, self.path, table)

    def views(self, spark: SparkSession) -> list[str]:
        """Registers <source>_<table> as a view for each table, for plain SQL."""
        names = []
        for t in self.tables:
            self.table(spark, t).createOrReplaceTempView(f"{self.name}_{t}")
            names.append(f"{self.name}_{t}")
        return names


_sources: dict[str, Source] = {}


def register_source(source: Source) -> Source:
    _sources[source.name] = source
    return source


def open_source(name: str, path: str | None = None) -> Source:
    """A registered source, at its own path or another one."""
    if name not in _sources:
        raise KeyError(f"no source {name}; known: {', '.join(sorted(_sources)) or 'none'}")
    known = _sources[name]
    return Source(known.name, path, known.tables, known.load) if path else known


def overrides(arguments: list[str]) -> dict[str, str]:
    """NAME=PATH arguments as a dictionary."""
    out = {}
    for a in arguments:
        name, sign, path = a.partition("=")
        if not sign or not name or not path:
            raise ValueError(f"NAME=PATH expected, {a!r} found")
        out[name] = path
    return out
