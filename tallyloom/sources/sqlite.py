"""SQLite databases as a data source: ranges of a key are partitions, simple filters and columns go into the query."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .contracts import Source, register_source

BATCH_ROWS = 4096
#: Declared types by the words that SQLite's rules of affinity look for, in their order. Fixed values.
AFFINITY = (("INT", "long"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"))


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def columns_of(path: str, table: str) -> list[tuple[str, str]]:
    """Names and Spark types of a table's or view's columns; types of no known affinity are text."""
    with opened(path) as c:
        rows = c.execute(f"pragma table_xinfo({quoted(table)})").fetchall()
    if not rows:
        raise ValueError(f"no table {table} in {path}")
    return [(r[1], next((kind for word, kind in AFFINITY if word in (r[2] or "").upper()), "string")) for r in rows]


@dataclass
class KeyRange(InputPartition):
    """Keys from low up to below high; without low also null keys, without high all from low on."""

    low: int | None
    high: int | None


#: The storage class of a column's own values, and their type in Python.
CLASSES = {"long": ("integer", int), "double": ("real", float), "string": ("text", str), "binary": ("blob", bytes)}
#: A condition: a column, one of these operators (or "not " and one of them), and a value, a list for `in`, None for `null`.
Condition = tuple[str, str, object]
SIGNS = ("=", "<", "<=", ">", ">=")
PARTS = {"starts": "substr({0}, 1, length(?1)) = ?1", "ends": "(?1 = '' or substr({0}, -length(?1)) = ?1)", "contains": "instr({0}, ?1) > 0"}


def judged(where: Condition) -> Column:
    """A condition as Spark judges it."""
    name, op, value = where
    x, plain = F.col(f"`{name.replace('`', '``')}`"), op.removeprefix("not ")
    made = {
        "=": lambda: x == value, "<": lambda: x < value, "<=": lambda: x <= value, ">": lambda: x > value, ">=": lambda: x >= value, "in": lambda: x.isin(value), "null": x.isNull,
        "starts": lambda: F.startswith(x, F.lit(value)), "ends": lambda: F.endswith(x, F.lit(value)), "contains": lambda: F.contains(x, F.lit(value)),
    }
    if plain not in made:
        raise ValueError(f"{op} is no operator")
    return ~made[plain]() if op != plain else made[plain]()


def pushed(where: Condition, kinds: dict[str, str]) -> tuple[str, list] | None:
    """A condition for SQLite and its values; None if SQLite might drop a row that Spark would keep. A column may hold
    values of another type than its own: such rows pass, and Spark judges them once they are converted."""
    name, op, value = where
    plain = op.removeprefix("not ")
    held, python = CLASSES[kinds[name]]
    values = [] if plain == "null" else list(value) if plain == "in" else [value]
    if not all(type(v) is python and (python is not str or "\0" not in v) for v in values) or (plain == "in" and not values):
        return None
    column = quoted(name)
    if plain == "null":
        text = f"{column} is null"
    elif plain == "in":
        text = f"{column} collate binary in ({', '.join('?' * len(values))})"
    elif plain in SIGNS:
        text = f"{column} collate binary {plain} ?"
    else:
        text = PARTS[plain].format(column)
        values = values * text.count("?1")
        text = text.replace("?1", "?")
    return f"typeof({column}) not in ('{held}', 'null') or {'not ' * (op != plain)}({text})", values


def converted(value, kind: str):
    """A stored value as the column's type; null if it can't be one."""
    try:
        if value is None:
            return None
        if kind == "long":
            return int(value) if not isinstance(value, float) or value == int(value) else None
        if kind == "double":
            return float(value)
        if kind == "binary":
            return value if isinstance(value, bytes) else str(value).encode()
        return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)
    except (ValueError, OverflowError):
        return None


ARROW = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.table, self.key = options["path"], options["table"], options.get("key")
        self.parts = int(options.get("partitions", "4"))
        self.names = [f.name for f in schema.fields]
        self.kinds = {f.name: {"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in schema.fields}
        if set(self.kinds.values()) - set(ARROW):
            raise ValueError(f"columns are long, double, string or binary, not {sorted(set(self.kinds.values()) - set(ARROW))}")
        made = [m for w in json.loads(options.get("where", "[]")) if (m := pushed(tuple(w), self.kinds)) is not None]
        self.where, self.values = [text for text, _ in made], [v for _, values in made for v in values]

    def _filter(self) -> str:
        return " where " + " and ".join(f"({w})" for w in self.where) if self.where else ""

    def partitions(self) -> list[KeyRange]:
        """Ranges of the key that are equally wide, over the keys that pass the filters."""
        if self.key is None or self.parts < 2:
            return [KeyRange(None, None)]
        key = quoted(self.key)
        with opened(self.path) as c:
            also = f"{' and' if self.where else ' where'} typeof({key}) = 'integer'"
            low, high = c.execute(f"select min({key}), max({key}) from {quoted(self.table)}{self._filter()}{also}", self.values).fetchone()
        if low is None:
            return [KeyRange(None, None)]
        edges = [low + (high - low + 1) * k // self.parts for k in range(1, self.parts)]
        edges = sorted({e for e in edges if e > low})
        return [KeyRange(a, b) for a, b in zip([None, *edges], [*edges, None], strict=True)]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        where, values = list(self.where), list(self.values)
        if partition.low is not None:
            where.append(f"{quoted(self.key)} >= ?")
            values.append(partition.low)
        if partition.high is not None:
            where.append(f"{quoted(self.key)} < ?" + f" or {quoted(self.key)} is null" * (partition.low is None))
            values.append(partition.high)
        columns = ", ".join(map(quoted, self.names)) or "1"
        sql = f"select {columns} from {quoted(self.table)}" + (" where " + " and ".join(f"({w})" for w in where) if where else "")
        with opened(self.path) as c:
            c.text_factory = lambda b: b.decode("utf-8", "replace")
            cursor = c.execute(sql, values)
            while rows := cursor.fetchmany(BATCH_ROWS):
                arrays = [pa.array([converted(v, self.kinds[n]) for v in column], ARROW[self.kinds[n]]) for n, column in zip(self.names, zip(*rows, strict=True), strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, self.names)


class SqliteSource(DataSource):
    """Options: path (of the database, readable by all executors), table; key, a whole-number column, and partitions for
    reading in parallel; where, conditions as JSON."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        return ", ".join(f"`{n.replace('`', '``')}` {kind}" for n, kind in columns_of(self.options["path"], self.options["table"]))

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(dict(self.options), schema)


def sqlite_table(spark: SparkSession, path: str, table: str, key: str | None = None, partitions: int = 4, columns: list[str] | None = None, where: list[Condition] = ()) -> DataFrame:
    """The rows of a table or view for which all conditions hold; only the given columns are read, if any are given.

    Conditions go into SQLite's query as far as it judges them like Spark, which applies all of them again. They are given
    here and not taken from filters on the result: Spark keeps what it has pushed into a Python source with the relation, so
    that another query of the same DataFrame would read under the first one's filters."""
    spark.dataSource.register(SqliteSource)
    kinds = dict(columns_of(path, table))
    reader = spark.read.format("sqlite").option("path", path).option("table", table).option("partitions", partitions).option("where", json.dumps(list(where)))
    reader = reader.option("key", key) if key else reader
    own = list(dict.fromkeys([*(columns or kinds), *(w[0] for w in where)]))
    rows = reader.schema(", ".join(f"`{c.replace('`', '``')}` {kinds[c]}" for c in own)).load()
    for w in where:
        rows = rows.filter(judged(w))
    return rows.select(*(f"`{c.replace('`', '``')}`" for c in columns or kinds))


def sqlite_source(name: str, path: str) -> Source:
    """A database with all its tables and views as a source that is opened by name; another path overrides its own."""
    with opened(path) as c:
        tables = tuple(r[0] for r in c.execute("select name from sqlite_master where type in ('table', 'view') and name not like 'sqlite_%' order by name"))
    return register_source(Source(name, path, tables, sqlite_table))
