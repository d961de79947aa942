"""Databases read in ranges, with filters in the database's own query."""

import json
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import sqlite


@pytest.fixture(scope="module")
def database(tmp_path_factory):
    """Orders, with values of other types than their columns' among them."""
    path = str(tmp_path_factory.mktemp("db") / "shop.db")
    r = random.Random(8)
    c = sqlite3.connect(path)
    c.execute('create table "Order ""x""" (id integer, name varchar(20) collate nocase, price real, note text, raw blob, odd integer, made date)')
    names = ["abc", "ABC", "Abc", "ünï", "日本", "", "a%c", "a_c", None]
    rows = [(k, r.choice(names), r.choice([None, 1.5, 2.0, 1e300]), r.choice(["x'y", "", None]), r.choice([b"\x00\xff", None]), r.choice([1, 2, "2", "two", 2.0, 2.5, None]), "2004-02-29") for k in range(500)]
    rows += [(None, "abc", 1.0, "null key", None, 1, None), (10**15, "far", 1.0, None, None, 1, None)]
    c.executemany('insert into "Order ""x""" values (?, ?, ?, ?, ?, ?, ?)', rows)
    c.execute('create view cheap as select id, name from "Order ""x""" where price < 2')
    c.execute("create table bare (id integer, v text)")
    c.commit()
    c.close()
    return path


TABLE = 'Order "x"'
FILTERS = [
    [("id", ">=", 100), ("id", "<", 250)], [("id", "=", 7)], [("id", "in", [1, 2, 3])], [("id", "null", None)], [("id", "not null", None)], [("name", "=", "abc")], [("name", "not =", "abc")], [("name", ">", "Abc")],
    [("name", "<=", "abc")], [("name", "in", ["abc", "a%c"])], [("name", "not in", ["abc", "ABC"])], [("name", "in", [])], [("name", "starts", "a")], [("name", "ends", "c")], [("name", "ends", "")], [("name", "contains", "b")],
    [("name", "contains", "%")], [("name", "not contains", "_")], [("name", "not starts", "ü")], [("price", ">", 1.5)], [("price", "=", 2.0)], [("price", "=", 2)], [("odd", "=", 2)], [("odd", "not =", 2)], [("odd", "null", None)],
    [("odd", "not null", None)], [("odd", ">", 1)], [("odd", "in", [1, 2])], [("note", "=", "x'y")], [("note", "=", "")], [("raw", "null", None)], [("made", "=", "2004-02-29"), ("name", "contains", "b"), ("id", ">", 50)],
]


def test_conditions_give_the_same_rows(spark, database):
    table = sqlite.sqlite_table(spark, database, TABLE, key="id", partitions=4)
    local = spark.createDataFrame(table.collect(), table.schema).cache()
    assert local.count() == 502
    for where in FILTERS:
        want = local
        for w in where:
            want = want.filter(sqlite.judged(w))
        got = sqlite.sqlite_table(spark, database, TABLE, key="id", partitions=2, where=where)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), where


def test_partitions_and_what_is_read(spark, database):
    where = [("id", "<", 400), ("name", "=", "abc")]
    table = sqlite.sqlite_table(spark, database, TABLE, key="id", partitions=4, columns=["id"], where=where)
    assert table.rdd.getNumPartitions() == 4
    plain = sqlite.opened(database).execute('select count(*) from "Order ""x""" where id < 400 and name collate binary = ?', ["abc"]).fetchone()[0]
    sizes = [len(p) for p in table.rdd.glom().collect()]
    assert sum(sizes) == plain and max(sizes) < plain / 2
    options = {"path": database, "table": TABLE, "key": "id", "partitions": "4", "where": json.dumps(where)}
    reader = sqlite.SqliteReader(options, spark.createDataFrame([], "id long, name string").schema)
    ranges = reader.partitions()
    assert len(ranges) == 4 and sum(b.num_rows for r in ranges for b in reader.read(r)) == plain  # nothing else leaves the database


def test_what_sqlite_judges(database):
    kinds = dict(sqlite.columns_of(database, TABLE))
    assert kinds == {"id": "long", "name": "string", "price": "double", "note": "string", "raw": "binary", "odd": "long", "made": "string"}
    text, values = sqlite.pushed(("id", ">", 5), kinds)
    assert text == "typeof(\"id\") not in ('integer', 'null') or (\"id\" collate binary > ?)" and values == [5]
    for where in (("id", "=", "5"), ("price", "=", 2), ("name", "=", "a\0b"), ("name", "in", [])):
        assert sqlite.pushed(where, kinds) is None
    with pytest.raises(ValueError):
        sqlite.judged(("id", "like", "x"))


def test_views_empty_tables_and_columns(spark, database):
    assert sqlite.sqlite_table(spark, database, "cheap").count() > 0
    assert sqlite.sqlite_table(spark, database, "bare", key="id").count() == 0
    few = sqlite.sqlite_table(spark, database, TABLE, key="id", partitions=600, columns=["name", "id"])
    assert few.columns == ["name", "id"] and few.count() == 502
    with pytest.raises(ValueError):
        sqlite.columns_of(database, "absent")


def test_joins_with_tables(spark, database, tmp_path):
    """A loader's joins over a database: keys from one table, lines from another."""
    c = sqlite3.connect(f"{tmp_path}/t.db")
    c.execute("create table head (k integer primary key, party text)")
    c.execute("create table line (k integer, quantity integer, price real)")
    c.executemany("insert into head values (?, ?)", [(k, f"p{k % 3}") for k in range(40)])
    c.executemany("insert into line values (?, ?, ?)", [(k // 3, 1 + k % 4, 2.5) for k in range(90)])
    c.commit()
    c.close()
    head, line = (sqlite.sqlite_table(spark, f"{tmp_path}/t.db", t, key="k") for t in ("head", "line"))
    got = head.join(line, "k", "left").groupBy("party").agg(F.count("quantity").alias("n"), F.sum(F.col("quantity") * F.col("price")).alias("v"))
    lines = [(k // 3, 1 + k % 4) for k in range(90)]
    assert sorted(map(tuple, got.collect())) == [(f"p{p}", sum(k % 3 == p for k, _ in lines), sum(q * 2.5 for k, q in lines if k % 3 == p)) for p in range(3)]
