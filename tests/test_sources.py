import json
import sqlite3

from pyspark.sql import functions as F

from tallyloom.plans import dataset
from tallyloom.sources import contracts, ingest, sqlite
from tallyloom.streaming import events


def test_sql_dump(spark, tmp_path):
    script = (
        "INSERT \"Region\" VALUES (1, N'East''ern')\nGO\nINSERT INTO [dbo].[Order Details](a,b,c) VALUES (10248, NULL, 0xFF), (-2.5, '7/4/1996', '(x, y)')\nGO\nSELECT 1\nGO\n"
        "INSERT INTO t (b, a) VALUES ('y', GETDATE())\nGO\ninsert t (b, a) values ('INSERT INTO u VALUES (1)', 1) -- VALUES (2)\ninsert into t (a, b) values (2, 'x')\nGO\nINSERT INTO t (a, b) VALUES (3)\nGO\n"
    )
    (tmp_path / "d.sql").write_text(script)
    got = ingest.sql_dump(spark, str(tmp_path / "d.sql")).collect()
    rows = sorted((r.table_name, r["values"], r.named) for r in got if r.error is None)
    assert rows == [
        ("Order Details", ["-2.5", "7/4/1996", "(x, y)"], {"a": "-2.5", "b": "7/4/1996", "c": "(x, y)"}),
        ("Order Details", ["10248", None, "0xFF"], {"a": "10248", "b": None, "c": "0xFF"}),
        ("Region", ["1", "East'ern"], None),
        ("t", ["2", "x"], {"a": "2", "b": "x"}),
        ("t", ["INSERT INTO u VALUES (1)", "1"], {"b": "INSERT INTO u VALUES (1)", "a": "1"}),
    ]
    assert sorted((r.table_name, r["values"], r.error) for r in got if r.error) == [("t", None, "1 values for 2 columns"), ("t", None, "a value expected, GETDATE found")]


def test_us_date(spark):
    given = ["7/4/1996", "12/31/1999 00:00:00", "1998-05-06", "7/4/96", "1/2/68", "1/2/69 10:00", "13/1/99", "x", None]
    d = spark.createDataFrame([(k, s) for k, s in enumerate(given)], "k int, s string").select("k", ingest.us_date(F.col("s")).alias("d"))
    got = [str(r.d) for r in sorted(d.collect())]
    assert got == ["1996-07-04", "1999-12-31", "1998-05-06", "1996-07-04", "2068-01-02", "1969-01-02", "None", "None", "None"]


def test_delimited(spark, tmp_path):
    (tmp_path / "t.csv").write_text("\ufeff1+|a+|&|2+|+|&|short&|3+|c d+|", encoding="utf-8")
    got = ingest.delimited(spark, str(tmp_path / "t.csv"), ["k", "v"], "+|", "&|").collect()
    assert [tuple(r) for r in got] == [("1", "a"), ("2", None), ("3", "c d")]
    text = "\ufeff1\té日本\r\n2\t\r\nshort\r\n3\tc d\r\n"
    want = [("1", "é日本"), ("2", None), ("3", "c d")]
    for name, codec in (("UTF-16", "utf-16-le"), ("UTF-16BE", "utf-16-be"), ("UTF-8", "utf-8")):
        path = tmp_path / f"{codec}.txt"
        path.write_bytes(text.encode(codec))
        assert [tuple(r) for r in ingest.delimited(spark, str(path), ["k", "v"], encoding=name).collect()] == want, name
    (tmp_path / "u.txt").write_bytes("1+|x&|\n2+|y&|\n".encode("utf-16-le"))
    assert [tuple(r) for r in ingest.delimited(spark, str(tmp_path / "u.txt"), ["k", "v"], "+|", "&|\n", "UTF-16").collect()] == [("1", "x"), ("2", "y")]


def test_json(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"doc_id": "a", "status": "ok"}\n{"doc_id": "b", "status": "failed"}\n')
    assert [r.doc_id for r in ingest.json_lines(spark, str(tmp_path / "m.jsonl"), "doc_id string, status string", ok_only=True).collect()] == ["a"]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text('{\n "number": "N1",\n "total": "9.10"\n}')
    assert [r.doc.total for r in ingest.json_documents(spark, str(tmp_path / "docs"), "number string, total string").collect()] == ["9.10"]


def test_stream_agrees_with_batch(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    table.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    q = events.windowed(stream).writeStream.outputMode("complete").format("memory").queryName("by_hour").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("by_hour").collect())) == sorted(map(str, events.windowed(table).collect()))
    for _ in range(2):
        events.write_once(stream, "event_id", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    events.write_once(stream, "event_id", f"{tmp_path}/out", f"{tmp_path}/other").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == table.count()


def test_references_and_ddl(spark):
    tables = {"orders": spark.createDataFrame([(1, 7), (2, 8), (3, None), (4, 9)], "o int, c int"), "customer": spark.createDataFrame([(7,)], "k int")}
    contract = contracts.Contract({"o": "int", "c": "int"}, ("o",), ("o",), ("o > 0",), (("c", "customer", "k"),))
    got = contracts.broken_references(tables.get, {"orders": contract}).collect()
    assert [tuple(r) for r in got] == [("orders", "c is in customer", 2, "8")]
    assert contract.ddl("orders") == "CREATE TABLE orders (\n  o int NOT NULL,\n  c int,\n  PRIMARY KEY (o),\n  FOREIGN KEY (c) REFERENCES customer (k),\n  CHECK (o > 0)\n)"


def test_sqlite_source_by_name(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        c = sqlite3.connect(f"{tmp_path}/{name}.db")
        c.execute("create table t (k integer)")
        c.executemany("insert into t values (?)", [(k,) for k in range(n)])
        c.execute("create view v as select k from t where k > 0")
        c.commit()
        c.close()
    sqlite.sqlite_source("shop", f"{tmp_path}/a.db")
    assert contracts.open_source("shop").tables == ("t", "v") and contracts.open_source("shop").table(spark, "v").count() == 2
    assert contracts.open_source("shop", f"{tmp_path}/b.db").table(spark, "t").count() == 5
    assert contracts.open_source("shop").views(spark) == ["shop_t", "shop_v"] and spark.sql("select sum(k) as s from shop_t").first().s == 3


def test_words_beside_documents(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b" é'), (2, None), (3, "")], "doc_id long, text string")
    for _ in range(2):
        dataset.write_words(rows, f"{tmp_path}/words")
    got = {r["doc_id"]: r["words"] for r in (json.loads(x.value) for x in spark.read.text(f"{tmp_path}/words").collect())}
    assert got == {1: [{"page": 0, "text": t, "bbox": [10.0 * k, 0.0, 10.0 * k + 8, 5.0]} for k, t in enumerate(["a", '"b"', "é"])], 2: None, 3: []}
