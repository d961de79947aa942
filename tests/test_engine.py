"""Worked numbers, determinism and invariants of the document engine."""

import decimal
import pathlib
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__
from tallyloom import registry
from tallyloom.functions import money, places, text
from tallyloom.operators import checks, invariants, payroll
from tallyloom.plans import dataset, planner

D = decimal.Decimal
SF = "/root/testdata/sf0.001"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def dec(x):
    return F.lit(x).cast("decimal(18,6)")


def test_rounding(spark):
    got = one(spark, *(f(dec(x)) for x in ("2.345", "-2.345", "2.355") for f in (money.half_up, money.half_even)))
    assert got == tuple(map(D, ("2.35", "2.34", "-2.35", "-2.34", "2.36", "2.36")))
    assert one(spark, money.exact(F.lit(1.005)), money.exact(F.lit(None).cast("double"))) == (D("1.005000"), D("0E-6"))


def test_two_line_invoice(spark):
    rows = spark.createDataFrame([("9.99", 3, "0.10", "0.200"), ("0.05", 1, "0.00", "0.055")], "p string, q int, d string, t string")
    rows = rows.select(money.line_total(F.col("p").cast("decimal(18,2)"), F.col("q"), F.col("d").cast("decimal(5,2)")).alias("line"), F.col("t").cast("decimal(9,4)").alias("t"))
    assert [r.line for r in rows.collect()] == [D("26.97"), D("0.05")]
    tax = sum(r.x for r in rows.select(money.half_up(F.col("line") * F.col("t")).alias("x")).collect())
    assert tax == D("5.39") and D("27.02") + D("4.50") + tax == D("36.91")


def test_formats(spark):
    v, d = dec("1234.5"), F.lit("2020-08-03").cast("date")
    assert one(spark, text.money(v, "en", "USD"), text.money(v, "fr", "EUR"), text.long_date(d, "fr"), text.percent(dec("0.055"), "fr")) == ("$1,234.50", "1 234,50 €", "3 août 2020", "5,5 %")
    assert one(spark, text.masked(F.lit("295847284")), text.masked(F.lit("12"))) == ("•••-••-7284", "12")
    assert one(spark, text.numeric_key(F.lit("16072:16")), text.numeric_key(F.lit("43659"))) == (1607216, 43659)
    assert one(spark, text.numeric_key(F.lit("category:3")) < 1_000_000, text.padded(F.lit(1234567), 5), text.padded(F.lit(7), 3)) == (True, "1234567", "007")
    assert one(spark, text.clean(F.lit(" a \n b ")), text.clean(F.lit(None).cast("string")), text.slug(F.lit("--Ab c!"))) == ("a b", "", "ab-c")
    assert one(spark, money.tender(dec("7.41").cast("decimal(18,2)"), F.lit(5)))[0] == D("10.00")
    assert one(spark, text.tolerant_json(F.lit('x ```{"a": 1}``` y'), "a int").a, text.tolerant_json(F.lit("none"), "a int").a) == (1, None)


def test_norm(spark):
    """White space between a hyphen and a word goes, on one line or over two; case folds; other spaces are plain."""
    given = ["Can - 12 oz", "Can -  12 oz", "well-\n  known\u00a0Thing", "a\u2011b", "Straße", None, " x -", "a- b- c", "- \u202f é"]
    d = spark.createDataFrame(list(enumerate(given)), "k int, s string")
    got = {r.k: (r.n, r.q) for r in d.select("k", text.norm(F.col("s")).alias("n"), text.squash(F.col("s")).alias("q")).collect()}
    assert [got[k][0] for k in range(9)] == ["can -12 oz", "can -12 oz", "well-known thing", "a-b", "strasse", "", "x -", "a-b-c", "-é"]
    assert [got[k][1] for k in range(4)] == ["can-12oz", "can-12oz", "well-knownthing", "a-b"]


def test_text_queries_on_awkward_rows(spark, tmp_path):
    """Null and empty texts, broken words and folded letters, against the SQL."""
    duckdb = pytest.importorskip("duckdb")
    texts = ["a well-\n  known\u00a0Thing", None, "", "Plain  text ß", "one two three four five three four five", "x- y- z three four-\nfive"]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "Plain text"), (1, "text"), (2, "b two c"), (3, "one two"), (4, "ne two three four fiv")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    for name in ("text_norm", "locate_spans", "text_contains_benchmark"):
        got = registry.queries()[name](spark, str(tmp_path))
        r = c.sql(registry.oracle_sql()[name])
        assert sorted(map(str, map(tuple, got.select(r.columns).collect()))) == sorted(map(str, r.fetchall())), name
    got = {(r.doc_id, r.item_id) for r in checks.text_contains_benchmark(spark, str(tmp_path)).collect()}
    assert got == {(3, 0), (3, 1), (4, 3), (4, 4)}


def test_leap_day(spark):
    got = one(spark, *(F.lit(x).cast("timestamp_ntz") + F.make_ym_interval(F.lit(19), F.lit(0)) for x in ("2004-02-29 10:11:12", "2005-02-28 01:00:00")))
    assert [str(x) for x in got] == ["2023-02-28 10:11:12", "2024-02-28 01:00:00"]


@pytest.mark.parametrize("caps, want", [((412, 5000, 5000), [412, 794, 794]), ((635, 93), [1271, 729]), ((0, 10), [995, 1005])])
def test_allocation(spark, caps, want):
    rows = spark.createDataFrame([(f"v{k}", c) for k, c in enumerate(caps)], "variant string, capacity long")
    assert sorted((r.variant, r.n) for r in planner.allocation(rows).collect()) == [(f"v{k}", n) for k, n in enumerate(want)]


def test_locate(spark):
    """Values that a layout splits elsewhere, hyphens with spaces, no partial words, and no run over a page's end."""
    rows = [(1, "see the state-of- the-art pump", "state-of-the-art pump"), (2, "Big Can - 12 oz.", "Big Can - 12 oz."), (3, "Can 120", "Can 12"), (4, "a b a b a", "b a"), (5, "a b c d", "c d"), (6, None, "x"), (7, "x", ""), (8, "x", None)]
    got = sorted((r.doc_id, r.first, r.next, r.page, r.left_x, r.right_x) for r in checks.locate(spark.createDataFrame(rows, "doc_id long, text string, value string"), words_a_page=5).collect())
    assert got == [(1, 2, 5, 0, 20.0, 48.0), (2, 0, 5, 0, 0.0, 48.0), (4, 1, 3, 0, 10.0, 28.0), (4, 3, 5, 0, 30.0, 48.0), (5, 2, 4, 0, 20.0, 38.0)]
    cut = checks.locate(spark.createDataFrame(rows, "doc_id long, text string, value string"), words_a_page=3).collect()
    assert sorted((r.doc_id, r.first, r.page) for r in cut) == [(4, 1, 0), (4, 3, 1)]


def test_merge_keeps_equal_parts(spark):
    """Four equal parts of two documents are eight documents; a part without companies counts."""
    rows = [(k % 4, "invoice", "train", D("10.00"), 1, 1) for k in range(8)] + [(5, "invoice", "train", D("1.00"), None, None)]
    df = spark.createDataFrame(rows, "okey long, doc_type string, split string, total decimal(18,2), pages long, company long")
    got = dataset.merged(*dataset.partials(df, F.col("okey")))
    assert [tuple(r) for r in got.collect()] == [("invoice", "train", 9, D("81.00"), 8, 1)]


def test_older_parts_get_their_scans(spark):
    """Only a part of one type without counts by type is filled."""
    rows = [("p", "by_type", "receipt", "", 3), ("p", "scans", "", "train", 2), ("q", "by_type", "payslip", "", 1), ("q", "scans", "", "test", 1), ("q", "by_type_scan_split", "payslip", "test", 1),
            ("r", "by_type", "quote", "", 1), ("r", "by_type", "invoice", "", 1), ("r", "scans", "", "train", 1)]
    got = dataset.back_filled(spark.createDataFrame(rows, "part string, counter string, key string, split string, n long")).filter("counter = 'by_type_scan_split'")
    assert sorted(tuple(r) for r in got.collect()) == [("p", "by_type_scan_split", "receipt", "train", 2), ("q", "by_type_scan_split", "payslip", "test", 1)]


def test_overtime_rounds_the_rate_first(spark):
    """10.01 an hour: 15.02 (from 15.015) for four hours is 60.08; a bonus is a part of the regular pay."""
    rows = spark.createDataFrame([(1, "en", "10.01", "80.00", 4, False, True, "0.10"), (2, "fr", "10.01", "70.00", 4, True, False, "0.10")], "emp long, locale string, r string, h string, over_hours int, salaried boolean, has_bonus boolean, b string")
    rows = rows.select("emp", "locale", F.col("r").cast("decimal(18,2)").alias("pay_rate"), F.col("h").cast("decimal(9,2)").alias("hours"), "over_hours", "salaried", "has_bonus", F.col("b").cast("decimal(5,2)").alias("bonus_part"))
    got = sorted((r.emp, r.label, r.rate, r.amount) for r in payroll.earnings_of(rows).collect())
    assert got == [(1, "bonus", None, D("80.08")), (1, "overtime_pay", D("15.02"), D("60.08")), (1, "regular_pay", D("10.01"), D("800.80")), (2, "regular_pay", D("10.01"), D("700.70"))]
    gross = spark.createDataFrame([(1, "en", D("940.96")), (2, "fr", D("700.70"))], "emp long, locale string, gross decimal(18,2)")
    taken = {(r.emp, r.label): r.amount for r in payroll.deductions_of(gross).collect()}
    assert taken[1, "medicare"] == D("13.64") and taken[1, "health_insurance"] == D("85.00") and taken[1, "retirement_401k"] == D("37.64") and taken[2, "mutuelle"] == D("41.40") and len(taken) == 11


def test_places_in_bins(spark):
    """Places over bins equal a plain numbering, whatever the bins and with nulls."""
    rows = spark.createDataFrame([(k % 3 or None, (k * 37) % 101) for k in range(200)], "g int, v int").withColumn("id", F.monotonically_increasing_id())
    for width in (1, 7, 1000):
        got = places.placed(rows, ["g"], F.floor(F.col("v") / width), [F.col("v"), F.col("id")])
        want = rows.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
        assert sorted(map(str, got.select("g", "v", "id", "place").collect())) == sorted(map(str, want.select("g", "v", "id", "place").collect()))


def test_broken_documents_are_named(spark):
    rows = spark.createDataFrame([(1, 5, 5), (2, 5, 6), (3, None, 1)], "k int, a int, b int")
    got = {(r.doc_key, r.problem) for r in invariants.broken(rows, "x", "k", same=F.col("a") == F.col("b"), low=F.col("b") < 6).collect()}
    assert got == {("2", "same"), ("2", "low"), ("3", "same")}


def test_plans_repeat(spark):
    q = registry.queries()
    for name in ("plan_no_repeat", "company_splits", "sample_lines"):
        first = sorted(map(tuple, q[name](spark, SF).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert first == sorted(map(tuple, q[name](spark, SF).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_dataset_sink(spark, tmp_path):
    rows = dataset.rows_of(spark, SF).select("okey", "doc_type", "split", "total")
    for form in ("parquet", "json"):
        path = f"{tmp_path}/{form}"
        dataset.write_dataset(rows, path, form)
        dataset.write_dataset(rows, path, form)
        assert spark.read.format(form).load(path).count() == rows.count()
    (tmp_path / "other").mkdir()
    (tmp_path / "other/file").write_text("x")
    with pytest.raises(ValueError):
        dataset.write_dataset(rows, f"{tmp_path}/other")


def test_entry_runs(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "total" in df.columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_sql_twins(spark):
    """All queries of the engine against their SQL at the smallest size."""
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in pathlib.Path(SF).glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    sql = registry.oracle_sql()

    def check(item):
        name, q = item
        df = q(spark, SF)
        columns = sorted(df.columns)
        rows = sorted(tuple(plain(r[x]) for x in columns) for r in df.collect())
        if name in sql:
            r = c.cursor().sql(sql[name])
            assert sorted(r.columns) == columns, name
            at = [r.columns.index(x) for x in columns]
            assert rows == sorted(tuple(plain(x[k]) for k in at) for x in r.fetchall()), name
        return name

    with ThreadPool(4) as pool:  # small jobs, several at a time
        assert len(pool.map(check, registry.queries().items(), chunksize=1)) == len(registry.queries())


def test_nothing_else_imports_the_corpus_operators():
    root = pathlib.Path(registry.__file__).parent
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "llm" not in f.read_text(), f
