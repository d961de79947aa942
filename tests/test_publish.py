"""The catalogue, the tax policy, printed checks, cleaned records, sinks, uploads and contracts on small fixtures."""

import collections
import datetime
import decimal
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import text
from tallyloom.operators import documents, invariants, options, printed
from tallyloom.plans import catalog, dataset, publish
from tallyloom.sources import contracts

D = decimal.Decimal


def test_tax_policy(spark):
    rows = [(m, l, c) for m in ("none", "given", "single", "multi") for l in ("en", "fr") for c in ("ECONOMY", "PROMO", "LARGE")]
    df = spark.createDataFrame(rows, "m string, l string, c string")
    got = {(r.m, r.l, r.c): r.t for r in df.select("*", printed.tax_rate(F.col("m"), F.col("l"), F.col("c")).alias("t")).collect()}
    for m, l, c in rows:
        standard, reduced = {"en": ("0.0825", "0.04"), "fr": ("0.20", "0.055")}[l]
        low = c == "ECONOMY" or (l == "fr" and c == "PROMO")
        want = "0" if m in ("none", "given") else reduced if m == "multi" and low else standard
        assert got[m, l, c] == D(want), (m, l, c)


def test_lines_are_made_once_for_strings_and_pages(spark):
    """The check reads each table as often as the strings that it checks, and the orders once more."""
    reads = lambda q: q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert reads(printed.required_strings) <= 10  # lines with parts and heads, heads, taxes of the source
    assert reads(printed.check_printed) == reads(printed.required_strings) + 1


def test_checked(spark):
    """A field that isn't on the page is missing, hyphens and spaces aside; an empty value needn't be there; arithmetic fails
    a document whose strings are all there."""
    needed = spark.createDataFrame([(1, "total", "$1,234.50"), (1, "name", "Top - Shelf Ltd"), (1, "note", ""), (2, "total", "$9.00"), (3, "total", "$1.00")], "okey long, field string, value string")
    pages = spark.createDataFrame([(1, "TOP -SHELF\n ltd ... $1,234.50"), (2, "nothing"), (4, "x")], "okey long, page string")
    problems = spark.createDataFrame([(1, "total != subtotal + freight + tax")], "okey long, problem string")
    got = {r.okey: (r.required, r.missing, r.arithmetic, r.ok) for r in printed.checked(needed, pages, problems).collect()}
    assert got == {1: (2, [], ["total != subtotal + freight + tax"], False), 2: (1, ["total"], [], False), 3: (1, ["total"], [], False)}
    fine = printed.checked(needed, pages, problems.filter("false")).filter("ok").collect()
    assert [r.okey for r in fine] == [1]


def test_invariants_name_the_problem(spark):
    heads = spark.createDataFrame([(k, D("10.00"), D("2.00"), D("1.00"), D("13.00") + (k == 4)) for k in range(1, 7)], "okey long, subtotal decimal(18,2), freight decimal(18,2), tax_total decimal(18,2), total decimal(18,2)")
    lines = [(k, D("5.00"), 2, D("0.00"), D("10.00")) for k in (1, 2, 3, 4)] + [(5, D("5.00"), 2, D("0.10"), D("10.00"))]
    lines = spark.createDataFrame(lines, "okey long, price decimal(18,2), qty int, discount decimal(5,2), line_total decimal(18,2)").unionByName(
        spark.createDataFrame([(3, D("1.00"), 1, D("0.00"), D("1.00"))], "okey long, price decimal(18,2), qty int, discount decimal(5,2), line_total decimal(18,2)"))
    taxes = spark.createDataFrame([(k, D("1.00")) for k in (1, 3, 4, 5, 6)] + [(2, D("0.99"))], "okey long, amount decimal(18,2)")
    got = collections.defaultdict(set)
    for r in invariants.broken_totals(heads, lines, taxes).collect():
        got[int(r.doc_key)].add(r.problem)
    assert got == {2: {"tax_total"}, 3: {"subtotal"}, 4: {"total"}, 5: {"line"}, 6: {"line", "subtotal"}}
    sheet = "ckey long, opening_balance decimal(18,2), invoiced decimal(18,2), payments decimal(18,2), amount_due decimal(18,2), current decimal(18,2), days_30 decimal(18,2), days_60 decimal(18,2), days_90 decimal(18,2)"
    z = D("0.00")
    sheets = spark.createDataFrame([(1, z, D("5.00"), D("2.00"), D("3.00"), D("3.00"), z, z, z), (2, z, D("5.00"), D("2.00"), D("4.00"), D("4.00"), z, z, z), (3, z, D("3.00"), z, D("3.00"), D("2.00"), z, z, z), (4, z, z, z, z, z, z, z, z)], sheet)
    rows = spark.createDataFrame([(1, 1, D("5.00")), (1, 2, D("3.00")), (2, 1, D("4.00")), (3, 1, D("2.00"))], "ckey long, row_no long, balance decimal(18,2)")
    assert {(int(r.doc_key), r.problem) for r in invariants.broken_statements(sheets, rows).collect()} == {(2, "amount_due"), (3, "balance"), (3, "aging")}
    notes = spark.createDataFrame([("a", 5, 1, 4), ("a", 5, 1, 4), ("b", 5, 1, 4), ("b", 5, 1, 5)], "purchase_key string, received long, rejected long, accepted long")
    assert [r.doc_key for r in invariants.broken_receipts(notes).collect()] == ["b"]


def test_words_and_dates(spark):
    d = F.lit(datetime.date(2021, 5, 7))
    row = spark.range(1).select(
        text.dated(d, "{dd}/{mm}/{yyyy}", "fr").alias("a"), text.dated(d, "{d} {mon} {yy}", "en").alias("b"), text.dated(d, "le {d} {month}", "fr").alias("c"), text.filled("Net {days} days, {who}", days=F.lit(30), who=F.lit(None).cast("string")).alias("d"),
        text.title(F.lit("o'neil 2nd-hand ÉTÉ")).alias("e"), text.labelled(F.lit("customer_id")).alias("f"), text.tolerant_json(F.lit("so: ```[1, 2]```"), "array<int>").alias("g"))
    assert tuple(row.first()) == ("07/05/2021", "7 May 21", "le 7 mai", "Net 30 days, ", "O'Neil 2Nd-Hand Été", "Customer Id", [1, 2])


def test_clean_json(spark):
    """Nulls, empty texts and lists, internal fields and what holds nothing else go, at any depth; a list's member that
    becomes empty stays as an empty record."""
    kind = T.StructType([T.StructField("a", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("inner", T.StructType([T.StructField("x", T.StringType()), T.StructField("deep", T.StructType([T.StructField("y", T.StringType())]))])),
                         T.StructField("list", T.ArrayType(T.StructType([T.StructField("s", T.StringType())]))), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("map", T.MapType(T.StringType(), T.StringType()))])
    rows = [(1, ("v", 5, 0, ("", ("",)), [("",), None, ("t",)], ["", "w", None], {"k": "", "l": "m", "doc_id": "z"})), (2, ("", 5, None, (None, ("y",)), [], [None, ""], {"k": ""})), (3, None), (4, (None, 1, None, None, [None], None, None))]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("k", T.IntegerType()), T.StructField("r", kind)]))
    got = {r.k: r.j and json.loads(r.j) for r in publish.clean_json(df, "r", "j").collect()}
    assert got == {1: {"a": "v", "n": 0, "list": [{}, {"s": "t"}], "words": ["w"], "map": {"l": "m"}}, 2: {"inner": {"deep": {"y": "y"}}}, 3: None, 4: {}}


def test_deletions_against_brute_force(spark):
    """Random trees: what is deleted covers the stale paths and nothing else, in as few steps as folders allow."""
    r = random.Random(12)
    rows = []
    for tree in range(12):
        paths = sorted({"/".join(r.choice("pqr") for _ in range(r.randint(1, 4))) + f"/f{r.randrange(5)}" for _ in range(r.randint(1, 25))} | {f"top{k}" for k in range(2)})
        rows.append((paths, [p for p in paths if r.random() < r.choice([0.2, 0.7, 1.0])]))
    df = lambda paths: spark.createDataFrame([(p,) for p in paths], "path string")
    for paths, stale in rows:
        kept, want = set(paths) - set(stale), set()
        for p in stale:
            above = ["/".join(p.split("/")[:k]) + "/" for k in range(1, p.count("/") + 1)]
            want.add(next((f for f in above if not any(k.startswith(f) for k in kept)), p))
        assert {x.path for x in publish.deletions(df(paths), df(stale)).collect()} == want


def test_records_are_made_once_for_both_sides(spark):
    """Neither the lines nor the paths' folders are computed again for what stays and what goes."""
    plan = publish.sync_deletions(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "explode" not in plan


def test_sync_plan_and_blob(spark):
    hashes = lambda rows: spark.createDataFrame(rows, "path string, hash string")
    got = {r.path: r.action for r in publish.sync_plan(hashes([("a", "1"), ("b", "2"), ("c", "3")]), hashes([("b", "2"), ("c", "9"), ("d", "4")])).collect()}
    assert got == {"a": "upload", "b": "skip", "c": "upload", "d": "delete"}
    assert spark.range(1).select(publish.blob_id(F.lit(b"hello\n"))).first()[0] == "ce013625030ba8dba906f756967f9e9ca394464a"


def test_numbers(spark):
    """Own forms with initials, default forms fixed for company and type, keys padded but never cut."""
    made = spark.range(300).select(F.col("id"), *(catalog.numbered(d, F.col("id"), F.lit("AB"), F.lit(k), F.lit("2031-05-07").cast("date")).alias(n) for n, d, k in (("a", "invoice", 42), ("b", "invoice", 123456789), ("c", "payslip", 7)))).collect()
    assert {r.a for r in made} == {"INV-2031-42", "AB-2031-42", "INV0000042", "AB0000042", "F31-42", "2031/42"}
    assert {r.b for r in made} == {"INV-2031-123456789", "AB-2031-123456789", "INV123456789", "AB123456789", "F31-123456789", "2031/123456789"}
    assert {r.c for r in made} == {f"{p}{rest}" for p in ("PAY", "AB") for rest in ("-2031-7", "000007", "/31/7")}


def test_given_tax_on_a_part(spark):
    """A credit of 30.00 on an order of 123.45 before rounding that was taxed 9.99 in all: 8.09 per cent of it."""
    m = lambda v: F.lit(v).cast("decimal(18,2)")
    base = lambda v: F.lit(v).cast("decimal(24,4)")
    row = spark.range(1).select(documents.given_part(m("30.00"), m("9.99"), base("123.4500")).alias("a"), documents.given_part(m("30.00"), m("0"), base("123.45")).alias("b"), documents.given_part(m("30.00"), m("9.99"), base("0")).alias("c"))
    assert tuple(row.first()) == (D("2.43"), D("0.00"), D("0.00"))


def test_pins(spark):
    """Three flags a company, the same for all of its documents; the others are drawn."""
    rows = options.options_pinned(spark, "/root/testdata/sf0.001").collect()
    by_company = collections.defaultdict(list)
    for r in rows:
        by_company[r.company].append(r)
    for own in by_company.values():
        fixed = [n for n in options.PINNABLE if len({r[n] for r in own}) == 1]
        assert len(own) < 40 or len(fixed) == options.PINNED


def test_card(spark):
    configs = spark.createDataFrame([("scans", "train", "scans/receipt/train-*.parquet", False, 0), ("receipt", "train", "data/receipt/train-*.parquet", False, 0), ("all", "test", "data/payslip/test-*.parquet", True, 2), ("all", "train", "data/receipt/train-*.parquet", True, 0), ("payslip", "test", "data/payslip/test-*.parquet", False, 2)],
                                    "config string, split string, paths string, is_default boolean, place int")
    card = publish.card_text(configs, spark.createDataFrame([("receipt", 1200), ("payslip", 3)], "key string, n long"), "Documents")
    yaml = pytest.importorskip("yaml")
    head = {c["config_name"]: c for c in yaml.safe_load(card.split("---")[1])["configs"]}
    assert list(head) == ["all", "payslip", "receipt", "scans"] and head["all"]["default"] and [f["split"] for f in head["all"]["data_files"]] == ["train", "test"]
    assert "| receipt | 1,200 |\n| payslip | 3 |" in card


def test_shards(spark, tmp_path):
    """Names, sizes, order, small row groups and metadata of shards; a second run gives the same files."""
    import pyarrow.parquet as pq

    rows = spark.range(730).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "invoice").otherwise("receipt").alias("doc_type"), F.lit("train").alias("split"), F.array(F.col("id")).alias("list"))
    for _ in range(2):
        made = {r.file: r.n for r in publish.write_shards(rows.repartition(3), f"{tmp_path}/data", "k", {"features": '{"pdf": "Pdf"}'}, rows_a_shard=250).collect()}
        assert made == {"invoice/train-00000.parquet": 244, "receipt/train-00000.parquet": 250, "receipt/train-00001.parquet": 236}
    assert sorted(p.relative_to(tmp_path / "data").as_posix() for p in (tmp_path / "data").rglob("*") if p.is_file() and p.name[0] not in "._") == sorted(made)
    file = pq.ParquetFile(tmp_path / "data/receipt/train-00000.parquet")
    assert file.metadata.num_row_groups == 3 and file.schema_arrow.metadata[b"features"] == b'{"pdf": "Pdf"}' and file.metadata.row_group(0).column(0).compression == "ZSTD"
    ids = file.read()["k"].to_pylist()
    assert ids == sorted(ids) == [k for k in range(730) if k % 3][:250]


def test_sinks_replace_datasets_only(spark, tmp_path):
    """A second, smaller run leaves no shard of the first; a folder of something else stays as it is."""
    rows = spark.range(600).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "invoice").otherwise("receipt").alias("doc_type"), F.lit("train").alias("split"))
    path = f"file:{tmp_path}/data"
    assert publish.write_shards(rows, path, "k", rows_a_shard=100).count() == 6
    (tmp_path / "data/README.md").write_text("the card")
    less = {r.file: r.n for r in publish.write_shards(rows.filter("k < 150 and doc_type = 'invoice'"), path, "k", rows_a_shard=50).collect()}
    assert less == {"invoice/train-00000.parquet": 50, "invoice/train-00001.parquet": 25}
    assert sorted(p.relative_to(tmp_path / "data").as_posix() for p in (tmp_path / "data").rglob("*.parquet")) == sorted(less)
    assert sorted(r.k for r in spark.read.parquet(f"{path}/invoice").collect()) == list(range(0, 150, 2)) and (tmp_path / "data/README.md").exists()
    (tmp_path / "other").mkdir()
    (tmp_path / "other/notes.txt").write_text("mine")
    for write in (lambda p: publish.write_shards(rows, p, "k"), lambda p: publish.write_json_rows(rows, p, ["k"]), lambda p: dataset.write_dataset(rows, p)):
        with pytest.raises(ValueError):
            write(str(tmp_path / "other"))
    assert [p.name for p in (tmp_path / "other").iterdir()] == ["notes.txt"]
    for n in (600, 30):
        publish.write_json_rows(rows.filter(F.col("k") < n), f"{tmp_path}/lines", ["k"])
        dataset.write_dataset(rows.filter(F.col("k") < n), f"{tmp_path}/set")
    assert spark.read.text(f"{tmp_path}/lines").count() == 30 and spark.read.parquet(f"{tmp_path}/set").count() == 30


def test_json_rows(spark, tmp_path):
    rows = spark.createDataFrame([("invoice", "train", None, 3), ("receipt", "test", "é", None)], "doc_type string, split string, name string, pages int")
    publish.write_json_rows(rows, f"{tmp_path}/m", ["doc_type", "name", "pages", "absent"])
    got = {r.doc_type: json.loads(r.value) for r in spark.read.text(f"{tmp_path}/m").collect()}
    assert got == {"invoice": {"doc_type": "invoice", "name": "", "pages": 3, "absent": ""}, "receipt": {"doc_type": "receipt", "name": "é", "pages": 0, "absent": ""}}


def test_company_files(spark, tmp_path):
    for slug, name, body in (("a", "company.json", '{"slug": "a", "locale": "fr", "party": {"name": "A SARL", "address": {"country": "France"}}}'), ("b", "company.yaml", "slug: b\nparty:\n  name: B Ltd\n"), ("c", "company.yaml", "a: [")):
        (tmp_path / slug).mkdir()
        (tmp_path / slug / name).write_text(body)
    pytest.importorskip("yaml")
    got = {r.slug: (r.locale, r.name, r.country, bool(r.error)) for r in publish.company_files(spark, str(tmp_path)).collect()}
    assert got == {"a": ("fr", "A SARL", "France", False), "b": (None, "B Ltd", None, False), "c": (None, None, None, True)}


def test_companies_and_variants(spark):
    sf = "/root/testdata/sf0.001"
    rows = catalog.issuers(spark, sf).collect()
    assert len({r.slug for r in rows}) == len(rows) and {r.sector for r in rows} <= set(catalog.SECTORS)
    assert {(r.sector, r.locale, r.currency) for r in rows} <= set(catalog.REGIONS.values())
    assert catalog.variants(spark).count() == 23 and catalog.variants(spark, ["invoice"], ["chinook"]).count() == 1
    with pytest.raises(ValueError):
        catalog.variants(spark, ["letter"])
    one = catalog.companies_for(catalog.variants(spark, ["receipt"]), catalog.issuers(spark, sf), slugs=[rows[0].slug])
    assert {r.sector for r in one.collect()} <= {rows[0].sector}


def test_contracts(spark):
    contract = contracts.Contract({"k": "bigint", "v": "int", "gone": "string"}, ("k",), ("k",), ("v > 0",))
    df = spark.createDataFrame([(1, 5), (1, 0), (None, None), (2, -1)], "k long, v long")
    got = {r.rule: r.violations for r in contracts.violations(df, "t", contract).collect()}
    assert got == {"gone is missing": 4, "v is bigint, not int": 4, "k is null": 1, "v > 0": 2, "k is unique": 1}
    assert contract.schema.fieldNames() == ["k", "v", "gone"] and not contract.schema["k"].nullable


def test_sources(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    spark.range(5).write.parquet(f"{tmp_path}/other/t.parquet")
    contracts.register_source(contracts.Source("shop", str(tmp_path), ("t",)))
    assert contracts.open_source("shop").views(spark) == ["shop_t"] and spark.sql("select count(*) from shop_t").first()[0] == 3
    given = contracts.overrides([f"shop={tmp_path}/other"])
    assert contracts.open_source("shop", given["shop"]).table(spark, "t").count() == 5
    contracts.register_source(contracts.Source("made", "7", ("n",), lambda s, path, table: s.range(int(path))))
    assert contracts.open_source("made").table(spark, "n").count() == 7
    for bad in (lambda: contracts.open_source("none"), lambda: contracts.open_source("shop").table(spark, "x")):
        with pytest.raises(KeyError):
            bad()
    with pytest.raises(ValueError):
        contracts.overrides(["shop"])
