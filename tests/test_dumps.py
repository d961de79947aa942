"""Dumps read in byte ranges of any size, against one reader from start to end."""

import random

import pytest

from tallyloom.sources import ingest


def serial(text):
    """Rows of a dump read in one go."""
    lines = text.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    return sorted((t, repr(row), repr(sorted(zip(columns, row)) if row and columns else None), why) for begun, s in ingest.statements(iter(lines), ingest.PLAIN, True) for t, columns, row, why in ingest.inserts(s) if begun)


def parallel(spark, path):
    return sorted((r.table_name, repr(r["values"]), repr(sorted(r.named.items()) if r.named else None), r.error) for r in ingest.sql_dump(spark, path).collect())


def dump(seed, end, n=120):
    """Statements with everything that hides a cut: literals, names and comments over several lines that hold INSERT and GO."""
    r = random.Random(seed)
    texts = ["x", "it''s", f"a{end}INSERT INTO u VALUES (9){end}b", f"{end}GO{end}", "--", "/*", "[", '"', "*/", "é日本", "''''", f"]{end}", ""]
    out = []
    for k in range(n):
        kind = r.random()
        name = r.choice(["t", "[Order Details]", '"Region"', "[dbo].[a]]b]", f"[odd{end}INSERT]"])
        if kind < 0.6:
            rows = ", ".join(f"({k}, N'{r.choice(texts)}', NULL, '{r.choice(texts)}'{r.choice(['', end])})" for _ in range(r.randint(1, 4)))
            out.append(f"insert into {name} (a, b, c, d) values {rows}")
        elif kind < 0.7:
            out.append(f"INSERT {name}{end}VALUES{end}({k}, 0xFF, -2.5e3){r.choice(['', ';'])}")
        elif kind < 0.8:
            out.append(f"/* {r.choice(texts).replace('*/', '')}{end}INSERT INTO c VALUES (0){end} */")
        elif kind < 0.9:
            out.append(f"-- {r.choice(['it', 'GO', chr(39)])}")
        else:
            out.append(r.choice(["GO", "SELECT 1", "INSERT INTO t VALUES (GETDATE())", "SET x = 1; INSERT INTO t VALUES (7)"]))
    return end.join(out) + r.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_gives_the_serial_rows(spark, tmp_path, end):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for seed, n, size in ((1, 12, 7), (2, 40, 64), (3, 120, 200), (4, 120, 1000), (5, 120, 1 << 20)):
            text = dump(seed, end, n)
            (tmp_path / f"{seed}.sql").write_bytes(text.encode())
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", str(size))
            want = serial(text)
            assert len(want) > n / 3 and parallel(spark, str(tmp_path / f"{seed}.sql")) == want, (seed, size)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        assert len(parallel(spark, str(tmp_path))) == sum(len(serial((tmp_path / f"{k}.sql").read_bytes().decode())) for k in range(1, 6))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_end_inside_literals(spark, tmp_path):
    """One literal longer than several ranges, and a range without a line of its own."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    text = "INSERT INTO t VALUES (1, '" + "INSERT INTO u VALUES (1)\n" * 50 + "')\nGO\nINSERT INTO t VALUES (2, '" + "y" * 400 + "')\n"
    (tmp_path / "d.sql").write_text(text)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        got = sorted((r.table_name, r["values"]) for r in ingest.sql_dump(spark, str(tmp_path / "d.sql")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [("t", ["1", "INSERT INTO u VALUES (1)\n" * 50]), ("t", ["2", "y" * 400])]


def test_states_compose():
    r = random.Random(6)
    for _ in range(200):
        lines = ["".join(r.choice("'\"[]-/* a") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 12))]
        k = r.randint(0, len(lines))
        whole, left, right = ingest.composed(iter(lines)), ingest.composed(iter(lines[:k])), ingest.composed(iter(lines[k:]))
        assert whole[0] == [right[0][s] for s in left[0]]


def test_nothing(spark, tmp_path):
    (tmp_path / "d.sql").write_text("")
    assert ingest.sql_dump(spark, str(tmp_path / "d.sql")).count() == 0
    (tmp_path / "e.sql").write_text("-- nothing\nSELECT 1\n")
    assert ingest.sql_dump(spark, str(tmp_path / "e.sql")).count() == 0
