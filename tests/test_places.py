"""First rows of groups, interval joins and places of values, against brute force."""

import datetime
import random

from pyspark.sql import functions as F

from tallyloom.functions import places
from tallyloom.operators import checks, intervals


def test_first_of_equals_sorting(spark):
    r = random.Random(3)
    most = {g: r.choice([0, 1, 7, 60, 10_000]) for g in range(8)}
    rows = [(r.choice([None, *range(7)]), r.randrange(200), k) for k in range(900)]
    given = [(g, v, k, most[g if g is not None else 7]) for g, v, k in rows]
    df = spark.createDataFrame(given, "g int, v int, k int, most long").repartition(5)
    got = places.first_of(df, ["g"], F.floor(F.col("v") / 9), [F.col("v"), F.col("k")], "most")
    want = []
    for g in {x[0] for x in given}:
        own = sorted((x for x in given if x[0] == g), key=lambda x: (x[1], x[2]))
        want += [(*x, n) for n, x in enumerate(own, 1) if n <= x[3]]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert places.first_of(df.filter("false"), ["g"], F.col("v"), [F.col("k")], "most").count() == 0


def test_first_of_sorts_only_bins_that_are_needed(spark):
    df = spark.range(20_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 20_000).alias("v"), F.lit(10).cast("long").alias("most"))
    got = places.first_of(df, ["g"], F.floor(F.col("v") / 100), [F.col("v")], "most")
    assert sorted(r.v for r in got.collect()) == list(range(10))
    plan = got._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "BroadcastHashJoin" in text and text.index("Window") < text.index("BroadcastHashJoin")  # the join lets few rows up to the window


def brute(points, spans):
    return sorted((a, b) for a, k, at in points for b, q, s, e in spans if k is not None and k == q and None not in (at, s, e) and s <= at < e)


def test_points_in_intervals(spark):
    r = random.Random(9)
    some = lambda n, span: [(k, r.choice([1, 1, 1, 2, None]), r.choice([None, r.randint(-span, span)])) for k in range(n)]
    for span, widths in ((40, 24), (40, 2), (3000, 24), (100_000, 24)):
        points = some(150, span)
        spans = [(k, r.choice([1, 1, 2, None]), s, r.choice([None, s, s + r.choice([1, 2, 7, 60, span]), s - 3])) for k in range(60) for s in [r.randint(-span, span)]]
        p, q = spark.createDataFrame(points, "a int, k int, at long").repartition(3), spark.createDataFrame(spans, "b int, k int, s long, e long")
        got = intervals.points_in(p, q, ["k"], "at", "s", "e", widths)
        assert got.columns == ["k", "a", "at", "b", "s", "e"]
        assert sorted((x.a, x.b) for x in got.collect()) == brute(points, spans)


def test_ranges_are_few_and_exact(spark):
    rows = [(s, e) for s in (-37, -1, 0, 5, 64) for e in (-40, -37, 0, 1, 63, 64, 65, 4000)]
    got = spark.createDataFrame(rows, "s long, e long").select("s", "e", intervals.ranges(F.col("s"), F.col("e")).alias("r")).collect()
    for s, e, pieces in got:
        covered = [x for p in pieces for x in range(p.at << p.k, (p.at + 1) << p.k)]
        assert sorted(covered) == list(range(s, e)) and len(pieces) <= 26


def test_ranges_are_not_broadcast(spark):
    """However small Spark takes a table of intervals to be, the rows of its ranges don't pass through the driver."""
    p = spark.range(50).select(F.col("id").alias("k"), F.lit(5).alias("at"))
    q = spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("s"), (F.col("id") + 1).alias("e"))
    got = intervals.points_in(p, q, ["k"], "at", "s", "e")
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in got.collect()) == list(range(5, 50))


def test_overlaps(spark):
    r = random.Random(10)
    span = lambda k: (k, r.choice([1, 2]), *[(d := r.randint(0, 60)), d + r.choice([-2, 0, 1, 5, 30])])
    left, right = [span(k) for k in range(60)], [span(k) for k in range(60)]
    day = lambda x: datetime.date(2020, 1, 1) + datetime.timedelta(x)
    a = spark.createDataFrame([(k, q, day(s), day(e)) for k, q, s, e in left], "a int, k int, ls date, le date")
    b = spark.createDataFrame([(k, q, day(s), day(e)) for k, q, s, e in right], "b int, k int, rs date, re date")
    got = sorted((x.a, x.b) for x in intervals.overlaps(a, b, ["k"], "ls", "le", "rs", "re").collect())
    assert got == sorted((x, y) for x, q, s, e in left for y, p, t, u in right if q == p and max(s, t) < min(e, u))


def plain_runs(tokens, target, page):
    """Each start is tried word by word."""
    out = []
    for i, t in enumerate(tokens):
        glued, j = "", i
        while t and j < len(tokens) and j // page == i // page and len(glued) < len(target):
            glued += tokens[j]
            j += 1
        if t and glued == target:
            out.append((i, j))
    return out


def test_runs_equal_trying_each_start():
    r = random.Random(5)
    for _ in range(400):
        tokens = [r.choice(["a", "b", "ab", "ba", "aa", "", "é"]) for _ in range(r.randint(0, 40))]
        target = "".join(r.choice("abé") for _ in range(r.randint(1, 6)))
        page = r.choice([3, 7, 100])
        assert list(checks.runs_of(tokens, target, page)) == plain_runs(tokens, target, page)


def test_boxes_of_wrapped_lines(spark):
    rows = [(1, "a b c d e f g h", "c d e f g"), (2, "x - y z", "x -y"), (3, "a b", "b")]
    got = checks.locate_boxes(spark.createDataFrame(rows, "doc_id long, text string, value string"), words_a_page=8, words_a_line=3).collect()
    assert sorted((r.doc_id, r.line, r.left_x, r.top_y, r.right_x, r.bottom_y) for r in got) == [
        (1, 0, 20.0, 0.0, 28.0, 5.0), (1, 1, 0.0, 10.0, 28.0, 15.0), (1, 2, 0.0, 20.0, 8.0, 25.0), (2, 0, 0.0, 0.0, 28.0, 5.0), (3, 0, 10.0, 0.0, 18.0, 5.0)]


def test_containment_both_ways(spark):
    """Passages within passages, alike, empty and null ones; an automaton and runs of words find the same."""
    r = random.Random(6)
    some = lambda n: " ".join(r.choice(["a", "b", "ab", "ba", "abc"]) for _ in range(n))
    docs = [(k, some(r.randint(0, 30))) for k in range(60)] + [(60, None), (61, "")]
    items = [(k, some(r.randint(1, 9))) for k in range(40)] + [(40, ""), (41, None), (42, "a b"), (43, "a b"), (44, "b a")]
    d, i = spark.createDataFrame(docs, "doc_id long, t string"), spark.createDataFrame(items, "item_id long, needle string")
    want = sorted((k, j) for k, t in docs for j, n in items if t is not None and n is not None and n in t)
    for way in (checks.by_automaton, checks.by_runs, checks.contained):
        assert sorted(map(tuple, way(d, i).collect())) == want, way.__name__
    assert checks.by_automaton(d, i.filter("false")).count() == 0
