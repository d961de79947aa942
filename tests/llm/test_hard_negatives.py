"""Mined negatives against all scores."""

import math
import random

from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives
from tallyloom.llm.queries import op11_hard_negatives

ROWS = "vec_id long, embedding array<float>, label int, class long, slot string, score double, rank int"


def plain(rows, is_anchor, positives=5, negatives=3):
    clean = set()
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.add((i, label, tuple(max(-hard_negatives.LARGEST, min(hard_negatives.LARGEST, math.floor(256 * x))) for x in v)))
    out = []
    for i, label, v in sorted(clean):
        if not is_anchor(i):
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in clean - {(i, label, v)} if len(w) == len(v)]
        for p, j, _ in sorted(s for s in scores if s[2] == label)[:positives]:
            fit = sorted(s for s in scores if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def awkward(seed, n=400, d=6):
    r = random.Random(seed)
    vector = lambda: [r.choice([-1.0, -0.5, 0.25, 0.5, 1.0, r.uniform(-1, 1)]) for _ in range(d)]
    some = [vector() for _ in range(40)]
    rows = [(k, r.choice(some) if r.random() < 0.6 else vector(), r.randrange(3)) for k in range(n)]
    rows += [(k, some[0], 1) for k in range(n, n + 200)]  # one vector of a third of all rows
    rows += [(7, None, 1), (8, [1.0, None] + [0.0] * (d - 2), 1), (9, [math.nan] * d, 1), (10, [math.inf] + [0.0] * (d - 1), 1), (None, some[0], 1), (11, some[1], None)]
    rows += [(20, some[2], 2), (20, some[3], 1), (20, some[4], 1), rows[40], rows[40], (60, [1.0, 1.0], 1), (61, [1.0, 0.5], 0), (62, [1.0, 1.0], 1), (80, [], 1), (81, [], 0), (82, [], 1), (100, [3e30] * d, 0)]
    return [(*x, 1, "s", 0.5, 9) for x in rows]


def test_equals_all_scores(spark, monkeypatch):
    for seed, chunk, few, digit in ((1, 7, 64, 11), (2, 32_768, 1, 3)):
        monkeypatch.setattr(hard_negatives, "FEW", few)
        monkeypatch.setattr(hard_negatives, "DIGIT", digit)
        rows = awkward(seed)
        got = hard_negatives.mine(spark.createDataFrame(rows, ROWS).repartition(5), F.col("vec_id") % 20 == 0, chunk=chunk)
        want = plain(rows, lambda i: i % 20 == 0)
        assert len(want) > 100
        assert sorted(map(tuple, got.collect())) == want


def test_nothing(spark):
    for rows in ([], [(1, [1.0], 1, 0, "", 0.0, 0)], [(0, [1.0], 1, 0, "", 0.0, 0)], [(k, [1.0], 1, 0, "", 0.0, 0) for k in range(30)]):
        assert hard_negatives.mine(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 20 == 0).count() == 0


def test_chunks_bounded(spark):
    classes = spark.range(0, 1000, 1, 7).select(F.monotonically_increasing_id().alias("class"))
    ranges = hard_negatives.chunks(classes, 64)
    counts = [classes.where((F.col("class") >= a) & (F.col("class") < b)).count() for a, b in ranges]
    assert sum(counts) == 1000 and max(counts) <= 64


def test_query_changes_labels(spark, tmp_path):
    rows = [(k, [1.0, k / 100], k % 2) for k in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(k, v, (label + 1) % 10 if k % 7 == 0 else label) for k, v, label in rows]
    got = sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in op11_hard_negatives(spark, str(tmp_path)).collect())
    want = plain([(k, [float(__import__("numpy").float32(x)) for x in v], label) for k, v, label in moved], lambda i: i % 50 == 0)
    assert got == want
