"""Hard negatives by distributed radix selection.

For each anchor and each of its positives, the negatives are the first few rows of another label whose score lies in a
window below the positive's score. No task holds all scores of an anchor and no list of scores is sorted: every pass scores
all rows against a block of anchors again, counts the scores of each window by one digit, finds the digit that holds the
k-th score, and goes on within that digit. At the end only rows at or above the last digit's lower edge are gathered.

What moves between passes is counts. A task reports a window's digits from the top until they hold k scores: lower digits
can't hold the k-th score of all rows, so the counts that matter are exact. Anchors meet rows in chunks of CHUNK classes,
broadcast one after the other; this is the only data that passes through the driver at once, and its size is fixed."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_in_arrow, written

#: Classes of anchors (different label or vector) that are scored in one pass; with 1,000 components they take 256 MB at most.
CHUNK = 32_768
#: Bits of a score that one pass decides.
DIGIT = 11
#: A window whose rows at or above its digit are no more than this needs no further pass.
FEW = 64
#: Anchors multiplied with a batch of rows at a time.
BLOCK = 256
#: Components are held within these bounds, which keep a hundred times a score of 1,024 components within a long.
LARGEST = 1 << 23

COUNTS = "class long, slot long, want int, digit long, n long"
FOUND = "class long, slot long, vec_id long, score long"


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and q = floor(scale * component). Rows with a null id or label, a null vector, or a null or non-finite
    component take no part. Components beyond LARGEST are held at it."""
    x = F.col("embedding").cast("array<double>")
    held = lambda v: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(v * scale))).cast("int")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(F.exists("x", odd), F.lit(True)))
        .select("vec_id", "label", F.transform("x", held).alias("q"))
    )


def representatives(rows: DataFrame, most: int) -> DataFrame:
    """Of rows that share label and vector, the `most` smallest ids: as their scores are equal, no other can be among the
    first. The limit is applied before the shuffle, so that one vector of a third of all rows costs no more than another."""
    same = Window.partitionBy(F.xxhash64("label", "q"), "label", "q").orderBy("vec_id")
    return rows.withColumn("n_th", F.row_number().over(same)).where(F.col("n_th") <= most).drop("n_th")


def chunks(classes: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of class numbers that hold at most so many classes each. Numbers count up within a partition."""
    per_part = classes.groupBy(F.shiftright("class", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    ranges, start, room = [], 0, most
    for part, n in per_part:
        at = 0
        while n - at > room:
            at += room
            ranges.append((start, (part << 33) + at))
            start, room = (part << 33) + at, most
        room -= n - at
    return [*ranges, (start, 1 << 62)] if per_part else []


def by_length(offsets: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The places and vectors of each length that lists have."""
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield int(d), at, values[(offsets[at][:, None] + np.arange(d)[None, :])].astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of integer vectors, exact: as doubles while these hold them, else as longs."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Windows:
    """Windows of one chunk: for class number c, rows of its label (same) or of other labels with lo <= score <= hi, of which
    the first `want` are looked for. `shift`: bits below the digit that this pass counts."""

    def __init__(self, classes: list, windows: list, same: bool):
        self.same, self.of = same, {}
        for w in windows:
            self.of.setdefault(w["class"], []).append((w["slot"], w["lo"], w["hi"], w["want"], w["shift"]))
        classes = [c for c in classes if c["class"] in self.of]
        self.by_length = {}
        for d in {len(c["q"]) for c in classes}:
            own = [c for c in classes if len(c["q"]) == d]
            self.by_length[d] = ([c["class"] for c in own], [c["label"] for c in own], np.array([c["q"] for c in own], np.int64).reshape(len(own), d))

    def scored(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Class, and ids and scores of the batch's rows that its windows can hold."""
        lists = batch.column("q")
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for d, at, vectors in by_length(lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)):
            numbers, own, anchors = self.by_length.get(d, ([], [], np.empty((0, d), np.int64)))
            for k in range(0, len(numbers), BLOCK):
                scores = products(anchors[k : k + BLOCK], vectors)
                for i, row in enumerate(scores, k):
                    right = (labels[at] == own[i]) == self.same
                    yield numbers[i], ids[at][right], row[right]


def count_digits(windows: Windows, batch: pa.RecordBatch) -> Iterator[tuple]:
    for number, _, scores in windows.scored(batch):
        for slot, lo, hi, want, shift in windows.of[number]:
            below = hi - scores[(scores >= lo) & (scores <= hi)]
            if len(below) > want:
                below = below[below >> shift <= np.partition(below, want - 1)[want - 1] >> shift]
            for digit, n in zip(*np.unique(below >> shift, return_counts=True), strict=True):
                yield number, slot, want, int(digit), int(n)


def gather_rows(windows: Windows, batch: pa.RecordBatch) -> Iterator[tuple]:
    for number, ids, scores in windows.scored(batch):
        for slot, lo, hi, want, _ in windows.of[number]:
            at = np.flatnonzero((scores >= lo) & (scores <= hi))
            if len(at) > want:
                at = at[np.lexsort((ids[at], -scores[at]))[:want]]
            for i in at:
                yield number, slot, int(ids[i]), int(scores[i])


def over_rows(rows: DataFrame, classes: list, windows: list, same: bool, what: Callable, schema: str) -> DataFrame:
    """what(windows, batch) for all batches of rows."""
    shared = rows.sparkSession.sparkContext.broadcast(Windows(classes, windows, same))
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    kind = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(what(shared.value, batch))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, kind.field(c).type) for c, v in zip(names, zip(*out, strict=True), strict=True)], schema=kind)

    return map_in_arrow(rows, run, schema)


def kth_digit(counts: DataFrame) -> DataFrame:
    """Of each window that holds as many as wanted: the digit of the last one wanted, and how many come before that digit."""
    running = Window.partitionBy("class", "slot").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.groupBy("class", "slot", "want", "digit").agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
        .select("class", "slot", "digit", "n", (F.col("upto") - F.col("n")).cast("int").alias("before"))
    )


def select_first(rows: DataFrame, classes: list, windows: list, same: bool, k: int) -> DataFrame:
    """The first k rows of each window by score and id: class, slot, vec_id, score. windows: rows of class, slot, lo, hi."""
    floor_of = {(w["class"], w["slot"]): w["lo"] for w in windows}
    top_of = {(w["class"], w["slot"]): w["hi"] for w in windows}
    width = lambda w: max(w["hi"] - w["lo"], 1).bit_length()
    active = [{**w, "want": k, "shift": max(width(w) - DIGIT, 0)} for w in windows]
    while active:
        digits = kth_digit(over_rows(rows, classes, active, same, count_digits, COUNTS))
        hit = {(r["class"], r["slot"]): r for r in digits.collect()}
        going = []
        for w in active:
            key = w["class"], w["slot"]
            if key not in hit:  # it holds fewer than wanted: all of its rows are
                continue
            r = hit[key]
            top = w["hi"] - (r["digit"] << w["shift"])
            bottom = max(w["lo"], top - (1 << w["shift"]) + 1)
            floor_of[key] = bottom
            if r["n"] + r["before"] > FEW and w["shift"] > 0:
                going.append({**w, "hi": top, "lo": bottom, "want": w["want"] - r["before"], "shift": max(w["shift"] - DIGIT, 0)})
        active = going
    last = [{"class": c, "slot": s, "lo": lo, "hi": top_of[c, s], "want": k, "shift": 0} for (c, s), lo in floor_of.items()]
    best = Window.partitionBy("class", "slot").orderBy(F.desc("score"), "vec_id")
    found = over_rows(rows, classes, last, same, gather_rows, FOUND)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def floor_div(a: Column, b: int) -> Column:
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def mine(rows: DataFrame, anchors: Column, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, chunk: int = CHUNK) -> DataFrame:
    """Hard negatives of the rows for which `anchors`, a condition on vec_id, holds: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score. rows: vec_id, label, embedding; other columns don't matter.

    A score is the integer inner product of quantised vectors; higher ones come first, ties by smaller id. An anchor's
    positives are the first other rows of its own label. A positive's negatives are the first rows of other labels
    with low * positive_score <= 100 * score <= high * positive_score.

    Rows with a null id, label or vector or a null or non-finite component take no part; rows repeated in full count once;
    rows that share an id but differ are rows of their own; vectors of different lengths don't meet; an anchor without
    positives, and a positive without negatives, gives no row. An empty table gives no rows."""
    spark = rows.sparkSession
    q = quantised(rows, scale).dropDuplicates(["vec_id", "label", "q"])
    kept = written(representatives(q, max(positives + 1, negatives)), "hn-rows")
    chosen = written(q.where(anchors), "hn-anchors")
    classes = written(chosen.groupBy("label", "q").agg(F.count("*").alias("n_anchors")).withColumn("class", F.monotonically_increasing_id()), "hn-classes")
    square = F.aggregate("q", F.lit(0).cast("long"), lambda a, v: a + v.cast("long") * v)
    longest = kept.agg(F.max(square)).first()[0] or 0
    near, hard = [], []
    for start, end in chunks(classes, chunk):
        part = classes.where((F.col("class") >= start) & (F.col("class") < end)).collect()
        bound = [math.isqrt(longest * sum(v * v for v in c["q"])) + 1 for c in part]
        everything = [{"class": c["class"], "slot": 0, "lo": -b, "hi": b} for c, b in zip(part, bound, strict=True)]
        first = written(select_first(kept, part, everything, True, positives + 1), "hn-positives")
        near.append(first)
        score = F.col("score")
        below = first.select("class", "score").distinct().select("class", score.alias("slot"), floor_div(score * low + 99, 100).alias("lo"), floor_div(score * high, 100).alias("hi"))
        windows = [r.asDict() for r in below.where("lo <= hi").collect()]
        if windows:
            hard.append(written(select_first(kept, part, windows, False, negatives), "hn-negatives"))
    if not hard:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    by_rank = F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))))
    listed = reduce(DataFrame.unionAll, near).groupBy("class").agg(by_rank.alias("listed"))
    numbered = chosen.join(classes, ["label", "q"]).select(F.col("vec_id").alias("anchor_id"), "class", square.alias("own_score"))
    scored = F.transform("listed", lambda p: F.struct(p["positive_id"].alias("anchor_id"), p["positive_score"].alias("own_score")))
    itself = F.array_position(scored, F.struct("anchor_id", "own_score"))
    other = F.slice(F.filter("listed", lambda p, i: i != itself - 1), 1, positives)
    pairs = numbered.join(listed, "class").select("anchor_id", "class", F.explode(other).alias("p")).select("anchor_id", "class", "p.positive_id", "p.positive_score")
    found = reduce(DataFrame.unionAll, hard).select("class", F.col("slot").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(found, ["class", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
