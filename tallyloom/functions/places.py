"""Places of rows in large groups: sums over bins first, so that no group has to be sorted by one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def placed(rows: DataFrame, group: list[str], bin_: Column, order: list[Column], name: str = "place") -> DataFrame:
    """rows with the place (from 1) of each within its group, in the order of bin_ and then of order. bin_ must not
    decrease along the order; the finer it is, the more tasks share a group. Only counts of bins meet in one place."""
    rows = rows.withColumn("pl_bin", bin_)
    counts = rows.groupBy(*group, "pl_bin").agg(F.count(F.lit(1)).alias("pl_n"))
    upto = Window.partitionBy(*group).orderBy(F.col("pl_bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("pl_before", F.coalesce(F.sum("pl_n").over(upto), F.lit(0))).drop("pl_n").withColumnsRenamed({c: f"pl_{c}" for c in group} | {"pl_bin": "pl_at"})
    inside = F.row_number().over(Window.partitionBy(*group, "pl_bin").orderBy(*order))
    rows = rows.withColumn("pl_inside", inside)
    same = [F.col(c).eqNullSafe(F.col(f"pl_{c}")) for c in group] + [F.col("pl_bin").eqNullSafe(F.col("pl_at"))]
    joined = rows.join(before, same)
    return joined.withColumn(name, F.col("pl_before") + F.col("pl_inside")).drop("pl_bin", "pl_at", "pl_before", "pl_inside", *(f"pl_{c}" for c in group))


def first_of(rows: DataFrame, group: list[str], bin_: Column, order: list[Column], most: str, name: str = "place") -> DataFrame:
    """The first rows of each group, as many as its column `most` says, with their place. bin_ as for placed().

    Bins are counted first. Only rows of bins that begin before the last place wanted move and are sorted: of other bins no
    row leaves its task. The bins that are needed are no more than the rows wanted, and so may be broadcast."""
    rows = rows.withColumn("pl_bin", bin_)
    counts = rows.groupBy(*group, "pl_bin").agg(F.count(F.lit(1)).alias("pl_n"), F.max(most).alias("pl_most"))
    upto = Window.partitionBy(*group).orderBy(F.col("pl_bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("pl_before", F.coalesce(F.sum("pl_n").over(upto), F.lit(0))).filter("pl_before < pl_most").drop("pl_n", "pl_most")
    needed = needed.withColumnsRenamed({c: f"pl_{c}" for c in group} | {"pl_bin": "pl_at"})
    same = [F.col(c).eqNullSafe(F.col(f"pl_{c}")) for c in group] + [F.col("pl_bin").eqNullSafe(F.col("pl_at"))]
    kept = rows.join(F.broadcast(needed), same)
    kept = kept.withColumn(name, F.col("pl_before") + F.row_number().over(Window.partitionBy(*group, "pl_bin").orderBy(*order)))
    return kept.filter(F.col(name) <= F.col(most)).drop("pl_bin", "pl_at", "pl_before", *(f"pl_{c}" for c in group))


def in_order(rows: DataFrame, order: list[str], value: str, written: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows with pos (from 0) in a total order of all rows, and before (the sum of `value` over the rows before).

    Rows are dealt by ranges of the order; counts and sums of these ranges are all that meets. `written` stores a table and
    reads it back, so that both passes see the same ranges."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("io_at", F.monotonically_increasing_id())
    dealt = written(dealt).withColumn("io_part", F.shiftright("io_at", 33))
    own = Window.partitionBy("io_part").orderBy("io_at")
    sums = dealt.groupBy(F.col("io_part").alias("io_of")).agg(F.count(F.lit(1)).alias("io_n"), F.sum(value).alias("io_sum"))  # a row for each range
    upto = Window.orderBy("io_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("io_of", F.coalesce(F.sum("io_n").over(upto), F.lit(0)).alias("io_rows"), F.coalesce(F.sum("io_sum").over(upto), F.lit(0)).alias("io_before"))
    dealt = dealt.join(F.broadcast(sums), F.col("io_part") == F.col("io_of"))
    pos, before = F.col("io_rows") + F.row_number().over(own) - 1, F.col("io_before") + F.sum(value).over(own) - F.col(value)
    return dealt.select(*rows.columns, pos.alias("pos"), before.alias("before"))
