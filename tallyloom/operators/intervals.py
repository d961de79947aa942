"""Joins of points and intervals with intervals, by equality.

An interval of whole numbers is the union of a few dyadic ranges, at most two of each width 2 ** k: those that a segment tree
takes. A point lies in one range of each width. So an interval holds a point if one of its ranges is one of the point's, and
exactly one is. Rows meet by key, width and range: a key that holds a third of all rows is dealt out over time, and an
interval over years is a few rows, not one for each day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.draws import below, draw_sql
from ..functions.money import exact, half_up
from ..registry import query
from ..sources.tables import read

#: Widths up to 2 ** 24 units: 45,000 years of days. Longer intervals are taken apart into ranges of that width.
WIDTHS = 24


def ranges(start: Column, end: Column, widths: int = WIDTHS) -> Column:
    """The dyadic ranges (k, at) that make up start <= x < end; none if the interval is empty."""

    def of(k: Column) -> Column:
        unit = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        low = -F.call_function("div", -start - F.pmod(-start, unit), unit)  # start / unit, up
        high = F.call_function("div", end - F.pmod(end, unit), unit)  # end / unit, down
        entry = lambda at: F.struct(k.alias("k"), at.alias("at"))
        two = F.array(F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), entry(low)), F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), entry(high - 1)))
        return F.when(k < widths, two).otherwise(F.when(low < high, F.transform(F.sequence(low, high - 1), entry)))

    top = F.least(F.lit(widths), widest(end - start))  # no range is longer than the interval
    each = F.flatten(F.transform(F.sequence(F.lit(0), top), lambda k: F.coalesce(of(k), F.array().cast("array<struct<k:int,at:bigint>>"))))
    return F.when(start < end, F.filter(each, lambda x: x.isNotNull())).otherwise(F.array().cast("array<struct<k:int,at:bigint>>"))


def widest(days: Column) -> Column:
    """The k of the widest dyadic range that fits into so many units; 0 if none does."""
    return F.length(F.bin(F.greatest(days, F.lit(1)).cast("long"))) - 1


def points_in(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, widths: int = WIDTHS) -> DataFrame:
    """Each row of points with each row of intervals of the same keys for which start <= at < end. at, start and end are
    dates or whole numbers. Column names of the two must differ but for the keys. Null keys, points and ends meet nothing."""
    whole = lambda df, c: (F.unix_date(c) if df.schema[c].dataType.simpleString() == "date" else F.col(c)).cast("long")
    first, last = whole(intervals, start), whole(intervals, end)
    held = intervals.withColumn("iv_range", F.explode(ranges(first, last, widths)))
    held = held.select([F.col(c).alias(f"iv_of_{c}") if c in keys else F.col(c) for c in intervals.columns] + [F.col("iv_range.k").alias("iv_k"), F.col("iv_range.at").alias("iv_at")])
    top = intervals.agg(F.least(F.lit(widths), F.max(widest(last - first))).alias("top"))  # one number
    point = whole(points, at)
    probes = points.filter(point.isNotNull()).select("*", F.explode(F.sequence(F.lit(0), F.coalesce(top.scalar(), F.lit(0)))).alias("iv_p"))
    same = [F.col(c) == F.col(f"iv_of_{c}") for c in keys] + [F.col("iv_p") == F.col("iv_k"), F.call_function("shiftright", point, F.col("iv_p")) == F.col("iv_at")]
    # Spark's estimate doesn't know how many rows a list of ranges gives: it would broadcast tables of any size.
    met = probes.join(held.hint("merge"), same)
    return met.select(*keys, *(c for c in points.columns if c not in keys), *(c for c in intervals.columns if c not in keys))


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], l_start: str, l_end: str, r_start: str, r_end: str) -> DataFrame:
    """Each pair of rows of the same keys whose intervals have a point in common. One of the two begins within the other: the
    right one within the left, or else the left one within the right and after its start, so that no pair comes twice."""
    proper = lambda df, a, b: df.filter(F.col(a) < F.col(b))
    left, right = proper(left, l_start, l_end), proper(right, r_start, r_end)
    begun = points_in(right, left, keys, r_start, l_start, l_end)
    later = points_in(left, right, keys, l_start, r_start, r_end).filter(F.col(l_start) > F.col(r_start))
    return begun.unionByName(later)


PERIODS = 3
PERIODS_SQL = f"""periods as (select c_custkey as p_key, n as period, (date '1995-01-01' + ({draw_sql("period-start", "c_custkey", "n")} % 2000)::integer)::date as opened,
  (date '1995-01-01' + ({draw_sql("period-start", "c_custkey", "n")} % 2000 + ([30, 90, 365])[n] + {draw_sql("period-days", "c_custkey", "n")} % 60)::integer)::date as closed from customer, (select unnest([1, 2, 3]) as n))"""


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement periods of each customer: about a month, a quarter and a year, which may overlap."""
    k, n = F.col("p_key"), F.col("period")
    rows = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("p_key"), F.explode(F.sequence(F.lit(1), F.lit(PERIODS))).alias("period"))
    start, days = below(2000, "period-start", k, n), F.get(F.array(F.lit(30), F.lit(90), F.lit(365)), n - 1) + below(60, "period-days", k, n)
    day = lambda x: F.date_add(F.lit("1995-01-01").cast("date"), x.cast("int"))
    return rows.select("p_key", "period", day(start).alias("opened"), day(start + days).alias("closed"))


@query(f"""with {PERIODS_SQL}, e as (select o_custkey, cast(o_orderdate as date) as on_day, round(cast(cast(o_totalprice as varchar) as decimal(24,6)), 2)::decimal(18,2) as amount from orders)
select p_key as ckey, period, opened, closed, count(o_custkey) as entries, coalesce(sum(amount), 0)::decimal(18,2) as invoiced, min(on_day) as first_on, max(on_day) as last_on
from periods left join e on o_custkey = p_key and on_day >= opened and on_day < closed group by 1, 2, 3, 4""")
def period_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was invoiced in each statement period of a table of periods, periods without entries included."""
    p = periods(spark, sf_dir)
    e = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("p_key"), F.to_date("o_orderdate").alias("at"), half_up(exact(F.col("o_totalprice"))).alias("amount"))
    sums = points_in(e, p, ["p_key"], "at", "opened", "closed").groupBy(F.col("p_key").alias("s_key"), F.col("period").alias("s_period")).agg(F.count(F.lit(1)).alias("entries"), F.sum("amount").cast("decimal(18,2)").alias("invoiced"), F.min("at").alias("first_on"), F.max("at").alias("last_on"))
    rows = p.join(sums, (F.col("p_key") == F.col("s_key")) & (F.col("period") == F.col("s_period")), "left")
    return rows.select(F.col("p_key").alias("ckey"), "period", "opened", "closed", F.coalesce("entries", F.lit(0)).cast("long").alias("entries"), F.coalesce("invoiced", F.lit(0)).cast("decimal(18,2)").alias("invoiced"), "first_on", "last_on")


@query(f"""with {PERIODS_SQL} select a.p_key as ckey, a.period as first_period, b.period as second_period, (least(a.closed, b.closed) - greatest(a.opened, b.opened))::integer as days
from periods a join periods b on a.p_key = b.p_key and a.period < b.period and a.opened < b.closed and b.opened < a.closed""")
def period_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement periods of one account that overlap, and by how many days."""
    p = periods(spark, sf_dir)
    names = {"period": "b_period", "opened": "b_opened", "closed": "b_closed"}
    pairs = overlaps(p, p.withColumnsRenamed(names), ["p_key"], "opened", "closed", "b_opened", "b_closed").filter("period < b_period")
    days = F.date_diff(F.least("closed", "b_closed"), F.greatest("opened", "b_opened"))
    return pairs.select(F.col("p_key").alias("ckey"), F.col("period").alias("first_period"), F.col("b_period").alias("second_period"), days.alias("days"))
