"""Lines and orders that lie ready by order: the same rows as the plain views, and no shuffle where an order's rows meet."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import columns, documents, required
from tallyloom.sources.tables import by_order, numbered, order_headers, priced_lines, read

SF = "/root/testdata/sf0.001"


def planned(df):
    """The plan before any stage has run."""
    plan = df._jdf.queryExecution().executedPlan()
    return plan.initialPlan() if "Adaptive" in plan.getClass().getName() else plan


def scans(df, name):
    return planned(df).toString().count(f"/{name}.parquet")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The smallest tables, some lines with parts and orders with customers that don't exist."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for f in os.listdir(SF):
        if f not in ("lineitem.parquet", "orders.parquet"):
            shutil.copy(f"{SF}/{f}", folder)
    read(spark, SF, "lineitem").withColumn("l_partkey", F.when(F.col("l_orderkey") % 5 == 1, F.col("l_partkey") + 10**9 * (F.col("l_linenumber") % 2)).otherwise(F.col("l_partkey"))).write.parquet(f"{folder}/lineitem.parquet")
    read(spark, SF, "orders").withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 == 1, -1).otherwise(F.col("o_custkey"))).write.parquet(f"{folder}/orders.parquet")
    return folder


def test_views_are_the_same(spark, tables):
    ready = by_order(spark, tables)
    for view in (lambda d: numbered(priced_lines(spark, d)), lambda d: order_headers(spark, d), lambda d: documents.shipped(spark, d), lambda d: documents.purchase_status(spark, d)):
        want, got = view(tables), view(ready)
        assert sorted(got.columns) == sorted(want.columns)
        got = got.select(want.columns)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_facts_of_orders_lie_with_their_order(spark):
    ready = by_order(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = planned(required.facts_of_orders(spark, ready))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(okey" in plan.outputPartitioning().toString()
    assert "Exchange hashpartitioning" not in plan.toString()


@pytest.mark.parametrize("query", [columns.printed_cells, required.required_all, required.check_documents])
def test_lines_are_read_and_joined_once(spark, query):
    assert scans(query(spark, SF), "lineitem") == 0


def test_buckets_grow_with_the_lines(spark, monkeypatch):
    """A task sorts the strings of a bucket, so a bucket's lines are bounded; facts still lie with their order."""
    monkeypatch.setattr("tallyloom.sources.tables.LINES_A_BUCKET", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ready = by_order(spark, SF)
        n = -(-read(spark, SF, "lineitem").count() // 500)
        assert n > 8 and ready.lines.rdd.getNumPartitions() == ready.orders.rdd.getNumPartitions() == n
        assert max(ready.lines.select("okey").rdd.glom().map(len).collect()) < 1000
        assert "Exchange hashpartitioning" not in planned(required.facts_of_orders(spark, ready)).toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
