"""Event streams: windowed counts with late data, and documents written once. An extension: the batch engine needs neither."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources.tables import read

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def windowed(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts and values by hour and type, for a stream or a table."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if events.isStreaming else e
    return e.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


@query("select date_trunc('hour', ts) as start, event_type, count(*) as n, sum(value::decimal(18,2))::decimal(18,2) as value from events group by 1, 2")
def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(read(spark, sf_dir, "events")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""with g as (select *, case when date_diff('second', lag(ts) over (partition by user_id order by ts, event_id), ts) <= 1800 then 0 else 1 end as fresh from events),
s as (select *, sum(fresh) over (partition by user_id order by ts, event_id rows unbounded preceding) as session from g)
select user_id, session::bigint as session, min(ts) as start, count(*) as n from s group by 1, 2""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lag("ts").over(w).cast("timestamp"))))
    rows = read(spark, sf_dir, "events").withColumn("fresh", F.when(gap <= 1800, 0).otherwise(1))
    rows = rows.withColumn("session", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("user_id", "session").agg(F.min("ts").alias("start"), F.count(F.lit(1)).alias("n"))


def write_once(stream: DataFrame, key: str, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d):
    """Writes rows of a stream whose key isn't in the output yet; a restarted run repeats none."""

    def save(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        rows = transform(batch.dropDuplicates([key]))
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
            done = spark.read.parquet(path).select(F.col(key).alias("done_key"))
            rows = rows.join(done, F.col(key) == F.col("done_key"), "left_anti")
        rows.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
