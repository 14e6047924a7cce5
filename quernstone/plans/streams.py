"""Event-time windows over the events table as a bounded stream; as batches they give the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.plans.registry import query
from quernstone.session import load, shared_folder
from quernstone.streaming import contracts


@query("st_tumbling", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.tumbling(load(spark, sf, "events"))


@query("st_sliding", "SELECT start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS start FROM events) GROUP BY start")
def sliding(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.sliding(load(spark, sf, "events"))


@query(
    "st_sessions",
    """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, s
    """,
)
def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.sessions(load(spark, sf, "events"), "6 hours")


def _folder(spark: SparkSession) -> str:
    """A new folder for a table of a query, gone when the driver ends."""
    path = f"{shared_folder(spark)}/streams-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


@query("st_exactly_once_unit", "SELECT 'findings' AS what, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE user_id % 3 <> 2 UNION ALL SELECT 'log', count(DISTINCT user_id), count(DISTINCT user_id) FROM events WHERE user_id % 3 <> 2")
def units(spark: SparkSession, sf: str) -> DataFrame:
    """Findings and the log of who was read, told together: one unit comes twice, and one breaks off before it is done."""
    e = load(spark, sf, "events").select("event_id", "user_id")
    told = contracts.Units(spark, _folder(spark), {"findings": "event_id long, user_id long", "log": "user_id long"})
    for number in (0, 0, 1):
        mine = e.where(F.col("user_id") % 3 == number)
        told.commit(number, {"findings": mine, "log": mine.select("user_id").distinct()})
    e.where("user_id % 3 = 2").write.parquet(f"{told.path}/u2/findings")
    counts = [told.read(name).agg(F.lit(name).alias("what"), F.count("*").alias("n"), F.countDistinct("user_id").alias("users")) for name in ("findings", "log")]
    return counts[0].union(counts[1])


@query("st_idempotent_replay", "SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, date_trunc('hour', ts) FROM events) GROUP BY user_id")
def replay(spark: SparkSession, sf: str) -> DataFrame:
    """One batch given three times, twice under its own number: the table has every key once."""
    e = load(spark, sf, "events").select("user_id", F.date_trunc("hour", "ts").alias("h"), F.lit("seen").alias("state"))
    table = contracts.BucketedTable(spark, _folder(spark), "user_id long, h timestamp_ntz, state string", ["user_id", "h"], 8)
    apply = contracts.merging(table, ["user_id", "h"], {})
    for number in (0, 0, 1):
        apply(e, number)
    return table.read().groupBy("user_id").agg(F.count("*").alias("n"))


@query("st_shard", "SELECT user_id % 4 AS shard, count(*) AS n FROM events GROUP BY 1")
def shards(spark: SparkSession, sf: str) -> DataFrame:
    e, out = load(spark, sf, "events"), None
    for k in range(4):
        one = contracts.shard(e, "user_id", 4, k).agg(F.count("*").alias("n")).select(F.lit(k).cast("long").alias("shard"), "n")
        out = one if out is None else out.unionByName(one)
    return out
