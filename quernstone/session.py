"""Session settings and table loading."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def get_session(app: str = "quernstone", cpus: str | None = None, **conf: str) -> SparkSession:
    """A session for local work; on a cluster the caller's own session is used instead."""
    builder = SparkSession.builder.appName(app)
    if "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cpus or '*'}]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        **({} if "SPARK_MASTER" in os.environ else {"spark.sql.shuffle.partitions": "8"}),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; only local sessions may leave it unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="quernstone-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data directory, by whatever file system Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
