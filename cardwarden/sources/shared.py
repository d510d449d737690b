"""Working folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``.

    Only a local session without that setting uses Spark's warehouse folder; on a cluster a
    missing setting is an error. The folders are the caller's to delete.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/cardwarden/{label}-{uuid.uuid4().hex}"


def shared_table(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    This cuts the lineage in a way that survives lost executors, and gives Spark the true
    size of the result: a later join broadcasts it only when that size is small enough.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, label)
    rows.write.parquet(path)
    return spark.read.parquet(path)
