"""Intermediate tables that every executor can reach and that outlive any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.sources.shared import shared_folder


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``.

    Where that is unset in a local session, as in tests, it lies in Spark's warehouse folder; on
    a cluster a missing setting is an error. The caller may delete what is there once the
    results have been written.
    """
    return shared_folder(spark, label)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read from there.

    This cuts the lineage, so that a lost executor costs no more than its running tasks, and
    gives Spark the measured size: a later join broadcasts the table only if that is small.
    """
    path = work_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table.work_path = path
    return table


def drop(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` whose last reader has been written."""
    for table in tables:
        place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.work_path)
        place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
