"""Save the results as Parquet and CSV."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from cardwarden.operators.ranking import first_rows
from cardwarden.policy import RiskPolicy
from cardwarden.sources.files import read_result
from cardwarden.sources.publishing import published

ENRICHED, SAMPLE = "enriched_transactions", "enriched_sample"


@dataclass(frozen=True)
class SinkStatus:
    sink: str
    file_format: str
    path: str
    rows: int | None = None
    error: str | None = None


class ExportError(RuntimeError):
    """Some sinks failed; ``statuses`` tells which, the others are complete."""

    def __init__(self, statuses: list[SinkStatus]):
        self.statuses = statuses
        failed = [f"{s.file_format} {s.sink}: {s.error}" for s in statuses if s.error]
        super().__init__("; ".join(failed))


def write_parquet(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace ``path`` when the new table is complete. A partitioned one is first rebalanced on its column.

    Rebalancing lets adaptive execution give a large partition value several writers and
    several small ones a common writer, so no value is bound to one task and no task
    writes many small files.
    """
    if partition_by is None:
        published(rows.sparkSession, path, rows.write.parquet)
    else:
        balanced = rows.hint("rebalance", partition_by)
        published(rows.sparkSession, path, balanced.write.partitionBy(partition_by).parquet)


def replace_partitions(rows: DataFrame, path: str, partition_by: str) -> None:
    """Replace those partitions of a partitioned table that the rows have a value of, and no other.

    Spark writes them aside and moves them when all are complete. A table that doesn't exist is
    made. Rows may come from the table itself.
    """
    balanced = rows.hint("rebalance", partition_by).write.mode("overwrite")
    balanced.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def csv_writer(rows: DataFrame) -> DataFrameWriter:
    """CSV with a header and with timestamps down to the microsecond, so none is cut off."""
    return rows.write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
    )


def write_csv(rows: DataFrame, path: str, single_file: bool) -> None:
    """Replace ``path`` when complete, with one file or with one per partition."""
    files = rows.coalesce(1) if single_file else rows
    published(rows.sparkSession, path, csv_writer(files).csv)


def export_all(
    results: dict[str, DataFrame],
    enriched: DataFrame,
    folder: str,
    policy: RiskPolicy = RiskPolicy(),
    partition_by: str | None = None,
    single_file: frozenset[str] = frozenset(),
) -> list[SinkStatus]:
    """Write each result and the enriched transactions, as Parquet and as CSV.

    Parquet comes first, and the CSV files are made from it, so every analysis runs once.
    A CSV has a file per partition, or one file, written by one task, for the results that
    ``single_file`` names. The CSV of the enriched transactions is a sample of the first ids
    in one file. A failing sink does not stop the others and leaves what an earlier run saved
    there; the error is raised at the end.
    """
    spark = enriched.sparkSession
    statuses: list[SinkStatus] = []

    def attempt(sink: str, file_format: str, path: str, write: Callable[[], int]) -> bool:
        try:
            statuses.append(SinkStatus(sink, file_format, path, rows=write()))
            return True
        except Exception as failure:  # noqa: BLE001 - a sink must not stop the others
            statuses.append(SinkStatus(sink, file_format, path, error=str(failure).split("\n")[0]))
            return False

    def parquet(path: str, rows: DataFrame, column: str | None) -> int:
        write_parquet(rows, path, column)
        return spark.read.parquet(path).count()

    def csv(path: str, rows: DataFrame, one_file: bool) -> int:
        write_csv(rows, path, one_file)
        return rows.count()

    def sample(path: str, rows: DataFrame) -> int:
        write_csv(first_rows(rows, "id", policy.sample_rows), path, single_file=True)
        return min(rows.count(), policy.sample_rows)

    saved: dict[str, DataFrame] = {}
    for name, rows in [*results.items(), (ENRICHED, enriched)]:
        path = f"{folder}/parquet/{name}"
        column = partition_by if name == ENRICHED else None
        done = attempt(name, "parquet", path, lambda: parquet(path, rows, column))
        saved[name] = read_result(spark, folder, name) if done else rows

    enriched = saved.pop(ENRICHED)
    for name, rows in saved.items():
        path = f"{folder}/csv/{name}"
        attempt(name, "csv", path, lambda: csv(path, rows, name in single_file))
    path = f"{folder}/csv/{SAMPLE}"
    attempt(SAMPLE, "csv", path, lambda: sample(path, enriched))

    if any(s.error for s in statuses):
        raise ExportError(statuses)
    return statuses


def statuses_frame(spark: SparkSession, statuses: list[SinkStatus]) -> DataFrame:
    """The statuses as rows: what was saved where, and what failed why."""
    columns = "sink string, file_format string, path string, rows bigint, error string"
    return spark.createDataFrame([tuple(vars(s).values()) for s in statuses], columns)


def read_results(spark, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """The saved Parquet results by name."""
    return {name: read_result(spark, folder, name) for name in names}


def row_counts(saved: dict[str, DataFrame]) -> DataFrame:
    """One row per saved result with its number of rows."""
    counted = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("sink"), "row_count")
        for name, rows in saved.items()
    ]
    union = counted[0]
    for one in counted[1:]:
        union = union.unionByName(one)
    return union
