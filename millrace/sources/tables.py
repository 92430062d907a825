"""Tables as partitioned Parquet under one root; the only place that knows how a table is written."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import new_folder
from millrace.sources import files

LAYERS = ("landing", "bronze", "silver", "gold", "ops")


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, layer: str, table: str = "") -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{table}".rstrip("/")

    @property
    def landing(self) -> str:
        return self.path("landing")

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/ops/checkpoints/{name}"


def create_namespaces(spark: SparkSession, prefix: str = "") -> None:
    """The layers as catalog schemas, for sites that register the tables."""
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Columns added later read as NULL in older files."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def spread_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Even output files: partitions are rebalanced by value, and AQE splits an oversized one."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df.hint("rebalance")


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Writes whole partitions: those present in `df` are replaced, all others stay."""
    (spread_for_write(df, partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def replace_range(df: DataFrame, path: str, partition: str, touched: set[str]) -> None:
    """Like replace_partitions, and partitions of `touched` that ended up without rows are removed.

    A written partition has new files, so one whose file names did not change was not written.
    """
    spark = df.sparkSession

    def contents() -> dict[str, set[str]]:
        listed = {value: {f.rsplit("/", 1)[1] for f in files.list_files(spark, f"{path}/{partition}={value}/part-*")}
                  for value in touched}  # only the partitions at stake, however large the table
        return {value: names for value, names in listed.items() if names}

    before = contents()
    replace_partitions(df, path, [partition])
    after = contents()
    for value in touched & set(before):
        if before[value] == after.get(value):
            files.remove_folder(spark, f"{path}/{partition}={value}")


def append_run(df: DataFrame, path: str, run_column: str = "run_id") -> None:
    """Appends the rows of one run; a repeated run id replaces its own rows instead of doubling them."""
    replace_partitions(df, path, [run_column])


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def staged(df: DataFrame) -> DataFrame:
    """`df` written aside in the shared folder and read back, so that Spark knows its size."""
    path = new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_then_replace(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """For plans that read the table they replace: write aside first, then swap the partitions."""
    replace_partitions(staged(df), path, partition_by)
