"""Sinks: full-replace tables with a load timestamp, date-partitioned tables,
CSV samples and per-layer output namespaces."""

from __future__ import annotations

import uuid

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.session import scratch_dir

if TYPE_CHECKING:
    from gridmix.operators.quality import ObservedChecks

#: Spark's two ways to overwrite a partitioned table: all of it, or the partitions that get rows.
WHOLE, TOUCHED = "static", "dynamic"

LAYERS = ("raw", "staging", "intermediate", "marts")


def layer_path(root: str, layer: str, name: str) -> str:
    """``<root>/<layer>/<name>``: one namespace per layer."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def with_loaded_at(df: DataFrame, col: str = "_loaded_at") -> DataFrame:
    """Stamp every row with the load time (UTC, one value per query)."""
    return df.withColumn(col, F.current_timestamp())


def write_table(df: DataFrame, path: str, partition_by: str | list | None = None,
                loaded_at: bool = False, mode: str = "overwrite",
                checks: ObservedChecks | None = None) -> None:
    """Write ``df`` as Parquet and replace the whole table, whatever the session's
    overwrite mode: rows of partitions that ``df`` no longer has go too.

    ``checks`` are counted by the same job (``checks.counts`` afterwards).
    """
    if loaded_at:
        df = with_loaded_at(df)
    watch = checks.watch if checks is not None else (lambda frame: frame)
    if not partition_by:
        watch(df).write.mode(mode).parquet(path)
        return
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    # Cluster rows of one partition value into the same task: few files per date.
    (watch(df.repartition(*cols)).write.mode(mode).option("partitionOverwriteMode", WHOLE)
     .partitionBy(*cols).parquet(path))


def write_touched(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others as they are."""
    (df.repartition(partition_by).write.mode("overwrite").option("partitionOverwriteMode", TOUCHED)
     .partitionBy(partition_by).parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sample with a header row."""
    df.write.mode(mode).option("header", True).csv(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used for small intermediate tables that several models read (the daily
    rollup): it is computed once, its lineage is cut, and a lost executor only
    costs a re-read of the written files. Without a shared folder (a cluster
    whose ``spark.checkpoint.dir`` is unset) ``df`` is returned unchanged.
    """
    spark = df.sparkSession
    root = scratch_dir(spark)
    if root is None:
        return df
    path = f"{root.rstrip('/')}/gridmix-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or folder of ours through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory())


def finished(spark: SparkSession, path: str) -> bool:
    """True when the job that wrote ``path`` has committed it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Staging:
    """Tables written to the shared checkpoint folder and removed when the block ends.

    Staging cuts lineage: a lost executor costs a read of the files, and a job
    never reads and overwrites the same table in one step.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Staging:
        self.root = scratch_dir(self.spark)
        if self.root is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: slices are staged "
                               "there before the tables they change are overwritten")
        return self

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root.rstrip('/')}/gridmix-stage-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)
