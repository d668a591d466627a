"""Helpers shared by the operators: column picking, shared scratch tables, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch. Long texts make wide rows; few rows keep a batch small.
ARROW_ROWS = 256


def configure(spark: SparkSession) -> None:
    """Session settings the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def place_of(df: DataFrame, name: str) -> int:
    """Place of a column, by exact name first and by any case else."""
    exact = [i for i, c in enumerate(df.columns) if c == name]
    loose = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not (exact or loose):
        raise ValueError(f"no column {name!r} in {df.columns}")
    return (exact or loose)[0]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, by exact name first and by any case else.

    Extra columns go, so they cannot clash with what an operator adds, not even
    columns whose names differ only in case.
    """
    where = [place_of(df, name) for name in names]
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[F.col(f"`{df.columns[i]}`").alias(n) for i, n in zip(where, names)])
    return numbered(df).select(*[F.col(f"c{i}").alias(n) for i, n in zip(where, names)])


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns called c0, c1, ...: whatever they were called, these clash with nothing.
    ``toDF(*df.columns)`` names them back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only in local mode without it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="gridmix-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, and
    a lost executor costs a read of the files, not the work before them."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, and where it was written."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file (a parameter of the operators)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver to be broadcast (its size is fixed, under 2 MB)."""
    with open(os.fspath(path), "rb") as f:
        return f.read()


def text_runs(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of an Arrow batch, cut where a run reaches ``most`` characters."""
    at, run, size = 0, [], 0
    for i, value in enumerate(batch.column(batch.schema.get_field_index(column))):
        text = value.as_py() or ""
        run.append(text)
        size += len(text)
        if size >= most:
            yield at, run
            at, run, size = i + 1, [], 0
    if run:
        yield at, run
