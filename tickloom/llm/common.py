"""Small helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickloom.session import cut_lineage, shared_folder, ship

__all__ = ["cut_lineage", "prepare", "small", "table", "written"]

#: Rows of a batch between the JVM and Python: few, as texts can be long.
ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """Ship the package, and keep batches small where the session has Spark's own setting."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; read by Spark, so any store will do."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Like ``cut_lineage`` for wide or long tables: compressed Parquet in the same shared folder."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few texts at a time become Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
