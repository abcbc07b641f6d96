"""What every query needs of a session."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, whatever their Python path; once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tickloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="tickloom-")) / "tickloom.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(to))
    context._tickloom_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that the cluster names in ``spark.checkpoint.dir``.

    A session on one machine (tests) without one gets a temporary folder; on a cluster, where other machines could not
    read that, the setting is required.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[[^\]]*\])?$", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tickloom-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of the shared folder.

    For loops: a checkpoint hands on what is known of its columns, and joins and windows of many rounds make that grow
    without end; a table starts afresh.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
