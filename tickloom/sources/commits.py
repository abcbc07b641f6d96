"""Tables of a dataset that become visible together.

A commit writes each of its tables below ``<folder>/<table>/commit=<name>`` and, last of all, one manifest row for each
table, in one file, below ``<folder>/manifests/commit=<name>``.  A reader joins a table with the manifests, so it sees all
tables of a commit or none, whatever was written before a failure; the join prunes the folders of other commits.  A
commit of a given name can be repeated: it replaces what an attempt that failed has left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "table string, kind string, schema string"


class Commit:
    """Tables that are written so far; nothing is visible yet."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name, self.tables = spark, folder, name, {}

    def write(self, table: str, rows: DataFrame, kind: str = "parquet") -> DataFrame:
        """``rows`` as a table of this commit, in Parquet or as JSON lines; returned as they were written, for other tables of
        the commit."""
        if table in self.tables or table == "manifests":
            raise ValueError(f"a commit has one table called {table!r}")
        place = f"{self.folder}/{table}/commit={self.name}"
        rows.write.mode("overwrite").format(kind).save(place)
        self.tables[table] = (table, kind, rows.schema.json())
        return self.spark.read.schema(rows.schema).format(kind).load(place)

    def finish(self) -> None:
        self.spark.createDataFrame(sorted(self.tables.values()), MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifests/commit={self.name}")


@contextmanager
def commit(spark: SparkSession, folder: str, name: str | None = None) -> Iterator[Commit]:
    """A commit that is finished when the block ends, and never if it raises."""
    if name is not None and (not name or not name.replace("-", "").replace("_", "").isalnum()):
        raise ValueError(f"{name!r} cannot name a commit")
    c = Commit(spark, folder, f"c-{name}" if name else f"c-{uuid.uuid4().hex}")
    yield c
    c.finish()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path; told by the reader, so any store will do."""
    try:
        spark.read.text(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """``table, kind, schema, commit`` of all finished commits."""
    schema = f"{MANIFEST}, commit string"
    if not exists(spark, f"{folder}/manifests"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{folder}/manifests")


def finished(spark: SparkSession, folder: str, name: str) -> bool:
    """Whether the commit of this name is visible."""
    return not manifests(spark, folder).where(F.col("commit") == f"c-{name}").isEmpty()


def read(spark: SparkSession, folder: str, table: str, lines: bool = False) -> DataFrame | None:
    """The rows of a table in all finished commits, None if none has it; with ``lines`` as unparsed text.

    The columns are those of the commit with the last name.
    """
    own = manifests(spark, folder).where(F.col("table") == table)
    last = own.orderBy(F.desc("commit")).select("kind", "schema").first()
    if last is None:
        return None
    import json

    schema = StructType().add("value", "string") if lines else StructType.fromJson(json.loads(last["schema"]))
    rows = spark.read.schema(schema.add("commit", "string")).format("text" if lines else last["kind"]).load(f"{folder}/{table}")
    return rows.join(own.select("commit").distinct(), "commit", "left_semi").drop("commit")


def drop_unfinished(spark: SparkSession, folder: str, tables: list[str]) -> list[str]:
    """Remove what attempts that never finished have left; the names of those commits.  For quiet times: a commit that is
    being written is not finished yet."""
    done = {r["commit"] for r in manifests(spark, folder).select("commit").distinct().collect()}
    context, gone = spark.sparkContext, set()
    for table in tables:
        place = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}")
        files = place.getFileSystem(context._jsc.hadoopConfiguration())
        for status in files.listStatus(place) if files.exists(place) else []:
            name = status.getPath().getName().removeprefix("commit=")
            if name != status.getPath().getName() and name not in done:
                files.delete(status.getPath(), True)
                gone.add(name)
    return sorted(gone)
