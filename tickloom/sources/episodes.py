"""Episode datasets: gated writing, quarantine, manifests and reading back.

A dataset is a folder with ``data`` (Parquet) and JSON tables for what was refused and for timing.  What is written
together is one commit (``sources.commits``): readers see data, quarantine and timing of finished commits only.  Names and
values that belong to the data lie in the footers of its files.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import frames, quality
from tickloom.operators.ordered import running
from tickloom.schema import POD_STATE, PVT_SCHEMA_VERSION, SAMPLE_COLUMNS
from tickloom.session import cut_lineage
from tickloom.sources import commits
from tickloom.sources.commits import Commit, commit

FRAME_DATASET_VERSION, DATASET_VERSION = 3, 1
#: Format of timing tables, and where every line says so (fixed values).
TIMING_VERSION, VERSION_KEY = 1, "timing_meta_version"


def current_rows(rows: DataFrame) -> DataFrame:
    """The columns of a sample, unknown ones dropped; raises for rows of a newer version."""
    version = F.coalesce("schema_version", F.lit(1))
    checked = F.when(version <= PVT_SCHEMA_VERSION, version).otherwise(F.raise_error(F.concat(F.lit("rows of version "), version, F.lit(" are newer than this reader"))))
    return rows.withColumn("schema_version", checked).select(*SAMPLE_COLUMNS, *[c for c in rows.columns if c == "seq"])


def migrated(rows: DataFrame, steps: dict[int, Callable[[DataFrame], DataFrame]], to: int = PVT_SCHEMA_VERSION) -> DataFrame:
    """Rows of all versions as rows of version ``to``; ``steps[v]`` makes rows of version v + 1 of those of version v.

    Rows without a version are of version 1; rows of newer versions than ``to`` raise.
    """
    missing = [v for v in range(1, to) if v not in steps]
    if missing:
        raise ValueError(f"there is no step from version {missing[0]}")
    version = F.coalesce("schema_version", F.lit(1))
    out = rows.withColumn("schema_version", F.when(version <= to, version).otherwise(F.raise_error(F.concat(F.lit("rows of version "), version, F.lit(" are newer than this reader")))))
    for v in range(1, to):
        old = steps[v](out.where(F.col("schema_version") == v)).withColumn("schema_version", F.lit(v + 1))
        out = out.where(F.col("schema_version") != v).unionByName(old)
    return out


def owned(samples: DataFrame, episode_id: str, task: str | None = None) -> DataFrame:
    """Samples with finite angles under this episode's id and task, whatever they carried."""
    return samples.where(quality.is_finite(F.col("joint_angle"))).withColumns({"episode_id": F.lit(episode_id), "task_label": F.lit(task).cast("string")})


#: Names under which rows bring the stamp of a state, first of all the own one (fixed values).
STAMP_NAMES = ["header_stamp_ns", "header_stamp"]


def states_of(rows: DataFrame, stamped: bool = False) -> DataFrame:
    """Rows of any types (text, say) as joint states; a value that is missing or of no such type raises.

    With ``stamped`` there is ``header_stamp_ns`` too: the first of ``STAMP_NAMES`` that a row has, or 0 where it has none;
    one that is no whole number raises.
    """
    typed = lambda name, kind: F.col(name).try_cast(kind)
    wrong = lambda name, kind: F.raise_error(F.concat(F.lit(f"no {kind} as {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("null"))))
    out = [F.coalesce(typed(name, kind), wrong(name, kind)).alias(name) for name, kind in POD_STATE.items()]
    if stamped:
        there = [F.when(F.col(c).isNotNull(), F.coalesce(typed(c, "long"), wrong(c, "long"))) for c in STAMP_NAMES if c in rows.columns]
        out.append(F.coalesce(*there, F.lit(0).cast("long")).alias(STAMP_NAMES[0]))
    return rows.select(*out)


#: The column of samples whose footer entry holds a dataset's names and values, and their key there.
CARRIER, ENTRY = "episode_id", "dataset"
#: Files of a timing table, so that equal tables are equal files.
TIMING_FILES = 16


def with_metadata(rows: DataFrame, values: dict[str, str] | None) -> DataFrame:
    """``rows`` with names and values that are written to the footer of every Parquet file, with the data."""
    if values is None:
        return rows
    if not values or any(not isinstance(x, str) for kv in values.items() for x in kv):
        raise ValueError("metadata are names and values of text")
    return rows.withMetadata(CARRIER, {**rows.schema[CARRIER].metadata, ENTRY: dict(sorted(values.items()))})


def metadata_of(rows: DataFrame) -> dict[str, str]:
    """What ``with_metadata`` gave these rows, or the rows that were written; empty if nothing."""
    return dict(rows.schema[CARRIER].metadata.get(ENTRY, {})) if CARRIER in rows.columns else {}


def _must_be_new(spark: SparkSession, folder: str) -> None:
    if not commits.manifests(spark, folder).isEmpty():
        raise FileExistsError(f"there is a dataset in {folder}")


def record(samples: DataFrame, folder: str, budget: quality.JitterBudget | None = None, strict: bool = False, mode: str = "errorifexists", metadata: dict[str, str] | None = None, name: str | None = None) -> DataFrame:
    """Write episodes that pass the recorder's gate to ``data`` and reasons for the others to ``quarantine``, as one commit.

    Returns the verdicts.  ``strict`` raises if any is refused, before anything is written.  ``mode``: ``errorifexists``
    for a new dataset, ``append`` for one more commit; ``overwrite`` replaces the commit ``name``.
    """
    if mode not in ("errorifexists", "append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = samples.sparkSession
    if mode == "errorifexists":
        _must_be_new(spark, folder)
    finite = samples.where(quality.is_finite(F.col("joint_angle")))
    verdicts = cut_lineage(quality.recorder_gate(finite, budget))
    if strict and not verdicts.where("not ok").isEmpty():
        raise ValueError("an episode was refused: " + json.dumps([r.asDict() for r in verdicts.where("not ok").limit(10).collect()], default=str))
    with commit(spark, folder, name if name or mode != "overwrite" else "all") as c:
        c.write("data", with_metadata(finite.join(verdicts.where("ok").select("episode_id"), "episode_id", "left_semi"), metadata))
        c.write("quarantine", verdicts.where("not ok"), "json")
    return verdicts


def _before_export(samples: DataFrame, folder: str, timing: DataFrame | None) -> None:
    _must_be_new(samples.sparkSession, folder)
    if timing is not None and not timing.select("episode_id").join(samples.select("episode_id"), "episode_id", "left_anti").isEmpty():
        raise ValueError("timing names an episode that is not exported")


def _timing(c: Commit, timing: DataFrame | None, exported: DataFrame) -> None:
    """Timing of exported episodes; the same rows give files of the same content, whatever the cluster."""
    if timing is not None:
        own = timing.join(exported.select("episode_id"), "episode_id", "left_semi")
        order = [x for x in ("episode_id", "modality") if x in own.columns]
        own = own.withColumn(VERSION_KEY, F.lit(TIMING_VERSION))
        c.write("timing", own.select(*sorted(own.columns)).repartition(TIMING_FILES, "episode_id").sortWithinPartitions(*order), "json")


def export_rows(samples: DataFrame, folder: str, timing: DataFrame | None = None, budget: quality.JitterBudget | None = None, metadata: dict[str, str] | None = None) -> DataFrame:
    """Rows with finite floats of accepted episodes, with a dense ``episode_index``; a ``rejected`` table always."""
    _before_export(samples, folder, timing)
    gate = cut_lineage(quality.export_gate(samples, budget))
    accepted = gate.where("ok").select("episode_id")
    order = samples.groupBy("episode_id").agg(F.min("seq").alias("order")).join(accepted, "episode_id")
    index = running(order, ["order"], {}).select("episode_id", F.col("number").alias("episode_index"))
    with commit(samples.sparkSession, folder) as c:
        c.write("data", with_metadata(samples.where(quality.finite_row()).join(index, "episode_id"), metadata))
        c.write("rejected", gate.where("not ok").select("episode_id", "reason"), "json")
        _timing(c, timing, accepted)
    return gate


def export_frames(samples: DataFrame, folder: str, timing: DataFrame | None = None, budget: quality.JitterBudget | None = None, metadata: dict[str, str] | None = None) -> DataFrame:
    """Frame dataset of accepted episodes: ``data`` with dense indices and arrays, and tables for episodes, tasks and info.

    Rows with non-finite floats go first; episodes that lose all rows are refused.
    """
    _before_export(samples, folder, timing)
    kept = samples.where(quality.finite_row())
    stats = cut_lineage(quality.jitter(quality.distinct_instants(kept), budget))
    gate = samples.select("episode_id").distinct().join(quality.judged_frames(stats, budget), "episode_id", "left")
    gate = gate.select("episode_id", F.coalesce("exported", F.lit(False)).alias("exported"), F.coalesce("quality_failed", F.lit(False)).alias("quality_failed"), F.when(F.col("exported").isNull(), "empty").otherwise(F.col("reason")).alias("reason"))
    gate = cut_lineage(gate)
    accepted = gate.where("exported").select("episode_id")
    good = kept.join(accepted, "episode_id", "left_semi")
    order = cut_lineage(good.groupBy("episode_id").agg(F.min("seq").alias("order"), F.min_by("task_label", "seq").alias("task_label"), F.min("timestamp_ns").alias("t0")))
    tasks = frames.task_index(order)
    rows = frames.dense_index(frames.pivot(good), order.select("episode_id", "order"))
    rows = rows.join(tasks, "episode_id").join(order.select("episode_id", "task_label", "t0"), "episode_id").withColumn("timestamp", (F.col("timestamp_ns") - F.col("t0")) / 1e9).drop("t0")
    stats = frames.infer_timing(stats.join(accepted, "episode_id", "left_semi"))
    counts = gate.agg(F.count("*").alias("input_episodes"), F.count_if(F.col("exported")).alias("total_episodes"), F.count_if(~F.col("exported")).alias("rejected_episodes"))
    with commit(samples.sparkSession, folder) as c:
        # Frames are made once; the other tables read what was written.
        made = c.write("data", with_metadata(rows, metadata))
        width = made.agg(F.count("*").alias("total_frames"), F.max(F.size("`observation.state`")).alias("dof"))
        c.write("episodes", made.groupBy("episode_id", "episode_index").agg(F.count("*").alias("n_frames")).join(gate, "episode_id"), "json")
        c.write("tasks", made.where("task_index >= 0").select("task_index", "task_label").distinct().orderBy("task_index"), "json")
        c.write("info", stats.join(counts).join(width).withColumn("version", F.lit(FRAME_DATASET_VERSION)), "json")
        _timing(c, timing, accepted)
    return gate


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of a dataset, rows of finished commits; a folder that was not written by commits is read as it is."""
    rows = commits.read(spark, folder, table)
    if rows is None:
        rows = spark.read.parquet(f"{folder}/{table}")
        if "commit" in rows.columns:
            raise FileNotFoundError(f"no commit of {folder} is finished")
    return rows


def read_rows(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "data")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a path with ``file_name`` and ``seq``: the rows in the order of the files' names, those of
    a file as they stand there.

    Names and places are hidden columns of the reader; rows are numbered by ranges, without a sort in one task.
    """
    rows = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    placed = rows.drop("seq").select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    return running(placed, ["file_name", "__path", "__row"], {}).drop("__path", "__row").withColumnRenamed("number", "seq")


def write_metadata(spark: SparkSession, folder: str, values: dict[str, str]) -> None:
    """Names and values of a dataset whose data have none, in the footer of a file without rows."""
    none = spark.createDataFrame([], f"{CARRIER} string")
    with_metadata(none, values).coalesce(1).write.mode("overwrite").parquet(f"{folder}/metadata")


def read_metadata(spark: SparkSession, folder: str) -> dict[str, str]:
    """Names and values from the footers: those of the data of the last finished commit, else what ``write_metadata``
    wrote; empty if there are none."""
    last = commits.manifests(spark, folder).where("table = 'data'").agg(F.max("commit")).first()[0]
    found = metadata_of(spark.read.parquet(f"{folder}/data/commit={last}")) if last else {}
    if not found and commits.exists(spark, f"{folder}/metadata"):
        found = metadata_of(spark.read.parquet(f"{folder}/metadata"))
    return found


def read_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of a frame dataset; older ones without chain arrays count joints by position."""
    df = read_table(spark, folder, "data")
    if "observation.chain_index" not in df.columns:
        df = df.withColumn("observation.chain_index", F.lit(None).cast("array<long>"))
    return frames.unnest(df)


def read_timing(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """Timing of a dataset, None if it has none; keys that the schema has not, broken lines, lines without a version and
    versions that this reader does not know raise."""
    from pyspark.sql.types import StructType

    lines = commits.read(spark, folder, "timing", lines=True)
    if lines is None:
        return None
    known = F.array(*[F.lit(c) for c in [*StructType.fromDDL(schema).fieldNames(), VERSION_KEY]])
    version = F.get_json_object("value", f"$.{VERSION_KEY}")
    wrong = lambda why: F.raise_error(F.concat(F.lit(f"{why} in timing: "), F.col("value")))
    strict = F.when(F.json_object_keys("value").isNull(), F.col("value")).when(F.size(F.array_except(F.json_object_keys("value"), known)) > 0, wrong("unknown key")).when(~version.eqNullSafe(F.lit(str(TIMING_VERSION))), wrong("missing or unknown version")).otherwise(F.col("value"))
    return lines.select(F.from_json(strict, schema, {"mode": "FAILFAST"}).alias("t")).select("t.*")
