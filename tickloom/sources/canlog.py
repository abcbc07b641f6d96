"""Bus captures as JSON lines: ``{"v": 1, "t_ns": ..., "id": ..., "data": "16 hex digits"}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import codec
from tickloom.operators.ordered import running
from tickloom.schema import CANLOG, PVT_SCHEMA_VERSION
from tickloom.session import cut_lineage

VERSION = 1


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, line, seq`` of every line of text files of any size, blank ones too.

    ``line`` counts from 1 in a file; ``seq`` from 1 over all files, in the order of their names.  Files are read in byte
    ranges as Spark cuts them.  A line's place in its range is its place in the scan; the lines of all ranges, one row for
    each, are added up in order of file and range.
    """
    scan = spark.read.option("lineSep", "\n").text(path)
    lines = scan.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    ranges = cut_lineage(lines.groupBy("file", "start").agg(F.min("at").alias("from"), F.count("*").alias("n")))
    totals = running(ranges, ["file", "start"], {"before": F.col("n")})
    of_file = totals.groupBy("file").agg(F.min("before").alias("of_file"))
    places = totals.join(of_file, "file").select("file", "start", "from", "before", "of_file")
    out = lines.join(places, ["file", "start"]).withColumn("seq", F.col("before") + F.col("at") - F.col("from") + 1)
    return out.select(F.regexp_replace("value", "\r$", "").alias("value"), "file", (F.col("seq") - F.col("of_file")).alias("line"), "seq")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``can_id, data, t_ns, seq`` of every record; blank lines are skipped, a missing version counts as 1.

    ``seq`` grows from line to line of a file, and from file to file in the order of their names; a capture is read by as
    many tasks as it has byte ranges.  Other versions, lines that are no objects, wrong data widths and non-hex data raise
    and name the file and the line.
    """
    # Blank lines go by explode, not by a filter, which might run after the checks.
    some = F.filter(F.array("value"), lambda x: F.trim(x) != "")
    lines = numbered_lines(spark, path).select("line", F.explode(some).alias("value"), "file", "seq")
    parsed = lines.withColumn("r", F.from_json("value", CANLOG, {"mode": "PERMISSIVE"}))
    bad = lambda why: F.raise_error(F.concat(F.lit(f"{why} in "), F.col("file"), F.lit(" line "), F.col("line"), F.lit(": "), F.col("value")))
    data = (
        F.when(~F.ltrim("value").startswith("{") | F.col("r").isNull() | F.col("r.id").isNull() | F.col("r.data").isNull(), bad("not a record"))
        .when(F.coalesce("r.v", F.lit(VERSION)) != VERSION, bad("unknown version"))
        .when(~F.col("r.data").rlike("^[0-9a-fA-F]{16}$"), bad("not 8 bytes of hex"))
        .otherwise(F.lower("r.data"))
    )
    return parsed.select(F.col("r.id").alias("can_id"), data.alias("data"), F.col("r.t_ns").alias("t_ns"), "seq")


def write(frames: DataFrame, path: str, mode: str = "append") -> None:
    """Frames (``can_id, data, t_ns``) as records; refuses frames that have not 8 bytes."""
    data = F.when(F.length("data") == 16, F.col("data")).otherwise(F.raise_error(F.lit("a frame has 8 bytes")))
    frames.select(F.to_json(F.struct(F.lit(VERSION).alias("v"), "t_ns", F.col("can_id").alias("id"), data.alias("data"))).alias("value")).write.mode(mode).text(path)


def replay(frames: DataFrame, start_ns: int, period_ns: int) -> DataFrame:
    """Frames in their order with fresh stamps; recorded ones are dropped."""
    return running(frames, ["seq"], {}).withColumn("t_ns", F.lit(start_ns).cast("long") + F.col("number") * period_ns).drop("number")


def samples(frames: DataFrame, episode_id: str, task: str | None = None, keep_bad_checksums: bool = False) -> tuple[DataFrame, DataFrame]:
    """Samples of an episode by the recorded stamps, and the counts of dropped frames by reason.

    With ``keep_bad_checksums`` frames with a wrong checksum stay if their angle is finite.
    """
    decoded = frames.withColumn("s", codec.decode(F.col("data"))).withColumn("angle", codec.angle_rad(F.col("s.millideg")))
    decoded = decoded.withColumn("reason", codec.reject_reason(F.lit(True) if keep_bad_checksums else F.col("s.valid"), F.col("angle")))
    kept = decoded.where("reason is null").select(
        F.coalesce("t_ns", F.lit(0)).alias("timestamp_ns"), F.lit(episode_id).alias("episode_id"), F.col("s.chain_index").alias("chain_index"), F.col("angle").alias("joint_angle"),
        *[F.lit(0.0).alias(c) for c in ("joint_velocity", "motor_current", "estimated_torque")], *[F.lit(None).cast("string").alias(c) for c in ("camera_frame_id", "tactile_event")], F.lit(task).cast("string").alias("task_label"), F.lit(PVT_SCHEMA_VERSION).alias("schema_version"), "seq",
    )
    return kept, decoded.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
