"""Datasets and captures written from the given events and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import codec
from tickloom.operators import meta, quality
from tickloom.plans import base, sql
from tickloom.plans.base import HOUR
from tickloom.session import shared_folder
from tickloom.sources import canlog, commits, episodes, roundtrip

BUDGET = quality.JitterBudget(p99_ns=48 * HOUR, gap_factor=6.0, min_samples=3)
PERIOD = 10_000_000


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/dataset-{uuid.uuid4().hex}"


def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row dataset as it is read back: size and place of every accepted episode, and why the others were refused."""
    folder = _folder(spark)
    episodes.export_rows(base.full_samples(spark, sf_dir), folder, budget=BUDGET, metadata={"robot": "arm"})
    data, rejected = episodes.read_rows(spark, folder), commits.read(spark, folder, "rejected")
    robot = F.lit(episodes.read_metadata(spark, folder).get("robot"))
    kept = data.groupBy("episode_id", "episode_index").agg(F.count("*").alias("n"), F.min("timestamp_ns").alias("first_ns"), F.sum("joint_velocity").alias("velocity"), F.lit(None).cast("string").alias("reason"))
    none = lambda kind: F.lit(None).cast(kind)
    refused = rejected.select("episode_id", none("long").alias("episode_index"), F.lit(0).cast("long").alias("n"), none("long").alias("first_ns"), none("double").alias("velocity"), "reason")
    return kept.unionByName(refused).withColumn("velocity", F.round("velocity", 6)).withColumn("robot", robot)


def dataset_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a recorder wrote in one commit: rows of good episodes, reasons for the others."""
    folder = _folder(spark)
    episodes.record(base.burst(spark, sf_dir).withColumn("joint_angle", F.when(F.col("seq") % 97 == 0, float("nan")).otherwise(F.col("value"))), folder, BUDGET)
    n = episodes.read_rows(spark, folder).groupBy("episode_id").agg(F.count("*").alias("n"), F.lit("").alias("reasons"))
    return n.unionByName(commits.read(spark, folder, "quarantine").select("episode_id", F.lit(0).cast("long").alias("n"), F.concat_ws(",", "reasons").alias("reasons")))


def _frames(spark: SparkSession, sf_dir: str) -> str:
    """A frame dataset with timing of its episodes."""
    folder, s = _folder(spark), base.by_day(spark, sf_dir)
    timing = s.groupBy("episode_id").agg(F.count("*").alias("clean"), F.lit(0).cast("long").alias("flagged"))
    episodes.export_frames(s, folder, timing, BUDGET)
    return folder


def dataset_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of a frame dataset as they are read back."""
    rows = episodes.read_frames(spark, _frames(spark, sf_dir))
    return rows.select("episode_id", "timestamp_ns", "pos", "chain_index", "joint_angle", "estimated_torque")


def dataset_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a frame dataset, and those of its episodes, tasks and timing tables."""
    folder = _frames(spark, sf_dir)
    info = commits.read(spark, folder, "info").select("input_episodes", "total_episodes", "rejected_episodes", "total_frames", "version")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    timing = episodes.read_timing(spark, folder, "episode_id long, clean long, flagged long")
    tables = [count(commits.read(spark, folder, "episodes"), "episodes"), count(commits.read(spark, folder, "tasks"), "tasks"), timing.agg(F.count("*").alias("timed"), F.coalesce(F.sum("clean"), F.lit(0)).alias("timed_records"))]
    for t in tables:  # one row each
        info = info.join(t)
    return info


def _capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture of all events in order of arrival, written and read; every 13th frame has a wrong checksum."""
    s = base.samples(spark, sf_dir)
    data = codec.encode((F.col("seq") % 65536).cast("int"), (F.col("seq") % 60000 - 30000).cast("int"), (F.col("episode_id") % 256).cast("int"), F.col("chain_index"), (F.col("seq") % 64).cast("int"))
    broken = F.concat(F.substring(data, 1, 14), F.lpad(F.lower(F.hex((codec.byte_at(data, 7).bitwiseXOR(255)).cast("long"))), 2, "0"))
    frames = s.select("seq", codec.can_id((F.col("episode_id") % 256).cast("int")).alias("can_id"), F.when(F.col("seq") % 13 == 0, broken).otherwise(data).alias("data"), F.col("timestamp_ns").alias("t_ns"))
    folder = _folder(spark)
    canlog.write(frames.repartitionByRange("seq").sortWithinPartitions("seq"), folder)
    return canlog.read(spark, folder)


def capture_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of a capture that is replayed with fresh stamps."""
    kept, _ = canlog.samples(canlog.replay(_capture(spark, sf_dir), 1, PERIOD), "replayed", "all")
    return kept.select("episode_id", "task_label", "seq", "timestamp_ns", "chain_index", "joint_angle", "schema_version")


def capture_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of a capture that give no sample, by reason."""
    return canlog.samples(_capture(spark, sf_dir), "recorded")[1]


def states_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint states whose fields all came as text."""
    state = _capture(spark, sf_dir).select(codec.decode(F.col("data")).alias("s"), "seq").select("s.*", "seq")
    fields = {"node_id": "node_id", "chain_index": "chain_index", "angle_raw_adc": "raw_adc", "angle_millideg": "millideg", "status_flags": "status_flags", "checksum_valid": "valid"}
    text = state.select(*[F.col(x).cast("string").alias(k) for k, x in fields.items()], codec.angle_rad(F.col("millideg")).cast("string").alias("angle_rad"), F.lit("1").alias("schema_version"))
    return episodes.states_of(text).groupBy("chain_index", "checksum_valid", "schema_version").agg(F.count("*").alias("n"), F.sum("angle_millideg").alias("millideg"), F.max("angle_rad").alias("most_rad"), F.sum("status_flags").alias("flags"), F.sum("node_id").alias("nodes"), F.max("angle_raw_adc").alias("most_raw"))


def rows_migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three versions, some without one, as rows of the last."""
    s = base.samples(spark, sf_dir).select("seq", "value", F.when(F.col("seq") % 4 > 0, (F.col("seq") % 4).cast("int")).alias("schema_version"))
    steps = {1: lambda df: df.withColumn("value", F.col("value") * 2), 2: lambda df: df.withColumn("value", F.col("value") + 1)}
    return episodes.migrated(s, steps, 3)


def timing_of_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which episodes of a frame dataset have timing, and the ids with timing that no episode has (none)."""
    folder = _frames(spark, sf_dir)
    timing = episodes.read_timing(spark, folder, "episode_id long, clean long, flagged long")
    exported = episodes.read_rows(spark, folder).select("episode_id").distinct()
    own, unknown = meta.select_timing(timing, exported, exported)
    return own.withColumn("known", F.lit(True)).unionByName(unknown.select("episode_id", F.lit(0).cast("long").alias("clean"), F.lit(0).cast("long").alias("flagged"), F.lit(False).alias("known")))


def dataset_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of dataset, written with timing and read back."""
    s = base.by_day(spark, sf_dir)
    timing = s.groupBy("episode_id").agg(F.count("*").alias("clean"), F.max("timestamp_ns").alias("last_ns"))
    return roundtrip.round_trips(s, timing, _folder(spark), BUDGET)


_GATE = f"""ok AS (SELECT * FROM fs WHERE isfinite(joint_angle) AND isfinite(joint_velocity) AND isfinite(motor_current) AND isfinite(estimated_torque)),
di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM ok GROUP BY 1, 2), {sql.jitter('di', 6.0)},
r AS (SELECT a.episode_id, a.first, CASE WHEN n_samples IS NULL THEN 'empty' WHEN backwards > 0 THEN 'backwards' WHEN dropouts > 0 THEN 'dropouts' END AS reason FROM (SELECT episode_id, min(seq) AS first FROM fs GROUP BY 1) a LEFT JOIN jit ON a.episode_id = jit.episode_id),
p AS (SELECT episode_id, row_number() OVER (ORDER BY first) - 1 AS episode_index FROM r WHERE reason IS NULL)"""
_FRAMES = f"""di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM bd GROUP BY 1, 2), {sql.jitter('di', 6.0)}, good AS (SELECT episode_id FROM jit WHERE backwards = 0 AND dropouts = 0)"""
_BYTES = "b1 AS (SELECT *, row_number() OVER (ORDER BY seq) AS line, seq % 60000 - 30000 AS deg, (seq % 60000 - 30000) * (pi() / 180.0::DOUBLE / 1000.0::DOUBLE) AS rad FROM ev)"

QUERIES = {f.__name__: f for f in (dataset_rows, dataset_round_trips, dataset_recorded, dataset_frames, dataset_info, timing_of_dataset, capture_samples, capture_drops, states_from_text, rows_migrated)}
SQL = {
    "dataset_round_trips": f"WITH {base.BY_DAY}, {_FRAMES} SELECT kind, (SELECT count(*) FROM good) AS episodes, true AS samples_survive, true AS timing_survives FROM (VALUES ('rows'), ('frames')) k(kind)",
    "dataset_rows": f"""WITH {base.FULL}, {_GATE} SELECT ok.episode_id, episode_index, count(*) AS n, min(timestamp_ns) AS first_ns, round(sum(joint_velocity), 6) AS velocity, NULL::VARCHAR AS reason, 'arm' AS robot FROM ok JOIN p ON p.episode_id = ok.episode_id GROUP BY 1, 2
UNION ALL SELECT episode_id, NULL, 0, NULL, NULL, reason, 'arm' FROM r WHERE reason IS NOT NULL""",
    "dataset_recorded": f"""WITH {base.BURST}, fin AS (SELECT * FROM bu WHERE seq % 97 <> 0), {sql.jitter('fin', 6.0)}
SELECT episode_id, CASE WHEN reasons = '' THEN n_samples ELSE 0 END AS n, reasons FROM (SELECT *, concat_ws(',', CASE WHEN n_samples < 3 THEN 'too_few_samples:' || n_samples END, CASE WHEN backwards > 0 THEN 'backwards:' || backwards END, CASE WHEN dropouts > 0 THEN 'dropouts:' || dropouts END,
    CASE WHEN p99_jitter_ns > {48 * HOUR} THEN 'p99_jitter_ns:' || p99_jitter_ns END) AS reasons FROM jit)""",
    "dataset_frames": f"""WITH {base.BY_DAY}, {_FRAMES} SELECT bd.episode_id, timestamp_ns, CAST(row_number() OVER (PARTITION BY bd.episode_id, timestamp_ns ORDER BY chain_index, seq) - 1 AS INTEGER) AS pos, chain_index::BIGINT AS chain_index, joint_angle, estimated_torque FROM bd JOIN good ON good.episode_id = bd.episode_id""",
    "dataset_info": f"""WITH {base.BY_DAY}, {_FRAMES}, own AS (SELECT bd.* FROM bd JOIN good ON good.episode_id = bd.episode_id), e AS (SELECT episode_id, min_by(task_label, seq) AS task FROM own GROUP BY 1)
SELECT (SELECT count(DISTINCT episode_id) FROM bd) AS input_episodes, (SELECT count(*) FROM good) AS total_episodes, (SELECT count(DISTINCT episode_id) FROM bd) - (SELECT count(*) FROM good) AS rejected_episodes, (SELECT count(*) FROM (SELECT DISTINCT episode_id, timestamp_ns FROM own)) AS total_frames, {episodes.FRAME_DATASET_VERSION}::BIGINT AS version,
    (SELECT count(*) FROM good) AS episodes, (SELECT count(DISTINCT task) FROM e WHERE task <> '') AS tasks, (SELECT count(*) FROM good) AS timed, (SELECT count(*) FROM own) AS timed_records""",
    "timing_of_dataset": f"WITH {base.BY_DAY}, {_FRAMES} SELECT bd.episode_id, count(*) AS clean, 0::BIGINT AS flagged, true AS known FROM bd JOIN good ON good.episode_id = bd.episode_id GROUP BY 1",
    "capture_samples": f"WITH {base.SAMPLES}, {_BYTES} SELECT 'replayed' AS episode_id, 'all' AS task_label, line AS seq, 1 + (line - 1) * {PERIOD} AS timestamp_ns, chain_index, rad AS joint_angle, 1 AS schema_version FROM b1 WHERE seq % 13 <> 0",
    "capture_drops": f"WITH {base.SAMPLES} SELECT 'checksum_invalid' AS reason, count(*) AS n FROM ev WHERE seq % 13 = 0 HAVING count(*) > 0",
    "states_from_text": f"WITH {base.SAMPLES}, {_BYTES} SELECT chain_index, seq % 13 <> 0 AS checksum_valid, 1 AS schema_version, count(*) AS n, CAST(sum(deg) AS BIGINT) AS millideg, max(rad) AS most_rad, CAST(sum(seq % 64) AS BIGINT) AS flags, CAST(sum(episode_id % 256) AS BIGINT) AS nodes, CAST(max(seq % 65536) AS INTEGER) AS most_raw FROM b1 GROUP BY 1, 2",
    "rows_migrated": f"WITH {base.SAMPLES} SELECT seq, CASE WHEN seq % 4 IN (0, 1) THEN value * 2 + 1 WHEN seq % 4 = 2 THEN value + 1 ELSE value END AS value, 3 AS schema_version FROM ev",
}
