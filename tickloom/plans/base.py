"""The given tables in the shape of the telemetry model, in Spark and in SQL.

``events`` stands for recorded samples: a user is an episode, ``event_id`` the order of arrival and, modulo 3, the chain;
some event types carry a tactile token.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import shared_folder, ship

TOKENS = {"signup": "contact_start", "click": "slip", "error": "impact", "purchase": "release"}
HOUR = 3_600_000_000_000
#: Modalities of ``streams``.
MODALITIES = ["click", "view"]


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.expr(f"unix_date(cast({ts} as date)) * 86400000000 + hour({ts}) * 3600000000L + minute({ts}) * 60000000L + cast(extract(SECOND FROM {ts}) * 1000000 as bigint)")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return _as_samples(spark.read.parquet(f"{sf_dir}/events.parquet"))


def samples_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as an unbounded table."""
    ship(spark)
    path = f"{sf_dir}/events.parquet"
    given = spark.read.parquet(path)
    source = spark.readStream.schema(given.schema)
    one_file = any(f.endswith("/events.parquet") for f in given.inputFiles()[:1])
    return _as_samples(source.option("pathGlobFilter", "events.parquet").parquet(sf_dir) if one_file else source.parquet(path))


def stream_folder(spark: SparkSession) -> str:
    """A new folder for the rows and the state of a stream, where all executors write and read."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _as_samples(e: DataFrame) -> DataFrame:
    token = F.create_map(*[F.lit(x) for kv in TOKENS.items() for x in kv])
    return e.select(
        F.col("user_id").alias("episode_id"), F.col("event_id").alias("seq"), (F.col("event_id") % 3).cast("int").alias("chain_index"), (micros("ts") * 1000).alias("timestamp_ns"), "value", "event_type",
        F.try_element_at(token, F.col("event_type")).alias("tactile_event"),
    )


SAMPLES = """ev AS (
    SELECT user_id AS episode_id, event_id AS seq, CAST(event_id % 3 AS INTEGER) AS chain_index, epoch_us(ts) * 1000 AS timestamp_ns, value, event_type,
        CASE event_type WHEN 'signup' THEN 'contact_start' WHEN 'click' THEN 'slip' WHEN 'error' THEN 'impact' WHEN 'purchase' THEN 'release' END AS tactile_event
    FROM events
)"""


def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with ``idx``, their number within the episode from 0."""
    order = Window.partitionBy("episode_id").orderBy("seq")
    return samples(spark, sf_dir).withColumn("idx", (F.row_number().over(order) - 1).cast("long"))


STAMPS = SAMPLES + """, st AS (
    SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY seq) - 1 AS idx FROM ev
)"""


def full_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with all floats; some angles are not a number, some torques infinite."""
    s = samples(spark, sf_dir)
    return s.select(
        "episode_id", "seq", "chain_index", "timestamp_ns", F.when(F.col("seq") % 97 == 0, float("nan")).otherwise(F.col("value")).alias("joint_angle"), (F.col("value") / 2).alias("joint_velocity"), (F.col("value") / 4).alias("motor_current"),
        F.when(F.col("seq") % 89 == 0, float("inf")).otherwise(F.col("value") / 8).alias("estimated_torque"), F.lit(None).cast("string").alias("camera_frame_id"), "tactile_event", F.col("event_type").alias("task_label"),
    )


FULL = SAMPLES + """, fs AS (
    SELECT episode_id, seq, chain_index, timestamp_ns, CASE WHEN seq % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS joint_angle, value / 2 AS joint_velocity, value / 4 AS motor_current,
        CASE WHEN seq % 89 = 0 THEN 'Infinity'::DOUBLE ELSE value / 8 END AS estimated_torque, tactile_event, event_type AS task_label
    FROM ev
)"""


def by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean samples whose stamps are cut to days, so that instants have several rows."""
    day = 24 * HOUR
    s = samples(spark, sf_dir)
    return s.select(
        "episode_id", "seq", "chain_index", (F.col("timestamp_ns") - F.col("timestamp_ns") % day).alias("timestamp_ns"), F.col("value").alias("joint_angle"), (F.col("value") / 2).alias("joint_velocity"), (F.col("value") / 4).alias("motor_current"), (F.col("value") / 8).alias("estimated_torque"),
        F.when(F.col("seq") % 2 == 0, F.concat(F.lit("frame_"), F.col("seq"))).alias("camera_frame_id"), "tactile_event", F.col("event_type").alias("task_label"),
    )


BY_DAY = SAMPLES + """, bd AS (
    SELECT episode_id, seq, chain_index, timestamp_ns - timestamp_ns % 86400000000000 AS timestamp_ns, value AS joint_angle, value / 2 AS joint_velocity, value / 4 AS motor_current, value / 8 AS estimated_torque,
        CASE WHEN seq % 2 = 0 THEN 'frame_' || seq END AS camera_frame_id, tactile_event, event_type AS task_label
    FROM ev
)"""


def burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of which the 10th to 14th of each episode arrive five days late."""
    from tickloom.operators.faults import burst_delay

    return burst_delay(stamps(spark, sf_dir), 10, 5, 120 * HOUR)


BURST = STAMPS + """, bu AS (
    SELECT * REPLACE (CASE WHEN idx BETWEEN 10 AND 14 THEN timestamp_ns + 432000000000000 ELSE timestamp_ns END AS timestamp_ns) FROM st
)"""


def streams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Purchases as references, views and clicks as two target modalities."""
    s = samples(spark, sf_dir)
    refs = s.where("event_type = 'purchase'").select("episode_id", "seq", F.col("timestamp_ns").alias("ns"))
    targets = s.where("event_type in ('view', 'click')").select("episode_id", F.col("event_type").alias("modality"), "seq", F.col("timestamp_ns").alias("ns"), "value")
    return refs, targets


STREAMS = SAMPLES + """, refs AS (
    SELECT episode_id, seq, timestamp_ns AS ns FROM ev WHERE event_type = 'purchase'
), tgts AS (
    SELECT episode_id, event_type AS modality, seq, timestamp_ns AS ns, value FROM ev WHERE event_type IN ('view', 'click')
)"""


def lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples dealt to three chains in turn, each on a 10 ms lattice; only chain 1 carries tokens."""
    s = stamps(spark, sf_dir).withColumn("chain_index", (F.col("idx") % 3).cast("int"))
    s = s.withColumn("timestamp_ns", F.lit(1_000_000_000) + F.floor(F.col("idx") / 3) * 10_000_000)
    return s.withColumn("tactile_event", F.when(F.col("chain_index") == 1, F.coalesce("tactile_event", F.lit("slip"))))


LATTICE = STAMPS + """, la AS (
    SELECT episode_id, seq, CAST(idx % 3 AS INTEGER) AS chain_index, 1000000000 + idx // 3 * 10000000 AS timestamp_ns, value,
        CASE WHEN idx % 3 = 1 THEN coalesce(tactile_event, 'slip') END AS tactile_event
    FROM st
)"""

#: A script of phases: kind, start and duration in seconds.
PHASES = [(0, "approach", 0.0, 0.01), (1, "contact_start", 0.01, 0.01), (2, "slip", 0.02, 0.01), (3, "impact", 0.03, 0.01), (4, "release", 0.04, 0.02), (5, "settle", 0.06, 0.24)]


def phases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PHASES, "phase_ix int, kind string, start_s double, duration_s double")


PHASES_SQL = "ph(phase_ix, kind, start_s, duration_s) AS (VALUES " + ", ".join(f"({i}, '{k}', {a}::DOUBLE, {b}::DOUBLE)" for i, k, a, b in PHASES) + ")"
