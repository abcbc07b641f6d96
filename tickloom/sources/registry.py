"""What can be chosen by name: sources, detectors, exporters and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import codec
from tickloom.operators import events
from tickloom.registry import Registry
from tickloom.schema import CANLOG, EVENT_KINDS
from tickloom.sources import canlog, episodes
from tickloom.streaming import stateful


SOURCES = Registry("source", "tickloom.sources")
SOURCES.register("file", canlog.read)
SOURCES.register("rows", episodes.read_rows)
SOURCES.register("frames", episodes.read_frames)


@SOURCES.register("replay")
def replay(spark: SparkSession, path: str, start_ns: int = 1, period_ns: int = 10_000_000) -> DataFrame:
    return canlog.replay(canlog.read(spark, path), start_ns, period_ns)


@SOURCES.register("memory")
def memory(spark: SparkSession, frames: list[tuple[int, str]], start_ns: int = 1, period_ns: int = 10_000_000) -> DataFrame:
    """Given frames (id, 16 hex digits), stamped in their order; a small list, as it is part of the plan."""
    if not frames:
        raise ValueError("there are no frames to replay")
    rows = [(can_id, data, start_ns + i * period_ns, i) for i, (can_id, data) in enumerate(frames)]
    return spark.createDataFrame(rows, "can_id int, data string, t_ns long, seq long")


@SOURCES.register("stream")
def stream(spark: SparkSession, folder: str) -> DataFrame:
    """An unbounded read of bus captures as they arrive in a folder: ``can_id, data, t_ns, fault``.

    ``fault`` is null for a good frame, else ``not_a_record``, ``unknown_version``, ``not_8_bytes`` or
    ``checksum_invalid``; nothing is dropped, so ``fault_counts`` can count what a reader leaves out.
    """
    lines = spark.readStream.text(folder).where(F.trim("value") != "")
    r = lines.select(F.from_json("value", CANLOG, {"mode": "PERMISSIVE"}).alias("r"))
    whole = F.col("r.data").rlike("^[0-9a-fA-F]{16}$")
    fault = (
        F.when(F.col("r").isNull() | F.col("r.id").isNull() | F.col("r.data").isNull(), "not_a_record")
        .when(F.coalesce("r.v", F.lit(canlog.VERSION)) != canlog.VERSION, "unknown_version")
        .when(~whole, "not_8_bytes")
        .when(codec.checksum(F.col("r.data")) != codec.byte_at(F.col("r.data"), 7), "checksum_invalid")
    )
    return r.select(F.col("r.id").alias("can_id"), F.lower("r.data").alias("data"), F.col("r.t_ns").alias("t_ns"), fault.alias("fault"))


def fault_counts(frames: DataFrame) -> DataFrame:
    """``fault, n`` of a read with faults, good frames under null; for ``complete`` output if it is a stream."""
    return frames.groupBy("fault").agg(F.count("*").alias("n"))


#: ``samples -> event records``.
DETECTORS = Registry("detector", "tickloom.detectors")


@DETECTORS.register("noop")
def noop(samples: DataFrame) -> DataFrame:
    return events.no_events(samples)


@DETECTORS.register("threshold")
def threshold(samples: DataFrame, channel: str = "motor_current", threshold: float = 1.0, kind: str = "current_spike", confidence: float = 1.0) -> DataFrame:
    events.check_channel(channel)
    if kind not in EVENT_KINDS:
        raise ValueError(f"unknown event kind {kind!r}; there are {', '.join(EVENT_KINDS)}")
    found = events.detect_threshold(samples.withColumn("signed", F.col(channel)), channel, threshold, kind, ["signed"])
    return events.records(found, channel, "threshold", confidence, {"value": F.col("signed"), "threshold": F.lit(float(threshold))})


@DETECTORS.register("contact")
def contact(samples: DataFrame, channel: str = "tactile_event", onset: float = 0.5, release: float = 0.5, confidence: float = 1.0) -> DataFrame:
    """By tactile tokens, or by the absolute value of a channel of numbers."""
    level = events.tactile_level(F.col(channel)) if channel == "tactile_event" else F.abs(F.col(events.check_channel(channel)))
    found = events.detect_contact(samples, level, onset, release)
    return events.records(found, channel, "contact", confidence, {"level": F.col("level"), "onset_threshold": F.lit(float(onset)), "release_threshold": F.lit(float(release))})


@DETECTORS.register("impact")
def impact(samples: DataFrame, channel: str = "joint_velocity", jerk: float = 1.0, refractory_ns: int = 0, confidence: float = 1.0) -> DataFrame:
    found = events.detect_impact(samples, events.check_channel(channel), jerk, refractory_ns, signed=True)
    return events.records(found, channel, "impact", confidence, {"delta": F.col("delta"), "jerk_threshold": F.lit(float(jerk))})


#: ``(samples, folder, timing=None, budget=None) -> verdicts``.
EXPORTERS = Registry("exporter", "tickloom.exporters")
EXPORTERS.register("rows", episodes.export_rows)
EXPORTERS.register("frames", episodes.export_frames)

#: ``(samples, place, ...)``: where a stream or a table of samples ends up.
SINKS = Registry("sink", "tickloom.sinks")
SINKS.register("episodes", episodes.record)
SINKS.register("batches", stateful.record_batches)
SINKS.register("memory", stateful.collect_finite)
