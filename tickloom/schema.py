"""Row shapes and constants of the telemetry data model."""

from __future__ import annotations

from pyspark.sql import types as T

PVT_SCHEMA_VERSION = 1
MIN_STAMP_NS, MAX_STAMP_NS = 1, (1 << 63) - 1

#: One sample of one joint at one instant; ``seq`` is the order of arrival within the episode.
SAMPLE = T.StructType(
    [
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("episode_id", T.StringType()),
        T.StructField("chain_index", T.IntegerType()),
        T.StructField("joint_angle", T.DoubleType()),
        T.StructField("joint_velocity", T.DoubleType()),
        T.StructField("motor_current", T.DoubleType()),
        T.StructField("estimated_torque", T.DoubleType()),
        T.StructField("camera_frame_id", T.StringType()),
        T.StructField("tactile_event", T.StringType()),
        T.StructField("task_label", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
    ]
)
SAMPLE_COLUMNS = [f.name for f in SAMPLE]
FLOATS = ["joint_angle", "joint_velocity", "motor_current", "estimated_torque"]

#: A decoded joint state (fixed values).
POD_STATE = {"node_id": "int", "chain_index": "int", "angle_raw_adc": "int", "angle_millideg": "int", "angle_rad": "double", "status_flags": "int", "checksum_valid": "boolean", "schema_version": "int"}

CAN_FRAME = T.StructType([T.StructField("can_id", T.IntegerType()), T.StructField("data", T.StringType()), T.StructField("t_ns", T.LongType())])
CANLOG = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("t_ns", T.LongType()), T.StructField("id", T.IntegerType()), T.StructField("data", T.StringType())])

# Tokens (fixed values).
FLAGS = ["backwards_in_source", "unknown_skew", "skew_out_of_range"]
METHODS = ["exact", "nearest", "window"]
QUALITIES = ["matched", "out_of_budget", "no_target"]
VERDICTS = ["aligned_within_budget", "degraded", "quarantined"]
EVENT_KINDS = ["contact_start", "contact_release", "current_spike", "impact", "slip"]
TACTILE_TOKENS = ["contact_start", "slip", "impact", "release"]
#: Bits of the status byte of a frame, lowest first (fixed values).
STATUS_BITS = ["adc_fault", "spi_fault", "can_fault", "magnet_oob", "not_enumerated", "calib_invalid"]
