"""Simulated recordings: trajectories, scripted contact scenarios, bus frames.

Everything is a closed form of a row number, so any part of a recording is computed on its own.  Noise comes from the
generator of Python's ``random`` module, one stream for each (channel, tick, joint), as recorded fixtures have it.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import codec
from tickloom.operators.faults import stream_seed

#: Scripts by name: kind, start and duration in seconds (fixed values).
SCENARIOS = {
    "pick_place": [("approach", 0.0, 0.5), ("contact_start", 0.5, 0.8), ("release", 1.3, 0.2), ("settle", 1.5, 0.3)],
    "slip_recovery": [("approach", 0.0, 0.4), ("contact_start", 0.4, 0.3), ("slip", 0.7, 0.15), ("impact", 0.85, 0.1), ("release", 0.95, 0.2), ("settle", 1.15, 0.25)],
}
CHANNELS = ["joint_angle", "joint_velocity", "motor_current", "estimated_torque"]


def lattice(spark: SparkSession, n: int, start_ns: int, period_ns: int) -> DataFrame:
    """``idx, timestamp_ns``: ``n`` stamps a period apart; raises beyond 64 bits."""
    return spark.range(n).select(F.col("id").alias("idx"), (F.lit(start_ns).cast("long") + F.col("id") * F.lit(period_ns).cast("long")).alias("timestamp_ns"))


def phase_offset(joint: Column, dof: int) -> Column:
    return 2.0 * math.pi * joint / dof


def sine(t: Column, joint: Column, dof: int, amplitude: float, hz: float) -> Column:
    return amplitude * F.sin(2.0 * math.pi * hz * t + phase_offset(joint, dof))


def ramp(t: Column, joint: Column, dof: int, amplitude: float, hz: float) -> Column:
    """Triangle between minus and plus the amplitude."""
    cycle = hz * t + phase_offset(joint, dof) / (2.0 * math.pi)
    return amplitude * (1.0 - 4.0 * F.abs(cycle - F.floor(cycle) - 0.5))


def hold(t: Column, joint: Column, dof: int, amplitude: float, hz: float) -> Column:
    return amplitude * F.sin(phase_offset(joint, dof)) + 0.0 * t


TRAJECTORIES: dict[str, Callable[..., Column]] = {"sine": sine, "ramp": ramp, "hold": hold}


def noise(channel: str, seed: int, sigma: float, clamp_sigmas: float) -> Column:
    """Clamped Gaussian noise of one channel for the columns ``tick`` and ``joint``."""
    if sigma <= 0:
        return F.lit(0.0)
    own = stream_seed(seed, channel)

    @F.pandas_udf("double")
    def draw(tick: pd.Series, joint: pd.Series) -> pd.Series:
        return pd.Series([random.Random(stream_seed(own, f"{i}:{j}")).gauss(0.0, sigma) for i, j in zip(tick, joint, strict=True)])

    bound = clamp_sigmas * sigma
    return F.greatest(F.lit(-bound), F.least(F.lit(bound), draw("tick", "joint")))


def robot(spark: SparkSession, n_ticks: int, dof: int = 3, trajectory: str = "sine", amplitude: float = 0.5, hz: float = 0.5, start_ns: int = 1_000_000_000, period_ns: int = 10_000_000, episode_id: str = "sim", task: str | None = None, seed: int = 0, sigmas: dict[str, float] | None = None, clamp_sigmas: float = 4.0) -> DataFrame:
    """Samples of a moving arm: angle by trajectory, velocity by difference, current and torque from velocity."""
    path = TRAJECTORIES[trajectory]
    grid = spark.range(n_ticks * dof).select(F.expr(f"id div {dof}").alias("tick"), (F.col("id") % dof).alias("joint"))
    at = lambda tick: path(tick * F.lit(period_ns) / 1e9, F.col("joint"), dof, amplitude, hz)
    velocity = F.when(F.col("tick") > 0, (at(F.col("tick")) - at(F.col("tick") - 1)) / F.lit(period_ns / 1e9)).otherwise(0.0)
    out = grid.withColumn("angle", at(F.col("tick"))).withColumn("velocity", velocity)
    clean = {"joint_angle": F.col("angle"), "joint_velocity": F.col("velocity"), "motor_current": 0.1 + 0.5 * F.abs("velocity"), "estimated_torque": 0.2 * F.col("velocity")}
    return out.select(
        (F.lit(start_ns).cast("long") + F.col("tick") * period_ns).alias("timestamp_ns"), F.lit(episode_id).alias("episode_id"), F.col("joint").cast("int").alias("chain_index"),
        *[(c + noise(k, seed, (sigmas or {}).get(k, 0.0), clamp_sigmas)).alias(k) for k, c in clean.items()],
        F.lit(None).cast("string").alias("camera_frame_id"), F.lit(None).cast("string").alias("tactile_event"), F.lit(task).cast("string").alias("task_label"), F.lit(1).alias("schema_version"),
    )


def phases(spark: SparkSession, name: str) -> DataFrame:
    if name not in SCENARIOS:
        raise ValueError(f"unknown scenario {name!r}; there are {', '.join(SCENARIOS)}")
    return spark.createDataFrame([(i, *p) for i, p in enumerate(SCENARIOS[name])], "phase_ix int, kind string, start_s double, duration_s double")


def _stream(spark: SparkSession, name: str, chain: int, start_ns: int, period_ns: int, episode_id: str) -> DataFrame:
    """Rows of a scripted stream: one for each period until the script ends, with the active token."""
    script = SCENARIOS[name]
    total = script[-1][1] + script[-1][2]
    n = math.ceil(round(total * 1e9) / period_ns)
    rows = lattice(spark, n, start_ns, period_ns)
    elapsed = (F.col("timestamp_ns") - start_ns).cast("double") / 1e9
    token = F.lit(None).cast("string")
    for kind, start, duration in reversed(script):
        if kind in ("contact_start", "slip", "impact", "release"):
            token = F.when((elapsed >= start - 1e-9) & (elapsed < start + duration - 1e-9), F.lit(kind)).otherwise(token)
    return rows.select("timestamp_ns", F.lit(episode_id).alias("episode_id"), F.lit(chain).alias("chain_index"), "idx", token.alias("token"))


def scenario_episode(spark: SparkSession, name: str = "slip_recovery", seed: int = 7, period_ns: int = 30_000_000, start_ns: int = 1_000_000_000) -> DataFrame:
    """Samples of three streams 10 ms apart: joint (chain 0), tactile (1) and camera (2), with ``seq`` in order of time."""
    phases(spark, name)
    episode, total = f"sim_{name}", round((SCENARIOS[name][-1][1] + SCENARIOS[name][-1][2]) * 1e9)
    joint = robot(spark, -(-total // period_ns), 1, start_ns=start_ns, period_ns=period_ns, episode_id=episode, task=name, seed=seed)
    lattice_ns = period_ns // 3
    zero = [F.lit(0.0).alias(c) for c in CHANNELS]
    none = lambda c: F.lit(None).cast("string").alias(c)
    tail = [F.lit(name).alias("task_label"), F.lit(1).alias("schema_version")]
    key = ["timestamp_ns", "episode_id", "chain_index"]
    tactile = _stream(spark, name, 1, start_ns + lattice_ns, period_ns, episode).select(*key, *zero, none("camera_frame_id"), F.col("token").alias("tactile_event"), *tail)
    camera = _stream(spark, name, 2, start_ns + 2 * lattice_ns, period_ns, episode).select(*key, *zero, F.format_string("frame_%06d", "idx").alias("camera_frame_id"), none("tactile_event"), *tail)
    merged = joint.unionByName(tactile).unionByName(camera)
    # On the common lattice the place of a row follows from its stamp.
    return merged.withColumn("seq", ((F.col("timestamp_ns") - start_ns) / lattice_ns).cast("long"))


def bus_frames(spark: SparkSession, n: int, pods: list[tuple[int, int]], start_ns: int = 1, period_ns: int = 10_000_000) -> DataFrame:
    """``can_id, data, t_ns``: state frames of pods (node, chain), interleaved by tick; angles swing by 30 degrees."""
    grid = spark.range(n).select(F.col("id").alias("tick"), F.posexplode(F.array(*[F.struct(F.lit(a).alias("node"), F.lit(c).alias("chain")) for a, c in pods])).alias("k", "pod"))
    degrees = 30.0 * F.sin((F.col("tick") + F.col("pod.node")) * 0.2)
    deg = (degrees * 1000).cast("int")
    raw = ((degrees + 180.0) / 360.0 * 4095).cast("int")
    return grid.select(codec.can_id(F.col("pod.node")).alias("can_id"), codec.encode(raw, deg, F.col("pod.node"), F.col("pod.chain"), F.lit(0)).alias("data"), (F.lit(start_ns).cast("long") + (F.col("tick") * len(pods) + F.col("k")) * period_ns).alias("t_ns"))
