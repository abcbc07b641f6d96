"""The five published timing cases, from simulated recordings."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bench, faults, simulate

#: case: budget of skew and window, period, number of stamps.
CASES = {
    "clean_baseline": dict(verdict="aligned_within_budget", flagged=(0, 166), missed=(0, 144), offsets=(20_000_000, 10106382.978723405, 10_000_000, 20_000_000), events=25, gate=True),
    "can_jitter_mild": dict(verdict="aligned_within_budget", flagged=(0, 425), missed=(0, 245), offsets=(199_634, 103649.775, 189_415, 199_092), events=25, gate=True),
    "camera_variable_33ms": dict(verdict="degraded", flagged=(0, 205), missed=(50, 140), offsets=(1_937_014, 831177.45, 1_781_464, 1_937_014), events=25, gate=True),
    "burst_stall_200ms": dict(verdict="quarantined", flagged=(20, 425), missed=(25, 263), offsets=(0, 0.0, 0, 0), events=20, gate=False),
    "skewed_source_clock": dict(verdict="quarantined", flagged=(0, 425), missed=(200, 250), offsets=(None, None, None, None), events=25, gate=True),
}
SEED = 104


def _disturbed(spark, name):
    n, period = (90, 33_333_333) if name == "camera_variable_33ms" else (200, 10_000_000)
    clean = simulate.lattice(spark, n, 1_000_000_000, period).withColumn("episode_id", F.lit("e"))
    late = {
        "can_jitter_mild": lambda: faults.jitter(clean, 200_000, SEED),
        "camera_variable_33ms": lambda: faults.variable_frame_time(clean, 0.04, SEED),
        "burst_stall_200ms": lambda: faults.burst_delay(clean, 100, 20, 200_000_000),
        "skewed_source_clock": lambda: faults.skewed_clock(clean, 5_000_000, 500.0),
    }[name]()
    return clean.withColumn("seq", F.col("idx")), late.withColumn("seq", F.col("idx")), period


@pytest.mark.parametrize("name", CASES)
def test_published_rows(spark, name):
    episode = simulate.scenario_episode(spark, "slip_recovery").withColumn("episode_id", F.lit("e"))
    chain = lambda c: episode.where(F.col("chain_index") == c)
    events = chain(1).where("tactile_event is not null")
    if name == "clean_baseline":
        out = bench.report(chain(0), {"frames": chain(2), "tactile": chain(1)}, 20_000_000, events=events, primary="frames", window_ns=30_000_000, gate_on=episode)
    else:
        clean, late, period = _disturbed(spark, name)
        out = bench.report(clean, {"disturbed": late}, 2_000_000, events=events, window_ns=period)
    (r,) = out.collect()
    want = CASES[name]
    assert (r["verdict"], r["gate_passed"]) == (want["verdict"], want["gate"])
    assert (r["flagged"], r["total_records"]) == want["flagged"]
    assert (r["non_matched"], r["total_results"]) == want["missed"]
    assert (r["max_abs_offset_ns"], r["mean_abs_offset_ns"], r["p95_abs_offset_ns"], r["p99_abs_offset_ns"]) == want["offsets"]
    assert (r["events_matched"], r["events_total"]) == (want["events"], 25)


def test_episode_has_three_interleaved_streams(spark):
    e = simulate.scenario_episode(spark, "slip_recovery")
    assert {r["chain_index"]: r["count"] for r in e.groupBy("chain_index").count().collect()} == {0: 47, 1: 47, 2: 47}
    assert e.select("seq").distinct().count() == 141
    assert e.where("tactile_event is not null").count() == 25


def test_gate_lists_failures_in_order(spark):
    rows = spark.createDataFrame([("a", 5, 1, 10, "quarantined"), ("b", 0, 0, None, "degraded")], "episode_id string, flagged int, non_matched int, p95_abs_offset_ns int, verdict string")
    got = {r["episode_id"]: r["failures"] for r in bench.gate(rows, {"max_flagged": 1, "max_non_matched": 2, "max_p95_abs_offset_ns": 3, "verdicts": ["degraded"]}).collect()}
    assert got == {"a": "flagged:5,p95_abs_offset_ns:10,verdict:quarantined", "b": ""}


def test_two_runs_are_equal(spark):
    a, b = (_disturbed(spark, "can_jitter_mild")[1] for _ in range(2))
    assert bench.same_rows(a, b)
