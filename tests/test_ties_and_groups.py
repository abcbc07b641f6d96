"""Rows that tie, and groups that are most of a table."""

from pyspark.sql import functions as F

from tickloom.functions import values
from tickloom.operators import frames, quality, simulate
from tickloom.sources import commits, episodes

FLOATS = "joint_angle double, joint_velocity double, motor_current double, estimated_torque double"


def test_tied_rows_have_one_place(spark):
    """Rows of one time, chain and angle, whose tasks differ, in two orders of arrival at the tasks."""
    rows = [(1, i, 10, 0, f"t{i * 7 % 5}", 0.5, 0.25, 0.125, 0.0625) for i in range(40)]
    make = lambda x: spark.createDataFrame(x, f"episode_id long, seq long, timestamp_ns long, chain_index int, task_label string, {FLOATS}").coalesce(1)
    a, b = make(rows), make(rows[::-1])
    assert frames.differences(a, b).isEmpty()
    assert frames.differences(a.drop("seq"), b.drop("seq")).isEmpty()
    other = b.withColumn("estimated_torque", F.when(F.col("seq") % 9 == 8, 2.0).otherwise(F.col("estimated_torque")))
    assert sorted(r["row"] for r in frames.differences(a, other).collect()) == [9, 18, 27, 36]


def test_rows_of_a_large_group_are_not_dealt_by_group(spark):
    """Only sums are shuffled, not the rows of a group, and they give what the rows give."""
    rows = [("a", i % 11, 3 * (i % 11) + i % 4) for i in range(500)] + [("b", 1, 7), ("c", 1, 7), ("c", 2, 7), ("d", 1, None), ("d", 2, 5), ("d", 4, 9)]
    df = values.with_line(spark.createDataFrame(rows, "g string, x int, y int"), "x", "y", ["g"])
    got = values.r_squared(df, "x", "y", "slope", "intercept", ["g"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    want = {}
    for g in "acd":
        own = [r.asDict() for r in df.where(F.col("g") == g).withColumn("p", values.adc_to_millideg(F.col("x"), F.col("slope"), F.col("intercept"))).collect()]
        m = sum(r["y"] or 0 for r in own) / len(own)
        res, tot = (sum((r["y"] - (r["p"] if k else m)) ** 2 for r in own if r["y"] is not None) for k in (1, 0))
        want[g] = 1.0 if tot == 0 else 1 - res / tot
    out = {r["g"]: r["r2"] for r in got.collect()}
    assert all(abs(out[g] - want[g]) < 1e-12 for g in want) and out["b"] == 0.0


def test_tables_of_a_frame_dataset_read_its_frames(spark, tmp_path, monkeypatch):
    """Frames are made once; before, each of the tables made them again."""
    seen, write = {}, commits.Commit.write

    def kept(self, table, rows, kind="parquet"):
        seen[table] = rows
        return write(self, table, rows, kind)

    monkeypatch.setattr(commits.Commit, "write", kept)
    samples = simulate.robot(spark, 20, 2, episode_id="a", task="t").withColumn("seq", F.monotonically_increasing_id())
    episodes.export_frames(samples, str(tmp_path / "d"))
    assert all(any("/data/commit=" in f for f in seen[t].inputFiles()) for t in ("episodes", "tasks", "info"))
    assert commits.read(spark, str(tmp_path / "d"), "info").first()["total_frames"] == 20


def test_intervals_are_counted_once(spark):
    """Medians and percentiles that are joined to the counts they come from make those again for each side."""
    times = {"a": [5, 15, 25, 25, 24, 90, 100, None, 110], "b": [7], "c": [None, None], "d": [10, 20, 30], "e": [3, 3]}
    rows = [(e, i, t) for e, x in times.items() for i, t in enumerate(x)]
    got = quality.jitter(spark.createDataFrame(rows, "episode_id string, seq long, timestamp_ns long"), quality.JitterBudget(gap_factor=2.5))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and plan.count("lag(") == 1
    want = {}
    for e, x in times.items():
        dt = sorted(b - a for a, b in zip(x, x[1:], strict=False) if a is not None and b is not None)
        period = (dt[(len(dt) - 1) // 2] + dt[len(dt) // 2]) >> 1 if dt else 0
        off = sorted(abs(d - period) for d in dt)
        p99 = off[min(max(round(0.99 * len(off)), 1), len(off)) - 1] if off else 0
        want[e] = (len(x), period, max(off, default=0), p99, sum(d <= 0 for d in dt), sum(period > 0 and d > 2.5 * period for d in dt), len(dt))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
