import pytest
from pyspark.sql import functions as F

from tickloom.operators import events, timeline
from tickloom.streaming import stateful


@pytest.fixture(scope="module")
def recorded(spark, tmp_path_factory):
    """Samples in two files, the second later than the first, with disordered stamps and repeated values."""
    rows = []
    for e in (1, 2):
        for i in range(60):
            t = 10**9 + i * 10**7 + (5 * 10**7 if i in (20, 21) else 0)
            rows.append((e, i, i % 2, t, float((i * 37 + e * 11) % 23), (i * 7 % 10) / 10))
    df = spark.createDataFrame(rows, "episode_id long, seq long, chain_index int, timestamp_ns long, value double, level double")
    d = tmp_path_factory.mktemp("stream")
    df.where("seq < 30").coalesce(1).write.parquet(str(d / "in"))
    df.where("seq >= 30").coalesce(1).write.mode("append").parquet(str(d / "in"))
    return df, d


def _stream(spark, recorded):
    df, d = recorded
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(d / "in"))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_normalisation_flags_and_keeps_late_rows(spark, recorded, tmp_path):
    got = stateful.collect_available(stateful.normalize(_stream(spark, recorded)), "norm", str(tmp_path))
    want = timeline.normalize(recorded[0]).select("episode_id", "seq", "timestamp_ns", F.concat_ws(",", "flags").alias("flags"))
    assert _rows(got) == _rows(want) and got.where("flags <> ''").count() > 0


def test_contacts_equal_the_batch_operator(spark, recorded, tmp_path):
    got = stateful.collect_available(stateful.contacts(_stream(spark, recorded), 0.7, 0.2), "con", str(tmp_path))
    want = events.detect_contact(recorded[0].withColumnRenamed("level", "x"), F.col("x"), 0.7, 0.2).drop("level")
    assert _rows(got) == _rows(want)


def test_impacts_equal_the_batch_operator(spark, recorded, tmp_path):
    got = stateful.collect_available(stateful.impacts(_stream(spark, recorded), 9.0, 30_000_000), "imp", str(tmp_path))
    want = events.detect_impact(recorded[0], "value", 9.0, 30_000_000).drop("kind")
    assert _rows(got) == _rows(want)


def test_latest_rows(spark, recorded, tmp_path):
    got = stateful.collect_available(stateful.latest(_stream(spark, recorded).select("episode_id", "chain_index", "seq", "value"), ["episode_id", "chain_index"]), "last", str(tmp_path), "complete")
    assert {(r["episode_id"], r["chain_index"]): r["seq"] for r in got.collect()} == {(1, 0): 58, (1, 1): 59, (2, 0): 58, (2, 1): 59}


def test_closed_episodes_go_through_the_gate(spark, tmp_path):
    from tickloom.operators import faults, simulate

    good = simulate.scenario_episode(spark)
    bad = faults.burst_delay(good.withColumn("idx", F.col("seq")), 10, 5, 10**9).drop("idx").withColumn("episode_id", F.lit("late"))
    good.unionByName(bad).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(good.schema).parquet(str(tmp_path / "in"))
    stateful.record_batches(source, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "out" / "batch=0" / "data")).select("episode_id").distinct().collect()] == ["sim_slip_recovery"]
    assert [r["episode_id"] for r in spark.read.json(str(tmp_path / "out" / "batch=0" / "quarantine")).collect()] == ["late"]
