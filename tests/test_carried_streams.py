"""Streams whose keys lie over many tasks and batches, against the batch operators over the whole."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import events, segmented, timeline
from tickloom.streaming import carried

SCHEMA = "episode_id string, chain_index int, seq long, timestamp_ns long, value double"


def recorded(seed, n=120):
    r, t, out = random.Random(seed), 10**9, []
    for i in range(n):
        for e in ("hot", "hot", "cold", None) if i < n // 2 else ("hot", "late"):
            t += r.choice([0, -30, 1, 7, 7, 50])
            out.append((e, len(out) % 2, len(out), t, r.choice([None, float("nan"), 0.0, 0.4, 0.5, 0.5, 0.6, 1.0, 1.0])))
    return out


def stream(spark, rows, folder, batches):
    """The rows as files, one a batch; the last has none of some keys, and one batch is empty."""
    size = -(-len(rows) // batches)
    for k in range(batches):
        spark.createDataFrame(rows[k * size : (k + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.fixture()
def short_states(monkeypatch):
    """States of all keys are written every second batch, so a state is read over a written one."""
    monkeypatch.setattr(carried, "FULL_EVERY", 2)


@pytest.mark.parametrize("seed", [1])
def test_streams_equal_the_whole(spark, short_states, tmp_path, seed):
    given = recorded(seed)
    whole, s = spark.createDataFrame(given, SCHEMA), stream(spark, given, tmp_path / "in", 4)
    want = timeline.normalize(whole.select("episode_id", "seq", "timestamp_ns"))
    got = carried.normalize(s, str(tmp_path / "norm"))
    assert got.columns == want.columns and rows(got) == rows(want) and got.where("normalized_ns is null").count() > 10
    readings = s.withColumn("level", F.col("value"))
    for k, (onset, release) in enumerate(((0.5, 0.5), (0.6, 0.4))):
        want = events.detect_contact(whole, F.col("value"), onset, release)
        got = carried.contacts(readings, str(tmp_path / f"contact{k}"), onset, release)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 20
    for k, refractory in enumerate((0, 90)):
        want = events.detect_impact(whole, "value", 0.5, refractory)
        got = carried.impacts(s, str(tmp_path / f"impact{k}"), 0.5, refractory)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 5


def test_a_batch_that_is_repeated_replaces_itself(spark, tmp_path):
    """The state after a batch is lost with the log of its commit: the batch runs again from the states before it."""
    given = recorded(3, 40)
    s = stream(spark, given, tmp_path / "in", 3)
    want = rows(carried.normalize(s, str(tmp_path / "out")))
    last = max((tmp_path / "out" / "log" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert rows(carried.normalize(s, str(tmp_path / "out"))) == want


def test_a_stream_goes_on_from_its_states(spark, tmp_path):
    given = recorded(4, 40)
    cut = len(given) // 2
    carried.contacts(stream(spark, given[:cut], tmp_path / "in", 1).withColumn("level", F.col("value")), str(tmp_path / "out"), 0.6, 0.4)
    got = carried.contacts(stream(spark, given[cut:], tmp_path / "in", 1).withColumn("level", F.col("value")), str(tmp_path / "out"), 0.6, 0.4)
    assert rows(got) == rows(events.detect_contact(spark.createDataFrame(given, SCHEMA), F.col("value"), 0.6, 0.4))


def test_no_rows_give_no_events(spark, tmp_path):
    s = stream(spark, [], tmp_path / "in", 1)
    assert carried.impacts(s, str(tmp_path / "out"), 1.0, 5).count() == 0


def test_the_value_before_over_ranges(spark):
    whole = spark.createDataFrame(recorded(5), SCHEMA).repartition(3)
    assert rows(events.impact_candidates(whole, "value", 0.4, long=True)) == rows(events.impact_candidates(whole, "value", 0.4))
    first = segmented.value_before(whole, ["episode_id"], "seq", "value", "b").groupBy("episode_id").agg(F.min_by(F.struct("b"), "seq").alias("x"))
    assert {r["x"]["b"] for r in first.collect()} == {None}
