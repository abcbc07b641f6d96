import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality
from tickloom.sources import commits
from tickloom.streaming import closed

#: One sample in five is not finite, so intervals of two periods are within the budget.
BUDGET = quality.JitterBudget(p99_ns=20_000_000)
SCHEMA = "episode_id string, seq long, chain_index int, timestamp_ns long, joint_angle double, tactile_event string, ends boolean"


def rows_of(name, n, late=(), ends=True, pure_mark=False):
    out = [(name, i, i % 2, 10**9 + i * 10**7 + (10**9 if i in late else 0), i / 7 if i % 5 else float("nan"), "slip" if i % 3 == 0 else None, None) for i in range(n)]
    if ends and pure_mark:
        return [*out, (name, None, None, None, None, None, True)]
    return [*out[:-1], (*out[-1][:-1], True)] if ends else out


def feed(spark, folder, batches):
    """One file for each batch, in order of time."""
    import os

    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            if f.endswith(".parquet") and not f.startswith("at-"):
                os.rename(f"{folder}/{f}", f"{folder}/at-{k}-{f}")
                os.utime(f"{folder}/at-{k}-{f}", (10**9 + k * 60, 10**9 + k * 60))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture()
def split(spark, tmp_path):
    """Episodes over three batches, in one, ended by a mark alone, refused, never ended, and rows after an end."""
    a, b, c, d = rows_of("a", 90), rows_of("b", 40, pure_mark=True), rows_of("c", 60, late=(20, 21)), rows_of("d", 30, ends=False)
    batches = [a[:30] + b[:10] + c[:15] + d, a[30:60] + b[10:] + c[15:25], a[60:] + c[25:] + rows_of("e", 25), rows_of("e", 3, ends=False) + rows_of("b", 2, ends=False)]
    return {"a": a, "b": b, "c": c, "d": d, "e": rows_of("e", 25)}, feed(spark, str(tmp_path / "in"), batches), tmp_path


def test_episodes_come_whole_and_once(spark, split):
    episodes, stream, d = split
    seen = []
    out = closed.closed_episodes(stream)
    assert out.columns == [*[c for c in stream.columns if c != "ends"], "closing"]
    with closed.bounded(spark):
        q = out.writeStream.foreachBatch(lambda b, k: seen.append(sorted((r["closing"], r["episode_id"], r["seq"]) for r in b.collect()))).option("checkpointLocation", str(d / "s")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    seen = [x for x in seen if x]
    whole = lambda name: [("ended", name, i) for i in range(len(episodes[name]) - (name == "b"))]
    assert seen == [whole("b"), sorted(whole("a") + whole("c") + whole("e")), [("after_end", n, i) for n, k in (("b", 2), ("e", 3)) for i in range(k)]]


def test_rows_come_back_as_they_were(spark, split):
    episodes, stream, d = split
    got = []
    with closed.bounded(spark):
        q = closed.closed_episodes(stream).where("closing = 'ended'").writeStream.foreachBatch(lambda b, k: got.extend(map(tuple, b.drop("closing").collect()))).option("checkpointLocation", str(d / "s")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = [r[:-1] for name in "abce" for r in episodes[name] if r[3] is not None]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_split_episodes_are_judged_as_the_batch_gate_judges_them_whole(spark, split):
    episodes, stream, d = split
    folder = str(d / "out")
    closed.record_closed(closed.closed_episodes(stream), folder, str(d / "s"), BUDGET).awaitTermination(120)
    everything = spark.createDataFrame([r for name in "abce" for r in episodes[name]], SCHEMA).where("timestamp_ns is not null").drop("ends").where(quality.is_finite(F.col("joint_angle")))
    verdicts = quality.recorder_gate(everything, BUDGET)
    good = verdicts.where("ok").select("episode_id")
    assert sorted(map(tuple, commits.read(spark, folder, "data").collect())) == sorted(map(tuple, everything.join(good, "episode_id", "left_semi").collect()))
    refused = {r["episode_id"]: list(r["reasons"]) for r in commits.read(spark, folder, "quarantine").collect()}
    assert {r["episode_id"] for r in good.collect()} == {"a", "b", "e"}
    assert refused == {r["episode_id"]: list(r["reasons"]) for r in verdicts.where("not ok").collect()} and "c" in refused
    assert commits.read(spark, folder, "stray").where("closing = 'after_end'").count() == 5


def test_a_restart_goes_on_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    a = rows_of("a", 60)
    folder, state = str(tmp_path / "out"), str(tmp_path / "s")
    stream = feed(spark, str(tmp_path / "in"), [a[:20], a[20:40]])
    closed.record_closed(closed.closed_episodes(stream), folder, state, BUDGET).awaitTermination(120)
    assert commits.read(spark, folder, "data") is None
    feed(spark, str(tmp_path / "in"), [[], [], a[40:]])
    closed.record_closed(closed.closed_episodes(stream), folder, state, BUDGET).awaitTermination(120)
    assert commits.read(spark, folder, "data").count() == len([r for r in a if r[4] == r[4]])
    name = commits.manifests(spark, folder).first()["commit"].removeprefix("c-")
    other = spark.createDataFrame([(*r[:-1], "ended") for r in rows_of("z", 30)], SCHEMA.replace("ends boolean", "closing string"))
    closed.commit_closed(other, name, folder, BUDGET)
    assert commits.read(spark, folder, "data").where("episode_id = 'z'").count() == 0


def test_a_quiet_episode_is_handed_on_as_not_ended(spark, tmp_path):
    folder, state = str(tmp_path / "out"), str(tmp_path / "s")
    stream = feed(spark, str(tmp_path / "in"), [rows_of("q", 12, ends=False)])
    out = closed.closed_episodes(stream, quiet_ms=1)
    closed.record_closed(out, folder, state, BUDGET).awaitTermination(120)
    feed(spark, str(tmp_path / "in"), [[], rows_of("x", 30)])
    closed.record_closed(out, folder, state, BUDGET).awaitTermination(120)
    feed(spark, str(tmp_path / "in"), [[], [], rows_of("q", 2, ends=False)])
    closed.record_closed(out, folder, state, BUDGET).awaitTermination(120)
    stray = commits.read(spark, folder, "stray").groupBy("episode_id", "closing").count().collect()
    assert {tuple(r) for r in stray} >= {("q", "not_ended", 12), ("q", "after_end", 2)}
    assert {r[0] for r in commits.read(spark, folder, "data").select("episode_id").collect()} <= {"x"}


def test_a_running_query_finds_quiet_episodes_without_other_rows(spark, tmp_path):
    import time

    folder = str(tmp_path / "out")
    stream = feed(spark, str(tmp_path / "in"), [rows_of("q", 12, ends=False)])
    q = closed.record_closed(closed.closed_episodes(stream, quiet_ms=500), folder, str(tmp_path / "s"), every="1 second")
    until = time.time() + 90
    while commits.read(spark, folder, "stray") is None and time.time() < until:
        time.sleep(1)
    q.stop()
    assert {(r["episode_id"], r["closing"]) for r in commits.read(spark, folder, "stray").collect()} == {("q", "not_ended")}


def test_a_batch_that_fails_between_its_tables_shows_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    batch = spark.createDataFrame([(*r[:-1], "ended") for r in rows_of("a", 40)], SCHEMA.replace("ends boolean", "closing string"))
    whole = commits.Commit.write

    def broken(self, table, rows, kind="parquet"):
        if table == "stray":
            raise OSError("lost")
        whole(self, table, rows, kind)

    monkeypatch.setattr(commits.Commit, "write", broken)
    with pytest.raises(OSError, match="lost"):
        closed.commit_closed(batch, "batch-1", folder, BUDGET)
    monkeypatch.undo()
    assert all(commits.read(spark, folder, t) is None for t in ("data", "quarantine", "stray"))
    closed.commit_closed(batch, "batch-1", folder, BUDGET)
    assert commits.read(spark, folder, "data").count() == 32


def test_ended_episodes_as_tables_are_judged_as_the_batch_gate_judges_them_whole(spark, split, monkeypatch):
    """No Python state handles an episode on its own; rows, verdicts and rows after an end are those of ``record_closed``."""
    episodes, stream, d = split
    folder = str(d / "out")
    monkeypatch.setattr(closed, "closed_episodes", lambda *_, **__: pytest.fail("a state for each episode"))
    closed.record_ended(stream, folder, str(d / "s"), BUDGET).awaitTermination(120)
    everything = spark.createDataFrame([r for name in "abce" for r in episodes[name]], SCHEMA).where("timestamp_ns is not null").drop("ends").where(quality.is_finite(F.col("joint_angle")))
    verdicts = quality.recorder_gate(everything, BUDGET)
    good = verdicts.where("ok").select("episode_id")
    assert sorted(map(tuple, commits.read(spark, folder, "data").collect())) == sorted(map(tuple, everything.join(good, "episode_id", "left_semi").collect()))
    refused = {r["episode_id"]: list(r["reasons"]) for r in commits.read(spark, folder, "quarantine").collect()}
    assert refused == {r["episode_id"]: list(r["reasons"]) for r in verdicts.where("not ok").collect()} and "c" in refused
    assert sorted((r["episode_id"], r["closing"]) for r in commits.read(spark, folder, "stray").collect()) == [("b", "after_end")] * 2 + [("e", "after_end")] * 3


def test_a_restart_finds_the_rows_of_open_episodes(spark, tmp_path):
    """Rows without an episode are those of one episode."""
    a, none = rows_of("a", 60), [(None, *r[1:]) for r in rows_of("n", 50)]
    folder, state = str(tmp_path / "out"), str(tmp_path / "s")
    stream = feed(spark, str(tmp_path / "in"), [a[:20] + none[:30], a[20:40]])
    closed.record_ended(stream, folder, state, BUDGET).awaitTermination(120)
    assert commits.read(spark, folder, "data") is None
    feed(spark, str(tmp_path / "in"), [[], [], a[40:] + none[30:]])
    closed.record_ended(stream, folder, state, BUDGET).awaitTermination(120)
    seen = commits.read(spark, folder, "data").where("episode_id = 'a'")
    assert seen.count() == len([r for r in a if r[4] == r[4]])
    waiting = spark.read.parquet(f"{state}/waiting/batch=4").groupBy("episode_id", "closing").count().collect()
    assert {tuple(r) for r in waiting} == {("a", "ended", 60), (None, "ended", 50)}
