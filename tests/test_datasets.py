import os

import pytest
from pyspark.sql import functions as F

from tickloom.operators import simulate
from tickloom.sources import commits, description, episodes, roundtrip


@pytest.fixture(scope="module")
def good(spark):
    from tickloom.session import written

    return written(simulate.scenario_episode(spark))


def test_metadata_lie_in_the_footers_with_the_data(spark, good, tmp_path):
    many = {f"name {i}": f"wert {i} é" for i in range(300)}
    episodes.record(good, str(tmp_path / "d"), metadata=many)
    assert episodes.read_metadata(spark, str(tmp_path / "d")) == many
    assert episodes.metadata_of(episodes.read_rows(spark, str(tmp_path / "d"))) == many
    assert sorted(os.listdir(tmp_path / "d")) == ["data", "manifests", "quarantine"]
    episodes.record(good, str(tmp_path / "d"), mode="append", metadata={"robot": "other"}, name="zz")
    assert episodes.read_metadata(spark, str(tmp_path / "d")) == {"robot": "other"}
    with pytest.raises(ValueError):
        episodes.with_metadata(good, {"robot": 1})
    with pytest.raises(FileExistsError):
        episodes.record(good, str(tmp_path / "d"))


@pytest.mark.parametrize("table", ["quarantine", "manifests"])
def test_a_failure_between_writes_shows_nothing(spark, good, tmp_path, monkeypatch, table):
    whole, finish = commits.Commit.write, commits.Commit.finish

    def broken(self, name, rows, kind="parquet"):
        if name == table:
            raise OSError("lost")
        whole(self, name, rows, kind)

    def broken_finish(self):
        raise OSError("lost")

    monkeypatch.setattr(commits.Commit, "write", broken)
    if table == "manifests":
        monkeypatch.setattr(commits.Commit, "finish", broken_finish)
    with pytest.raises(OSError, match="lost"):
        episodes.record(good, str(tmp_path / "d"))
    monkeypatch.undo()
    assert commits.Commit.finish is finish
    assert commits.read(spark, str(tmp_path / "d"), "data") is None
    with pytest.raises(FileNotFoundError):
        episodes.read_rows(spark, str(tmp_path / "d"))
    episodes.record(good, str(tmp_path / "d"))
    assert episodes.read_rows(spark, str(tmp_path / "d")).count() == good.count()
    assert len(commits.drop_unfinished(spark, str(tmp_path / "d"), ["data", "quarantine"])) == 1
    assert episodes.read_rows(spark, str(tmp_path / "d")).count() == good.count()


def test_commits_add_up_and_repeat_by_name(spark, tmp_path):
    row = lambda *ids: spark.createDataFrame([(i,) for i in ids], "k long")
    for name, ids in (("a", (1, 2)), ("b", (3,)), ("a", (4,))):
        with commits.commit(spark, str(tmp_path), name) as c:
            c.write("data", row(*ids))
    assert sorted(r[0] for r in commits.read(spark, str(tmp_path), "data").collect()) == [3, 4]
    assert commits.finished(spark, str(tmp_path), "b") and not commits.finished(spark, str(tmp_path), "c")
    assert commits.read(spark, str(tmp_path), "other") is None
    with pytest.raises(ValueError), commits.commit(spark, str(tmp_path), "../x"):
        pass


def test_rows_come_in_the_order_of_file_names(spark, tmp_path):
    want = []
    for name, values in (("b", [5, 1]), ("a", [9, 7, 8]), ("c", [2])):
        spark.createDataFrame([(v,) for v in values], "v long").coalesce(1).write.parquet(str(tmp_path / f"tmp-{name}"))
        part = next(f for f in os.listdir(tmp_path / f"tmp-{name}") if f.endswith(".parquet"))
        os.makedirs(tmp_path / "in", exist_ok=True)
        os.rename(tmp_path / f"tmp-{name}" / part, tmp_path / "in" / f"{name}.parquet")
        want += [(f"{name}.parquet", v) for v in values]
    (tmp_path / "in" / "notes.txt").write_text("no data")
    got = episodes.read_directory(spark, str(tmp_path / "in")).orderBy("seq").collect()
    assert [(r["file_name"], r["v"]) for r in got] == sorted(want, key=lambda x: x[0]) and [r["seq"] for r in got] == list(range(6))


def test_equal_timing_gives_equal_files_and_versions_are_checked(spark, good, tmp_path):
    ids = [good.first()["episode_id"]]
    timing = spark.createDataFrame([(ids[0], m, i) for i, m in enumerate("cab")], "episode_id string, modality string, clean long")
    contents = []
    for k, t in enumerate((timing, timing.repartition(5).orderBy(F.rand(1)))):
        episodes.export_rows(good, str(tmp_path / str(k)), t)
        folder = next(p for p, _, f in os.walk(tmp_path / str(k) / "timing") if any(x.endswith(".json") for x in f))
        contents.append(sorted((tmp_path / str(k) / "timing" / folder / f).read_bytes() for f in os.listdir(folder) if f.endswith(".json")))
    assert contents[0] == contents[1]
    schema = "episode_id string, modality string, clean long"
    assert episodes.read_timing(spark, str(tmp_path / "0"), schema).count() == 3
    for line in ('{"episode_id": "a", "modality": "m", "clean": 1}', '{"episode_id": "a", "modality": "m", "clean": 1, "timing_meta_version": 2}'):
        with commits.commit(spark, str(tmp_path / "bad"), "only") as c:
            c.write("timing", spark.createDataFrame([(line,)], "value string"), "text")
        with pytest.raises(Exception, match="version"):
            episodes.read_timing(spark, str(tmp_path / "bad"), schema).collect()


def test_a_dataset_that_loses_a_row_does_not_survive(spark, good, tmp_path):
    timing = good.groupBy("episode_id").agg(F.count("*").alias("clean"))
    load = {"frames": lambda s, f: episodes.read_frames(s, f).where("chain_index > 0"), "rows": lambda s, f: episodes.read_rows(s, f).withColumn("joint_angle", F.col("joint_angle") + F.when(F.col("seq") == 3, 1e-9).otherwise(0.0))}
    got = {r["kind"]: (r["samples_survive"], r["timing_survives"]) for r in roundtrip.round_trips(good, timing, str(tmp_path / "x"), load=load).collect()}
    assert got == {"rows": (False, True), "frames": (False, True)}
    fine = roundtrip.round_trips(good, timing, str(tmp_path / "y")).collect()
    assert {(r["samples_survive"], r["timing_survives"]) for r in fine} == {(True, True)}


def test_the_plan_of_a_long_chain_does_not_double(spark):
    n = 60
    joints = spark.createDataFrame([(f"j{i}", f"l{i}", f"l{i + 1}") for i in range(n)], "name string, parent string, child string")
    out = description.depths(joints)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") + out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") < 6
    assert {r["name"]: r["depth"] for r in out.collect()} == {f"j{i}": i for i in range(n)}
