import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions import codec, serial, values
from tickloom.operators import events, faults, frames, quality, simulate
from tickloom.registry import Registry
from tickloom.sources import canlog, description, episodes
from tickloom.sources.registry import DETECTORS, EXPORTERS, SINKS, SOURCES, fault_counts
from tickloom.streaming import stateful

#: Recorded frame and what it holds.
VECTOR = "000150c901000099"


def test_recorded_frame_decodes_and_encodes(spark):
    (r,) = spark.createDataFrame([(VECTOR,)], "data string").select(codec.decode(F.col("data")).alias("s")).select("s.*").collect()
    assert r.asDict() == {"raw_adc": 256, "millideg": -14000, "node_id": 1, "chain_index": 0, "status_flags": 0, "valid": True}
    (e,) = spark.range(1).select(codec.encode(F.lit(256), F.lit(-14000), F.lit(1), F.lit(0), F.lit(0)).alias("d")).collect()
    assert e["d"] == VECTOR


def test_wrong_checksum_decodes_as_invalid_and_short_frames_raise(spark):
    df = spark.createDataFrame([(VECTOR[:-2] + "98",)], "data string")
    assert df.select(codec.decode(F.col("data"))["valid"]).first()[0] is False
    with pytest.raises(Exception, match="8 bytes"):
        spark.createDataFrame([("00",)], "data string").select(codec.decode(F.col("data"))).collect()


def test_calibration_refuses_values_out_of_range(spark):
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(codec.encode_calib(F.lit(4096), F.lit(0), F.lit(1), F.lit(0), F.lit(0))).collect()


def test_single_precision_conversion(spark):
    (r,) = spark.range(1).select(values.adc_to_millideg(F.lit(1599), 9.999, -32767.4).alias("m")).collect()
    import numpy as np

    assert r["m"] == int(np.float32(np.float32(1599) * np.float32(9.999)) + np.float32(-32767.4))


def _log(tmp_path, lines):
    p = tmp_path / "a.canlog"
    p.write_text("\n".join(lines))
    return str(p)


def test_canlog_reads_and_drops(spark, tmp_path):
    record = lambda t, d: json.dumps({"v": 1, "t_ns": t, "id": 257, "data": d})
    path = _log(tmp_path, [record(0, VECTOR), "", json.dumps({"t_ns": 5, "id": 257, "data": VECTOR.upper()}), record(9, VECTOR[:-2] + "00")])
    frames_ = canlog.read(spark, path)
    assert [r["t_ns"] for r in frames_.orderBy("seq").collect()] == [0, 5, 9]
    kept, dropped = canlog.samples(frames_, "e", "task")
    assert kept.count() == 2 and {r["reason"]: r["n"] for r in dropped.collect()} == {"checksum_invalid": 1}
    out = tmp_path / "out"
    canlog.write(frames_.drop("seq"), str(out))
    assert canlog.read(spark, str(out)).drop("seq").exceptAll(frames_.drop("seq")).isEmpty()


@pytest.mark.parametrize("line", ['{"v":2,"t_ns":0,"id":1,"data":"%s"}' % VECTOR, "[1]", '{"v":1,"t_ns":0,"id":1,"data":"00"}', '{"v":1,"t_ns":0,"id":1,"data":"zz0150c901000099"}', "nonsense"])
def test_canlog_refuses_bad_lines(spark, tmp_path, line):
    with pytest.raises(Exception):
        canlog.read(spark, _log(tmp_path, [line])).collect()


def _episode(spark):
    return simulate.robot(spark, 50, 2, episode_id="a", task="t").withColumn("seq", F.row_number().over(__import__("pyspark").sql.Window.orderBy("timestamp_ns", "chain_index")).cast("long"))


def test_frame_export_reads_back(spark, tmp_path):
    good = _episode(spark)
    empty = good.withColumn("episode_id", F.lit("b")).withColumn("joint_angle", F.lit(float("nan")))
    gap = good.withColumn("episode_id", F.lit("c")).withColumn("timestamp_ns", F.when(F.col("seq") > 50, F.col("timestamp_ns") + 10**9).otherwise(F.col("timestamp_ns")))
    gate = {r["episode_id"]: r for r in episodes.export_frames(good.unionByName(empty).unionByName(gap), str(tmp_path / "d")).collect()}
    assert gate["a"]["exported"] and gate["b"]["reason"] == "empty" and gate["c"]["reason"] == "dropouts"
    back = episodes.read_frames(spark, str(tmp_path / "d"))
    assert frames.differences(good.withColumn("task_label", F.lit(None).cast("string")), back.withColumn("task_label", F.lit(None).cast("string"))).isEmpty()
    info = spark.read.json(str(tmp_path / "d" / "info")).first()
    assert (info["total_episodes"], info["rejected_episodes"], info["total_frames"], info["dof"], info["fps"]) == (1, 2, 50, 2, 100.0)


def test_row_export_and_recorder(spark, tmp_path):
    good = _episode(spark).where("chain_index = 0")
    burst = faults.burst_delay(good.withColumn("idx", ((F.col("timestamp_ns") - 10**9) / 10**7).cast("long")), 10, 5, 10**9).drop("idx").withColumn("episode_id", F.lit("z"))
    both = good.unionByName(burst)
    gate = {r["episode_id"]: r["reason"] for r in episodes.export_rows(both, str(tmp_path / "r")).collect()}
    assert gate == {"a": None, "z": "backwards"}
    assert episodes.read_rows(spark, str(tmp_path / "r")).select("episode_id", "episode_index").distinct().collect() == [("a", 0)]
    verdicts = episodes.record(both, str(tmp_path / "q"))
    assert {r["episode_id"]: r["ok"] for r in verdicts.collect()} == {"a": True, "z": False}
    assert spark.read.json(str(tmp_path / "q" / "quarantine")).count() == 1
    with pytest.raises(ValueError, match="refused"):
        episodes.record(burst, str(tmp_path / "s"), strict=True)


def test_timing_of_unknown_episodes_is_refused(spark, tmp_path):
    timing = spark.createDataFrame([("nobody", 1)], "episode_id string, clean long")
    with pytest.raises(ValueError, match="timing"):
        episodes.export_rows(_episode(spark), str(tmp_path / "t"), timing)
    assert not (tmp_path / "t").exists()


def test_timing_reads_back_strictly(spark, tmp_path):
    timing = spark.createDataFrame([("a", 7)], "episode_id string, clean long")
    episodes.export_rows(_episode(spark).where("chain_index = 0"), str(tmp_path / "t"), timing)
    assert episodes.read_timing(spark, str(tmp_path / "t"), "episode_id string, clean long").collect() == [("a", 7)]
    with pytest.raises(Exception, match="unknown key"):
        episodes.read_timing(spark, str(tmp_path / "t"), "episode_id string").collect()


def test_newer_rows_are_refused(spark):
    df = _episode(spark).withColumn("schema_version", F.lit(2))
    with pytest.raises(Exception, match="newer"):
        episodes.current_rows(df).collect()


URDF = """<robot name="arm"><link name="a"/><link name="b"/><link name="c"/>
<joint name="j1" type="revolute"><parent link="a"/><child link="b"/><axis xyz="0 0 1"/><limit lower="-1" upper="1"/></joint>
<joint name="f" type="fixed"><parent link="b"/><child link="c"/></joint></robot>"""


def _described(spark, folder, text):
    folder.mkdir()
    (folder / "arm.xml").write_text(text)
    return description.joints(spark, str(folder)), description.links(spark, str(folder))


def test_robot_description(spark, tmp_path):
    joints, links = _described(spark, tmp_path / "a", URDF)
    assert description.faults(joints, links).isEmpty()
    assert {r["name"]: (r["depth"], r["axis"], r["lower"]) for r in description.depths(joints).collect()} == {"j1": (0, [0.0, 0.0, 1.0], -1.0), "f": (1, [1.0, 0.0, 0.0], None)}
    arm = description.arm(joints, links)
    assert arm.collect() == [(0, "j1", "revolute", -1.0, 1.0)]
    description.write_arm(arm, str(tmp_path / "arm"))
    assert description.read_arm(spark, str(tmp_path / "arm")).collect() == arm.collect()
    description.write_arm(arm.withColumn("chain_index", F.lit(1)), str(tmp_path / "arm"))
    with pytest.raises(ValueError, match="without gaps"):
        description.read_arm(spark, str(tmp_path / "arm"))


@pytest.mark.parametrize(
    "old,new,fault",
    [
        ('parent link="b"', 'parent link="a"', "branches"), ('child link="c"', 'child link="b"', "two_parents"), ('type="fixed"', 'type="rubber"', "unknown_kind"), ('child link="c"', 'child link="z"', "no_such_link"),
        ('xyz="0 0 1"', 'xyz="0 0 0"', "bad_axis"), ('xyz="0 0 1"', 'xyz="0 one 1"', "bad_axis"), ('lower="-1"', "", "no_limits"), ('lower="-1"', 'lower="2"', "limits_crossed"), ('name="f"', 'name="j1"', "name_twice"),
        ('<link name="c"/>', '<link name="c"/><link name="d"/>', "not_one_base"), ('parent link="a"', 'parent link="c"', "circle"), ('<link name="c"/>', '<link name="c"/><link name="c"/>', "link_twice"),
    ],
)
def test_faults_of_descriptions(spark, tmp_path, old, new, fault):
    joints, links = _described(spark, tmp_path / "a", URDF.replace(old, new))
    assert fault in {r["fault"] for r in description.faults(joints, links).collect()}
    with pytest.raises(ValueError, match=fault):
        description.arm(joints, links)


def test_registry():
    r = Registry("thing")
    r.register("a", lambda: 1)
    assert r.make("a") == 1 and "file" in SOURCES.names() and DETECTORS.names() == ["contact", "impact", "noop", "threshold"]
    assert EXPORTERS.names() == ["frames", "rows"] and SINKS.names() == ["batches", "episodes", "memory"]
    with pytest.raises(ValueError, match="version 2"):
        r.register("c", lambda: 3, version=2)
    with pytest.raises(ValueError, match="there already"):
        r.register("a", lambda: 2)
    with pytest.raises(ValueError, match="there are a"):
        r.make("b")


def test_simulated_bus_frames_are_valid(spark):
    f = simulate.bus_frames(spark, 20, [(1, 0), (2, 1)])
    assert f.count() == 40 and f.where(~codec.decode(F.col("data"))["valid"]).isEmpty()


@pytest.mark.parametrize("name", simulate.TRAJECTORIES)
def test_trajectories_stay_in_range(spark, name):
    s = simulate.robot(spark, 300, 4, name, amplitude=0.7)
    low, high = s.agg(F.min("joint_angle"), F.max("joint_angle")).first()
    assert -0.7 - 1e-9 <= low <= high <= 0.7 + 1e-9


def test_noise_is_reproducible_and_bounded(spark):
    make = lambda: [r[0] for r in simulate.robot(spark, 40, 1, "hold", seed=3, sigmas={"joint_angle": 0.1}, clamp_sigmas=2).orderBy("timestamp_ns").select("joint_angle").collect()]
    a = make()
    assert a == make() and max(abs(x) for x in a) <= 0.2 + 1e-12 and len(set(a)) > 10


def test_scripts_are_valid_and_faults_found(spark):
    for name in simulate.SCENARIOS:
        assert events.check_phases(simulate.phases(spark, name)).isEmpty()
    bad = spark.createDataFrame([(0, "slip", 0.0, 1.0), (1, "dance", 1.0, 1.0), (2, "approach", 3.0, 1.0)], "phase_ix int, kind string, start_s double, duration_s double")
    assert {r["phase_ix"]: r["fault"] for r in events.check_phases(bad).collect()} == {0: "outside_grasp", 1: "unknown_kind", 2: "not_tiled"}


def test_jitter_of_short_episodes(spark):
    s = spark.createDataFrame([("a", 0, 5), ("b", 0, 5), ("b", 1, 5), ("c", 0, 1), ("c", 1, 4), ("c", 2, 9)], "episode_id string, seq long, timestamp_ns long")
    got = {r["episode_id"]: (r["n_samples"], r["period_ns"], r["backwards"], r["max_jitter_ns"]) for r in quality.jitter(s).collect()}
    assert got == {"a": (1, 0, 0, 0), "b": (2, 0, 1, 0), "c": (3, 4, 0, 1)}


def test_lines_of_captures_are_numbered_and_named(spark, tmp_path):
    good = '{"v": 1, "t_ns": %d, "id": 257, "data": "000150c901000099"}'
    (tmp_path / "a.canlog").write_text("\n".join([good % 5, "", good % 6]))
    (tmp_path / "b.canlog").write_text(good % 1 + "\n")
    out = canlog.read(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r["t_ns"] for r in out] == [5, 6, 1]
    (tmp_path / "b.canlog").write_text(good % 1 + "\n\nno record\n")
    with pytest.raises(Exception, match="b.canlog line 3"):
        canlog.read(spark, str(tmp_path)).collect()


def test_bad_checksums_are_kept_on_demand(spark):
    frames = spark.createDataFrame([(257, "000150c901000099", 1, 0), (257, "000150c901000098", 2, 1)], "can_id int, data string, t_ns long, seq long")
    assert canlog.samples(frames, "e")[0].count() == 1 and canlog.samples(frames, "e", keep_bad_checksums=True)[0].count() == 2
    mine = episodes.owned(canlog.samples(frames, "other", "t")[0], "e", "mine")
    assert mine.select("episode_id", "task_label").collect() == [("e", "mine")]


def test_states_are_read_from_text_or_refused(spark):
    row = ("1", "2", "3", "4", "0.5", "0", "true", "1")
    names = ", ".join(f"{c} string" for c in ("node_id", "chain_index", "angle_raw_adc", "angle_millideg", "angle_rad", "status_flags", "checksum_valid", "schema_version"))
    assert episodes.states_of(spark.createDataFrame([row], names)).collect() == [(1, 2, 3, 4, 0.5, 0, True, 1)]
    for bad in ("x", None):
        with pytest.raises(Exception):  # noqa: B017
            episodes.states_of(spark.createDataFrame([(bad, *row[1:])], names)).collect()


def test_metadata_and_absent_sidecars(spark, tmp_path):
    assert episodes.read_timing(spark, str(tmp_path), "episode_id string") is None and episodes.read_metadata(spark, str(tmp_path)) == {}
    episodes.write_metadata(spark, str(tmp_path), {"robot": "arm", "by": "x"})
    assert episodes.read_metadata(spark, str(tmp_path)) == {"robot": "arm", "by": "x"}
    with pytest.raises(ValueError):
        episodes.write_metadata(spark, str(tmp_path), {"robot": 1})


def test_strict_text_of_stamps_and_records(spark):
    read = lambda t, f: spark.createDataFrame([(t,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]
    for text in ('{"raw_ns": 5, "domain": "source"}', '{"raw_ns": 5, "domain": "source", "x": 1}'):
        assert tuple(read(text, serial.read_stamp)) == (5, "source")
    with pytest.raises(Exception, match="keys are not those"):
        read('{"raw_ns": 5, "domain": "source", "x": 1}', lambda t: serial.read(t, serial.STAMP))
    for bad in ('{"raw_ns": 5}', '{"raw_ns": 5, "domain": "lunar"}', '{"raw_ns": 0, "domain": "wall"}', "nothing", '{"raw_ns": "a", "domain": "wall"}', '{"raw_ns": null, "domain": "wall"}'):
        with pytest.raises(Exception):  # noqa: B017
            read(bad, serial.read_stamp)
    good = '{"original": {"raw_ns": 5, "domain": "wall"}, "normalized_ns": null, "flags": ["unknown_skew"], "skew_ns": null}'
    assert read(good, serial.read_record)["flags"] == ["unknown_skew"]
    for old, new in (("unknown_skew", "odd"), ('["unknown_skew"]', "[]"), ('"normalized_ns": null', '"normalized_ns": 5'), ('"wall"', '"lunar"')):
        with pytest.raises(Exception):  # noqa: B017
            read(good.replace(old, new), serial.read_record)
    two = spark.createDataFrame([((1, "wall"), (2, "wall"), (2, "source"))], "a struct<raw_ns: long, domain: string>, b struct<raw_ns: long, domain: string>, c struct<raw_ns: long, domain: string>")
    assert two.select(serial.stamp_before(F.col("a"), F.col("b"))).first()[0] is True
    with pytest.raises(Exception, match="no order"):
        two.select(serial.stamp_before(F.col("a"), F.col("c"))).collect()


def test_event_records_are_checked(spark):
    s = spark.createDataFrame([("e", 0, 0, 10, 3.0), ("e", 1, 0, 20, -9.0)], "episode_id string, seq long, chain_index int, timestamp_ns long, motor_current double")
    out = DETECTORS.make("threshold", s, threshold=2.0, confidence=0.25).orderBy("seq").collect()
    assert [(r["t_monotonic_ns"], r["confidence"], r["channel"], r["detector"], r["schema_version"], r["payload"]) for r in out] == [(10, 0.25, "motor_current", "threshold", 1, {"value": 3.0, "threshold": 2.0}), (20, 0.25, "motor_current", "threshold", 1, {"value": -9.0, "threshold": 2.0})]
    assert DETECTORS.make("noop", s).count() == 0
    for args in (dict(confidence=1.5), dict(channel="no_such"), dict(kind="wave")):
        with pytest.raises(ValueError):
            DETECTORS.make("threshold", s, **args)
    found = events.detect_threshold(s, "motor_current", 2.0)
    with pytest.raises(Exception, match="confidence"):
        events.records(found, "x", "y", F.lit(2.0), {"a": F.lit(1.0)}).collect()


BAD_FAULTS = [
    dict(kind="sneeze"), dict(kind="jitter"), dict(kind="jitter", magnitude_ns=0), dict(kind="jitter", magnitude_ns=1.5), dict(kind="drop"), dict(kind="drop", every_k=2, probability=0.5), dict(kind="drop", every_k=1), dict(kind="drop", probability=1.0),
    dict(kind="reorder", window_start=0, window_len=1), dict(kind="skewed_clock", offset_ns=0, drift_ppm=0.0), dict(kind="variable_frame_time", wobble=1.0), dict(kind="fixed_delay", delay_ns=5, wobble=0.1), dict(kind="duplicate", at_index=-1), dict(kind="burst_delay", delay_ns=1, window_start=0, window_len=True),
]


@pytest.mark.parametrize("fault", BAD_FAULTS, ids=str)
def test_faults_that_change_nothing_or_are_unknown_are_refused(fault):
    with pytest.raises(ValueError):
        faults.check_fault(fault)


def test_chains_of_faults(spark):
    n = 12
    s = spark.createDataFrame([("e", i, 1000 * (i + 1)) for i in range(n)], "episode_id string, idx long, timestamp_ns long")
    stamps = lambda *chain: [r["timestamp_ns"] for r in faults.chain(s, list(chain), 9).orderBy("idx").collect()]
    assert stamps() == [1000 * (i + 1) for i in range(n)]
    drop, swap = dict(kind="drop", probability=0.3), dict(kind="reorder", window_start=0, window_len=3)
    first = stamps(drop)
    assert 0 < len(first) < n and stamps(drop, dict(kind="fixed_delay", delay_ns=7)) == [t + 7 for t in first]
    assert sorted(stamps(swap)) == sorted(stamps()) and stamps(swap) != stamps()
    assert stamps(dict(kind="jitter", magnitude_ns=100)) != stamps(dict(kind="fixed_delay", delay_ns=1), dict(kind="jitter", magnitude_ns=100))
    for bad, why in (([dict(kind="burst_delay", window_start=n, window_len=1, delay_ns=1)], "past the end"), ([dict(kind="duplicate", at_index=n)], "past the end"), ([dict(kind="reorder", window_start=n - 1, window_len=2)], "past the end"), ([swap, dict(kind="jitter", magnitude_ns=1)], "increasing")):
        with pytest.raises(Exception, match=why):
            stamps(*bad)


def test_corrupt_frames_of_a_stream_are_counted(spark, tmp_path):
    good = '{"t_ns": 1, "id": 257, "data": "000150c901000099"}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.canlog").write_text("\n".join([good, good.replace("99", "98"), "junk", good.replace("000150c901000099", "00"), good.replace("{", '{"v": 2, ', 1), ""]))
    out = stateful.collect_available(fault_counts(SOURCES.make("stream", spark, str(tmp_path / "in"))), "frame_faults", str(tmp_path / "state"), "complete")
    assert {r["fault"]: r["n"] for r in out.collect()} == {None: 1, "checksum_invalid": 1, "not_a_record": 1, "not_8_bytes": 1, "unknown_version": 1}


def test_older_rows_are_migrated_step_by_step(spark):
    rows = spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("c", None, 30)], "name string, schema_version int, x int")
    steps = {1: lambda df: df.withColumn("x", F.col("x") + 1), 2: lambda df: df.withColumn("x", F.col("x") * 100)}
    assert {r["name"]: (r["schema_version"], r["x"]) for r in episodes.migrated(rows, steps, 3).collect()} == {"a": (3, 1100), "b": (3, 2000), "c": (3, 3100)}
    with pytest.raises(ValueError, match="from version 2"):
        episodes.migrated(rows, {1: steps[1]}, 3)
    with pytest.raises(Exception, match="newer"):
        episodes.migrated(rows, {}, 1).collect()


def test_frames_in_memory_are_replayed(spark):
    frames = [(257, "000150c901000099"), (258, "000150c90200009a")]
    assert [tuple(r) for r in SOURCES.make("memory", spark, frames, 100, 10).orderBy("seq").collect()] == [(257, frames[0][1], 100, 0), (258, frames[1][1], 110, 1)]
    with pytest.raises(ValueError, match="frames"):
        SOURCES.make("memory", spark, [], 1, 1)
