"""Checks, report tables, scripts, descriptions and streams beside the registered queries."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions import checks
from tickloom.operators import align, bench, events, scoring
from tickloom.schema import QUALITIES
from tickloom.sources import description, episodes
from tickloom.streaming import stateful

REPORT = "name string, episode_id long, verdict string, violations long, flagged long, total_records long, non_matched long, total_results long, max_abs_offset_ns long, p95_abs_offset_ns long, p99_abs_offset_ns long, events_matched long, events_total long, deterministic boolean, round_trips boolean, failures string"
GOOD = ("a", 2, "degraded", 0, 1, 10, 2, 8, 5, 4, 5, 3, 4, True, True, "")


@pytest.mark.parametrize("value", [True, 1.0, "1", None, -1, 1 << 63])
def test_parameters_that_are_no_whole_numbers(value):
    with pytest.raises(ValueError, match="skew must be"):
        checks.whole_number(value, "skew")


@pytest.mark.parametrize("value", [True, "0.5", 1.5, -0.1, float("nan")])
def test_parameters_that_are_no_proportions(value):
    with pytest.raises(ValueError, match="share must be"):
        checks.proportion(value, "share")


def test_good_parameters_pass():
    assert (checks.whole_number(0, "n"), checks.whole_number((1 << 63) - 1, "n"), checks.proportion(1, "p")) == (0, (1 << 63) - 1, 1.0)


@pytest.mark.parametrize(
    ("check", "good", "bad"),
    [
        (lambda c: checks.member(c, QUALITIES, "quality"), ["'matched'", "'no_target'"], ["'Matched'", "cast(null as string)", "''"]),
        (lambda c: checks.count(c, "n"), ["0L", "9L"], ["-1L", "cast(null as long)"]),
        (lambda c: checks.offset(c, "d"), ["-9223372036854775807L", "cast(null as long)"], ["(-9223372036854775807L - 1L)"]),
        (lambda c: checks.ratio(c, "r"), ["0.0d", "1.0d"], ["1.1d", "double('NaN')", "cast(null as double)"]),
    ],
)
def test_column_checks(spark, check, good, bad):
    for x in good:
        r = spark.range(1).select(F.expr(x).alias("x")).select("x", check(F.col("x")).alias("y")).first()
        assert r["x"] == r["y"]
    for x in bad:
        with pytest.raises(Exception, match="must be"):
            spark.range(1).select(F.expr(x).alias("x")).select(check(F.col("x"))).collect()


def test_alignment_and_matching_check_their_parameters(spark):
    refs = spark.createDataFrame([(1, 5)], "episode_id long, ns long")
    targets = refs.withColumn("modality", F.lit("m"))
    for bad in (-1, True, 1.5):
        with pytest.raises(ValueError, match="max_skew_ns"):
            align.align_nearest(refs, targets, bad, ["m"])
        with pytest.raises(ValueError, match="window_ns"):
            align.align_window(refs, targets, bad, ["m"])
        with pytest.raises(ValueError, match="tolerance_ns"):
            scoring.match(refs, refs, bad)
    with pytest.raises(ValueError, match="window_ns"):
        align.align_window(refs, targets, 0, ["m"])


def test_table_of_reports(spark, tmp_path):
    rows = [("b", None, None, *[None] * 10, None, None, "no_report"), GOOD, ("a", 10, *GOOD[2:8], None, None, None, 0, 0, False, False, "not_deterministic,no_round_trip")]
    gated = spark.createDataFrame(rows, REPORT)
    lines = [r["line"] for r in bench.table_lines(gated).orderBy("number").collect()]
    assert lines[0].count("|") == lines[1].count("|") == len(bench.TABLE) + 1
    assert lines[2:] == [
        "| a | 2 | degraded | 0 | 1/10 | 2/8 | 5 | 4 | 5 | 3/4 | yes | ok | - |",
        "| a | 10 | degraded | 0 | 1/10 | 2/8 | - | - | - | 0/0 | NO | FAIL | not_deterministic,no_round_trip |",
        "| b | - | - | - | -/- | -/- | - | - | - | -/- | - | - | no_report |",
    ]
    bench.write_table(gated, str(tmp_path / "table"))
    assert "\n".join(p.read_text().rstrip("\n") for p in sorted((tmp_path / "table").glob("part-*")) if p.stat().st_size).split("\n") == lines


def test_exit_status(spark):
    good = spark.createDataFrame([GOOD], REPORT)
    assert bench.exit_status(good) == 0
    assert bench.exit_status(good.where("false")) == 1
    for failure in ("violations:1", None):
        assert bench.exit_status(good.unionByName(good.withColumn("failures", F.lit(failure)))) == 1


def test_streams_of_an_episode_and_what_survives(spark):
    rows = [(1, 0, 0, 10, None), (1, 1, 1, 11, "slip"), (1, 2, 2, 12, None), (1, 3, 1, 9, None), (1, 4, 1, 20, "slip"), (1, 5, 7, 30, "slip"), (2, 0, 0, 5, None)]
    given = bench.episode_streams(spark.createDataFrame(rows, "episode_id long, seq long, chain_index int, timestamp_ns long, tactile_event string"))
    assert {k: df.count() for k, df in given.items()} == {"proprio": 2, "tactile": 3, "frames": 1, "events": 2}
    late = given | {"proprio": given["proprio"].where("episode_id = 1")}
    got = {(r["episode_id"], r["stream"]): (r["given"], r["delivered"], r["surviving"]) for r in bench.survival(given, late).collect()}
    assert got == {(1, "proprio"): (1, 1, 1), (1, "tactile"): (3, 3, 2), (1, "frames"): (1, 1, 1), (1, "events"): (2, 2, 2), (2, "proprio"): (1, 0, 0)}


def test_scripts_are_judged_apart(spark):
    rows = [("x", 0, "approach", 0.0, 1.0), ("x", 1, "contact_start", 1.0, 1.0), ("x", 2, "release", 2.0, 1.0), ("y", 0, "contact_start", 0.0, 1.0), ("y", 1, "settle", 1.5, 1.0)]
    phases = spark.createDataFrame(rows, "script string, phase_ix int, kind string, start_s double, duration_s double")
    assert [tuple(r) for r in events.check_phases(phases, ("script",)).collect()] == [("y", 1, "not_tiled")]
    assert events.check_phases(phases.where("script = 'x'").drop("script")).isEmpty()


def test_description_is_read_as_written(spark, tmp_path):
    joints = spark.createDataFrame([("j&1", "revolute", "base", "a", [0.0, 0.1, 1.0], -1.5, 2.0), ("f", "fixed", "a", "tip", [1.0, 0.0, 0.0], None, None)], "name string, kind string, parent string, child string, axis array<double>, lower double, upper double")
    links = spark.createDataFrame([("base",), ("a",), ("tip",)], "name string")
    description.write(joints, links, str(tmp_path / "robot"))
    back = description.joints(spark, str(tmp_path / "robot" / "joints"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, joints.collect()), key=str)
    assert description.links(spark, str(tmp_path / "robot" / "links")).exceptAll(links).isEmpty()
    assert description.faults(back, links).isEmpty()


def test_stamps_of_states_by_either_name(spark):
    own = "'1' node_id, '0' chain_index, '2' angle_raw_adc, '3' angle_millideg, '0.5' angle_rad, '0' status_flags, 'true' checksum_valid, '1' schema_version"
    state = lambda more: episodes.states_of(spark.range(1).selectExpr(*own.split(", "), *more), stamped=True).first()["header_stamp_ns"]
    assert state([]) == 0
    assert state(["'7' header_stamp"]) == 7
    assert state(["'7' header_stamp", "'8' header_stamp_ns"]) == 8
    assert state(["'7' header_stamp", "cast(null as string) header_stamp_ns"]) == 7
    for bad in (["'7.5e' header_stamp"], ["'now' header_stamp_ns", "'7' header_stamp"]):
        with pytest.raises(Exception, match="no long as header_stamp"):
            state(bad)


def test_latest_of_a_stream_over_several_batches(spark, tmp_path):
    schema = "k long, seq long, x double"
    for n, rows in enumerate([[(1, 0, 0.5), (2, 1, 1.5)], [(1, 2, 2.5)], [(3, 3, None), (1, 1, 9.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"b={n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    got = stateful.latest_available(stream, ["k"], str(tmp_path / "out"))
    assert sorted(map(tuple, got.select("k", "seq", "x").collect())) == [(1, 2, 2.5), (2, 1, 1.5), (3, 3, None)]


def test_latest_of_an_empty_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("k long, seq long").parquet(str(tmp_path / "in"))
    assert stateful.latest_available(stream, ["k"], str(tmp_path / "out")).isEmpty()
