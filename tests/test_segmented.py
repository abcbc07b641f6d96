"""Scans over ranges against folds and against the operators that hold an episode in one task."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import align, bench, events, meta, scoring, segmented, timeline

NAN = float("nan")


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def long_episode(seed, n=300):
    r = random.Random(seed)
    t, out = 10**9, []
    for e, size in (("long", n), ("short", 7), (None, 40)):
        for i in range(size):
            t += r.choice([0, -30, 1, 7, 7, 50])
            out.append((e, i, t, r.choice([None, NAN, 0.0, 0.4, 0.5, 0.5, 0.6, 1.0])))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "episode_id string, seq long, timestamp_ns long, value double").repartition(5)


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("seed", range(2))
def test_one_episode_over_many_ranges(spark, many_ranges, seed):
    s = frame(spark, long_episode(seed))
    assert segmented.dealt(s, ["episode_id"], ["seq"]).where("episode_id = 'long'").select(segmented.RANGE).distinct().count() > 4
    assert rows(timeline.normalize(s, long=True)) == rows(timeline.normalize(s))
    for onset, release in ((0.5, 0.5), (0.6, 0.4), (1.0, 0.0)):
        assert rows(events.detect_contact(s, F.col("value"), onset, release, long=True)) == rows(events.detect_contact(s, F.col("value"), onset, release))
    named = s.withColumn("ns", F.col("timestamp_ns"))
    refs = named.where("seq % 3 = 0")
    targets = named.where("seq % 3 > 0").withColumn("modality", F.when(F.col("seq") % 3 == 1, "a").otherwise("b"))
    for skew in (8, 10**6):
        kinds = ["a", "b", "none"]
        assert rows(align.align_nearest(refs, targets, skew, kinds, long=True)) == rows(align.align_nearest(refs, targets, skew, kinds))


def test_ranges_that_only_turn_the_state_over(spark, many_ranges):
    """Long runs without a decisive reading: each range hands on the parity of its turns."""
    values = [1.0] + [0.5] * 100 + [None] * 30 + [0.5] * 41 + [0.0] + [0.5] * 60
    s = frame(spark, [("e", i, 10**9 + i, v) for i, v in enumerate(values)])
    state, want = 0, []
    for i, v in enumerate(values):
        was = state
        if v is not None:
            state = 1 if v > 0.5 else 0 if v < 0.5 else 1 - state
        if state != was:
            want.append((i, "contact_start" if state else "contact_release"))
    got = events.detect_contact(s, F.col("value"), 0.5, 0.5, long=True)
    assert sorted((r["seq"], r["kind"]) for r in got.collect()) == want


def greedy(truth, found, tolerance):
    pairs = sorted((abs(t - f), t, i, f, j) for e, t, i in truth for g, f, j in found if e == g and abs(t - f) <= tolerance)
    ts, fs, out = set(), set(), set()
    for d, _, i, _, j in pairs:
        if i not in ts and j not in fs:
            ts.add(i)
            fs.add(j)
            out.add((i, j, d))
    return out


def sides(spark, truth, found):
    make = lambda x: spark.createDataFrame([(e, "slip", t, i) for e, t, i in x], "episode_id long, kind string, t_ns long, ix long").repartition(3)
    return make(truth), make(found)


@pytest.mark.parametrize("seed,n,spread,tolerance,rounds", [(1, 120, 400, 9, 12), (2, 150, 60, 9, 12), (3, 60, 25, 30, 12), (4, 80, 80, 5, 1), (5, 0, 10, 5, 12)])
def test_rounds_of_best_partners_are_greedy_matches(spark, many_ranges, seed, n, spread, tolerance, rounds):
    r = random.Random(seed)
    truth, found = ([(r.choice([0, 0, 0, 1]), r.randrange(spread), k * 1000 + i) for i in range(n)] for k in (0, 1))
    t, f = sides(spark, truth, found)
    want = set().union(*[greedy([x for x in truth if x[0] == e], [x for x in found if x[0] == e], tolerance) for e in (0, 1)])
    got = scoring.match(t, f, tolerance, rounds).collect()
    assert {(x["truth_ix"], x["found_ix"], x["dist"]) for x in got} == want and len(got) == len(want)
    assert sorted(map(tuple, scoring.walked(t, f, tolerance).collect())) == sorted(map(tuple, got))


def test_a_row_of_equal_distances_is_left_to_the_walk(spark):
    truth, found = [(0, 20 * i, i) for i in range(40)], [(0, 20 * i + 10, i) for i in range(40)]
    got = scoring.match(*sides(spark, truth, found), 10, 3).collect()
    assert sorted((x["truth_ix"], x["found_ix"]) for x in got) == [(i, i) for i in range(40)]


def fired(times, refractory):
    out, last = [], None
    for i, t in enumerate(times):
        if last is None or t - last >= refractory:
            out.append(i)
            last = t
    return out


@pytest.mark.parametrize("seed", range(2))
def test_refractory_impacts_by_doubling(spark, seed):
    """Bursts, pauses, repeated and backwards stamps; every row is a candidate."""
    r = random.Random(seed)
    data, want = [], set()
    for chain in range(3):
        t, times = 10**6, []
        for i in range(90):
            t += r.choice([1, 2, 3, 3, 0, -8, 40 if seed % 2 else 4])
            times.append(t)
            data.append(("e", chain, i, t, float(i % 2) * 5))
        hits = times[1:]
        want |= {(chain, i + 1) for i in fired(hits, 11)}
    s = spark.createDataFrame(data, "episode_id string, chain_index int, seq long, timestamp_ns long, value double").repartition(3)
    got = events.detect_impact(s, "value", 5.0, 11)
    assert got.columns == events.detect_impact(s, "value", 5.0).columns
    assert {(x["chain_index"], x["seq"]) for x in got.collect()} == want


def test_strict_alignment_refuses_bad_timelines(spark):
    make = lambda stamps, m: spark.createDataFrame([(1, m, i, t) for i, t in enumerate(stamps)], "episode_id long, modality string, seq long, ns long")
    good = make([5, 10, 20], "a")
    for bad, why in (([5, 5, 9], "repeated stamp"), ([5, 9, 7], "out of order"), ([0, 4], "no stamp"), ([3, None], "no stamp")):
        for f in (lambda a, b: align.align_nearest(a, b, 3, ["a"], strict=True), lambda a, b: align.align_exact(a, b, ["a"], strict=True), lambda a, b: align.align_window(a, b, 3, ["a"], strict=True)):
            for refs, targets in ((good, make(bad, "a")), (make(bad, "a"), good)):
                with pytest.raises(Exception, match=why):
                    f(refs, targets).collect()
    assert align.align_nearest(good, good, 0, ["a"], strict=True).where("quality = 'matched'").count() == 3


def test_digests_tell_contents_apart(spark):
    a = spark.createDataFrame([(1, "x", 0.5), (2, None, NAN), (2, None, NAN)], "k long, s string, v double")
    row = lambda df: tuple(bench.digest(df).first())
    assert row(a) == row(a.repartition(7).select("v", "k", "s"))
    assert len({row(x) for x in (a, a.distinct(), a.limit(0), a.withColumn("k", F.col("k") + 1), a.withColumn("s", F.lit("")), a.withColumnRenamed("s", "t"))}) == 6
    runs = bench.run_digests({"same": lambda: a, "shaken": lambda: a.withColumn("v", F.rand())})
    assert {r["name"]: (r["rows"], r["same"]) for r in runs.collect()} == {"same": (3, True), "shaken": (3, False)}


def test_a_random_case_is_not_deterministic(spark):
    case = lambda df: lambda: df.withColumn("v", F.rand())
    ids = spark.range(5).withColumnRenamed("id", "episode_id")
    got = bench.suite({"fixed": lambda: ids.withColumn("v", F.col("episode_id") * 0.1), "random": case(ids)})
    assert {(r["name"], r["deterministic"], r["round_trips"]) for r in got.collect()} == {("fixed", True, True), ("random", False, True)}


def test_summaries_count_what_occurs(spark):
    records = spark.createDataFrame([("e", "m", 5, []), ("e", "m", None, ["unknown_skew", "backwards_in_source"]), ("e", "m", None, ["unknown_skew"])], "episode_id string, modality string, normalized_ns long, flags array<string>")
    results = spark.createDataFrame([("e", "m", 0, "exact", "matched"), ("e", "m", None, "nearest", "no_target"), ("e", "o", None, "window", "no_target")], "episode_id string, modality string, offset_ns long, method string, quality string")
    got = {r["modality"]: r for r in meta.summary(records, results).collect()}
    assert list(got["m"]["flag_counts"].items()) == [("backwards_in_source", 1), ("unknown_skew", 2)] and got["o"]["flag_counts"] == {}
    assert got["m"]["method_counts"] == {"exact": 1, "nearest": 1} and got["o"]["quality_counts"] == {"no_target": 1}
    faults = {(r["modality"], r["fault"]) for r in meta.summary_faults(meta.summary(records, results)).collect()}
    assert faults == {("o", "no_records")}


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString().lower()


def test_no_frame_ends_with_the_last_row(spark, many_ranges):
    """Such a frame is computed anew for every row: the square of a range, or of an episode."""
    s = frame(spark, long_episode(3)).withColumn("ns", F.col("timestamp_ns"))
    targets = s.where("seq % 3 > 0").withColumn("modality", F.lit("a"))
    for long in (False, True):
        plan = plan_of(align.align_nearest(s.where("seq % 3 = 0"), targets, 8, ["a"], long=long))
        assert "rangeframe" in plan and "unboundedfollowing" not in plan
    assert "unboundedfollowing" not in plan_of(align.bracket(s.where("seq % 3 = 0"), targets, "value"))


def test_refractory_impacts_follow_their_steps_inside_ranges(spark, monkeypatch):
    """One burst of one chain over all ranges: few candidates are left to the rounds of joins, and no chain is a window."""
    s = frame(spark, [("e", i, 10**9 + 3 * i, float(i % 2) * 5) for i in range(400)]).withColumn("chain_index", F.lit(0))
    joined = []

    def kept(df):
        if "to" in df.columns and "leaves" not in df.columns:
            joined.append(df.count())
        return written(df)

    written = events.written
    monkeypatch.setattr(events, "written", kept)
    got = events.detect_impact(s, "value", 5.0, 11, long=True)
    assert sorted(x["seq"] for x in got.collect()) == list(range(1, 400, 4))
    assert joined and max(joined) < 30


def test_dense_matches_list_no_pairs(spark, many_ranges, monkeypatch):
    """Runs of one side need a round for each event where only best partners are taken, and copies at one time too; both were
    left to a walk over all pairs of a cluster, in one task."""
    r = random.Random(8)
    rows = lambda k: [(0, 10_000 + (1 - 2 * k) * r.randrange(1, 400), 1000 * k + i) for i in range(50)] + [(0, 20_000 + 7 * k, 5000 + 1000 * k + i) for i in range(30 + k)] + [(0, r.randrange(9_000, 21_000), 9000 + 1000 * k + i) for i in range(80)]
    truth, found = rows(0), rows(1)
    monkeypatch.setattr(scoring, "candidate_pairs", lambda *_: pytest.fail("pairs are listed"))
    got = scoring.match(*sides(spark, truth, found), 500).collect()
    assert {(x["truth_ix"], x["found_ix"], x["dist"]) for x in got} == greedy(truth, found, 500) and len(got) > 100


@pytest.mark.parametrize("seed", range(30))
def test_what_a_stretch_settles_does_not_depend_on_others(seed):
    r = random.Random(seed)
    events = sorted((r.randrange(300), r.random() < 0.5, i) for i in range(60))
    events = [e for k, e in enumerate(events) if k == 0 or e[0] > events[k - 1][0]]
    whole, _ = scoring.greedy([e[0] for e in events], [e[1] for e in events], [[e[2]] for e in events], 9)
    cut = len(events) // 2
    for part, outside in ((events[:cut], (None, events[cut][0])), (events[cut:], (events[cut - 1][0], None))):
        pairs, waiting = scoring.greedy([e[0] for e in part], [e[1] for e in part], [[e[2]] for e in part], 9, *outside)
        own = {(part[t][2], part[f][2]) for t, f, _ in pairs}
        assert own <= {(events[t][2], events[f][2]) for t, f, _ in whole}
        there = {e[2] for e in part}
        settled = there - {part[i][2] for i, _, _ in waiting}
        assert own == {(events[t][2], events[f][2]) for t, f, _ in whole if {events[t][2], events[f][2]} <= settled}
