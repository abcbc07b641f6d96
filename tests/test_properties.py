"""Window and join forms against sequential folds in plain Python, on seeded random data."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import align, events, faults, frames, quality, scoring, timeline

NAN = float("nan")


def rows_of(seed, n=400):
    r = random.Random(seed)
    out = []
    for e in range(4):
        t = 10**9
        for i in range(n // 4):
            t += r.choice([0, -5, 1, 7, 7, 7, 50])
            out.append((e, i, r.randrange(3), t, r.choice([None, NAN, 0.0, 0.2, 0.5, 0.8, 1.0, 1.5, -2.0])))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "episode_id long, seq long, chain_index int, timestamp_ns long, value double").repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_normalisation_equals_a_fold(spark, seed):
    rows = rows_of(seed)
    want, top = {}, {}
    for e, i, _, t, _ in rows:
        late = e in top and t <= top[e]
        want[e, i] = (None, ["backwards_in_source"]) if late else (t, [])
        top[e] = max(top.get(e, t), t)
    got = {(r["episode_id"], r["seq"]): (r["normalized_ns"], r["flags"]) for r in timeline.normalize(table(spark, rows)).collect()}
    assert got == want


def test_source_offsets_out_of_range(spark):
    rows = [(0, i, 0, t, 0.0) for i, t in enumerate([5, 20, (1 << 63) - 5])]
    d = table(spark, rows)
    up = {r["seq"]: (r["normalized_ns"], r["flags"]) for r in timeline.normalize(d, "source", 10).collect()}
    assert up == {0: (15, []), 1: (30, []), 2: (None, ["skew_out_of_range"])}
    down = {r["seq"]: r["normalized_ns"] for r in timeline.normalize(d, "source", -10).collect()}
    assert down == {0: None, 1: 10, 2: (1 << 63) - 15}
    assert all(r["flags"] == ["unknown_skew"] and r["normalized_ns"] is None for r in timeline.normalize(d, "source").collect())
    with pytest.raises(ValueError):
        timeline.normalize(d, "wall")


@pytest.mark.parametrize("onset,release", [(0.8, 0.2), (0.5, 0.5), (1.0, 0.0)])
def test_contacts_equal_a_fold(spark, onset, release):
    rows = rows_of(3)
    want, held = [], {}
    for e, i, _, _, v in rows:
        if v is None or v != v:
            continue
        v = abs(v)
        if not held.get(e) and v >= onset:
            held[e] = True
            want.append((e, i, "contact_start"))
        elif held.get(e) and v <= release:
            held[e] = False
            want.append((e, i, "contact_release"))
    got = events.detect_contact(table(spark, rows), F.abs("value"), onset, release)
    assert sorted((r["episode_id"], r["seq"], r["kind"]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("refractory", [0, 20, 100])
def test_impacts_equal_a_fold(spark, refractory):
    rows = rows_of(4)
    want, last, fired = [], {}, {}
    for e, i, c, t, v in rows:
        p = last.get((e, c))
        if v is not None and p is not None and abs(v - p) >= 0.9 and (refractory <= 0 or (e, c) not in fired or t - fired[e, c] >= refractory):
            fired[e, c] = t
            want.append((e, i))
        last[e, c] = v
    got = events.detect_impact(table(spark, rows), "value", 0.9, refractory)
    assert sorted((r["episode_id"], r["seq"]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("tolerance", [0, 30, 1000])
def test_greedy_matching_equals_a_fold(spark, tolerance):
    r = random.Random(5)
    side = lambda n, o: [(r.randrange(2), r.choice("ab"), r.randrange(3000), o + i) for i in range(n)]
    truth, found = side(120, 0), side(150, 1000)
    pairs = sorted((abs(t[2] - f[2]), t[2], t[3], f[2], f[3], t[0], t[1]) for t in truth for f in found if t[:2] == f[:2] and abs(t[2] - f[2]) <= tolerance)
    used, want = set(), set()
    for _, _, i, _, j, _, _ in pairs:
        if i not in used and j not in used:
            used |= {i, j}
            want.add((i, j))
    make = lambda x: spark.createDataFrame(x, "episode_id long, kind string, t_ns long, ix long")
    got = scoring.match(make(truth), make(found), tolerance)
    assert {(r["truth_ix"], r["found_ix"]) for r in got.collect()} == want


def test_scores_without_events(spark):
    none = spark.createDataFrame([], "episode_id long, kind string, t_ns long, ix long")
    one = spark.createDataFrame([(1, "a", 5, 0)], none.schema)
    (r,) = scoring.score(one, none, 10).where("kind = 'a'").collect()
    assert (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"], r["f1"]) == (0, 0, 1, 1.0, 0.0, 0.0)


@pytest.mark.parametrize("skew", [0, 4, 50])
def test_nearest_equals_brute_force(spark, skew):
    r = random.Random(6)
    refs = [(e, r.randrange(1, 400)) for e in range(3) for _ in range(30)]
    targets = [(e, m, r.randrange(1, 400)) for e in (0, 1) for m in "ab" for _ in range(25) if (e, m) != (1, "b")]
    got = align.align_nearest(spark.createDataFrame(refs, "episode_id long, ns long"), spark.createDataFrame(targets, "episode_id long, modality string, ns long"), skew, ["a", "b"])
    want = []
    for e, t in refs:
        for m in "ab":
            near = sorted({(abs(x - t), x) for e2, m2, x in targets if (e2, m2) == (e, m)})
            if not near:
                want.append((e, m, t, None, "no_target", False))
            elif near[0][0] > skew:
                want.append((e, m, t, None, "out_of_budget", False))
            else:
                want.append((e, m, t, near[0][1], "matched", len(near) > 1 and near[1][0] == near[0][0]))
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["episode_id"], r["modality"], r["ref_ns"], r["matched_ns"], r["quality"], r["tie"]) for r in got.collect()), key=key) == sorted(want, key=key)


def test_window_ends_are_closed(spark):
    refs = spark.createDataFrame([(0, 100), (0, 500)], "episode_id long, ns long")
    targets = spark.createDataFrame([(0, "m", x) for x in (90, 110, 89, 111, 100)], "episode_id long, modality string, ns long")
    got = sorted((r["ref_ns"], r["matched_ns"] or 0, r["quality"]) for r in align.align_window(refs, targets, 10).collect())
    assert got == [(100, 90, "matched"), (100, 100, "matched"), (100, 110, "matched"), (500, 0, "no_target")]


def test_percentile_ranks(spark):
    n = spark.range(1, 21).select("id", quality.percentile_rank(F.col("id")).alias("even"), quality.nearest_rank(F.col("id"), 95.0).alias("up"))
    import math

    for r in n.collect():
        assert r["even"] == min(max(round(0.99 * r["id"]), 1), r["id"]) and r["up"] == math.ceil(95 / 100 * r["id"])


def test_unanimity_counts_null(spark):
    rows = [(0, 1, 0, 0, "x"), (0, 1, 1, 1, "x"), (0, 2, 0, 2, "x"), (0, 2, 1, 3, None), (0, 3, 0, 4, None), (0, 3, 1, 5, None)]
    df = spark.createDataFrame(rows, "episode_id long, timestamp_ns long, chain_index int, seq long, tactile_event string").select("*", *[F.lit(1.0).alias(c) for c in frames.ARRAYS.values()], F.lit("c").alias("camera_frame_id"))
    assert {r["timestamp_ns"]: r["tactile_event"] for r in frames.pivot(df).collect()} == {1: "x", 2: None, 3: None}


def test_drawn_faults_keep_order_or_count(spark):
    s = spark.range(50).select(F.lit("e").alias("episode_id"), F.col("id").alias("idx"), (F.lit(10**9) + F.col("id") * 1000).alias("timestamp_ns"))
    jit = [r["timestamp_ns"] for r in faults.jitter(s, 5000, 3).orderBy("idx").collect()]
    assert all(a < b for a, b in zip(jit, jit[1:], strict=False))
    re = [r["timestamp_ns"] for r in faults.reorder(s, 10, 8, 3).orderBy("idx").collect()]
    assert sorted(re) == [r["timestamp_ns"] for r in s.orderBy("idx").collect()] != re
    assert 0 < faults.drop_randomly(s, 0.5, 3).count() < 50
    with pytest.raises(Exception, match="out of range"):
        faults.fixed_delay(s, -(10**10)).collect()


def test_running_totals_equal_a_fold(spark):
    from tickloom.operators.ordered import running

    r = random.Random(8)
    rows = [(i, r.randrange(10**6), r.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, o long, n long").repartition(5)
    got = {x["id"]: (x["number"], x["before"]) for x in running(df, ["o", "id"], {"before": F.col("n")}).collect()}
    want, total = {}, 0
    for k, (i, _, n) in enumerate(sorted(rows, key=lambda x: (x[1], x[0]))):
        want[i] = (k, total)
        total += n
    assert got == want and running(df.limit(0), ["o"], {}).count() == 0


def test_replayed_frames_get_fresh_stamps(spark):
    from tickloom.sources import canlog

    f = spark.createDataFrame([(1, "00" * 8, 99, 5), (1, "00" * 8, 7, 9)], "can_id int, data string, t_ns long, seq long")
    assert [r["t_ns"] for r in canlog.replay(f, 100, 10).orderBy("seq").collect()] == [100, 110]
