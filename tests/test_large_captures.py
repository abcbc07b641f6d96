"""Captures cut into many byte ranges."""

import json
import random

import pytest

from tickloom.sources import canlog


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def capture(r, n):
    lines = []
    for i in range(n):
        data = bytes(r.randrange(256) for _ in range(8)).hex()
        lines.append(json.dumps({"v": 1, "t_ns": i * 1000, "id": r.randrange(2048), "data": data, "note": "x" * r.randrange(90)}))
        if r.random() < 0.1:
            lines.append(r.choice(["", "   "]))
    return lines


def test_lines_are_numbered_over_byte_ranges(spark, small_ranges, tmp_path):
    r, want, seq = random.Random(0), [], 0
    for name, n, end in (("a.canlog", 900, "\n"), ("b.canlog", 3, "\r\n"), ("c.canlog", 700, "\r\n"), ("d.canlog", 400, "\n")):
        lines = capture(r, n)
        (tmp_path / name).write_bytes((end.join(lines) + (end if name != "c.canlog" else "")).encode())
        for k, x in enumerate(lines):
            seq += 1
            want.append((x, name, k + 1, seq))
    got = canlog.numbered_lines(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30
    assert sorted(((r["value"], r["file"].rsplit("/", 1)[1], r["line"], r["seq"]) for r in got.collect()), key=lambda x: x[3]) == want
    records = [(json.loads(x)["t_ns"], json.loads(x)["data"], q) for x, _, _, q in want if x.strip()]
    assert sorted(((r["t_ns"], r["data"], r["seq"]) for r in canlog.read(spark, str(tmp_path)).collect()), key=lambda x: x[2]) == records


@pytest.mark.parametrize("bad,why", [("[1]", "not a record"), ('{"v": 2, "t_ns": 1, "id": 1, "data": "0011223344556677"}', "unknown version"), ('{"t_ns": 1, "id": 1, "data": "00"}', "not 8 bytes of hex")])
def test_a_bad_line_deep_in_a_capture_is_named(spark, small_ranges, tmp_path, bad, why):
    lines = capture(random.Random(1), 500)
    lines[777 % len(lines)] = bad
    at = lines.index(bad) + 1
    (tmp_path / "z.canlog").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match=rf"{why} in .*z\.canlog line {at}: "):
        canlog.read(spark, str(tmp_path / "z.canlog")).collect()


def test_replayed_frames_keep_their_order(spark, small_ranges, tmp_path):
    lines = capture(random.Random(2), 400)
    (tmp_path / "r.canlog").write_text("\n".join(lines))
    frames = canlog.replay(canlog.read(spark, str(tmp_path)), 5, 10)
    got = [(x["t_ns"], x["data"]) for x in frames.orderBy("seq").collect()]
    assert got == [(5 + 10 * k, json.loads(x)["data"]) for k, x in enumerate(x for x in lines if x.strip())]


def test_no_lines(spark, tmp_path):
    (tmp_path / "e.canlog").write_text("\n\n")
    assert canlog.read(spark, str(tmp_path)).count() == 0
