import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions import serial

SCORE = {"kind": "slip", "tp": 2, "fp": 2, "fn": 0, "precision": 0.5, "recall": 1.0, "f1": 2 / 3}
PHASE = {"kind": "slip", "start_s": 0.5, "duration_s": 0.25}
REPORT = {
    "episode_id": 1, "verdict": "degraded", "gate_passed": True, "total_records": 9, "violations": 1, "flagged": 2, "total_results": 4, "non_matched": 1, "max_abs_offset_ns": 9, "p95_abs_offset_ns": 5, "p99_abs_offset_ns": 9, "mean_abs_offset_ns": 3.5,
}
CASES = {serial.read_score: SCORE, serial.read_phase: PHASE, serial.read_report: REPORT}


def load(spark, reader, row):
    return spark.createDataFrame([(json.dumps(row),)], "text string").select(reader(F.col("text")).alias("r")).first()["r"].asDict()


def test_good_rows_come_back(spark):
    for reader, row in CASES.items():
        assert load(spark, reader, row) == row
    assert load(spark, serial.read_score, {"kind": None, "tp": 0, "fp": 0, "fn": 0, "precision": 1.0, "recall": 1.0, "f1": 1.0})["kind"] is None
    empty = REPORT | {"non_matched": 4} | {k: None for k in REPORT if "offset" in k}
    assert load(spark, serial.read_report, empty) == empty


@pytest.mark.parametrize("reader,change", [
    (serial.read_score, {"tp": -1}), (serial.read_score, {"precision": 0.6}), (serial.read_score, {"f1": None}), (serial.read_score, {"more": 1}),
    (serial.read_phase, {"kind": "dance"}), (serial.read_phase, {"duration_s": 0.0}), (serial.read_phase, {"start_s": -1.0}), (serial.read_phase, {"start_s": None}),
    (serial.read_report, {"verdict": "fine"}), (serial.read_report, {"flagged": 10}), (serial.read_report, {"violations": 3}), (serial.read_report, {"gate_passed": False}), (serial.read_report, {"p95_abs_offset_ns": 10}), (serial.read_report, {"non_matched": 4}), (serial.read_report, {"mean_abs_offset_ns": 9.5}),
])
def test_bad_rows_are_refused(spark, reader, change):
    with pytest.raises(Exception, match="no (score|phase|report)|keys are not"):
        load(spark, reader, CASES[reader] | change)
