"""Strict text forms (JSON) of stamps, records and timing summaries: what is read back is what was written, or it raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.values import checked_stamp
from tickloom.schema import FLAGS, VERDICTS

#: Clock domains (fixed values).
DOMAINS = ["monotonic", "source", "wall"]

STAMP = "raw_ns long, domain string"
RECORD = "original struct<raw_ns: long, domain: string>, normalized_ns long, flags array<string>, skew_ns long"
TIMING = (
    "episode_id long, modality string, clean long, flagged long, matched long, out_of_budget long, no_target long, offset_min_ns long, offset_max_ns long, offset_mean_ns double"
)

SCORE = "kind string, tp long, fp long, fn long, precision double, recall double, f1 double"
PHASE = "kind string, start_s double, duration_s double"
#: Kinds of a script's phases (fixed values).
PHASE_KINDS = ["approach", "contact_start", "slip", "impact", "release", "settle"]
REPORT = "episode_id long, verdict string, gate_passed boolean, total_records long, violations long, flagged long, total_results long, non_matched long, max_abs_offset_ns long, p95_abs_offset_ns long, p99_abs_offset_ns long, mean_abs_offset_ns double"


def _columns(schema: str) -> list[str]:
    return StructType.fromDDL(schema).fieldNames()


def written(schema: str) -> Column:
    """The columns of ``schema`` as one line of JSON, nulls included."""
    return F.to_json(F.struct(*_columns(schema)), {"ignoreNullFields": "false"})


def read(text: Column, schema: str, more: bool = False) -> Column:
    """A struct of ``schema`` from its text; raises for missing keys, for values of other types and, unless ``more`` keys
    may be there, for unknown ones."""
    names = F.array(*[F.lit(c) for c in _columns(schema)])
    keys = F.json_object_keys(text)
    wrong = keys.isNull() | (F.size(F.array_except(names, keys)) > 0)
    if not more:
        wrong = wrong | (F.size(F.array_except(keys, names)) > 0)
    strict = F.when(~wrong, text).otherwise(F.raise_error(F.concat(F.lit("keys are not those of the schema: "), F.coalesce(text, F.lit("null")))))
    return F.from_json(strict, schema, {"mode": "FAILFAST"})


def read_stamp(text: Column) -> Column:
    """``raw_ns, domain`` of a stamp; raises for an unknown domain and for stamps out of range too."""
    s = read(text, STAMP, more=True)
    domain = F.when(s["domain"].isin(DOMAINS), s["domain"]).otherwise(F.raise_error(F.concat(F.lit("unknown clock domain in "), text)))
    ns = F.coalesce(s["raw_ns"], F.raise_error(F.concat(F.lit("no stamp in "), text)))
    return F.struct(checked_stamp(ns).alias("raw_ns"), domain.alias("domain"))


def read_record(text: Column) -> Column:
    """A normalised record; raises for unknown flags, and unless it has either a normalised stamp or a flag."""
    r = read(text, RECORD, more=True)
    fine = r["flags"].isNotNull() & (F.size(F.array_except(r["flags"], F.array(*map(F.lit, FLAGS)))) == 0) & (r["normalized_ns"].isNull() == (F.size(r["flags"]) > 0))
    fine = fine & r["original"]["domain"].isin(DOMAINS) & (r["original"]["raw_ns"] >= 1)
    return F.when(fine, r).otherwise(F.raise_error(F.concat(F.lit("no normalised record: "), text)))


def stamp_before(a: Column, b: Column) -> Column:
    """Whether stamp ``a`` is earlier than ``b``; raises across clock domains, where that has no meaning."""
    return F.when(a["domain"] == b["domain"], a["raw_ns"] < b["raw_ns"]).otherwise(F.raise_error(F.lit("stamps of two clock domains have no order")))


def _checked(text: Column, schema: str, fine, what: str) -> Column:
    """What ``read`` gives, if it is ``fine``; raises otherwise."""
    r = read(text, schema)
    return F.when(fine(r), r).otherwise(F.raise_error(F.concat(F.lit(f"no {what}: "), text)))


def read_score(text: Column) -> Column:
    """A row of scores; raises for counts below zero and for ratios that do not follow from the counts."""

    def fine(r: Column) -> Column:
        share = lambda part, whole: F.when(whole == 0, 1.0).otherwise(part / whole)
        p, q = share(r["tp"], r["tp"] + r["fp"]), share(r["tp"], r["tp"] + r["fn"])
        f1 = F.when(p + q == 0, 0.0).otherwise(2 * p * q / (p + q))
        near = lambda a, b: F.abs(a - b) <= 1e-12
        return F.coalesce((F.least(r["tp"], r["fp"], r["fn"]) >= 0) & near(r["precision"], p) & near(r["recall"], q) & near(r["f1"], f1), F.lit(False))

    return _checked(text, SCORE, fine, "score")


def read_phase(text: Column) -> Column:
    """A phase of a script; raises for unknown kinds, starts below zero and durations that are nothing or not finite."""
    finite = lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))
    return _checked(text, PHASE, lambda r: F.coalesce(r["kind"].isin(PHASE_KINDS) & finite(r["start_s"]) & finite(r["duration_s"]) & (r["start_s"] >= 0) & (r["duration_s"] > 0), F.lit(False)), "phase")


def read_report(text: Column) -> Column:
    """A row of a timing report; raises for unknown verdicts, for parts that are more than the whole, for a refused gate
    without quarantine, and for offsets out of order."""

    def fine(r: Column) -> Column:
        known = r["verdict"].isin(VERDICTS) & r["gate_passed"].isNotNull()
        parts = (r["flagged"].between(0, r["total_records"])) & (r["violations"].between(0, r["flagged"])) & (r["non_matched"].between(0, r["total_results"]))
        matched = r["total_results"] > r["non_matched"]
        offsets = [r[c] for c in ("p95_abs_offset_ns", "p99_abs_offset_ns", "max_abs_offset_ns", "mean_abs_offset_ns")]
        order = F.when(matched, (offsets[0] >= 0) & (offsets[0] <= offsets[1]) & (offsets[1] <= offsets[2]) & offsets[3].between(0, offsets[2])).otherwise(offsets[0].isNull() & offsets[1].isNull() & offsets[2].isNull() & offsets[3].isNull())
        return F.coalesce(known & parts & order & (r["gate_passed"] | (r["verdict"] == "quarantined")), F.lit(False))

    return _checked(text, REPORT, fine, "report")
