"""Timing reports: one row for each case, and the gate that judges them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import align, meta, quality, timeline
from tickloom.operators.ordered import running
from tickloom.session import cut_lineage


def report(reference: DataFrame, targets: dict[str, DataFrame], max_skew_ns: int, budget: quality.JitterBudget | None = None, events: DataFrame | None = None, primary: str | None = None, window_ns: int = 0, gate_on: DataFrame | None = None) -> DataFrame:
    """One row for each ``episode_id``.

    ``reference`` and ``targets``: ``episode_id, seq, timestamp_ns``.  Everything is normalised, targets are aligned with
    the reference by nearest stamp, and ``events``, if there are any, with the ``primary`` target within a window.  The
    interval gate looks at ``gate_on`` (default: the first target).
    """
    streams = {"reference": reference} | targets | ({"events": events} if events is not None else {})
    tagged = [df.select("episode_id", F.lit(k).alias("modality"), "seq", "timestamp_ns") for k, df in streams.items()]
    # Records and results are read by every figure below; written once, neither they nor the plan are repeated.
    records = cut_lineage(timeline.normalize(reduce(DataFrame.unionByName, tagged), by=("episode_id", "modality")))
    clean = timeline.split(records)[0].select("episode_id", "modality", F.col("normalized_ns").alias("ns"))
    refs = clean.where("modality = 'reference'")
    results = align.align_nearest(refs, clean.where(F.col("modality").isin(*targets)), max_skew_ns, list(targets))
    if events is not None:
        against = clean.where(F.col("modality") == (primary or next(iter(targets)))).withColumn("modality", F.lit("events"))
        results = results.unionByName(align.align_window(clean.where("modality = 'events'"), against, window_ns, ["events"]))
    results = cut_lineage(results)
    near = results.where("method <> 'window'")
    timing = cut_lineage(meta.modality_timing(records, results))
    verdict = meta.sync_verdict(timing)
    offsets = near.where("offset_ns is not null").select("episode_id", F.abs("offset_ns").alias("off"))
    ranks = quality.nearest_rank_percentiles(offsets, "off", ("episode_id",), {"p95_abs_offset_ns": 95.0, "p99_abs_offset_ns": 99.0})
    spread = offsets.groupBy("episode_id").agg(F.max("off").alias("max_abs_offset_ns"), (F.sum(F.col("off").cast("decimal(20,0)")).cast("double") / F.count("*")).alias("mean_abs_offset_ns"))
    gate = quality.recorder_gate(gate_on if gate_on is not None else next(iter(targets.values())), budget).select("episode_id", F.col("ok").alias("gate_passed"))
    backwards = records.groupBy("episode_id").agg(F.count_if(F.array_contains("flags", "backwards_in_source")).alias("violations"))
    totals = timing.groupBy("episode_id").agg(F.sum(F.col("clean") + F.col("flagged")).alias("total_records"), F.sum("flagged").alias("flagged"), F.sum(F.col("matched") + F.col("out_of_budget") + F.col("no_target")).alias("total_results"), F.sum(F.col("out_of_budget") + F.col("no_target")).alias("non_matched"))
    out = totals.join(backwards, "episode_id").join(spread, "episode_id", "left").join(ranks, "episode_id", "left").join(gate, "episode_id").join(verdict.select("episode_id", "verdict"), "episode_id")
    out = out.withColumn("verdict", F.when(~F.col("gate_passed"), "quarantined").otherwise(F.col("verdict")))
    if events is not None:
        hits = results.where("method = 'window' and quality = 'matched'").groupBy("episode_id").agg(F.countDistinct("ref_ns").alias("events_matched"))
        all_events = events.groupBy("episode_id").agg(F.count("*").alias("events_total"))
        out = out.join(all_events, "episode_id", "left").join(hits, "episode_id", "left").na.fill(0, ["events_total", "events_matched"])
        out = out.withColumn("event_accuracy", F.when(F.col("events_total") > 0, F.col("events_matched") / F.col("events_total")))
    return out


def episode_streams(samples: DataFrame, proprio: int = 0, tactile: int = 1, frames: int = 2) -> dict[str, DataFrame]:
    """The stamps of an episode's chains by stream, and as ``events`` those of the tactile chain that carry a token."""
    stamps = samples.select("episode_id", "chain_index", "seq", "timestamp_ns", "tactile_event")
    own = {name: stamps.where(F.col("chain_index") == chain) for name, chain in (("proprio", proprio), ("tactile", tactile), ("frames", frames))}
    return {k: df.select("episode_id", "seq", "timestamp_ns") for k, df in (own | {"events": own["tactile"].where("tactile_event is not null")}).items()}


def survival(given: dict[str, DataFrame], delivered: dict[str, DataFrame]) -> DataFrame:
    """``episode_id, stream, given, delivered, surviving``: stamps before and after faults, and those that normalise cleanly."""
    tagged = lambda streams: reduce(DataFrame.unionByName, [df.select("episode_id", F.lit(k).alias("stream"), "seq", "timestamp_ns") for k, df in streams.items()])
    keys = ["episode_id", "stream"]
    arrived = timeline.normalize(tagged(delivered), by=tuple(keys)).select(*keys, F.lit(0).alias("given"), F.lit(1).alias("delivered"), F.col("normalized_ns").isNotNull().cast("int").alias("surviving"))
    both = tagged(given).select(*keys, F.lit(1).alias("given"), F.lit(0).alias("delivered"), F.lit(0).alias("surviving")).unionByName(arrived)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("given", "delivered", "surviving")])


def gate(reports: DataFrame, thresholds: dict) -> DataFrame:
    """``episode_id, failures``: bounds that a report row breaks, in fixed order; empty if none."""
    over = lambda c, k: F.when(F.coalesce(F.col(c), F.lit(0)) > thresholds[k], F.concat(F.lit(f"{c}:"), F.col(c))) if k in thresholds else F.lit(None).cast("string")
    checks = [over("violations", "max_violations"), over("flagged", "max_flagged"), over("non_matched", "max_non_matched"), over("p95_abs_offset_ns", "max_p95_abs_offset_ns")]
    if "verdicts" in thresholds:
        checks.append(F.when(~F.col("verdict").isin(*thresholds["verdicts"]), F.concat(F.lit("verdict:"), F.col("verdict"))))
    return reports.select("episode_id", F.concat_ws(",", *checks).alias("failures"))


#: What the five published cases may show at most (fixed values); a bound that is null is none.
THRESHOLDS = "name string, verdicts array<string>, max_violations long, max_flagged long, max_abs_offset_ns long, max_p99_abs_offset_ns long, min_event_accuracy double"
PUBLISHED = [
    ("clean_baseline", ["aligned_within_budget"], 0, 0, 20_000_000, 20_000_000, 1.0),
    ("can_jitter_mild", ["aligned_within_budget", "degraded"], 0, 0, 200_000, 200_000, 1.0),
    ("camera_variable_33ms", ["aligned_within_budget", "degraded"], 0, 0, 2_000_000, 2_000_000, 1.0),
    ("burst_stall_200ms", ["quarantined"], 20, 20, 0, 0, 0.5),
    ("skewed_source_clock", ["quarantined"], 0, 0, None, None, 1.0),
]


def demand_clean(names: list[str]) -> list[tuple]:
    """Bounds that only cases without any violation keep."""
    if not names or len(set(names)) < len(names):
        raise ValueError("names of cases are needed, each once")
    return [(n, ["aligned_within_budget"], 0, 0, None, None, 1.0) for n in names]


def gate_cases(reports: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``reports`` (with ``name, deterministic, round_trips`` beside the columns of ``report``) with ``failures``: what a
    row breaks of its case's thresholds, in fixed order.

    A case without thresholds, and thresholds without a case, are rows with that failure alone, so neither goes
    unnoticed.  Determinism and round trips are always enforced.
    """
    t = thresholds.select("name", *[F.col(c).alias(f"t_{c}") for c in thresholds.columns if c != "name"]).withColumn("t", F.lit(True))
    both = reports.withColumn("r", F.lit(True)).join(t, "name", "full_outer")
    over = lambda c, bound: F.when(F.col(c) > F.col(bound), F.concat(F.lit(f"{c}:"), F.col(c)))
    known = F.col("r").isNotNull() & F.col("t").isNotNull()
    broken = F.concat_ws(
        ",",
        F.when(~F.array_contains("t_verdicts", F.col("verdict")), F.concat(F.lit("verdict:"), F.col("verdict"))),
        over("violations", "t_max_violations"), over("flagged", "t_max_flagged"), over("max_abs_offset_ns", "t_max_abs_offset_ns"), over("p99_abs_offset_ns", "t_max_p99_abs_offset_ns"),
        *([F.when(F.col("event_accuracy") < F.col("t_min_event_accuracy"), F.lit("event_accuracy"))] if "event_accuracy" in reports.columns else []),
        F.when(~F.col("deterministic"), F.lit("not_deterministic")), F.when(~F.col("round_trips"), F.lit("no_round_trip")),
    )
    failures = F.when(known, broken).when(F.col("r").isNull(), F.lit("no_report")).otherwise(F.lit("no_thresholds"))
    return both.select(*[F.col(c) for c in reports.columns], failures.alias("failures"))


def suite(cases: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """The reports of all cases, each computed twice, with ``name, deterministic, round_trips``.

    ``deterministic``: both runs gave the row; each run is computed and written for itself, so nothing of the first can
    serve the second.  ``round_trips``: a row's text form reads back to the same row.
    """
    out = None
    for name, run in cases.items():
        first, again = cut_lineage(run()), cut_lineage(run())
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in first.schema)
        same = again.select("episode_id", F.to_json(F.struct(*first.columns)).alias("again"))
        both = first.withColumn("text", F.to_json(F.struct(*first.columns))).join(same, "episode_id", "left")
        back = F.to_json(F.from_json("text", schema, {"mode": "FAILFAST"}))
        rows = both.select(F.lit(name).alias("name"), *first.columns, F.col("text").eqNullSafe(F.col("again")).alias("deterministic"), (back == F.col("text")).alias("round_trips"))
        out = rows if out is None else out.unionByName(rows)
    return out


def digest(rows: DataFrame) -> DataFrame:
    """``rows, first, second``: the number of rows and two sums of hashes over them, one row.

    Equal tables have equal digests, in any order and partitioning, repeated rows included; two hashes of different
    kinds make an accident unlikely.  Partial sums are all that is shuffled.
    """
    text = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    exact = lambda h: F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("decimal(38,0)")
    half = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
    return rows.select(F.xxhash64(text).alias("x"), half.alias("y")).agg(F.count("*").alias("rows"), exact(F.col("x")).alias("first"), exact(F.col("y")).alias("second"))


def run_digests(cases: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """``name, rows, same`` of every case: whether two runs, written one after the other, have the same content."""
    out = None
    for name, run in cases.items():
        first, again = digest(cut_lineage(run())), digest(cut_lineage(run()))
        other = again.select(*[F.col(c).alias(f"again_{c}") for c in again.columns])
        same = (F.col("rows") == F.col("again_rows")) & (F.col("first") == F.col("again_first")) & (F.col("second") == F.col("again_second"))
        row = first.join(other).select(F.lit(name).alias("name"), "rows", same.alias("same"))  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def write_report(reports: DataFrame, folder: str) -> None:
    """Gated reports as JSON lines, in order of name and episode."""
    reports.select(*sorted(reports.columns)).repartitionByRange("name", "episode_id").sortWithinPartitions("name", "episode_id").write.mode("overwrite").json(folder)


#: Columns of the table of reports.
TABLE = ["case", "episode", "verdict", "violations", "flagged/records", "non-matched/results", "max abs offset (ns)", "p95 (ns)", "p99 (ns)", "events", "deterministic", "round trips", "failures"]


def table_lines(gated: DataFrame) -> DataFrame:
    """``number, line``: gated reports (``gate_cases``) as a table in Markdown, two lines of head first, rows in order of case
    and episode; numbered by ranges."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    share = lambda a, b: F.concat(shown(a), F.lit("/"), shown(b))
    said = lambda c, yes, no: F.when(F.col(c), yes).when(~F.col(c), no).otherwise("-")
    events = share("events_matched", "events_total") if "events_total" in gated.columns else F.lit("-")
    cells = [
        shown("name"), shown("episode_id"), shown("verdict"), shown("violations"), share("flagged", "total_records"), share("non_matched", "total_results"), shown("max_abs_offset_ns"), shown("p95_abs_offset_ns"), shown("p99_abs_offset_ns"),
        events, said("deterministic", "yes", "NO"), said("round_trips", "ok", "FAIL"), F.when(F.col("failures") == "", "-").otherwise(F.col("failures")),
    ]
    rows = running(gated.select("name", "episode_id", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line")), ["name", "episode_id"], {})
    head = ["| " + " | ".join(TABLE) + " |", "|" + "---|" * len(TABLE)]
    return gated.sparkSession.createDataFrame(list(enumerate(head)), "number long, line string").unionByName(rows.select((F.col("number") + len(head)).alias("number"), "line"))


def write_table(gated: DataFrame, folder: str) -> None:
    """The lines of ``table_lines`` as text files, whose names are in the order of the lines."""
    table_lines(gated).repartitionByRange("number").sortWithinPartitions("number").select("line").write.mode("overwrite").text(folder)


def exit_status(gated: DataFrame) -> int:
    """0 if there are gated reports and none has a failure, else 1."""
    n = gated.agg(F.count("*").alias("rows"), F.count_if(F.coalesce("failures", F.lit("unknown")) != "").alias("failed")).first()
    return int(n["rows"] == 0 or n["failed"] > 0)


def missing_thresholds(reports: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Cases with a report but no thresholds, or thresholds but no report; there must be none."""
    a, b = reports.select("name"), thresholds.select("name")
    return a.join(b, "name", "left_anti").withColumn("fault", F.lit("no_thresholds")).unionByName(b.join(a, "name", "left_anti").withColumn("fault", F.lit("no_report")))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two runs gave the same rows."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
