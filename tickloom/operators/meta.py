"""Audit summaries of normalisation and alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schema import FLAGS, METHODS, QUALITIES


def histogram(rows: DataFrame, token: str, by: list[str]) -> DataFrame:
    """Counts by token, without zero counts."""
    return rows.where(F.col(token).isNotNull()).groupBy(*by, token).agg(F.count("*").alias("n"))


def flag_histogram(records: DataFrame, by: list[str]) -> DataFrame:
    return histogram(records.select(*by, F.explode("flags").alias("flag")), "flag", by)


def modality_timing(records: DataFrame, results: DataFrame) -> DataFrame:
    """One row for each episode and modality: counts of clean and flagged records, of results by quality, and the least,
    largest and mean published offset."""
    keys = ["episode_id", "modality"]
    a = records.groupBy(*keys).agg(F.count_if(F.col("normalized_ns").isNotNull()).alias("clean"), F.count_if(F.col("normalized_ns").isNull()).alias("flagged"))
    b = results.groupBy(*keys).agg(
        *[F.count_if(F.col("quality") == q).alias(q) for q in ("matched", "out_of_budget", "no_target")],
        F.min("offset_ns").alias("offset_min_ns"), F.max("offset_ns").alias("offset_max_ns"),
        (F.sum(F.col("offset_ns").cast("decimal(20,0)")).cast("double") / F.count("offset_ns")).alias("offset_mean_ns"),
    )
    out = a.join(b, keys, "full_outer")
    zero = [c for c in ("clean", "flagged", "matched", "out_of_budget", "no_target")]
    return out.select(*keys, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero], "offset_min_ns", "offset_max_ns", "offset_mean_ns")


def severity() -> Column:
    """2 for a modality without clean records or without a match, 1 for one with any flaw, else 0."""
    results = F.col("matched") + F.col("out_of_budget") + F.col("no_target")
    return F.when((F.col("clean") == 0) | ((results > 0) & (F.col("matched") == 0)), 2).when((F.col("flagged") > 0) | (results > F.col("matched")), 1).otherwise(0)


def sync_verdict(timing: DataFrame) -> DataFrame:
    """``episode_id, verdict`` with the totals over its modalities."""
    worst = timing.groupBy("episode_id").agg(F.max(severity()).alias("s"), *[F.sum(c).cast("long").alias(f"total_{c}") for c in ("flagged", "matched", "out_of_budget", "no_target")])
    return worst.select("episode_id", F.element_at(F.array(*map(F.lit, ("aligned_within_budget", "degraded", "quarantined"))), F.col("s") + 1).alias("verdict"), *[c for c in worst.columns if c.startswith("total_")])


def orphans(records: DataFrame, results: DataFrame, reference: str) -> DataFrame:
    """Modalities that were aligned but never recorded, or recorded but, unless the reference, never aligned."""
    keys = ["episode_id", "modality"]
    a, b = records.select(*keys).distinct(), results.select(*keys).distinct()
    return b.join(a, keys, "left_anti").withColumn("fault", F.lit("no_records")).unionByName(a.where(F.col("modality") != reference).join(b, keys, "left_anti").withColumn("fault", F.lit("no_results")))


def max_abs_offset(timing: DataFrame) -> DataFrame:
    """Largest absolute offset of an episode over its modalities."""
    return timing.groupBy("episode_id").agg(F.max(F.greatest(F.abs("offset_min_ns"), F.abs("offset_max_ns"))).alias("max_abs_offset_ns"))


def select_timing(timing: DataFrame, known: DataFrame, exported: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Timing rows of exported episodes, and ids with timing that no episode has (there must be none)."""
    ids = timing.select("episode_id").distinct()
    return timing.join(exported.select("episode_id").distinct(), "episode_id", "left_semi"), ids.join(known, "episode_id", "left_anti")


def contradictions(timing: DataFrame, max_skew_ns: int) -> DataFrame:
    """Keys of summary rows that contradict themselves: no records or results, counts below zero, a mean without matches
    or matches without a mean, a mean outside the offsets, offsets in the wrong order or beyond the budget.  There must be
    none."""
    counts = [F.col(c) for c in ("clean", "flagged", "matched", "out_of_budget", "no_target")]
    wrong = (counts[2] + counts[3] + counts[4] == 0) | (counts[0] + counts[1] == 0) | (F.least(*counts) < 0) | ~F.col("offset_mean_ns").between(F.col("offset_min_ns"), F.col("offset_max_ns")) | ((F.col("matched") > 0) != F.col("offset_mean_ns").isNotNull()) | (F.col("offset_min_ns") > F.col("offset_max_ns")) | (F.greatest(F.abs("offset_min_ns"), F.abs("offset_max_ns")) > max_skew_ns)
    return timing.where(wrong).select("episode_id", "modality")


def _counts(tokens: list[str], when) -> Column:
    """A map of the tokens that occur, in their order, to the number of rows that have them."""
    pairs = [x for t in sorted(tokens) for x in (F.lit(t), F.count_if(when(t)))]
    return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)


def summary(records: DataFrame, results: DataFrame) -> DataFrame:
    """``modality_timing`` with ``flag_counts, method_counts, quality_counts``: what occurs, sorted, with its counts.

    A record counts under each of its flags.  One aggregation of records and one of results.
    """
    keys = ["episode_id", "modality"]
    a = records.groupBy(*keys).agg(_counts(FLAGS, lambda t: F.array_contains("flags", t)).alias("flag_counts"))
    b = results.groupBy(*keys).agg(_counts(METHODS, lambda t: F.col("method") == t).alias("method_counts"), _counts(QUALITIES, lambda t: F.col("quality") == t).alias("quality_counts"))
    none = F.expr("map_filter(map('', 0L), (k, n) -> n > 0)")
    out = modality_timing(records, results).join(a, keys, "left").join(b, keys, "left")
    return out.withColumns({c: F.coalesce(c, none) for c in ("flag_counts", "method_counts", "quality_counts")})


def summary_faults(summaries: DataFrame, reference: str | None = None) -> DataFrame:
    """``episode_id, modality, fault`` of every row of ``summary`` that cannot come from records and results, with the
    first fault in fixed order; empty if there is none.

    Only the ``reference`` may have no results.
    """
    c = F.col
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda a, n: a + n)
    of = lambda m, t: F.coalesce(F.try_element_at(c(m), F.lit(t)), F.lit(0))
    foreign = lambda m, known: F.size(F.array_except(F.map_keys(m), F.array(*map(F.lit, known)))) > 0
    empty = lambda m: F.exists(F.map_values(m), lambda n: n.isNull() | (n <= 0))
    maps = ("flag_counts", "method_counts", "quality_counts")
    any_of = lambda f: f(maps[0]) | f(maps[1]) | f(maps[2])
    mean, low, high = c("offset_mean_ns"), c("offset_min_ns"), c("offset_max_ns")
    given = lambda x: x.isNotNull()
    fault = (
        F.when(F.least("clean", "flagged", "matched", "out_of_budget", "no_target") < 0, "negative_count")
        .when(c("clean") + c("flagged") == 0, "no_records")
        .when(foreign("flag_counts", FLAGS) | foreign("method_counts", METHODS) | foreign("quality_counts", QUALITIES), "unknown_token")
        .when(any_of(empty), "count_without_rows")
        .when(any_of(lambda m: F.map_keys(m) != F.array_sort(F.map_keys(m))), "tokens_out_of_order")
        .when((c("flagged") == 0) != (F.size("flag_counts") == 0), "flags_without_records")
        .when(total("flag_counts") < c("flagged"), "too_few_flags")
        .when(F.exists(F.map_values("flag_counts"), lambda n: n > c("flagged")), "too_many_of_a_flag")
        .when(total("method_counts") != total("quality_counts"), "methods_and_qualities_differ")
        .when((of("quality_counts", "matched") != c("matched")) | (of("quality_counts", "out_of_budget") != c("out_of_budget")) | (of("quality_counts", "no_target") != c("no_target")), "counts_and_qualities_differ")
        .when((total("quality_counts") == 0) & ~c("modality").eqNullSafe(F.lit(reference)), "no_results")
        .when((of("method_counts", "window") > 0) & (F.size("method_counts") > 1), "window_among_others")
        .when((of("method_counts", "window") > 0) & (c("out_of_budget") > 0), "window_out_of_budget")
        .when((c("matched") == 0) & (given(low) | given(high) | given(mean)), "offsets_without_matches")
        .when((c("matched") > 0) & ~(given(low) & given(high) & given(mean)), "matches_without_offsets")
        .when(F.isnan(mean) | (F.abs(mean) == float("inf")), "mean_not_finite")
        .when(low > high, "offsets_inverted")
        .when(~mean.between(low, high), "mean_outside_offsets")
        .when((F.size("method_counts") == 1) & (of("method_counts", "exact") > 0) & ((low != 0) | (high != 0)), "exact_with_offset")
    )
    return summaries.select("episode_id", "modality", fault.alias("fault")).where("fault is not null")
