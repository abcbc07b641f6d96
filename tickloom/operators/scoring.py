"""Scoring detected events against ground truth."""

from __future__ import annotations

import heapq
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.checks import whole_number
from tickloom.operators import segmented
from tickloom.session import written

#: Rounds of ever wider ranges before an episode and kind is one task, and events of a range in the first.
ROUNDS, RANGE_ROWS = 12, 250_000

def candidate_pairs(truth: DataFrame, found: DataFrame, tolerance_ns: int) -> DataFrame:
    """Pairs of one episode and kind at most ``tolerance_ns`` apart; joined by buckets of that width."""
    width = max(1, tolerance_ns)
    bucket = ((F.col("t_ns") - F.pmod(F.col("t_ns"), F.lit(width))) / width).cast("long")
    t = truth.select("episode_id", "kind", F.col("t_ns").alias("truth_ns"), F.col("ix").alias("truth_ix"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
    d = found.select("episode_id", "kind", F.col("t_ns").alias("found_ns"), F.col("ix").alias("found_ix"), bucket.alias("bucket"))
    return t.join(d, ["episode_id", "kind", "bucket"]).drop("bucket").withColumn("dist", F.abs(F.col("truth_ns") - F.col("found_ns"))).where(F.col("dist") <= tolerance_ns)


#: What a range settles: pairs, whose truth has a number, and events that wait for other ranges.
_SETTLED = "is_truth boolean, t_ns long, ix long, truth_ix long, found_ix long, truth_ns long, found_ns long, dist long"


def greedy(times: list[int], is_truth: list[bool], members: list[list[int]], tolerance_ns: int, before: int | None = None, after: int | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Greedy matches of one stretch of events, and what depends on events outside of it.

    Events of one time and side are a group: they are taken in order of ``members``, so groups match as events do.  The
    closest pair that is free has no free group between its ends, so pairs of neighbours in a heap are all that is looked
    at.  ``before`` and ``after``: the nearest events outside.  A pair is certain only if what is unknown is farther
    from it than its ends are from each other (behind it, as far at least: of equal pairs the earlier counts); the ends
    of any other pair join what is unknown.  Returns ``group, group, n`` of the pairs, in order, and ``group, from, to`` of
    the events that wait; all others have no partner.
    """
    n = len(times)
    back, on = list(range(-1, n - 1)), list(range(1, n + 1))
    taken, size = [0] * n, [len(m) for m in members]
    least, most = (x if x is not None else y for x, y in ((before, -(1 << 80)), (after, 1 << 80)))

    def place(i, j):
        return (times[j] - times[i], *((times[i], times[j]) if is_truth[i] else (times[j], times[i])), i, j)

    heap = [place(i, i + 1) for i in range(n - 1) if is_truth[i] != is_truth[i + 1] and times[i + 1] - times[i] <= tolerance_ns]
    heapq.heapify(heap)
    pairs = []
    while heap:
        dist, _, _, i, j = heapq.heappop(heap)
        if on[i] != j or taken[i] == size[i] or taken[j] == size[j]:
            continue
        if times[i] - least <= dist or most - times[j] < dist:
            if times[i] - least <= dist:
                least = max(least, times[j])
            if most - times[j] < dist:
                most = min(most, times[i])
            continue
        k = min(size[i] - taken[i], size[j] - taken[j])
        pairs.append((i, j, k) if is_truth[i] else (j, i, k))
        taken[i] += k
        taken[j] += k
        left, right = i if taken[i] < size[i] else back[i], j if taken[j] < size[j] else on[j]
        if left >= 0:
            on[left] = right
        if right < n:
            back[right] = left
        if left >= 0 and right < n and is_truth[left] != is_truth[right] and times[right] - times[left] <= tolerance_ns:
            heapq.heappush(heap, place(left, right))
    return pairs, [(i, taken[i], size[i]) for i in range(n) if taken[i] < size[i] and (times[i] - least <= tolerance_ns or most - times[i] <= tolerance_ns)]


def _settled(rows: DataFrame, tolerance_ns: int) -> DataFrame:
    """Pairs, and events that wait (``_SETTLED``), of rows that are in order in every partition; ``before`` and ``after`` are
    the nearest events of the same episode and kind in other partitions, if there are any."""
    schema = f"{', '.join(f'`{c}` {rows.schema[c].dataType.simpleString()}' for c in ('episode_id', 'kind'))}, {_SETTLED}"

    def settle(batches):
        import pyarrow as pa

        key, times, truths, members, outside, out = None, [], [], [], [None, None], []

        def close(nearest):
            pairs, waiting = greedy(times, truths, members, tolerance_ns, *nearest)
            taken = [0] * len(times)
            for t, f, k in pairs:
                dist = abs(times[t] - times[f])
                out.extend((*key, None, None, None, a, b, times[t], times[f], dist) for a, b in zip(members[t][taken[t] : taken[t] + k], members[f][taken[f] : taken[f] + k], strict=True))
                taken[t] += k
                taken[f] += k
            for i, a, b in waiting:
                out.extend((*key, truths[i], times[i], ix, None, None, None, None, None) for ix in members[i][a:b])

        def handed():
            columns = list(zip(*out, strict=True)) or [[]] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for b in batches:
            types = [b.schema.field("episode_id").type, b.schema.field("kind").type, pa.bool_(), *[pa.int64()] * 7]
            for e, k, is_truth, t, ix, before, after in zip(*(b.column(c).to_pylist() for c in ("episode_id", "kind", "is_truth", "t_ns", "ix", "before", "after")), strict=True):
                if times and ((e, k) != key or t - times[-1] > tolerance_ns):
                    # Events beyond a gap that is wider than the tolerance are of no account.
                    close([outside[0], outside[1] if (e, k) != key else None])
                    outside[0] = before if (e, k) != key else None
                    times, truths, members = [], [], []
                elif not times:
                    outside[0] = before
                key, outside[1] = (e, k), after
                if times and times[-1] == t and truths[-1] == is_truth:
                    members[-1].append(ix)
                else:
                    times.append(t)
                    truths.append(is_truth)
                    members.append([ix])
            if len(out) >= 50_000:
                yield handed()
                out = []
        if times:
            close(outside)
        if out:
            yield handed()

    names = [f.split()[0].strip("`") for f in schema.split(", ")]
    return rows.select("episode_id", "kind", "is_truth", "t_ns", "ix", "before", "after").mapInArrow(settle, schema)


def _in_ranges(events: DataFrame, n: int) -> DataFrame:
    """``events`` in order in at most ``n`` ranges, with the nearest events outside, ``before`` and ``after``, where a range
    cuts an episode and kind."""
    by = ["episode_id", "kind"]
    rows = segmented.dealt(events, by, ["t_ns"], n)
    ends = rows.groupBy(*by, segmented.RANGE).agg(F.min("t_ns").alias("first"), F.max("t_ns").alias("last"))
    order = Window.partitionBy(*by).orderBy(segmented.RANGE)
    # At most two rows a range: only its first and its last episode and kind go on elsewhere.
    cut = ends.select(*by, segmented.RANGE, F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")).where("before is not null or after is not null")
    return segmented.attach(rows, F.broadcast(cut), [*by, segmented.RANGE]).sortWithinPartitions(*by, "t_ns", "is_truth", "ix")


def match(truth: DataFrame, found: DataFrame, tolerance_ns: int, rounds: int = ROUNDS) -> DataFrame:
    """Greedy one-to-one matches: pairs in order of distance, truth time and number, found time and number; each pair
    is taken if both sides are free.

    A pair that is the first of all pairs of either of its events is taken whatever the others do.  So every range of time
    settles by itself what does not depend on its neighbours (``greedy``), no pairs are listed, and a round later the
    events near its ends, which are few, are dealt to new and wider ranges.  A long row of equal distances waits for its
    beginning; ranges widen until it lies in one, and after ``rounds`` rounds an episode and kind is one task.
    """
    whole_number(tolerance_ns, "tolerance_ns")
    side = lambda df, is_truth: df.select("episode_id", "kind", F.lit(is_truth).alias("is_truth"), "t_ns", F.col("ix").cast("long").alias("ix")).where("t_ns is not null")
    left, done = written(side(truth, True).unionByName(side(found, False))), []
    for k in range(rounds):
        size = left.count()
        if not size:
            break
        if k < rounds - 1:
            n = -(-size // (RANGE_ROWS << 2 * k))
            # At first as many ranges as there are tasks; what is left of them may be little.
            rows = _in_ranges(left, max(n, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if k == 0 else n)
        else:
            rows = left.repartition("episode_id", "kind").withColumns({c: F.lit(None).cast("long") for c in ("before", "after")}).sortWithinPartitions("episode_id", "kind", "t_ns", "is_truth", "ix")
        settled = written(_settled(rows, tolerance_ns))
        done.append(settled.where("truth_ix is not null"))
        left = settled.where("truth_ix is null").select(*left.columns)
    columns = ["episode_id", "kind", "truth_ix", "found_ix", "truth_ns", "found_ns", "dist"]
    return reduce(DataFrame.unionByName, done).select(*columns) if done else walked(truth.limit(0), found.limit(0), tolerance_ns)


def walked(truth: DataFrame, found: DataFrame, tolerance_ns: int) -> DataFrame:
    """The matches of ``match`` by a walk over all pairs within the tolerance, in order.

    Only pairs that can compete share a task: events of one kind that lie in one chain of gaps of twice the tolerance at
    most.  The pairs of such a cluster stream through in order; what is held is the set of events taken in it.
    """
    pairs = candidate_pairs(truth, found, tolerance_ns)
    order = Window.partitionBy("episode_id", "kind").orderBy("truth_ns", "truth_ix")
    ends = truth.select("episode_id", "kind", F.col("t_ns").alias("truth_ns"), F.col("ix").alias("truth_ix"))
    far = F.coalesce(F.col("truth_ns") - F.lag("truth_ns").over(order), F.lit(0)) > 2 * tolerance_ns
    clustered = ends.withColumn("new", far.cast("int")).withColumn("cluster", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("new")
    pairs = pairs.join(clustered, ["episode_id", "kind", "truth_ns", "truth_ix"])

    def take(batches):
        key, truths, founds = None, set(), set()
        for b in batches:
            keep = []
            for e, k, c, t, f in zip(b["episode_id"], b["kind"], b["cluster"], b["truth_ix"], b["found_ix"], strict=True):
                if (e, k, c) != key:
                    key, truths, founds = (e, k, c), set(), set()
                free = t not in truths and f not in founds
                if free:
                    truths.add(t)
                    founds.add(f)
                keep.append(free)
            yield b[keep]

    ordered = pairs.repartition("episode_id", "kind", "cluster").sortWithinPartitions("episode_id", "kind", "cluster", "dist", "truth_ns", "truth_ix", "found_ns", "found_ix")
    return ordered.mapInPandas(take, ordered.schema).select("episode_id", "kind", "truth_ix", "found_ix", "truth_ns", "found_ns", "dist")


def ratio(part: Column, whole: Column, empty: float) -> Column:
    return F.when(whole == 0, F.lit(empty)).otherwise(part.cast("double") / whole)


def ratios(counts: DataFrame) -> DataFrame:
    """``counts`` (``tp, fp, fn``) with precision, recall and f1; nothing found or nothing to find counts as 1."""
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    out = counts.withColumn("precision", ratio(tp, tp + fp, 1.0)).withColumn("recall", ratio(tp, tp + fn, 1.0))
    both = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(both == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / both))


def score(truth: DataFrame, found: DataFrame, tolerance_ns: int, by: tuple[str, ...] = ("kind",)) -> DataFrame:
    """``tp, fp, fn`` and ratios for each kind that occurs, and over all kinds (``kind`` null)."""
    n = lambda df, name: df.groupBy(*by).agg(F.count("*").alias(name))
    kinds = truth.select(*by).union(found.select(*by)).distinct()
    out = kinds.join(n(truth, "nt"), list(by), "left").join(n(found, "nf"), list(by), "left").join(n(match(truth, found, tolerance_ns), "tp"), list(by), "left").na.fill(0)
    out = out.select(*by, F.col("tp"), (F.col("nf") - F.col("tp")).alias("fp"), (F.col("nt") - F.col("tp")).alias("fn"))
    return ratios(out.rollup(*by).agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn")]))
