"""Event detectors and ground truth from scripted phases."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.codec import is_finite
from tickloom.operators import segmented
from tickloom.schema import EVENT_KINDS, FLOATS
from tickloom.session import written

EPSILON_S = 1e-9
#: Format of event records, and most phases of a script.
EVENT_VERSION, MOST_PHASES = 1, 10_000
CONTACT_KINDS = ["contact_start", "slip", "impact"]


def check_channel(channel: str) -> str:
    """The channel; raises unless a sample has it as a number."""
    if channel not in FLOATS:
        raise ValueError(f"no channel of numbers is called {channel!r}; there are {', '.join(FLOATS)}")
    return channel


def records(found: DataFrame, channel: str, detector: str, confidence: float | Column, payload: dict[str, Column]) -> DataFrame:
    """Events (``episode_id, seq, t_ns, kind`` and what ``payload`` needs) as full records.

    ``episode_id, seq, kind, t_monotonic_ns, confidence, channel, detector, schema_version, payload``; raises for an
    unknown kind, and for a confidence outside 0 to 1.
    """
    if not isinstance(confidence, Column):
        if not 0.0 <= confidence <= 1.0:
            raise ValueError(f"confidence must be from 0 to 1, got {confidence}")
        sure = F.lit(float(confidence))
    else:
        sure = F.when(confidence.between(0.0, 1.0) & ~F.isnan(confidence), confidence).otherwise(F.raise_error(F.lit("confidence must be from 0 to 1")))
    kind = F.when(F.col("kind").isin(EVENT_KINDS), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown event kind "), F.coalesce("kind", F.lit("null")))))
    pairs = [x for name, value in payload.items() for x in (F.lit(name), value.cast("double"))]
    return found.select(
        "episode_id", "seq", kind.alias("kind"), F.col("t_ns").alias("t_monotonic_ns"), sure.alias("confidence"), F.lit(channel).alias("channel"), F.lit(detector).alias("detector"), F.lit(EVENT_VERSION).alias("schema_version"), F.create_map(*pairs).alias("payload"),
    )


def no_events(samples: DataFrame) -> DataFrame:
    """Records of a detector that finds nothing."""
    return records(samples.where(F.lit(False)).select("episode_id", "seq", F.col("timestamp_ns").alias("t_ns"), F.lit("slip").alias("kind")), "", "noop", 1.0, {"none": F.lit(0.0)})


def script(phases: DataFrame) -> DataFrame:
    """The phases, for a broadcast; raises if there are too many for one."""
    if phases.limit(MOST_PHASES + 1).count() > MOST_PHASES:
        raise ValueError(f"a script has {MOST_PHASES} phases at most")
    return F.broadcast(phases)


def detect_threshold(samples: DataFrame, channel: str = "motor_current", threshold: float = 1.0, kind: str = "current_spike", keep: list[str] | None = None) -> DataFrame:
    """An event for every row whose absolute value reaches the threshold; NaN never does, infinity does."""
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    v = F.col(channel)
    return samples.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) >= threshold)).select("episode_id", "seq", F.col("timestamp_ns").alias("t_ns"), F.lit(kind).alias("kind"), F.lit(channel).alias("channel"), F.abs(v).alias("level"), *(keep or []))


def tactile_level(token: Column) -> Column:
    """1 in contact, 0 at release, null where the token says nothing."""
    return F.when(token.isin(CONTACT_KINDS), 1.0).when(token == "release", 0.0)


def detect_contact(samples: DataFrame, level: Column, onset: float, release: float, long: bool = False) -> DataFrame:
    """Contact starts and releases of a Schmitt trigger over all readings of an episode, whatever their chain.

    Null and NaN readings hold the state.  A reading that satisfies both thresholds turns the state over.  With ``long``
    an episode is spread over many tasks.
    """
    if not 0 <= release <= onset:
        raise ValueError("0 <= release <= onset is needed")
    readings = samples.withColumn("level", level).where(F.col("level").isNotNull() & ~F.isnan("level"))
    up, down = F.col("level") >= onset, F.col("level") <= release
    # 1 and 0 set the state, 2 turns it over: the state is the last one set, turned over once for each 2 since.
    coded = readings.withColumn("code", F.when(up & down, 2).when(up, 1).when(down, 0))
    if long:
        coded = segmented.trigger_states(coded, ["episode_id"], "seq", "code")
    else:
        order = Window.partitionBy("episode_id").orderBy("seq")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        coded = coded.withColumn("set", F.coalesce(F.last(F.when(F.col("code") < 2, F.col("code")), True).over(upto), F.lit(0)))
        coded = coded.withColumn("span", F.count(F.when(F.col("code") < 2, 1)).over(upto))
        inside = Window.partitionBy("episode_id", "span").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
        coded = coded.withColumn("state", (F.col("set") + F.count(F.when(F.col("code") == 2, 1)).over(inside)) % 2)
        coded = coded.withColumn("was", F.coalesce(F.lag("state").over(order), F.lit(0)))
    changed = coded.where("state <> was")
    return changed.select("episode_id", "seq", F.col("timestamp_ns").alias("t_ns"), F.when(F.col("state") == 1, "contact_start").otherwise("contact_release").alias("kind"), "level")


def impact_candidates(samples: DataFrame, channel: str, jerk: float, signed: bool = False, long: bool = False) -> DataFrame:
    """Rows whose value differs from the one before on its chain by ``jerk`` or more; a non-finite difference is none.
    ``delta`` is the size of the difference, with ``signed`` the difference itself.  With ``long`` a chain is spread over many
    tasks."""
    if jerk <= 0:
        raise ValueError("jerk must be above 0")
    if long:
        samples = segmented.value_before(samples, ["episode_id", "chain_index"], "seq", channel, "__before")
        change = F.col(channel) - F.col("__before")
    else:
        change = F.col(channel) - F.lag(channel).over(Window.partitionBy("episode_id", "chain_index").orderBy("seq"))
    delta = samples.withColumn("delta", change if signed else F.abs(change))
    return delta.where(is_finite(F.col("delta")) & (F.abs("delta") >= jerk)).select("episode_id", "chain_index", "seq", F.col("timestamp_ns").alias("t_ns"), F.lit("impact").alias("kind"), "delta")


def detect_impact(samples: DataFrame, channel: str, jerk: float, refractory_ns: int = 0, signed: bool = False, long: bool = False) -> DataFrame:
    """Impacts of every chain.  After one that fired, others less than ``refractory_ns`` later are not reported.  With ``long``
    candidates are found in many tasks a chain.

    Only candidates later than all before them can fire: each one that fires is later than the last by the refractory time,
    and what did not fire is earlier than that.  Of these, one that comes ``refractory_ns`` after its predecessor fires for
    sure.  The others fire if they are reached from such a one by steps to the first candidate that is ``refractory_ns``
    later.  Candidates are dealt by ranges of time: steps inside a range are followed in its task, and only candidates that
    are stepped on from another range, with where their steps leave their own, are joined; those steps are doubled, so the
    rounds are the logarithm of the number of ranges.
    """
    found = impact_candidates(samples, channel, jerk, signed, long)
    if refractory_ns <= 0:
        return found
    keys = ["episode_id", "chain_index"]
    chain = Window.partitionBy(*keys)
    if long:
        found = segmented.running_max_before(found, keys, "seq", "t_ns", "before")
    else:
        found = found.withColumn("before", F.max("t_ns").over(chain.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)))
    columns = [c for c in found.columns if c != "before"]
    # What is later than all before follows on the last of these: ``before`` is the stamp of its predecessor.
    able = found.where(F.col("before").isNull() | (F.col("t_ns") > F.col("before"))).withColumn("fires", F.col("before").isNull() | (F.col("t_ns") - F.col("before") >= refractory_ns)).drop("before")
    later = F.coalesce(F.try_add("t_ns", F.lit(int(refractory_ns))), F.lit((1 << 63) - 1))
    if long:
        able = written(able)
        steps = able.select(*keys, F.col("t_ns").alias("at"), F.lit(None).cast("long").alias("t_ns"), F.struct("t_ns", "fires").alias("e")).unionByName(able.select(*keys, later.alias("at"), "t_ns", F.lit(None).cast("struct<t_ns: bigint, fires: boolean>").alias("e")))
        steps = segmented.last_and_next(steps, keys, "at", {"e": (F.col("e"), F.col("e"))}).where("t_ns is not null").select(*keys, "t_ns", F.col("ahead_e").alias("to"))
        able = segmented.attach(able, steps, [*keys, "t_ns"])
    else:
        onward = chain.orderBy(F.desc("t_ns")).rangeBetween(Window.unboundedPreceding, -int(refractory_ns))
        able = able.withColumn("to", F.min(F.struct("t_ns", "fires")).over(onward))
    # A step onto a candidate that fires for sure tells nothing.
    able = segmented.dealt(able.withColumn("to", F.when(~F.col("to.fires"), F.col("to.t_ns"))), keys, ["t_ns"])
    left = written(_in_ranges(able, "leaves long, inside boolean", _leave, last_first=True))
    onto = left.where("to is not null and not inside").select(*keys, F.col("to").alias("t_ns"), F.lit(True).alias("stepped_on")).distinct()
    steps = segmented.attach(left, onto, [*keys, "t_ns"]).where("stepped_on or fires and leaves is not null")
    steps = written(steps.select(*keys, "t_ns", "fires", F.col("leaves").alias("to")))
    while not steps.where("fires and to is not null").isEmpty():
        reached = steps.where("fires and to is not null").select(*keys, F.col("to").alias("t_ns"), F.lit(True).alias("reached")).distinct()
        further = steps.select(*keys, F.col("t_ns").alias("to"), F.col("to").alias("further"))
        steps = segmented.attach(segmented.attach(steps, reached, [*keys, "t_ns"]), further, [*keys, "to"])
        steps = written(steps.select(*keys, "t_ns", (F.col("fires") | F.coalesce("reached", F.lit(False))).alias("fires"), F.col("further").alias("to")))
    sure = segmented.attach(left.drop("leaves", "inside"), steps.where("fires").select(*keys, "t_ns", F.lit(True).alias("reached")), [*keys, "t_ns"])
    sure = sure.withColumn("fires", F.col("fires") | F.coalesce("reached", F.lit(False))).drop("reached")
    return _in_ranges(sure, "fired boolean", _follow).where("fired").select(*columns)


def _in_ranges(rows: DataFrame, more: str, walk, last_first: bool = False) -> DataFrame:
    """``rows`` of ``segmented.dealt`` with the columns ``more``, one tuple of ``walk`` for each row, range by range and chain
    by chain in order of time; only the stamps that a chain steps on in a range are held."""
    place = [segmented.RANGE, "episode_id", "chain_index"]
    fields = StructType.fromDDL(more).fields
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_()}

    def each(batches):
        step, chain = None, None
        for b in batches:
            out = []
            for *at, t, to, fires in zip(*(b[c].to_pylist() for c in (*place, "t_ns", "to", "fires")), strict=True):
                if at != chain:
                    step, chain = walk(), at
                out.append(step(t, to, fires))
            for i, f in enumerate(fields):
                b = b.append_column(f.name, pa.array([x[i] for x in out], kinds[f.dataType.simpleString()]))
            yield b

    time = F.desc("t_ns") if last_first else F.asc("t_ns")
    schema = StructType([*rows.schema.fields, *fields])
    return rows.repartition(segmented.RANGE).sortWithinPartitions(*place, time).mapInArrow(each, schema)


def _leave():
    """Where the steps from a candidate leave its range, and whether the first one stays in it; from the last one on."""
    leaves = {}

    def step(t, to, fires):
        inside = to in leaves
        leaves[t] = leaves[to] if inside else to
        return leaves[t], inside

    return step


def _follow():
    """Whether a candidate fires: it is known to, or one that fires steps on it."""
    due = set()

    def step(t, to, fires):
        fires = fires or t in due
        due.discard(t)
        if fires and to is not None:
            due.add(to)
        return (fires,)

    return step


def phase_of(samples: DataFrame, phases: DataFrame, start_ns: Column) -> DataFrame:
    """Samples with the phase (``phase_ix, kind``) that is active at their time since ``start_ns``.

    Phases are a script of a few rows; they are half-open and tile the script, with a tolerance of a nanosecond.
    """
    t = (F.col("timestamp_ns") - start_ns).cast("double") / 1e9
    inside = (F.col("start_s") - EPSILON_S <= F.col("elapsed_s")) & (F.col("elapsed_s") < F.col("start_s") + F.col("duration_s") - EPSILON_S)
    return samples.withColumn("elapsed_s", t).join(script(phases.select("phase_ix", F.col("kind").alias("phase_kind"), "start_s", "duration_s")), inside, "left").drop("start_s", "duration_s")


def check_phases(phases: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Faults of a script, or of the scripts that ``by`` tells apart, one row each; empty for valid ones.

    Phases follow each other without gap or overlap, last longer than nothing, are of known kinds, and grasps open and
    close in turn, with slips and impacts only inside.
    """
    order = Window.partitionBy(*by).orderBy("phase_ix")
    end = F.col("start_s") + F.col("duration_s")
    open_ = F.sum(F.when(F.col("kind") == "contact_start", 1).when(F.col("kind") == "release", -1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    p = phases.withColumn("want", F.coalesce(F.lag(end).over(order), F.lit(0.0))).withColumn("open", open_).withColumn("last", F.lead("phase_ix").over(order).isNull())
    known = F.col("kind").isin("approach", "contact_start", "slip", "impact", "release", "settle")
    fault = F.when(~known, "unknown_kind").when(F.col("duration_s") <= 0, "no_duration").when(F.abs(F.col("start_s") - F.col("want")) > EPSILON_S, "not_tiled").when(~F.col("open").isin(0, 1), "unbalanced").when(F.col("kind").isin("slip", "impact") & (F.col("open") != 1), "outside_grasp").when(F.col("last") & (F.col("open") != 0), "not_released")
    return p.select(*by, "phase_ix", fault.alias("fault")).where("fault is not null")


def ground_truth(samples: DataFrame, phases: DataFrame) -> DataFrame:
    """``episode_id, kind, t_ns``: the earliest tactile sample of each contact phase.

    The script starts at the first stamp of the one chain that carries tokens.  Raises for an episode with several such
    chains, and for a contact phase without a sample.
    """
    carrying = samples.where("tactile_event is not null").groupBy("episode_id").agg(F.countDistinct("chain_index").alias("chains"), F.min("chain_index").alias("chain"))
    carrying = carrying.withColumn("chain", F.when(F.col("chains") == 1, F.col("chain")).otherwise(F.raise_error(F.concat(F.lit("several chains carry tokens in "), F.col("episode_id").cast("string")))))
    own = samples.join(carrying.select("episode_id", F.col("chain").alias("chain_index")), ["episode_id", "chain_index"])
    anchored = own.join(own.groupBy("episode_id").agg(F.min("timestamp_ns").alias("anchor")), "episode_id")
    contact = phases.where(F.col("kind").isin("contact_start", "slip", "impact", "release"))
    hits = phase_of(anchored, contact, F.col("anchor")).where("phase_ix is not null").groupBy("episode_id", "phase_ix").agg(F.min("timestamp_ns").alias("t_ns"))
    each = contact.limit(MOST_PHASES + 1).agg(F.collect_list(F.struct("phase_ix", "kind")).alias("p")).first()["p"]
    wanted = carrying.select("episode_id", F.inline(F.array(*[F.struct(F.lit(p["phase_ix"]).alias("phase_ix"), F.lit(p["kind"]).alias("kind")) for p in each]))) if each else carrying.select("episode_id", F.lit(0).alias("phase_ix"), F.lit("").alias("kind")).limit(0)
    out = wanted.join(hits, ["episode_id", "phase_ix"], "left")
    kind = F.when(F.col("kind") == "release", "contact_release").otherwise(F.col("kind"))
    return out.select("episode_id", "phase_ix", kind.alias("kind"), F.coalesce("t_ns", F.raise_error(F.lit("a contact phase has no sample"))).alias("t_ns"))
