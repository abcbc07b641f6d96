"""Removal of byte strings that repeat anywhere in a corpus (operator 8).

Every byte that is covered by a ``length``-byte string which also starts elsewhere, in the same or another document,
is removed.  Three steps keep the sorting to where it matters:

1.  Each start of a ``length``-byte string is dealt to one *anchor*: the ``GRAM``-byte gram with the least hash among
    the grams that the string holds.  Equal strings have equal grams at equal places, hence equal anchors.  The starts
    of one anchor are consecutive; their text is a *fragment*.
2.  Anchors are counted by gram and by (gram, fragment).  A fragment that occurs twice is repeated throughout and needs
    no sorting; a gram with one fragment only is settled as well.  Copies thus meet as counts, not as texts.
3.  The distinct fragments of the other grams are gathered by gram and suffix-sorted in two stages: the suffixes that
    are smaller than their successors are sorted directly, the rest are induced by one scan over the buckets of first
    bytes; starts whose neighbours in that order share a prefix of ``length`` bytes are repeated.  A gram with more than
    ``crowded`` fragments (a passage amid a large part of all documents) is first split: its fragments get anchors of
    grams twice as long, as often as needed, so no sort holds more than a bounded number of fragments.

The repeated starts go back to every occurrence of their fragment and become the spans that are cut out.

Strings of two lengths cost little more than those of the shorter one: whatever repeats over ``length`` bytes repeats in
all its shorter strings, so the longer ones are sought in the stretches that the shorter ones leave (`longer_spans`).
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small, written
from tickloom.llm.rolling import gram_hashes, sliding_min

LENGTH, GRAM = 400, 64
#: Distinct fragments of one gram that are suffix-sorted together at most, and bytes after which a batch is sorted.
CROWDED, BATCH = 2_000, 1_000_000
#: Bytes of the strings that make a repeated passage, and of their grams: 51 words are seldom as short.
PASSAGE, PASSAGE_GRAM = 200, 48


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``start, n, gram hash, fragment hash`` of every anchor: the starts ``start`` to ``start + n - 1`` are its own."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    place = sliding_min(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    n = np.diff(np.append(first, len(place)))
    own = np.array([xxhash.xxh3_64_intdigest(data[s : s + k + length - 1]) for s, k in zip(first.tolist(), n.tolist(), strict=True)], dtype=np.uint64)
    return first, n, hashes[place[first].astype(np.int64)].view(np.int64), own.view(np.int64)


def repeated_starts(fragments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each fragment: which of its starts begin a ``length``-byte string that begins at another start as well.

    Two-stage suffix sorting.  A suffix is small if it is less than the one that starts a byte later.
    """
    sizes = np.array([len(f) for f in fragments], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    ends = begins + sizes
    joined = b"\0".join(fragments) + b"\0"
    text = np.frombuffer(joined, np.uint8).astype(np.int16) + 1
    text[ends] = 0  # the end of a fragment is less than any byte
    n = len(text)
    step = np.zeros(n, np.int16)
    step[:-1] = text[1:] - text[:-1]
    step[ends] = 1  # an end counts as small
    change = np.where(step != 0, np.arange(n), n)
    change = np.minimum.accumulate(change[::-1])[::-1]  # where the run of equal bytes ends
    small = step[np.minimum(change, n - 1)] > 0
    # The starts, and after them what is needed to reach a small suffix.
    inside = np.zeros(n + 1, np.int64)
    following = np.where(small, np.arange(n), n)
    following = np.minimum.accumulate(following[::-1])[::-1]
    starts_end = ends - length + 1
    np.add.at(inside, begins, 1)
    np.add.at(inside, following[starts_end - 1] + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    # First stage: sort the small ones by their bytes, a bucket at a time.
    stop = np.repeat(ends, sizes + 1)
    direct = np.flatnonzero(inside & small)
    two = text[direct].astype(np.int32) * 257 + text[np.minimum(direct + 1, n - 1)]
    order = np.argsort(two, kind="stable")
    direct, two = direct[order], two[order]
    bounds = np.flatnonzero(np.concatenate([[True], two[1:] != two[:-1], [True]]))
    until = np.minimum(stop[direct], direct + length).tolist()
    direct = direct.tolist()
    in_order: list[int] = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a == 1:
            in_order.append(direct[a])
        else:
            keys = sorted((joined[direct[i] : until[i]], direct[i]) for i in range(a, b))
            in_order.extend(p for _, p in keys)
    # Second stage: scan the buckets; each suffix puts the larger one that starts a byte earlier.
    counts = np.bincount(text[inside], minlength=257)
    large = inside & ~small
    n_large = np.bincount(text[large], minlength=257)
    heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
    tails = heads + n_large
    ordered_small = np.array(in_order, dtype=np.int64)
    first_of = text[ordered_small]
    rank = np.arange(len(in_order)) - np.searchsorted(first_of, first_of)
    placed = np.zeros(int(counts.sum()), np.int64)
    placed[tails[first_of] + rank] = ordered_small
    before = np.zeros(n, np.int16)  # the byte before, where that suffix is to be induced
    before[1:][large[:-1]] = text[:-1][large[:-1]]
    before, suffixes, head = array("h", before.tobytes()), placed.tolist(), heads.tolist()
    for i in range(len(suffixes)):
        j = suffixes[i]
        c = before[j]
        if c:
            suffixes[head[c]] = j - 1
            head[c] += 1
    # Adjacent common prefixes among the starts.
    suffixes = np.array(suffixes, dtype=np.int64)
    is_start = np.zeros(n + 1, np.int64)
    np.add.at(is_start, begins, 1)
    np.add.at(is_start, starts_end, -1)
    suffixes = suffixes[np.cumsum(is_start[:-1])[suffixes] > 0]
    equal = same_prefix(np.frombuffer(joined, np.uint8), suffixes[:-1], suffixes[1:], length)
    hit = np.zeros(n, bool)
    hit[suffixes[:-1][equal]] = True
    hit[suffixes[1:][equal]] = True
    return [np.flatnonzero(hit[b:e]) for b, e in zip(begins.tolist(), starts_end.tolist(), strict=True)]


def same_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix at ``a`` and ``b`` has ``length`` bytes at least, eight bytes at a time."""
    words = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for k in range(8):
        words |= padded[k : k + len(data)].astype(np.uint64) << np.uint64(8 * k)
    alive = np.arange(len(a))
    for at in [*range(0, length - 7, 8), max(0, length - 8)]:
        if length < 8:
            break
        alive = alive[words[a[alive] + at] == words[b[alive] + at]]
        if not len(alive):
            break
    if length < 8:
        for at in range(length):
            alive = alive[data[a[alive] + at] == data[b[alive] + at]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def _runs(x: np.ndarray) -> list[dict]:
    """Maximal runs of increasing integers as first and length."""
    if not len(x):
        return []
    cut = np.flatnonzero(np.diff(x) != 1)
    first, last = x[np.concatenate([[0], cut + 1])], x[np.concatenate([cut, [len(x) - 1]])]
    return [{"at": a, "n": b - a + 1} for a, b in zip(first.tolist(), last.tolist(), strict=True)]


_RUN = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))
_RUN_SQL = "array<struct<at:long,n:long>>"


def _anchored(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``k1, k2, start, n, g, f, times`` of every anchor of ``texts`` (``k1, k2, times, bytes``)."""

    def find(batches):
        for b in small(batches):
            *keys, data = (c.to_pylist() for c in b.columns)
            rows = [anchors(d or b"", length, gram) for d in data]
            n = [len(r[0]) for r in rows]
            k1, k2, times = (np.repeat(np.array(k, np.int64), n) for k in keys)
            cols = [np.concatenate([r[c] for r in rows] or [np.zeros(0, np.int64)]) for c in range(4)]
            if sum(n):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (k1, k2, *cols, times)], names=["k1", "k2", "start", "n", "g", "f", "times"])

    return texts.select("k1", "k2", "times", "bytes").mapInArrow(find, "k1 long, k2 long, start long, n long, g long, f long, times long")


def _slices(texts: DataFrame, length: int) -> DataFrame:
    """``g, f, times, kinds, bytes``: the wanted fragments of ``texts`` (``bytes, wanted``)."""

    def run(batches):
        for b in small(batches, 128):
            out = [[], [], [], [], []]
            for data, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for x in wanted:
                    for o, v in zip(out, (x["g"], x["f"], x["times"], x["kinds"], data[x["start"] : x["start"] + x["n"] + length - 1]), strict=True):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, [pa.int64()] * 4 + [pa.binary()], strict=True)], names=["g", "f", "times", "kinds", "bytes"])

    return texts.select("bytes", "wanted").mapInArrow(run, "g long, f long, times long, kinds long, bytes binary")


def _sorted(fragments: DataFrame, length: int) -> DataFrame:
    """``g, f, runs``: the repeated starts of fragments (``g, f, times, bytes``) that occur once, by suffix sorting."""

    def sort(batches):
        def settle():
            rows = [(g, f, _runs(starts)) for (g, f, times, _), starts in zip(held, repeated_starts([h[3] for h in held], length), strict=True) if times == 1 and len(starts)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], _RUN)], names=["g", "f", "runs"])

        held, size, seen = [], 0, set()
        for b in small(batches):
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and row[0] != held[-1][0] and size >= BATCH:
                    yield settle()
                    held, size, seen = [], 0, set()
                if row[:2] not in seen:
                    seen.add(row[:2])
                    held.append(row)
                    size += len(row[3])
        if held:
            yield settle()

    dealt = fragments.select("g", "f", "times", "bytes").repartition("g").sortWithinPartitions("g", "f")
    return dealt.mapInArrow(sort, f"g long, f long, runs {_RUN_SQL}")


def _settled(found: DataFrame, fetch: Callable[[DataFrame], DataFrame], length: int, gram: int, crowded: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``found`` whose gram occurs more than once, and ``g, f, runs`` of the fragments that repeat anything.

    ``found``: anchors of ``gram`` bytes; ``fetch`` adds the ``bytes`` of owners to rows with ``k1, k2``.
    """
    kinds = found.groupBy("g", "f").agg(F.sum("times").alias("times"))
    grams = kinds.groupBy("g").agg(F.sum("times").alias("total"), F.count("*").alias("kinds")).where("total > 1").select("g", "kinds")
    kinds = written(kinds.join(grams, "g").select("g", "f", "times", "kinds"))
    shared = written(found.select("k1", "k2", "start", "n", "g", "f", F.col("times").alias("own")).join(kinds, ["g", "f"]))
    whole = shared.where("times > 1").groupBy("g", "f").agg(F.max("n").alias("n")).select("g", "f", F.array(F.struct(F.lit(0).cast("long").alias("at"), "n")).alias("runs"))
    if gram == length:
        return shared, whole  # every fragment is one string

    # Texts of the distinct fragments, each from one of its occurrences.
    one = shared.where("kinds > 1").groupBy("g", "f", "times", "kinds").agg(F.min(F.struct("k1", "k2", "start", "n")).alias("one")).select("g", "f", "times", "kinds", "one.*")
    wanted = one.groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "f", "times", "kinds", "start", "n")).alias("wanted"))
    fragments = written(_slices(fetch(wanted), length))
    out = whole.unionByName(_sorted(fragments.where(F.col("kinds") <= crowded), length))
    many = fragments.where(F.col("kinds") > crowded)
    if not many.isEmpty():
        many = many.select(F.col("g").alias("k1"), F.col("f").alias("k2"), "times", "bytes").dropDuplicates(["k1", "k2"])
        parts, inner = _settled(written(_anchored(many, length, min(2 * gram, length))), lambda w: many.join(w.hint("shuffle_hash"), ["k1", "k2"]), length, min(2 * gram, length), crowded)
        out = out.unionByName(_owned(parts.where("own = 1"), inner).select(F.col("k1").alias("g"), F.col("k2").alias("f"), "runs"))
    return shared, out


def _owned(found: DataFrame, settled: DataFrame) -> DataFrame:
    """``k1, k2, runs``: repeated starts of every owner; equal rows count once."""
    runs = found.join(settled, ["g", "f"]).select("k1", "k2", F.transform("runs", lambda r: F.struct((r["at"] + F.col("start")).alias("at"), r["n"].alias("n"))).alias("runs"))
    return runs.groupBy("k1", "k2").agg(F.flatten(F.collect_set("runs")).alias("runs"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``k1, k2, runs`` of the documents that repeat anything; runs: the starts of repeated strings, not yet merged.

    ``docs`` has ``k1, k2, bytes``; equal keys mean equal texts.
    """
    if length < gram:
        raise ValueError("strings must be as long as a gram at least")
    found = written(_anchored(docs.withColumn("times", F.lit(1).cast("long")), length, gram))
    # Every text that is long enough has one anchor at its start, so these are the keys of several rows.
    again = written(found.where("start = 0").groupBy("k1", "k2").count().where("count > 1").select("k1", "k2", F.lit(True).alias("again")))

    def fetch(wanted):
        got = docs.join(wanted.join(again, ["k1", "k2"], "left").hint("shuffle_hash"), ["k1", "k2"])
        return got.where("again is null").unionByName(got.where("again").dropDuplicates(["k1", "k2"]))

    return _owned(*_settled(found, fetch, length, gram, crowded))


def longer_spans(docs: DataFrame, shorter: DataFrame, short: int, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``repeated_spans(docs, length, gram, crowded)`` by way of its result ``shorter`` for strings of ``short`` bytes.

    All strings of ``short`` bytes within a repeated string repeat, so wherever it occurs it lies in one stretch of such
    starts.  Only the texts of stretches that are long enough are searched, each as a document of its own.
    """
    if length < short:
        raise ValueError("the longer strings must be as long as the shorter ones at least")
    least = length - short + 1

    def stretches(batches):
        for b in small(batches, 128):
            out = [[], [], [], []]
            for k1, k2, data, runs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for x, y in spans(runs, 1, len(data)):
                    if y - x >= least:
                        for o, v in zip(out, (k1, k2, x, data[x : y + short - 1]), strict=True):
                            o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, [pa.int64()] * 3 + [pa.binary()], strict=True)], names=["k1", "k2", "at", "bytes"])

    many = shorter.where(F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["n"]) >= least)
    inside = docs.join(many.hint("shuffle_hash"), ["k1", "k2"]).select("k1", "k2", "bytes", "runs").mapInArrow(stretches, "k1 long, k2 long, at long, bytes binary")
    inside = written(inside.withColumn("own", F.xxhash64("bytes")))
    found = repeated_spans(inside.select("k1", F.col("own").alias("k2"), "bytes"), length, gram, crowded).select("k1", F.col("k2").alias("own"), "runs")
    places = inside.select("k1", "k2", "own", "at").distinct().join(found, ["k1", "own"])
    moved = places.select("k1", "k2", F.transform("runs", lambda r: F.struct((r["at"] + F.col("at")).alias("at"), r["n"].alias("n"))).alias("runs"))
    return moved.groupBy("k1", "k2").agg(F.flatten(F.collect_set("runs")).alias("runs"))


def spans(runs: list[dict] | None, length: int, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal covered spans from runs of starts."""
    if not runs:
        return []
    out: list[list[int]] = []
    for a, b in sorted({(r["at"], r["at"] + r["n"] - 1 + length) for r in runs}):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, n_bytes)) for a, b in out]


def _keyed(docs: DataFrame) -> DataFrame:
    """``k1, k2, bytes, row`` of every row; row: all columns but the text."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(text).alias("k2"), text.cast("binary").alias("bytes"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def removal_digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED, passage: int | None = None, passage_gram: int = PASSAGE_GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text`` of every document.

    ``text``: what is left, without the parts of characters that a cut went through.  With ``passage``, which is at most
    ``length``, ``n_passage_bytes`` and ``n_passages`` follow: the bytes that repeated strings of ``passage`` bytes cover,
    and their spans; these stay in ``text``.  Null texts count as empty; repeated rows are copies of each other, so their
    long strings go from each; an empty table gives no rows; other columns are not read.
    """
    names = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "text": pa.string()}
    if passage is not None:
        names |= {"n_passage_bytes": pa.int64(), "n_passages": pa.int64()}

    def digest(batches):
        for b in small(batches):
            rows = []
            for data, r, *shorter in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                cut = spans(r, length, len(data))
                kept = without(data, cut)
                row = [len(data), sum(y - x for x, y in cut), len(cut), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")]
                for q in shorter:
                    held = spans(q, passage, len(data))
                    row += [sum(y - x for x, y in held), len(held)]
                rows.append(row)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(list(names.values())[1:]))], names=list(names))

    whole = _keyed(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"))
    texts = whole.select("k1", "k2", "bytes")
    if passage is None:
        found = repeated_spans(texts, length, gram, crowded)
    else:
        shorter = written(repeated_spans(texts, passage, passage_gram, crowded))
        found = shorter.withColumnRenamed("runs", "shorter").join(longer_spans(texts, shorter, passage, length, gram, crowded), ["k1", "k2"], "left")
    joined = whole.join(found.hint("shuffle_hash"), ["k1", "k2"], "left").select("row.doc_id", "bytes", "runs", *(["shorter"] if passage is not None else []))
    return joined.mapInArrow(digest, ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in names.items()))


def without(data: bytes, cut: list[tuple[int, int]]) -> bytes:
    """``data`` without the spans ``cut``."""
    at, kept = 0, []
    for x, y in cut:
        kept.append(data[at:x])
        at = y
    return b"".join([*kept, data[at:]])


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` and every other column as it was, whatever its name.

    A cut can fall inside a character; what is left of such a character goes too.  A null text becomes an empty one;
    repeated rows are copies of each other, so their long strings go from each; an empty table gives no rows.
    """

    def cut(batches):
        for b in small(batches):
            out = [without(data, spans(r, length, len(data))).decode("utf-8", "ignore") for data, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *b.columns[2:]], names=["text", *[f"c{i}" for i in range(b.num_columns - 2)]])

    rest = [c for c in docs.columns if c != "text"]
    whole = _keyed(docs)
    found = repeated_spans(whole.select("k1", "k2", "bytes"), length, gram, crowded)
    joined = whole.join(found.hint("shuffle_hash"), ["k1", "k2"], "left").select("bytes", "runs", *[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(rest)])
    schema = ", ".join(["text string", *[f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)]])
    names = {c: f"c{i}" for i, c in enumerate(rest)} | {"text": "text"}
    return joined.mapInArrow(cut, schema).select(*[F.col(names[c]).alias(c) for c in docs.columns])
