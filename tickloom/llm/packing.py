"""Packing documents into sequences of a fixed number of tokens (operator 4).

Every length is an integer of at most the capacity, so the corpus is known to the planner by its histogram alone: at
most ``capacity`` counts, however many documents there are.  The plan follows large-item matching: lengths above a
third of the capacity share a sequence with at most one other such length, matched greedily, largest first; smaller
lengths then go, largest first, to the tightest gap that holds them, and to new sequences when none does.  Equal
lengths are placed in bulk, so the plan has a few thousand runs at most, whatever the counts.  Spark numbers the pieces
of each length (in salted groups, so a length that a third of all pieces have is split over many tasks) and reads each
piece's place from the run that its number falls in.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.bpe import SPLIT, bytes_of_chars, default_path
from tickloom.llm.common import cut_lineage, small

CAPACITY, END_ID = 1024, 2
#: Pieces of one length that are numbered together.
GROUP = 500
#: Groups that are counted together.
RANGE = 1000
#: Pieces that a worker remembers before it starts afresh (about 200 MB), and characters of a piece that it forgets.
REMEMBERED, LONG_PIECE = 1_000_000, 256


class _Pieces(dict):
    """Pieces of texts met so far with their ids; the library's model encodes the words of a new one."""

    def __init__(self, library: tokenizers.Tokenizer):
        self.tokenize, self.words = library.model.tokenize, regex.compile(SPLIT).findall
        self.stand_in = {b: c for c, b in bytes_of_chars().items()}

    def __missing__(self, piece: str) -> bytes:
        # Most pieces are a space and letters, maybe with one mark: what the rule makes of these is plain.
        if piece[1:].isalpha() and piece[0] == " ":
            words = None
        elif piece[-1] in ".,;:!?" and piece[1:-1].isalpha() and piece[0] == " ":
            words = piece[:-1], piece[-1]
        else:
            words = self.words(piece)
        if words is None or len(words) == 1:
            shown = piece if piece.isascii() else piece.encode("utf-8", "replace").decode("latin-1")
            tokens = self.tokenize(shown.translate(self.stand_in))
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        else:
            ids = b"".join(map(self.__getitem__, words))
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _encoder(path: str):
    """A function from a text to its ids by the tokenizers library and the vocabulary in ``path``.

    Pieces of a text begin at its spaces, as the vocabulary's rule begins a word at a space that stands alone between
    other characters; a text with other spaces is cut into words by the rule itself.  The library's model encodes every
    piece once, and it is remembered.  A text that names a special token goes to the library as a whole.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    spaces = [c for c in map(chr, range(0x3001)) if regex.match(r"\s", c) and c != " "]
    known = _Pieces(library)

    def plain(text: str) -> bool:
        """Whether every space of a text stands alone between other characters."""
        return not ("  " in text or text[0] == " " or text[-1] == " " or "\0" in text or any(c in text and (f" {c}" in text or f"{c} " in text) for c in spaces))

    def encode(text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if any(s in text for s in special):
            return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        if len(known) > REMEMBERED:
            known.clear()
        pieces = text.replace(" ", "\0 ").split("\0") if plain(text) else known.words(text)
        return np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u4")

    return encode


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: all full but the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece; a narrow map that keeps no ids."""
    path = path or default_path()

    def run(batches):
        encode = _encoder(path)
        for b in small(batches, 128):
            out = [[], [], [], [], []]
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(encode(t), end_id).astype("<u4")
                for k, (s, n) in enumerate(cut_points(len(ids), capacity)):
                    for o, x in zip(out, (d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())), strict=True):
                        o.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs ``(length, first, n, bin, each, offset)`` and the number of sequences.

    Pieces number ``first`` to ``first + n - 1`` of a length lie in the sequences from ``bin`` on, ``each`` in every
    one, the first of them at ``offset``.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first bin, number of bins)
    sizes: list[int] = []  # gaps in order
    n_bins = 0

    def put(size: int, first_bin: int, bins: int, each: int, n: int, offset: int) -> None:
        runs.append((size, used[size], n, first_bin, each, offset))
        used[size] += n
        left[size] -= n

    def leave(gap: int, first_bin: int, bins: int) -> None:
        if gap > 0 and bins > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first_bin, bins))

    large = sorted(s for s in left if 3 * s > capacity)
    for s in reversed(large):
        k = len(large) - 1
        while left[s]:
            k = min(k, len(large) - 1)
            while k >= 0 and (large[k] + s > capacity or not left[large[k]] or (large[k] == s and left[s] < 2)):
                k -= 1
            if k < 0:
                bins = left[s]
                put(s, n_bins, bins, 1, bins, 0)
                leave(capacity - s, n_bins, bins)
            elif large[k] == s:
                bins = left[s] // 2
                put(s, n_bins, bins, 2, 2 * bins, 0)
                leave(capacity - 2 * s, n_bins, bins)
            else:
                bins = min(left[s], left[large[k]])
                put(s, n_bins, bins, 1, bins, 0)
                put(large[k], n_bins, bins, 1, bins, s)
                leave(capacity - s - large[k], n_bins, bins)
            n_bins += bins
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(sizes, s)
            if at == len(sizes):
                gap, first, bins = capacity, n_bins, -(-left[s] // (capacity // s))
                n_bins += bins
            else:
                gap = sizes[at]
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            each = gap // s
            whole = min(bins, left[s] // each)
            if whole:
                put(s, first, whole, each, whole * each, capacity - gap)
                leave(gap - each * s, first, whole)
            if whole < bins:
                rest = left[s]
                if rest:
                    put(s, first + whole, 1, rest, rest, capacity - gap)
                    leave(gap - rest * s, first + whole, 1)
                leave(gap, first + whole + bool(rest), bins - whole - bool(rest))
    return runs, n_bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, start, length, ids_crc32``) plus ``sequence_id`` and ``offset``.

    ``pieces`` should be cheap to read twice.  Equal rows are placed like any others; an empty input gives no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs, _ = plan(counts, capacity)
    salts = -(-max(counts.values(), default=1) // GROUP)
    runs = spark.createDataFrame(runs or [(0, 0, 0, 0, 1, 0)], "run_length long, first long, n long, bin long, each long, at long")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    group = Window.partitionBy("length", "salt")
    # How many pieces lie in earlier groups: by ranges of groups, then within a range.
    sizes = salted.groupBy("length", "salt").count().withColumn("range", F.floor(F.col("salt") / RANGE))
    earlier = lambda w: F.coalesce(F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = sizes.groupBy("length", "range").agg(F.sum("count").alias("count")).select("length", "range", earlier(Window.partitionBy("length").orderBy("range")).alias("base"))
    before = sizes.withColumn("before", earlier(Window.partitionBy("length", "range").orderBy("salt"))).join(ranges, ["length", "range"]).select("length", "salt", (F.col("before") + F.col("base")).alias("before"))
    numbered = (
        salted.withColumn("number", F.row_number().over(group.orderBy("doc_id", "piece", "ids_crc32")) - 1)
        .join(before, ["length", "salt"])
        .withColumn("number", F.col("number") + F.col("before"))
    )
    placed = numbered.join(F.broadcast(runs), (F.col("length") == F.col("run_length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("n")))
    inside = F.col("number") - F.col("first")
    return placed.select(
        *[c for c in pieces.columns],
        (F.col("bin") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(inside, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every document as pieces with their places: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are one piece that holds the end id alone; repeated documents are packed once each; other
    columns are not read; an empty table gives no rows.
    """
    return pack(cut_lineage(token_pieces(docs, capacity, path=path)), capacity)
