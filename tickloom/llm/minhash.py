"""Near-duplicate documents by consistent weighted sampling (operator 1).

A document is a weighted set of shingles of ``WIDTH`` words.  The weight of a shingle is its count in the document
times ``1 + ln(1 + N / df) / 10``, rounded to a power of e^(1/16); ``df`` counts the documents with a shingle in the
same of ``BUCKETS`` hash buckets, over all ``N`` documents.  The table of counts has a fixed size, and as both ``df``
and ``N`` grow with the corpus, weights keep their meaning.  The constant 1 keeps a large group of copies from losing
the weight of what they share to its own size.

1.  Improved consistent weighted sampling draws, for each of ``BANDS * ROWS`` hash functions, a shingle and a level of
    its weight; two documents draw the same with the probability of their weighted Jaccard similarity.  The draws
    (gamma, gamma, uniform) of a shingle come from a fixed table of 65,536 places, at the place that its hash gives for
    that function.  Two shingles of a document at one place have equal draws, and the lesser hash wins: about one
    shingle in 80 of a document of 800 words is concerned, at another place for every function.
2.  ``ROWS`` samples form a band.  Documents with the same words in the same order are one node from the start, so copies
    never meet in pairs.  Band buckets with the same members are compared once.
3.  A bucket is dealt to blocks of at most about ``BLOCK`` nodes, and its leader goes to every block.  A block is one
    *cell*: its nodes are compared, by exact weighted Jaccard similarity, until all that were not compared with
    everything are of one class; only links that join two classes leave the cell.
4.  Where a bucket of several blocks still holds several classes, the nodes outside its largest class meet all blocks
    once more, so every pair of different classes that shares a bucket has been compared.
5.  Classes are the components of the links.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut_lineage, small, written
from tickloom.llm.components import components
from tickloom.llm.rolling import mix, prefix_sums, substring_hashes

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
BUCKETS = 1 << 18
#: Steps of e^(1/16) in which weights are kept, and the largest step.
STEPS, TOP = 16, 255
#: Nodes, and words, of a block of a bucket, about.
BLOCK, BLOCK_WORDS = 128, 150_000
_DRAWS = 1 << 16


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words, in lower case; words stand between white space."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[1], blank, [1]]).astype(np.int8))
    return substring_hashes(prefix_sums(data), np.flatnonzero(edge < 0), np.flatnonzero(edge > 0))


def shingles(words: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order, and how often each occurs.  Fewer words than ``width`` form one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = min(width, len(words))
    out = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[k : len(words) - width + 1 + k]
    return np.unique(mix(out), return_counts=True)


def fingerprint(words: np.ndarray) -> bytes:
    """128 bits of the word sequence."""
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    one = mix(words ^ (at * np.uint64(0x9E3779B97F4A7C15))).sum(dtype=np.uint64)
    two = mix((words + np.uint64(0x632BE59BD9B4E019)) * (at * np.uint64(2) + np.uint64(1))).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def weight_steps(hashes: np.ndarray, counts: np.ndarray, log_idf: np.ndarray) -> np.ndarray:
    """Logarithms of the weights, in steps of 1/16."""
    return np.clip(np.rint(STEPS * (np.log(counts) + log_idf[buckets_of(hashes)])), 0, TOP).astype(np.int64)


class Sampler:
    """The draws of all hash functions, and for each weight step the values that the least of which is sampled."""

    def __init__(self, n: int, seed: int = 1):
        r = np.random.default_rng(seed)
        self.r = r.gamma(2, 1, _DRAWS)
        self.log_c = np.log(r.gamma(2, 1, _DRAWS))
        self.beta = r.random(_DRAWS)
        self.factor = (r.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.values = np.empty((TOP + 1, _DRAWS), np.float32)
        self.ready = np.zeros(TOP + 1, bool)

    def sample(self, hashes: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """One 64-bit sample for each hash function; ``hashes`` in order, so ties go to the least."""
        for s in np.unique(steps):
            if not self.ready[s]:
                t = np.floor(s / STEPS / self.r + self.beta)
                self.values[s] = self.log_c - self.r * (t - self.beta + 1)
                self.ready[s] = True
        flat, base = self.values.ravel(), steps * _DRAWS
        best = np.full(len(self.factor), np.inf, np.float32)
        chosen = np.zeros(len(self.factor), np.int64)
        for a in range(0, len(hashes), 1 << 15):
            b = min(a + (1 << 15), len(hashes))
            at = ((self.factor[:, None] * hashes[None, a:b]) >> np.uint64(48)).view(np.int64)
            at += base[None, a:b]
            value = flat.take(at)
            least = value.argmin(1)
            value = value[np.arange(len(least)), least]
            better = value < best
            best[better] = value[better]
            chosen[better] = least[better] + a
        h = hashes[chosen]
        at = ((self.factor * h) >> np.uint64(48)).view(np.int64)
        t = np.floor(steps[chosen] / STEPS / self.r[at] + self.beta[at]).astype(np.int64)
        return mix(h ^ (t.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


@lru_cache(maxsize=2)
def sampler(n: int) -> Sampler:
    return Sampler(n)


def bands(samples: np.ndarray, n_bands: int) -> np.ndarray:
    """One key for each band; keys of different bands differ."""
    rows = samples.reshape(n_bands, -1)
    out = np.arange(1, n_bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        out = out * np.uint64(0xD1342543DE82EF95) + rows[:, k]
    return mix(out).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets (hashes in order, weight steps)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = np.exp(a[1] / STEPS), np.exp(b[1] / STEPS)
    both = np.minimum(x[i], y[j]).sum()
    return float(both / (x.sum() + y.sum() - both))


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """``ln(1 + ln(1 + N / df) / 10)`` of every bucket, from all rows: a table of fixed size."""

    def count(batches):
        n, found = 0, np.zeros(BUCKETS, np.int64)
        for b in small(batches):
            for t in b.column(0).to_pylist():
                found[np.unique(buckets_of(shingles(word_hashes(t))[0]))] += 1
                n += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(found[at], n), pa.int64())], names=["bucket", "n"])

    rows = docs.select(docs["text"].cast("string").alias("t")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = (rows.column(c).to_numpy() for c in ("bucket", "n"))
    total = n[at < 0].sum() if len(at) else 0
    df = np.ones(BUCKETS)
    df[at[at >= 0]] = n[at >= 0]
    return np.log(1 + np.log1p(max(total, 1) / df) / 10).astype(np.float32)


def _signed(docs: DataFrame, log_idf) -> DataFrame:
    """``doc_id, own, fp, words, bands`` of every row; own: a hash of the text as it is; documents with fewer words than
    a shingle have no bands."""

    def sign(batches):
        draw = sampler(BANDS * ROWS)
        for b in small(batches):
            fps, n, keys = [], [], []
            for t in b.column(1).to_pylist():
                w = word_hashes(t)
                fps.append(fingerprint(w))
                n.append(len(w))
                h, c = shingles(w)
                keys.append(bands(draw.sample(h, weight_steps(h, c, log_idf.value)), BANDS) if len(w) >= WIDTH else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps, pa.binary()), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "own", "fp", "words", "bands"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"), _own(docs)).mapInArrow(sign, "doc_id long, own long, fp binary, words long, bands array<long>")


def _own(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def _id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1))


class Cell:
    """Weighted sets that are compared with each other."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]], classes: list):
        self.sets = [(h, np.exp(s / STEPS)) for h, s in sets]
        self.totals = np.array([w.sum() for _, w in self.sets])
        names: dict = {}
        self.of = np.array([names.setdefault(c, len(names)) for c in classes])
        self.rows = None

    def scan(self, i: int) -> np.ndarray:
        """Similarities of set ``i`` and all sets."""
        if self.rows is None:
            hashes = np.concatenate([h for h, _ in self.sets])
            order = np.argsort(hashes, kind="stable")
            owner = np.repeat(np.arange(len(self.sets)), [len(h) for h, _ in self.sets])
            self.rows = hashes[order], owner[order], np.concatenate([w for _, w in self.sets])[order]
        hashes, owner, weights = self.rows
        h, w = self.sets[i]
        first = np.searchsorted(hashes, h)
        n = np.searchsorted(hashes, h, side="right") - first
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(owner[at], np.minimum(weights[at], np.repeat(w, n)), len(self.sets))
        return both / (self.totals[i] + self.totals - both)

    def links(self, least: float) -> list[tuple[int, int]]:
        """Pairs of similarity ``least`` or more that join the classes of the cell.

        Ends when the sets that were not compared with all others are of one class: nothing is left to join.
        """
        out, fresh = [], np.ones(len(self.sets), bool)
        i = 0
        while True:
            fresh[i] = False
            near = np.flatnonzero((self.scan(i) >= least) & (self.of != self.of[i]))
            for j in near.tolist():
                if self.of[j] != self.of[i]:
                    out.append((i, j))
                    self.of[self.of == self.of[j]] = self.of[i]
            of = self.of[fresh]
            if not len(of) or (of == of[0]).all():
                return out
            left = np.flatnonzero(fresh & (self.of != np.bincount(self.of).argmax()))
            i = int(left[0] if len(left) else np.flatnonzero(fresh)[0])


def _linked(places: DataFrame, log_idf, least: float) -> DataFrame:
    """``u, v`` of links between the nodes of every cell; ``places``: ``cell, first, fp, root, text``.

    A cell is read as a whole, leader first; cells are bounded by ``BLOCK``.
    """

    def compare(batches):
        def settle(held):
            found = Cell([x[2] for x in held], [x[1] for x in held]).links(least) if len(held) > 1 else []
            return [(held[i][0], held[j][0]) for i, j in found]

        cell, held, seen, out = None, [], set(), []
        for b in small(batches, 128):
            for c, fp, root, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != cell:
                    out += settle(held)
                    cell, held, seen = c, [], set()
                if fp not in seen:
                    seen.add(fp)
                    h, n = shingles(word_hashes(text))
                    held.append((fp, root or fp, (h, weight_steps(h, n, log_idf.value))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["u", "v"])
                out = []
        if out := settle(held):
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["u", "v"])

    dealt = places.repartition("cell").sortWithinPartitions("cell", F.desc("first"), "fp")
    return dealt.select("cell", "fp", "root", "text").mapInArrow(compare, "u binary, v binary")


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``fp, text, at`` of every node of ``members``, fetched by id and hash of the text; ``at``: its buckets, each with
    ``key, blocks`` and whether the node leads there.

    Rows that repeat an id and a text would be fetched as often; of them one is kept.
    """
    at = members.groupBy("fp").agg(F.collect_list(F.struct("key", "blocks", (F.xxhash64("fp") == F.col("lead")).alias("first"))).alias("at"))
    wanted = nodes.select("fp", "pick.*").join(at, "fp")
    texts = docs.select(_id(docs).alias("id"), _own(docs).alias("own"), docs["text"].cast("string").alias("text"))
    got = texts.join(wanted.hint("shuffle_hash"), ["id", "own"]).drop("id", "own")
    got = got.where("n = 1").unionByName(got.where("n > 1").dropDuplicates(["fp"])).drop("n")
    return written(got.withColumn("large", F.exists("at", lambda p: p["blocks"] > 1)))


def _blocks(n: Column, words: Column, block: int) -> Column:
    return F.greatest(F.ceil(n / block), F.ceil(words / BLOCK_WORDS)).cast("int")


def _block_of(fp: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(fp), blocks).cast("int")


def _by_blocks(texts: DataFrame) -> DataFrame:
    """The cells of the first pass: every block of a bucket with the bucket's leader."""
    each = texts.select("fp", "text", F.explode("at").alias("p")).select("fp", "text", "p.*")
    own = F.array(_block_of("fp", F.col("blocks")))
    spread = each.withColumn("b", F.explode(F.when(F.col("first"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)))
    return spread.select(F.xxhash64("key", "b").alias("cell"), "first", "fp", F.lit(None).cast("binary").alias("root"), "text")


def _across_blocks(texts: DataFrame, members: DataFrame, found: DataFrame, block: int) -> DataFrame | None:
    """The cells of the second pass, or None if no bucket of several blocks holds several classes.

    The nodes outside the largest class of such a bucket, the rest, are dealt to blocks, and so is the largest class.
    Every block of the rest meets every block of the largest class, and the other blocks of the rest.
    """
    now = members.where("blocks > 1").join(found.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", "words", F.coalesce("root", "fp").alias("root"))
    parts = now.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("words").alias("words"))
    whole = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "words", "root")).alias("big"), F.sum("n").alias("n"), F.sum("words").alias("words")).where("parts > 1")
    mixed = cut_lineage(whole.select("key", F.col("big.root").alias("big"), _blocks(F.col("big.n"), F.col("big.words"), block).alias("d"), _blocks(F.col("n") - F.col("big.n"), F.col("words") - F.col("big.words"), block).alias("r")))
    if mixed.isEmpty():
        return None
    meeting = now.join(mixed, "key").withColumn("in_big", F.col("root") == F.col("big"))
    b = F.when(F.col("in_big"), _block_of("fp", F.col("d"))).otherwise(_block_of("fp", F.col("r")))
    at = meeting.groupBy("fp").agg(F.first("root").alias("root"), F.collect_list(F.struct("key", "in_big", "d", "r", b.alias("b"))).alias("at"))
    each = texts.where("large").select("fp", "text").join(at.hint("shuffle_hash"), "fp").select("fp", "root", "text", F.explode("at").alias("p")).select("fp", "root", "text", "p.*")
    rest, other = F.lit("rest"), F.lit("big")
    ahead = F.transform(F.sequence(F.lit(0), F.col("r") - 1), lambda j: F.xxhash64("key", other, "b", j))
    back = F.transform(F.sequence(F.lit(0), F.col("d") - 1), lambda i: F.xxhash64("key", other, i, "b"))
    side = F.transform(F.filter(F.sequence(F.lit(0), F.col("r") - 1), lambda j: j != F.col("b")), lambda j: F.xxhash64("key", rest, F.least(j, F.col("b")), F.greatest(j, F.col("b"))))
    return each.select(F.explode(F.when(F.col("in_big"), ahead).otherwise(F.concat(back, side))).alias("cell"), F.lit(False).alias("first"), "fp", "root", "text")


def classes(docs: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id`` of every row; class_id: the least doc_id of the class.

    Copies (null and empty texts among themselves as well) are one class.  Repeated rows share a class; a null doc_id
    never names a class unless all of its class are null; an empty table gives no rows; other columns are not read.
    """
    return _classified(docs, similarity, block).select("doc_id", "class_id")


def _classified(docs: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """``doc_id, own, root, class_id`` of every row."""
    log_idf = docs.sparkSession.sparkContext.broadcast(document_frequencies(docs))
    signed = written(_signed(docs, log_idf))
    rows = signed.groupBy("fp", "words", "bands", "doc_id", "own").agg(F.count("*").alias("n"))
    nodes = written(rows.groupBy("fp", "words", "bands").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct(_id(rows).alias("id"), "own", "n")).alias("pick")))

    # Buckets by what they hold: those with the same nodes give the same links, so one of them is enough.
    keyed = nodes.select("fp", "words", F.explode("bands").alias("key"))
    h = F.xxhash64("fp")
    held = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum("words").alias("w"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("y"), F.min(h).alias("lead")).where("n > 1")
    buckets = held.groupBy("n", "w", "x", "y", "lead").agg(F.min("key").alias("key")).select("key", "lead", _blocks(F.col("n"), F.col("w"), block).alias("blocks"))
    members = written(keyed.join(buckets, "key"))

    texts = _texts(docs, nodes, members)
    links = cut_lineage(_linked(_by_blocks(texts), log_idf, similarity).distinct())
    found = written(components(links))
    across = _across_blocks(texts, members, found, block)
    if across is not None:
        links = links.unionByName(cut_lineage(_linked(across, log_idf, similarity).distinct()))
        found = written(components(links))
    by_node = nodes.select("fp", "doc_id").join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = by_node.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    by_node = by_node.join(named, "root").select("fp", "root", "class_id")
    return signed.select("doc_id", "own", "fp").join(by_node, "fp").select("doc_id", "own", "root", "class_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class; all columns as they were, whatever their names.

    The row with the least doc_id stays (one without an id only if the whole class has none); among texts that share
    that id the one with the least hash, and of rows with the same id and text any one.  Null and empty texts are copies
    of each other, so one of them stays; an empty table gives no rows.
    """
    found = _classified(docs, similarity)
    rows = found.groupBy("root", _id(found).alias("id"), "own").agg(F.count("*").alias("n"))
    keep = cut_lineage(rows.groupBy("root").agg(F.min(F.struct("id", "own", "n")).alias("k")).select("k.*"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _id(docs).alias("id"), _own(docs).alias("own"))
    kept = whole.join(keep.hint("shuffle_hash"), ["id", "own"])
    return kept.where("n = 1").select("row.*").unionByName(kept.where("n > 1").dropDuplicates(["id", "own"]).select("row.*"))
