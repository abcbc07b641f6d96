"""Language identification by sparse multinomial logistic regression (operator 11).

A text is its letters in lower case, everything else being one space; its features are the character n-grams of
``ORDERS`` characters, hashed to ``BUCKETS`` and weighted by TF-IDF.  The weights of the languages are learnt with
follow-the-regularised-leader: every coordinate has its own learning rate, the l1 penalty leaves coordinates at zero that
the data do not pay for, the l2 penalty shrinks the others.  A temperature, fitted on a part of the sample that the
weights have not seen, turns the scores into calibrated probabilities.

Document frequencies are counted over all documents that may be learnt from.  Only the fit uses a sample: whole texts of at
most ``PER_SAMPLE`` documents, dealt evenly to the languages (``LEAST`` for each language at least), about
``labelled.SAMPLE_CHARS`` characters.  Scoring reads every whole text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import labelled
from tickloom.llm.common import cut_lineage, prepare, small
from tickloom.llm.labelled import fold
from tickloom.llm.rolling import mix

FOLDS, HELD = 4, 2
ORDERS, BUCKETS = (1, 2, 3), 1 << 16
#: Bounds of the training sample, and the part of it (one in so many) that fits the temperature.
PER_SAMPLE, LEAST, CALIBRATION = 8000, 50, 5
#: Learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 0.05, 0.1, 3
NO_LANGUAGE = "und"
#: Characters that are counted at once; a cut costs no n-gram.
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """Of every code point: a letter's lower case, or a space."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(text: str) -> np.ndarray:
    """Code points of ``text``: letters in lower case, one space for what is between, and one at either end."""
    x = _folding()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    x = np.concatenate([[np.uint32(32)], x, [np.uint32(32)]])
    return x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text's n-grams and their counts; none without letters."""
    x = letters(text or "")
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0)
    count = np.zeros(BUCKETS, np.int64) if len(x) > CHUNK else None
    most = max(ORDERS)
    for at in range(0, len(x), CHUNK):
        piece = x[max(0, at - most + 1) : at + CHUNK].astype(np.uint64)
        fresh = at - max(0, at - most + 1)  # n-grams that end before are those of the last piece
        key, found = np.zeros(len(piece), np.uint64), []
        for n in range(1, most + 1):
            key = key[: len(piece) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + piece[n - 1 :] + np.uint64(n)
            if n in ORDERS:
                some = key[max(0, fresh - n + 1) :] if n > 1 else key[fresh:][piece[fresh:] != 32]
                found.append((mix(some.copy()) >> np.uint64(48)).astype(np.int64))
        if count is not None:
            count += np.bincount(np.concatenate(found), minlength=BUCKETS)
    if count is not None:
        return np.flatnonzero(count), count[count > 0].astype(float)
    which, times = np.unique(np.concatenate(found), return_counts=True)
    return which, times.astype(float)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class Sparse:
    """A fitted model: ``rows`` of weights for the buckets that have any, by language."""

    languages: list[str]
    idf: np.ndarray
    place: np.ndarray
    rows: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        which, count = grams(text)
        v = (1 + np.log(count)) * self.idf[which]
        return which, v / max(float(np.sqrt((v * v).sum())), 1e-12)

    def scores(self, which: np.ndarray, v: np.ndarray) -> np.ndarray:
        at = self.place[which]
        used = at >= 0
        return v[used] @ self.rows[at[used]] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its probability; no language and 0 where there is no letter or nothing was learnt."""
        which, v = self.features(text)
        if not len(which) or not self.languages:
            return NO_LANGUAGE, 0.0
        p = softmax(self.scores(which, v) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


class Leader:
    """Follow-the-regularised-leader for one sparse row at a time; the last row of the state is the bias, not penalised."""

    def __init__(self, features: int, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, which: np.ndarray) -> np.ndarray:
        z = self.z[which]
        l1, l2 = (np.where(which < len(self.z) - 1, x, 0.0)[:, None] for x in (self.l1, self.l2))
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[which])) / self.alpha + l2))

    def learn(self, which: np.ndarray, v: np.ndarray, y: int) -> None:
        which, v = np.append(which, len(self.z) - 1), np.append(v, 1.0)
        w = self.weights(which)
        error = softmax(v @ w)
        error[y] -= 1
        g = v[:, None] * error
        n = self.n[which]
        grown = n + g * g
        self.z[which] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[which] = grown


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm between 1/20 and 20.

    The labels are held to be wrong once in ``len(y) + 2`` times: without that, a part that is told apart without an error
    would call for certainty.
    """
    wrong, classes = 1 / (len(y) + 2), scores.shape[1]

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(1, keepdims=True)
        less = np.log(np.exp(s).sum(1, keepdims=True)) - s
        right = less[np.arange(len(y)), y]
        return float(((1 - wrong) * right + wrong * (less.sum(1) - right) / max(classes - 1, 1)).mean())

    low, high, g = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(rows: list[tuple[str, str]], df: np.ndarray, n_docs: int, epochs: int = EPOCHS) -> Sparse:
    """A model from ``(text, language)``, in an order that does not depend on the language; ``df`` are the document frequencies among ``n_docs``."""
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    names = sorted({lang for _, lang in rows})
    model = Sparse(names, idf, np.full(BUCKETS, -1, np.int64), np.zeros((0, len(names))), np.zeros(len(names)))
    known = {lang: i for i, lang in enumerate(names)}
    data = [(*model.features(text), known[lang]) for text, lang in rows]
    data = [d for d in data if len(d[0])]
    held = [d for i, d in enumerate(data) if i % CALIBRATION == 0 and len(data) >= 10 * CALIBRATION]
    fitted = [d for i, d in enumerate(data) if i % CALIBRATION or len(data) < 10 * CALIBRATION]
    leader, r = Leader(BUCKETS, len(names)), np.random.default_rng(0)
    for _ in range(epochs):
        for i in r.permutation(len(fitted)):
            leader.learn(*fitted[i])
    w = leader.weights(np.arange(BUCKETS + 1))
    kept = np.flatnonzero((w[:-1] != 0).any(1))
    model.place[kept] = np.arange(len(kept))
    model.rows, model.bias = w[kept], w[-1]
    if held:
        model.temperature = temperature(np.array([model.scores(which, v) for which, v, _ in held]), np.array([y for _, _, y in held]))
    return model


def learnable(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang`` of the documents that may be learnt from."""
    return docs.select("doc_id", docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")).where((fold(F.col("doc_id"), FOLDS) != HELD) & F.col("lang").isNotNull())


def document_frequencies(learn: DataFrame) -> tuple[np.ndarray, int]:
    """Of every bucket the number of documents that have it, and the number of documents, over all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in small(batches):
            for text in b.column(0).to_pylist():
                df[grams(text)[0]] += 1
                n += 1
        which = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(which, -1), pa.int64()), pa.array(np.append(df[which], n), pa.int64())], names=["bucket", "n"])

    found = learn.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, n_docs = np.zeros(BUCKETS, np.int64), 0
    for r in found:
        if r["bucket"] < 0:
            n_docs = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return df, n_docs


def sample(learn: DataFrame) -> list[tuple[str, str]]:
    """``(text, lang)`` of the bounded sample: of every language the documents with the least hashes of their ids.

    A language with many documents is thinned by hash first, to about four times its share, so it is never gathered in
    one task.  A document with several rows or languages counts once, with the least of them.
    """
    sizes = learn.where("doc_id is not null").groupBy("lang").agg(F.count("*").alias("docs")).collect()
    if not sizes:
        return []
    each = max(PER_SAMPLE // len(sizes), LEAST)
    chars = labelled.SAMPLE_CHARS / len(sizes)
    shares = learn.sparkSession.createDataFrame([(r["lang"], min(1.0, (4 * each + 100) / r["docs"])) for r in sizes], "lang string, share double")
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    some = learn.where("doc_id is not null").select("doc_id", "lang", h.alias("h"), F.coalesce(F.length("text"), F.lit(0)).alias("size")).join(F.broadcast(shares), "lang").where(F.col("h") < F.col("share") * (1 << 32))
    some = some.groupBy("doc_id", "h").agg(F.min(F.struct("lang", "size")).alias("x")).select("doc_id", "h", "x.*")
    least = Window.partitionBy("lang").orderBy("h", "doc_id")
    before = F.coalesce(F.sum("size").over(least.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = cut_lineage(some.withColumn("k", F.row_number().over(least)).withColumn("before", before).where((F.col("k") <= each) & (F.col("before") < chars)).select("doc_id", "lang"))
    rows = learn.join(F.broadcast(chosen), ["doc_id", "lang"]).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(each * len(sizes)).select("doc_id", "text", "lang").collect()
    return [(r["text"] or "", r["lang"]) for i, r in enumerate(rows) if not i or r["doc_id"] != rows[i - 1]["doc_id"]]


def fit(docs: DataFrame) -> Sparse:
    """The model of a corpus, without the held-out fold."""
    prepare(docs.sparkSession)
    learn = learnable(docs)
    return train(sample(learn), *document_frequencies(learn))


def predicted(docs: DataFrame, model: Sparse) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; whole texts, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in small(batches):
            got = [model.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([round(p, 9) for _, p in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    ``lang_pred`` is one of the languages learnt, or ``und`` with score 0 for a text that is null or has no letter (and
    for all texts if no document may be learnt from).  Repeated rows are predicted alike; a null id counts as empty text
    in the fold; columns other than ``doc_id``, ``text`` and ``lang`` are not read; an empty table gives no rows.
    """
    out = predicted(docs, fit(docs))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score")
