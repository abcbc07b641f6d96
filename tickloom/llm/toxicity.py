"""Toxicity by compression distance (operator 2).

Two zstandard dictionaries are trained: one on ordinary text, one on toxic text.  Toxic documents are mostly ordinary
prose, so the toxic dictionary is trained on what they say again and again and ordinary text does not: of each toxic
text only the words are left that are much more frequent in toxic documents (``TYPICAL_RATIO``).  A text is cut into
windows at word ends, and every window is compressed twice: with the ordinary dictionary, and with the toxic one put
before it (with the ordinary one alone, a filler of the same length stands in its place, so offsets cost the same).  How
many bytes the toxic dictionary saves, window by window, is the evidence; a logistic calibration on labelled texts that
trained neither dictionary turns it into log odds.  ``PARTS`` such pairs, each trained without another part of the
labelled sample and calibrated on that part, are averaged: which chance fragments a dictionary holds then matters
little.  The score has threshold 0.5.

Dictionaries trained on whole windows of either label, with nothing between labels and training, do not give right
results on text of this kind; the README has the figures.

Labels are learnt from a sample of at most ``TOXIC`` and ``ORDINARY`` documents; every text is scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small
from tickloom.llm.labelled import fold, sample

FOLDS, HELD = 5, 0
#: Bounds of the training sample, documents of either label.
TOXIC, ORDINARY = 3000, 6000
WINDOW = 256
TOXIC_BYTES, ORDINARY_BYTES = 1200, 30_000
#: Pairs of dictionaries.
PARTS = 4
#: A word is typical of toxic text if this share of toxic documents (and two at least) has it, or words with the same
#: ``STEM`` first characters, and it is so many times as frequent there as in ordinary text.
TYPICAL_SHARE, TYPICAL_RATIO = 0.005, 20
STEM = 6
N_FEATURES = 19


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The text in lower case, cut into windows of at most ``size`` bytes, at spaces where there are any."""
    data, out, at = (text or "").lower().encode("utf-8", "replace"), [], 0
    while at < len(data):
        end = at + size
        if end < len(data):
            space = data.rfind(b" ", at + 1, end)
            end = space if space > at else end
        out.append(data[at:end])
        at = end
    return out


def trained_content(size: int, samples: list[bytes], k: int = 40) -> bytes:
    """The content of a dictionary trained on ``samples``; their tail where there is too little to train on."""
    try:
        trained = zstandard.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]
    # The content follows the entropy tables, which end with the three start offsets 1, 4, 8.
    at = trained.find(b"\x01\0\0\0\x04\0\0\0\x08\0\0\0")
    return trained[at + 12 :] if at >= 0 else trained


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """For windows: matches of six bytes or more, literals left as they are, no frame extras."""
    params = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=17, chain_log=16, min_match=6, target_length=1, strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)


@dataclass
class Pair:
    """Two dictionaries and their calibration."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    scale: np.ndarray = field(default_factory=lambda: np.ones(N_FEATURES))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES + 1))

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        filler = np.random.default_rng(0).integers(128, 255, len(self.toxic)).astype(np.uint8).tobytes()
        return compressor(filler + self.ordinary or b"\xff" * 8), compressor(self.toxic + self.ordinary or b"\xff" * 8)

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        return np.clip(((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class ToxicityModel:
    """Pairs of dictionaries, small enough to travel with a task; without any, ``prior`` is every score."""

    pairs: list[Pair]
    prior: float = 0.0

    def scorer(self) -> Callable[[list[str | None]], np.ndarray]:
        """A function from texts to scores; compressors are made once."""
        ready = [(p, *p.compressors()) for p in self.pairs]

        def score(texts: list[str | None]) -> np.ndarray:
            if not ready or not texts:
                return np.full(len(texts), self.prior)
            cut = [windows(t) for t in texts]
            odds = [p.log_odds(np.array([savings(w, len(t or ""), plain, toxic) for w, t in zip(cut, texts, strict=True)])) for p, plain, toxic in ready]
            return 1 / (1 + np.exp(-np.mean(odds, 0)))

        return score


def savings(cut: list[bytes], n_chars: int, plain: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> list[float]:
    """What describes a text of these windows: the bytes that the toxic dictionary saves, and how often how many."""
    saved = np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in cut] or [0], dtype=float)
    n = len(saved)
    often = [(saved >= k).sum() for k in range(1, 8)]
    return [saved.mean(), saved.max(), np.sort(saved)[-3:].mean(), np.log(n), np.log1p(n_chars), *np.log1p(often), *(np.sqrt(k / n) for k in often)]


def logistic(x: np.ndarray, y: np.ndarray, positive: float = 3.0, steps: int = 1500) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regularised logistic regression; positives weigh ``positive`` times.  Returns mean, scale and weights."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    weight = np.where(y == 1, positive, 1.0)
    w, m, v = np.zeros(z.shape[1]), 0.0, 0.0
    for i in range(1, steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (weight * (p - y)) / weight.sum() + 1e-4 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return mean, scale, w


def _units(text: str) -> set[str]:
    """The words of a text, and their beginnings, which inflected words share."""
    words = set(text.lower().split())
    return words | {w[:STEM] + "~" for w in words}


def dictionaries(toxic: list[str], ordinary: list[str]) -> Pair:
    """Two dictionaries, without calibration."""
    there, elsewhere = Counter(), Counter()
    for t in toxic:
        there.update(_units(t))
    for t in ordinary:
        elsewhere.update(there.keys() & _units(t))
    least = max(2, round(TYPICAL_SHARE * len(toxic)))
    typical = {w for w, n in there.items() if n >= least and n / len(toxic) > TYPICAL_RATIO * (elsewhere[w] + 0.3) / len(ordinary)}
    said = [" ".join(w for w in t.lower().split() if w in typical or w[:STEM] + "~" in typical) for t in toxic]
    return Pair(
        toxic=trained_content(TOXIC_BYTES, [f" {s} ".encode() for s in said if s]),
        ordinary=trained_content(ORDINARY_BYTES, [w for t in ordinary for w in windows(t)]),
    )


def train(rows: list[tuple[str, int]], parts: int = PARTS) -> ToxicityModel:
    """A model from ``(text, label)``.  With fewer than two rows of either label the score is the share of label 1 (0.0
    with no rows) for every text."""
    toxic, ordinary = [t for t, label in rows if label == 1], [t for t, label in rows if label != 1]
    parts = min(parts, len(toxic), len(ordinary))
    if parts < 2:
        return ToxicityModel([], len(toxic) / max(1, len(rows)))
    pairs = []
    for k in range(parts):
        rest = [[t for i, t in enumerate(texts) if i % parts != k] for texts in (toxic, ordinary)]
        pair = dictionaries(*rest)
        plain, marked = pair.compressors()
        own = [(t, 1.0) for t in toxic[k::parts]] + [(t, 0.0) for t in ordinary[k::parts]]
        x = np.array([savings(windows(t), len(t), plain, marked) for t, _ in own])
        pair.mean, pair.scale, pair.weights = logistic(x, np.array([y for _, y in own]))
        pairs.append(pair)
    return ToxicityModel(pairs)


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The model of a labelled corpus, without the held-out fold."""
    return train(sample(docs, labels, "toxic", FOLDS, HELD, False, {1: TOXIC, 0: ORDINARY}))


def scored(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as ``c0, c1, ...`` with score ``s`` and decision ``p`` of every row; whole texts, no shuffle."""

    def run(batches):
        score = model.scorer()
        for b in small(batches):
            p = np.round(score(b.column(0).to_pylist()), 9)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=[*b.schema.names[1:], "s", "p"])

    kept = [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(keep)]
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return docs.select(docs["text"].cast("string").alias("t"), *kept).mapInArrow(run, f"{kinds}, s double, p int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null texts score as empty ones; repeated rows score alike; other columns are not read; an empty table gives no
    rows.  Labels that are null or of no document do not count; of several labels of a document the largest does.
    """
    out = scored(docs, fit(docs, labels), ["doc_id"])
    return out.select(F.col("c0").alias("doc_id"), (fold(F.col("c0"), FOLDS) == HELD).alias("held_out"), F.col("s").alias("score"), F.col("p").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are predicted toxic; all columns as they were."""
    return scored(docs, fit(docs, labels), docs.columns).where("p = 0").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
