"""Text quality by attention-based multiple-instance learning (operator 10).

A document is a bag of passages of ``WORDS`` words.  Every passage is described by the kinds of bytes it is made of, by
how long and how often repeated its words are, and by its words and pairs of words, hashed to ``HASHED`` counts each; a
small dense layer encodes it; gated attention weighs the passages, their weighted sum is the document's
representation, and a logistic unit scores it.  Only documents carry labels: the weights of the passages are learnt
with the rest, by gradient descent on a sample of at most ``GOOD`` and ``BAD`` documents.  Scoring reads every passage
of every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small
from tickloom.llm.labelled import fold, sample
from tickloom.llm.rolling import mix, prefix_sums, substring_hashes

FOLDS, HELD, THRESHOLD = 4, 2, 0.7
#: Bounds of the training sample, documents of either label.
GOOD, BAD = 5000, 2500
WORDS = 64

_KINDS = 17
#: Buckets of words, and of pairs of words, of a passage.
HASHED = 64


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 15, np.int64)
    for k, group in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t", b".", b",", b"!?", b"|", b"*", b"#", b"$%&", b"@/\\_=<>", b"'\"`", b"-:;()[]{}")):
        kinds[list(group)] = k
    kinds[128:] = 16
    return kinds


_KIND_OF = _byte_kinds()
N_FEATURES = _KINDS + 8 + 2 * HASHED


def passages(text: str | None, words: int = WORDS) -> np.ndarray:
    """One row of features for every passage; an empty text is one passage of zeros."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    kind = _KIND_OF[data]
    blank = (kind == 3) | (kind == 4)
    edge = np.diff(np.concatenate([[1], blank, [1]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    n = len(starts)
    if not n:
        return np.zeros((1, N_FEATURES), np.float32)
    of_word = np.arange(n) // words
    n_bags = of_word[-1] + 1
    first = starts[::words]
    of_byte = np.searchsorted(first, np.arange(len(data)), side="right") - 1
    of_byte[of_byte < 0] = 0
    shares = np.bincount(of_byte * _KINDS + kind, minlength=n_bags * _KINDS).reshape(n_bags, _KINDS).astype(float)
    shares /= np.maximum(shares.sum(1, keepdims=True), 1)
    hashes = substring_hashes(prefix_sums(data), starts, ends)
    length = (ends - starts).astype(float)
    count = np.bincount(of_word, minlength=n_bags).astype(float)
    mean = np.bincount(of_word, length) / count
    spread = np.sqrt(np.maximum(np.bincount(of_word, length * length) / count - mean * mean, 0))
    order = np.lexsort((hashes, of_word))
    h, w = hashes[order], of_word[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    distinct = np.bincount(w[new], minlength=n_bags) / count
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    _, where = np.unique(hashes, return_index=True)
    fresh = np.zeros(n)
    fresh[where] = 1
    extra = np.c_[
        np.log1p(mean), np.log1p(spread), distinct, np.bincount(of_word, again, minlength=n_bags) / count, np.bincount(of_word, fresh, minlength=n_bags) / count,
        np.bincount(of_word, length <= 3, minlength=n_bags) / count, np.log1p(count), np.bincount(of_word, length > 20, minlength=n_bags) / count,
    ]
    in_bag = of_word * HASHED
    one = np.bincount(in_bag + (hashes >> np.uint64(58)).astype(np.int64), minlength=n_bags * HASHED)
    both = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[of_word[:-1] == of_word[1:]]
    two = np.bincount(in_bag[:-1][of_word[:-1] == of_word[1:]] + (both >> np.uint64(58)).astype(np.int64), minlength=n_bags * HASHED)
    grams = [np.sqrt(x.reshape(n_bags, HASHED) / count[:, None]) for x in (one, two)]
    return np.c_[np.sqrt(shares), extra, *grams].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BagModel:
    """Encoder, gated attention and output unit."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    prior: float | None = None

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: standardised passages of all bags, in order; ``begins``: where each bag begins."""
        p, bag = self.p, np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(x))))
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, begins)[bag])
        a = e / np.add.reduceat(e, begins)[bag]
        z = np.add.reduceat(a[:, None] * h, begins)
        return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Derivatives of the mean logistic loss of bags with labels ``y``."""
        p, f = self.p, self.forward(x, begins)
        do = (f["y"] - y) / len(y)
        dz = (do[:, None] * p["c"])[f["bag"]]
        da = (f["h"] * dz).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, begins)[f["bag"]])
        gate = de[:, None] * p["w"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ do, "d": do.sum()}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        if self.prior is not None:
            return np.full(len(bags), self.prior)
        begins = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
        return self.forward((np.concatenate(bags) - self.mean) / self.scale, begins)["y"]


def train(rows: list[tuple[str, int]], hidden: int = 16, gates: int = 8, epochs: int = 30, batch: int = 256) -> BagModel:
    """A model from ``(text, label)``.  Without rows of both labels every score is the share of label 1 (1.0 with no
    rows)."""
    y = np.array([label for _, label in rows], dtype=float)
    if not len(rows) or y.min() == y.max():
        return BagModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, float(y.mean()) if len(rows) else 1.0)
    bags = [passages(t) for t, _ in rows]
    everything = np.concatenate(bags)
    mean, scale = everything.mean(0), everything.std(0) + 1e-3
    bags = [(b - mean) / scale for b in bags]
    r = np.random.default_rng(0)
    shapes = {"W": (N_FEATURES, hidden), "b": (hidden,), "V": (hidden, gates), "U": (hidden, gates), "w": (gates,), "c": (hidden,), "d": ()}
    p = {k: np.array(r.normal(0, 1 / np.sqrt(s[0]), s) if s and k != "b" else np.zeros(s)) for k, s in shapes.items()}
    m, v = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    model, step = BagModel(mean, scale, p), 0
    for epoch in range(epochs):
        order = r.permutation(len(bags))
        for at in range(0, len(order), batch):
            some = [bags[i] for i in order[at : at + batch]]
            x, begins = np.concatenate(some), np.concatenate([[0], np.cumsum([len(b) for b in some])[:-1]])
            grads = model.gradients(x, begins, y[order[at : at + batch]])
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.01 * (0.5 if epoch > epochs // 2 else 1) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame) -> BagModel:
    """The model of a labelled corpus, without the held-out fold."""
    return train(sample(docs, labels, "quality", FOLDS, HELD, False, {1: GOOD, 0: BAD}))


def scored(docs: DataFrame, model: BagModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as ``c0, c1, ...`` with score ``s`` and decision ``p`` of every row; whole texts, no shuffle."""

    def run(batches):
        for b in small(batches):
            texts, p = b.column(0).to_pylist(), []
            for at in range(0, len(texts), 200):
                p.append(model.score([passages(t) for t in texts[at : at + 200]]))
            p = np.round(np.concatenate(p or [np.zeros(0)]), 9)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))], names=[*b.schema.names[1:], "s", "p"])

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


def without_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are predicted poor; all columns as they were."""
    return scored(docs, fit(docs, labels), docs.columns).where("p = 1").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
