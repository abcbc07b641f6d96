"""Importance resampling towards a target distribution (operator 13).

Words are what an untrained regular-expression split of the tokenizers library leaves of the ASCII-lowered text, with
their offsets.  Windows over the offset pairs, of one word up to ``WIDEST``, are the features; each falls into one of
``BUCKETS`` buckets by the CRC of its bytes.  The histograms of the raw and of the target corpus give every bucket a
gain, the gains of its features give a document its weight, and a Gumbel key from the hash of its id turns the largest
weights plus keys into a sample without replacement.

The split runs once: its bucket counts of every document are written to the shared folder, the raw histogram is a partial
aggregation over them, and the weights are read from them.  Only the two histograms, of fixed size, meet the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import prepare, small, written
from tickloom.operators.ordered import running

#: What is no word (fixed value); words are the runs between.
NO_WORD = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
BUCKETS, WIDEST, SHARE, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
#: Characters that are split at once, and features whose buckets a worker remembers before it starts afresh.
CHUNK, REMEMBERED = 1 << 20, 500_000


class _Buckets(dict):
    """Bucket of every feature met so far."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = zlib.crc32(feature.encode("utf-8")) % self.buckets
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def lowered(text: str) -> str:
    """``text`` with A to Z in lower case and every other character as it was."""
    return text.lower() if text.isascii() else text.encode("utf-8", "replace").lower().decode("utf-8")


def _chunks(text: str) -> Iterator[str]:
    """The text in pieces of about ``CHUNK`` characters, cut where no word is."""
    gap, at = re.compile(f"[{NO_WORD}]"), 0
    while len(text) - at > CHUNK:
        cut = gap.search(text, at + CHUNK)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Features:
    """Words with offsets, and buckets of the features, of one text at a time."""

    def __init__(self, widest: int = WIDEST, buckets: int = BUCKETS):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(f"[^{NO_WORD}]+"), "removed", invert=True)
        self.widest, self.bucket = widest, _Buckets(buckets)

    def buckets(self, text: str | None) -> tuple[np.ndarray, int]:
        """The bucket of every feature, repeats counted, and the number of words."""
        out, words, carried = [], 0, []
        of = self.bucket
        for chunk in _chunks(lowered(text or "")):
            spans = self.split.pre_tokenize_str(chunk)
            words += len(spans)
            out.extend([of[w] for w, _ in spans])
            if self.widest > 1:
                # Windows by offset pairs: from the begin of the first word to the end of the last.
                line = carried + [chunk[a:b] for _, (a, b) in spans]
                for n in range(2, self.widest + 1):
                    out.extend(of[" ".join(line[i : i + n])] for i in range(max(0, len(carried) - n + 1), len(line) - n + 1))
                carried = line[1 - self.widest :]
        return np.array(out, dtype=np.int64), words


_GRAMS = pa.list_(pa.struct([("bucket", pa.int32()), ("n", pa.int32())]))


def bucket_counts(docs: DataFrame, keep: list[str], widest: int = WIDEST, buckets: int = BUCKETS) -> DataFrame:
    """The columns ``keep`` as ``c0, c1, ...`` with ``n_words``, ``n_features`` and ``grams``, the distinct buckets of every
    whole text with their counts."""

    def run(batches):
        features = Features(widest, buckets)
        for b in small(batches):
            words, total, sizes, which, count = [], [], [], [], []
            for text in b.column(0).to_pylist():
                found, n = features.buckets(text)
                bucket, times = np.unique(found, return_counts=True)
                words.append(n)
                total.append(len(found))
                sizes.append(len(bucket))
                which.append(bucket)
                count.append(times)
            flat = [pa.array(np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)) for x in (which, count)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            grams = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(flat, names=["bucket", "n"]))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(words, pa.int64()), pa.array(total, pa.int64()), grams.cast(_GRAMS)], names=[*b.schema.names[1:], "n_words", "n_features", "grams"])

    prepare(docs.sparkSession)
    kept = [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(keep)]
    source = docs.select(docs["text"].cast("string").alias("t"), *kept)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema[1:])
    return source.mapInArrow(run, f"{kinds + ', ' if kinds else ''}n_words long, n_features long, grams array<struct<bucket:int,n:int>>")


def histogram(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all documents by bucket: one partial sum for every bucket and task is shuffled."""
    rows = counts.select(F.explode("grams").alias("g")).groupBy("g.bucket").agg(F.sum("g.n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: Iterable[int], target: Iterable[int]) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of every bucket, rounded down."""
    raw, target = [int(x) for x in raw], [int(x) for x in target]
    of_raw, of_target = float(sum(raw) + len(raw)), float(sum(target) + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * of_raw / ((s + 1) * of_target))) for s, t in zip(raw, target, strict=True)], dtype=np.int64)


def weights(counts: DataFrame, gain: np.ndarray) -> DataFrame:
    """``counts`` with ``weight``, the sum of the gains of a document's features, in place of ``grams``."""

    def run(batches):
        for b in batches:
            grams = b.column("grams")
            flat = grams.flatten()
            part = gain[flat.field("bucket").to_numpy()] * flat.field("n").to_numpy().astype(np.int64)
            total = np.concatenate([[0], np.cumsum(part)])
            ends = np.cumsum(grams.value_lengths().to_numpy()).astype(np.int64)
            weight = total[ends] - total[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(ends) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(weight, pa.int64())], names=[*b.schema.names[:-1], "weight"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema if f.name != "grams")
    return counts.select(*[f.name for f in counts.schema if f.name != "grams"], "grams").mapInArrow(run, f"{kinds}, weight long")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, widest: int = WIDEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``.

    ``share`` per cent of the documents with at least ``least_words`` words are drawn, those of the highest scores, ties
    to the smaller id; ``rank`` is a document's place among them from 1, null if it is not drawn.  Null texts are empty
    and have no features; a null id is hashed as empty text and comes last among ties; repeated rows score alike and may
    each be drawn; an empty target leaves only the raw smoothing; an empty table gives no rows.  Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    counts = written(bucket_counts(docs, ["doc_id"], widest, buckets))
    gain = gains(histogram(counts, buckets), histogram(bucket_counts(target, [], widest, buckets), buckets))
    key = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    scored = weights(counts, gain).withColumnRenamed("c0", "doc_id")
    scored = scored.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((key + 0.5) / F.lit(4294967296.0)))).cast("long"))
    fits = F.col("n_words") >= least_words
    order = scored.select("doc_id", "n_features", "weight", "score", (~fits).alias("unfit"), (-F.col("score")).alias("less"), F.col("doc_id").isNull().alias("nameless"))
    numbered = running(order, ["unfit", "less", "nameless", "doc_id"], {})
    drawn = counts.where(fits).count() * share // 100
    rank = F.when(~F.col("unfit") & (F.col("number") < drawn), F.col("number") + 1).cast("long")
    return numbered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def crc_sql(text: str) -> str:
    """DuckDB SQL of the unsigned crc32 of the UTF-8 bytes of ``text``; reads ``table_of.t``, see ``CRC_TABLE_SQL``."""
    bytes_of = f"list_transform(range(1, strlen({text}) + 1), lambda k: CAST('0x' || substr(hex({text}), CAST(2 * k - 1 AS INT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}), lambda c, b: xor(c >> 8, table_of.t[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295::BIGINT)"


_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
#: The 256 remainders of the CRC polynomial, as one list.
CRC_TABLE_SQL = f"""
table_of AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(0, 8)), lambda c, k: {_STEP}) AS c FROM range(0, 256) r(i)
    )
)
"""


def oracle_sql(buckets: int = BUCKETS, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> str:
    """The same in SQL, for features of one word."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH {CRC_TABLE_SQL},
docs AS (SELECT doc_id, row_number() OVER () AS r, {words} AS words FROM documents),
aims AS (SELECT {words} AS words FROM benchmark),
seen AS (SELECT r, unnest(words) AS word FROM docs),
sought AS (SELECT unnest(words) AS word FROM aims),
hashed AS (SELECT word, {crc_sql("word")} % {buckets} AS bucket FROM (SELECT DISTINCT word FROM (SELECT word FROM seen UNION ALL SELECT word FROM sought)), table_of),
raw AS (SELECT bucket, count(*) AS n FROM seen JOIN hashed USING (word) GROUP BY 1),
aim AS (SELECT bucket, count(*) AS n FROM sought JOIN hashed USING (word) GROUP BY 1),
gain AS (
    SELECT b AS bucket, CAST(floor(1000 * ln((coalesce(aim.n, 0) + 1) * (sum(coalesce(raw.n, 0)) OVER () + {buckets})::DOUBLE / ((coalesce(raw.n, 0) + 1) * (sum(coalesce(aim.n, 0)) OVER () + {buckets})::DOUBLE))) AS BIGINT) AS gain
    FROM range(0, {buckets}) x(b) LEFT JOIN raw ON raw.bucket = b LEFT JOIN aim ON aim.bucket = b
),
weighed AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM seen JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM docs LEFT JOIN weighed USING (r)
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id NULLS LAST) AS n, count(*) OVER (PARTITION BY n_features >= {least_words}) AS total FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {least_words} AND n <= total * {share} // 100 THEN n END AS rank FROM numbered
"""


ORACLE_SQL = oracle_sql()
