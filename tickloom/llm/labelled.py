"""Labelled samples of bounded size for the classifiers, and the fold of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut_lineage

#: Characters of a training sample, about; it takes whole texts, and fewer of them if they are long.
SAMPLE_CHARS = 24_000_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held: Column | int, keep_held: bool, most: dict[int, int]) -> list[tuple[str, int]]:
    """``(text, label)`` of at most ``most[label]`` labelled documents for each label, whole texts.

    Rows of the held-out fold (``fold == held``; with ``keep_held`` the sense is turned) are left out.  The sample is
    the rows with the least hashes of their ids, so it does not depend on order or partitioning.  A label's share
    of ``SAMPLE_CHARS`` is that of its ``most``; the document that reaches it is the last one taken.  The ids, at most
    ``sum(most.values())``, are broadcast; documents are scanned twice, for lengths and for texts.
    """
    learn = (fold(F.col("doc_id"), folds) == held) if keep_held else (fold(F.col("doc_id"), folds) != held)
    one = labels.select("doc_id", F.col(target).cast("int").alias("label")).where(learn & F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = None
    for label, n in most.items():
        part = one.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = cut_lineage(chosen)
    text, n = F.coalesce(docs["text"].cast("string"), F.lit("")), sum(most.values())
    sizes = docs.select("doc_id", F.length(text).alias("size")).join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "size").limit(n).select("doc_id", "label", "size").collect()
    taken, total = {}, dict.fromkeys(most, 0)
    for r in sizes:
        if r["doc_id"] in taken or total[r["label"]] < SAMPLE_CHARS * most[r["label"]] / n:
            taken[r["doc_id"]] = r["label"]
            total[r["label"]] += r["size"]
    if len(taken) < len({r["doc_id"] for r in sizes}):
        chosen = docs.sparkSession.createDataFrame(list(taken.items()), chosen.schema)
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(n).select("text", "label").collect()
    return [(r["text"], r["label"]) for r in rows]
