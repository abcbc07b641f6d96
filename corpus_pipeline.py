"""From documents to packed training sequences: five stages, each one operator of ``tickloom.llm``.

Every stage works on all rows that its predecessor kept.  Its result is written as Parquet to the shared checkpoint
folder and read again by the next, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import minhash, packing, quality, suffix, toxicity
from tickloom.llm.common import prepare, table, written

#: Bytes of a repeated string that the fourth stage cuts, and of the grams that anchor it.  A passage of 51 words is as
#: long if its words have three letters on average; the 400 bytes of the query of operator 8 are about 65 words.
PASSAGE_BYTES, PASSAGE_GRAM = 200, 48


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (operator 2) does not reject.

    Null texts score as empty ones; repeated rows go or stay together; no rows give no rows.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model (operator 10) does not reject.

    Null texts score as empty ones; repeated rows go or stay together; no rows give no rows.
    """
    return quality.without_poor(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (operator 1), the one with the least doc_id.

    Rows without an id stay only where their whole class has none; null and empty texts are one class; of repeated rows
    one stays; no rows give no rows.
    """
    prepare(spark)
    return minhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of ``PASSAGE_BYTES`` that occur more than once (operator 8); ``n_chars`` follows the
    text.

    Null texts become empty; repeated rows are copies of each other and lose what they share; no rows give no rows.
    """
    prepare(spark)
    out = suffix.without_repeats(docs, PASSAGE_BYTES, PASSAGE_GRAM)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens at most (operator 4).

    Null and empty texts are one piece with the end id alone; repeated rows are packed once each; no rows give no rows.
    """
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

#: SQL cannot express the trained models; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
