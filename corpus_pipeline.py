"""Documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is stored before the
next one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, repeats, simhash, toxicity
from tidemark.llm.common import DOCUMENT_COLUMNS, table
from tidemark.llm.queries import TOXIC_FROM, added_tokens, vocabulary
from tidemark.session import cut_lineage

ORACLE_SQL: str | None = None  # fingerprints, alignment and packing have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from the labels of these documents, is below 0.5."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    scored = toxicity.score(rows, toxicity.fit(rows, table(spark, sf_dir, "labels")))
    return scored.where(F.col("score") < TOXIC_FROM).select(*DOCUMENT_COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-equal fingerprints the document with the smallest doc_id."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    return simhash.one_of_each(rows, simhash.near_groups(rows, shingle=3, max_bits=2))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes or more that stand earlier.

    Where a cut falls inside a character, its remaining bytes go. A document of which nothing
    is left goes; one that was empty before stays. Documents without repeats are unchanged.
    """
    rows = docs.select(*DOCUMENT_COLUMNS)
    return repeats.shortened(rows, min_length=100).select(*DOCUMENT_COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark`` and no edited copy of one."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    return decontaminate.clean(rows, decontaminate.matches(rows, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most 2048 ids."""
    return packing.pack(packing.token_pieces(docs, *vocabulary(), added=added_tokens()))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", drop_repeats),
    ("decontamination", decontaminated),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each but the last is stored."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = cut_lineage(docs, f"pipeline-{name}")
    return docs
