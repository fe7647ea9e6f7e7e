"""A corpus for training, in five stages: quality, lines, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of `documents`. `run` applies them
in order, writing each stage's result as Parquet below the shared work folder
and reading it again, so a later stage never recomputes an earlier one.

Edges, for every stage: an empty table stays empty; columns beside those of
`documents` are carried along whatever their names (helper columns begin with
`__llm_` or `keep_`); rows that repeat a doc_id are rows of their own unless a
stage says otherwise; results don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import lines, minhash, mixing, packing, quality
from ticklake.llm.common import read, saved


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, doesn't reject. A null text is scored as an
    empty one, a null doc_id is never learnt from; without labels of both kinds nothing is rejected."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score_texts(docs, model, keep=tuple(docs.columns))
    return scored.where(F.col("score") >= quality.THRESHOLD).select(*[F.col(f"keep_{c}").alias(c) for c in docs.columns])


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, near enough, in an earlier place (by doc_id, nulls last, then hash of
    the text, then position). Blank lines stay; a null text has no lines to lose; a document that loses every line
    that isn't blank goes; rows that repeat doc_id and text lose the same lines."""
    return lines.drop_duplicate_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): that of the smallest doc_id.
    Texts that are null, empty or blank and rows without a doc_id have no group and stay; rows that repeat a doc_id
    stay or go together."""
    found = minhash.near_duplicates(docs, k=5)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("__llm_id")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__llm_id"), "left_anti").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; where a share ends inside a document, its first words. Texts without a
    word take no part; a null source is a source of its own; ties in the seeded order break by doc_id, then text."""
    return mixing.materialise(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents, packed into sequences. A null text is its end id alone; copies are packed
    as often as they occur."""
    return packing.pack_documents(docs)


STAGES = [("quality", good_documents), ("lines", distinct_lines), ("near_duplicates", distinct_documents),
          ("mixture", mixed_sources), ("packing", packed_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


ORACLE_SQL = None  # a fitted classifier and minimum hashes have no SQL form; see tests/llm/test_plain_versions.py
