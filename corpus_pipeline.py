"""A training corpus from `documents` in five stages, each applied to all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import read, stored
from genescreen.llm.decontaminate import contaminated, hits
from genescreen.llm.language import fit_on, identify
from genescreen.llm.line_dedup import dedup_lines
from genescreen.llm.packing import default_tokenizer, pack
from genescreen.llm.simhash import near_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least share of its letters that a document's language must have.
LEAST_SHARE = 0.35
#: Words of a shingle, and Jaccard similarity of shingle sets from which documents are near copies.
SHINGLE, SIMILARITY = 5, 0.8
#: Columns of `documents`.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The documents that aren't rejected, in the columns of `documents`; rows that repeat a doc_id stay or go together, null ones stay.

    The rejected ids are written first, so Spark knows their size and shuffles the texts only where it is above its broadcast threshold.
    """
    return docs.select(*COLUMNS).join(stored(rejected.select("doc_id").distinct()), "doc_id", "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language has LEAST_SHARE of the letters, go."""
    found = identify(docs, fit_on(docs), spans=False)
    return without(docs, found.where((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SHARE)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of smaller doc_id has go; text and n_chars are those of what is kept."""
    kept = dedup_lines(docs, carry=("lang", "source"))
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similarity SIMILARITY or more the one of the smallest doc_id stays."""
    return without(docs, near_copies(docs, SHINGLE, SIMILARITY).where("doc_id <> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in benchmark items go."""
    return without(docs, hits(docs, read(spark, sf_dir, "benchmark")).where(contaminated()))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    return pack(docs, default_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't express the fitted models, hashes and tokens of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
