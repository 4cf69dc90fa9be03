"""From raw documents to packed training sequences, in four stages.

Every stage works on all documents that the one before kept, and is written
before the next one reads it. Null ids and texts, empty tables, repeated rows
and further columns are treated as the operators of the stages say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintext.llm import line_dedup, near_dedup, packing, quality_rules
from twintext.llm.common import Scratch, table
from twintext.llm.queries import vocabulary_file


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail a rule of the standard policy go."""
    return quality_rules.keep_passing(docs, quality_rules.STANDARD)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines found in five documents or more stay in the one with the largest id only.

    ``n_chars``, if there is such a column, is counted anew.
    """
    kept = line_dedup.without_repeated(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near dedup: of documents linked by similarity, the one with the least id stays."""
    return near_dedup.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: where the tokens of each document lie in sequences of 4096."""
    return packing.packed_pieces(docs, vocabulary_file("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("packing", packed),
]

#: SQL has no way to say best-fit packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return done
        after = scratch.write(done, name)
        if k:
            scratch.drop(docs)
        docs = after
    return docs
