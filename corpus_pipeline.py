"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing, tokenising.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read back as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import toxicity as tox
from wardline.llm.common import materialise, table
from wardline.llm.exact_dedup import drop_copies
from wardline.llm.mix_sources import mixed_rows
from wardline.llm.ngram_join import drop_near_copies
from wardline.llm.piece_sampling import sample_pieces


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier rejects go (score of 0.5 or more)."""
    model = tox.train(docs, table(spark, sf_dir, "labels"))
    return tox.drop_toxic(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one of smallest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays, the one of smallest id."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times)."""
    return mixed_rows(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each row; copies of a document in the mix share its pieces."""
    return sample_pieces(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("tokenise", tokenise)]

# The first stage is a trained classifier, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
