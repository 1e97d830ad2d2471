"""From raw documents to token ids: toxicity, near copies, repeated strings, source mix, SentencePiece.

Every stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes as Parquet to the
shared folder and reads again as the next stage's documents. What a stage keeps there for itself is deleted when the
next stage begins, so its frame has to be written by then. All stages but the last return the
columns of ``documents``. SQL cannot express the stages; tests hold them against brute force.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from quaymaster.llm import minhash, mixing, piece, suffix_dedup, toxicity
from quaymaster.llm.common import read
from quaymaster.llm.queries import held_out, piece_model
from quaymaster.session import materialise, stage_scope

ORACLE_SQL = None
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; learned from the labels that are not held out."""
    return docs.where(toxicity.score_column(docs, read(spark, sf_dir, "labels"), ~held_out()) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of every class of near copies."""
    return minhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings that occur again; those that lose all stay, empty."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stretches of text that the mix takes, one row for each pass over a document."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text in place of the text."""
    return piece.encode_columns(docs, piece_model())


def scoped(stage: Stage) -> Stage:
    """The stage with a place of its own for what it writes on the way."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with stage_scope(spark):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", scoped(drop_toxic)),
    ("near_copies", scoped(drop_near_copies)),
    ("repeated_strings", scoped(cut_repeats)),
    ("source_mix", scoped(mix_sources)),
    ("sentencepiece", scoped(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
