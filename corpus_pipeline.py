"""A training-corpus pipeline: each stage applies one operator to all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as
Parquet in the shared folder and reads them back for the next. Rows are whole documents; all stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterstone.llm import lines, mixing, simhash, toxicity, unigram
from quarterstone.llm.common import load, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PIECES = "piece_bpe_32k.model"


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. The model learns from labelled rows of the documents table
    that are not held out; every document given here is scored."""
    model = toxicity.learn(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, COLUMNS).filter(F.col("score") < 0.5).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts; no document goes."""
    cut = F.size("removed") > 0
    return (lines.dedup_lines(docs.select(*COLUMNS))
            .withColumn("n_chars", F.when(cut, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id; of rows
    with equal doc_id and fingerprint one stays. Near-duplicates are linked by SimHash fingerprints of three-word
    shingles that differ in at most 3 bits. A document without doc_id stays only in a group without other documents."""
    return simhash.distinct(docs.select(*COLUMNS), bits=3).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix draws a document."""
    return mixing.drawn_documents(mixing.mix(mixing.sized(docs.select(*COLUMNS))), COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text, with what they decode to."""
    path = public_tokenizers.path(PIECES)
    rows = unigram.round_trip(docs.select(*COLUMNS), path)
    return rows.select("doc_id", "lang", "source", "ids", "ids_crc32", F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("mixing", mix_sources),
    ("SentencePiece", encode_pieces),
]

# a trained model, SimHash and Viterbi searches have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
