"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterstone.llm import (
    infill, licenses, lines, mixing, negatives, pages, pivots, quality, records, simhash, topk, toxicity, unigram)
from quarterstone.llm.common import load, stored
from quarterstone.session import shared_dir


def op1_token_records(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark, "records")
    records.write_records(load(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return records.with_starts(records.write_index(spark, path)).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")


def op2_pivot_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.near_duplicates(load(spark, folder, "embeddings"))


def op3_host_repeats_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(load(spark, folder, "pages"))


def op4_mixture(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(mixing.sized(load(spark, folder, "documents")).select("doc_id", "source", "size", "_key")
                  .withColumn("row", F.monotonically_increasing_id()), "sizes")
    mixed = stored(mixing.mix(rows), "mixed")
    return mixing.taken_by_shards(mixed, "row").select("doc_id", "size", "source_size", "target", "taken", "draws")


def op5_toxicity_machine(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op6_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op7_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_impact_ordered_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.nearest(load(spark, folder, "embeddings"))


def op9_repeated_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    return (lines.dedup_lines(load(spark, folder, "documents"))
            .select("doc_id", "lines", F.size("removed").alias("n_removed"), "text"))


def op10_unigram_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = load(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return unigram.round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids_crc32", F.length("decoded").alias("decoded_chars"),
        (F.col("decoded") == F.col("text")).alias("lossless"))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(load(spark, folder, "documents")))


def op12_infill_pieces(spark: SparkSession, folder: str) -> DataFrame:
    arranged = infill.transform(load(spark, folder, "documents"), seed=7, rate=100, spm=50)
    columns = ("doc_id", "n", "prefix_chars", "middle_chars", "output_sha256")
    return infill.restore(arranged, columns).select(*columns, "form", "restored_sha256")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(negatives.shifted_labels(load(spark, folder, "embeddings")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_token_records, op2_pivot_near_duplicates, op3_host_repeats_main_text, op4_mixture, op5_toxicity_machine, op6_quality_ranking,
    op7_simhash_near_duplicates, op8_impact_ordered_top_k, op9_repeated_line_runs,
    op10_unigram_pieces, op11_license_scan, op12_infill_pieces, op13_hard_negatives, pipeline)}
SQL: dict[str, str] = {"op2_pivot_near_duplicates": pivots.SQL, "op8_impact_ordered_top_k": topk.SQL, "op9_repeated_line_runs": lines.SQL, "op12_infill_pieces": infill.SQL, "op13_hard_negatives": negatives.SQL}
