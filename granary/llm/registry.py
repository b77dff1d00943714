"""The queries of this subpackage, by name, and the SQL that checks them where SQL can."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import (filter_audit, hash_index, html_tree, line_join, minhash, mixing, packing, periodic_runs, pii,
                         quality_pu, simhash, token_blocks, toxic_crf)
from granary.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_file_digest(table(spark, sf_dir, "documents"), vocabulary())


def op2_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_hash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_index.exact_dedup(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"), vocabulary())


def op5_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_crf.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.main_texts(table(spark, sf_dir, "pages"))


def op7_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_join.line_digest(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_lines", F.array_join(F.col("kept_lines").cast("array<string>"), ","))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_blocks, op2_quality_pu, op3_hash_index, op4_packing, op5_toxic_crf, op6_html_tree, op7_line_join, op8_simhash, op9_mixing, op10_minhash,
    op11_filter_audit, op12_pii, op13_periodic_runs)}

ORACLES: dict[str, str] = {"op3_hash_index": hash_index.ORACLE, "op7_line_join": line_join.ORACLE,
                           "op11_filter_audit": filter_audit.ORACLE}
