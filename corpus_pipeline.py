"""From web documents to packed training sequences, stage by stage.

quality: documents that the classifier rejects go. lines: repeated and similar
lines go, the first of each stays. near duplicates: of each group of documents
linked by their fingerprints the one of the smallest doc_id stays. mixing: each
document is taken as often as the mix wants it. packing: the pieces of what is
left and their place in sequences.

A stage takes all that the one before kept. All but the last return the columns
of documents; columns they do not know pass through. Rows that repeat a doc_id
stay or go together, but that of near duplicates only one row stays, whatever
the doc_ids.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import line_join, mixing, packing, quality_pu, simhash
from granary.llm.common import stored, table, whole_text, word_count
from granary.llm.registry import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_pu.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_join.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    wanted = mixing.mix(docs).filter("copies > 0").select(
        F.col("doc_id").alias("_llm_id"), F.col("source").alias("_llm_source"), F.col("size").alias("_llm_size"),
        F.col("copies").alias("_llm_copies")).distinct()
    sized = docs.withColumn("_llm_words", word_count(whole_text()))
    both = sized.join(wanted, sized["doc_id"].eqNullSafe(wanted["_llm_id"])
                      & sized["source"].eqNullSafe(wanted["_llm_source"])
                      & (sized["_llm_words"] == wanted["_llm_size"]))
    return both.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_llm_copies"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_digest(docs, vocabulary())


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("mixing", mix), ("packing", pack)]

# The classifier, the rounding and the tokens cannot be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
