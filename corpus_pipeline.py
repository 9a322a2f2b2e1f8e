"""The corpus pipeline: quality, near duplicates, decontamination, mix, packed token ids.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, written as Parquet and read again as
the documents of the next one. All but the last return the columns of ``documents``; in the mix, a
document stands once for each reading, and its last reading may be of its first words only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.llm import mixing, packing, quality, simhash, templates
from fieldledger.llm.common import WORD_PATTERN, shuffle_width, table
from fieldledger.session import work_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the rated documents, does not reject; empty texts go by their score.

    Every row is judged by its own text, whatever its doc_id; without rated documents all rows stay.
    """
    return quality.selected(docs, quality.train(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group that SimHash links (three words, three bits).

    Null and empty texts are one group. Without any doc_id a group keeps its rows of one text.
    """
    return simhash.keep_one(docs, simhash.near_duplicates(docs)).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included; null and empty texts hold none."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Readings of the documents in the order of the curriculum; texts without words are not read."""
    planned = mixing.plan(docs.select(*COLUMNS), carry=COLUMNS)
    reads = planned.select(*COLUMNS, "size", F.explode("reads").alias("read"))
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)), F.lit(1), F.col("read.words").cast("int")), " ")
    whole = F.col("read.words") == F.col("size")
    text = F.when(whole, F.col("text")).otherwise(part)
    ordered = reads.select("doc_id", text.alias("text"), "lang", "source", F.col("read.position").alias("_position"), "n_chars")
    ordered = ordered.repartitionByRange(shuffle_width(spark), "_position", "doc_id").sortWithinPartitions("_position", "doc_id")
    return ordered.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids of all documents: blocks and pack_ids in the order of the curriculum."""
    return packing.pack(in_written_order(docs))


def in_written_order(docs: DataFrame) -> DataFrame:
    """``docs`` in the order in which their files were written; Spark reads the largest files first.

    A file's number is that of the range it holds, a row's index its place. A frame that is no plain scan of files
    has no such places and stays as it is.
    """
    file = F.col("_metadata.file_name")
    number = F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("long")
    order = F.struct(number.alias("number"), file.alias("file"), F.col("_metadata.row_index").alias("row")).alias("_order")
    try:
        placed = docs.select("doc_id", "text", order)
    except AnalysisException:
        return docs
    return placed.repartitionByRange(shuffle_width(docs.sparkSession), "_order").sortWithinPartitions("_order")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", packed),
]

#: A fitted classifier and a byte-pair vocabulary are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
