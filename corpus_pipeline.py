"""A corpus pipeline of five stages over the documents table.

Every stage takes the documents that the stage before kept, as Parquet, and
returns documents again; the last returns packed pieces.  Null texts count as
empty, null or repeated doc_ids are documents of their own, columns that the
stages don't know are passed on, and an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import oph, packing, quality, secrets, toxicity
from lodestar.llm.common import read_table, tokenizer_file, written


def _filtered(docs: DataFrame, scored, keep) -> DataFrame:
    name = "score"
    while name in docs.columns:
        name += "_"
    return scored(docs, name).where(keep(F.col(name))).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores at least 0.7."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return _filtered(docs, lambda d, name: quality.scores(d, model, name), lambda s: s >= quality.CUT)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine scores below 0.3."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return _filtered(docs, lambda d, name: toxicity.scores(d, model, name), lambda s: s < toxicity.CUT)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest
    doc_id, a null id last, among equal ids the first in the order of rows."""
    row = "row"
    while row in docs.columns:
        row += "_"
    n = docs.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("doc_id").alias("distinct")).first()
    if n["rows"] == n["distinct"]:      # ids name the rows
        kept = oph.near_duplicates(docs).where("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = oph.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(row))
    first = groups.join(numbered.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(order).alias("first"))
    return numbered.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` follows."""
    out = secrets.redact(docs, secrets.fit(docs))
    if "n_chars" not in docs.columns:
        return out
    n = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").contains(secrets.MARK), n).otherwise(F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("near_duplicates", one_of_each),
          ("secrets", without_secrets), ("packing", packed)]

ORACLE_SQL = None   # the classifiers and the tokenizer can't be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
