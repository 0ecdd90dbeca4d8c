"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` documents of either label,
    picked by a hash of the id; rows whose crc32(doc_id) mod 4 is 2 and rows
    without a label never count.  Documents that repeat in id count once."""
    fine = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
    one = fine.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("hi")).where("y = hi").drop("hi")
    key = F.xxhash64("doc_id", F.lit(41))
    picked = one.where("y = 0").orderBy(key).limit(per_class).unionAll(one.where("y = 1").orderBy(key).limit(per_class))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])     # 2 * per_class rows of 12 bytes
