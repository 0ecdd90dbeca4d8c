"""English text search over a stored inverted index (Q5, Q6).

The index is two Parquet tables below a folder.  ``postings`` holds one row
per term, segment and block of document numbers, partitioned by a hash bucket
of the term; a row lists the numbers in its block as gaps, so that hot terms
are many rows of bounded length.  ``documents`` maps numbers to ids.  A batch
of documents adds a segment; its postings are written before its documents, so
a half-written segment is never found.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from lodestar.functions.stem import stem_word, stemmed
from lodestar.operators.quality import STOP_WORDS, spaced_terms, terms, token_runs, weighted_postings
from lodestar.session import checkpoint_dir

SEARCHED = ["title", "description", "organization"]
BUCKETS = 64            # folders of terms
BLOCK_BITS = 16         # documents of a block, as a power of two


KNOWN_MAX = 500_000     # stems remembered per worker
_KNOWN: dict[str, str] = {}


def _stems(words: list[str]) -> list[str]:
    """The stems of words; a worker remembers up to ``KNOWN_MAX`` of them."""
    if len(_KNOWN) > KNOWN_MAX:
        _KNOWN.clear()
    for w in words:
        if w not in _KNOWN:
            _KNOWN[w] = stem_word(w)
    return [_KNOWN[w] for w in words]


def stemmed_postings(opps: DataFrame) -> DataFrame:
    """Q5 with English stems: (id, term, weight, tf) per document and stem; a
    stem keeps its words' best weight and the sum of their counts.  Stop words
    are dropped before stemming.  A task gives one row a document and stem, so
    only rows that share an id need a shuffle to meet."""
    rows = weighted_postings(opps, _stems)
    n = opps.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("distinct")).first()
    if n["rows"] == n["distinct"]:      # ids name the documents
        return rows
    # a weight as a number keeps the aggregate a hash aggregate
    return (rows.groupBy("id", "term").agg(F.min(F.ascii("weight")).alias("weight"), F.sum("tf").alias("tf"))
            .withColumn("weight", F.char("weight")))


def _lists(bits: int):
    """Per run of documents, (term, block, at): the stem's documents in a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docno = batch.column("docno").to_numpy()
            for row, code, _, known in token_runs(batch, SEARCHED, _stems):
                code, row = np.divmod(np.unique(code * len(batch) + row), len(batch))
                order = np.lexsort((docno[row], code))
                code, no = code[order], docno[row[order]]
                block = no >> bits
                new = np.ones(len(code), bool)
                new[1:] = (np.diff(code) != 0) | (np.diff(block) != 0)
                first = np.flatnonzero(new)
                at = pa.ListArray.from_arrays(pa.array(np.append(first, len(code)), pa.int32()),
                                              pa.array(no & ((1 << bits) - 1), pa.int32()))
                yield pa.RecordBatch.from_arrays([known.take(pa.array(code[first])), pa.array(block[first]), at],
                                                 names=["term", "block", "at"])
    return run


def _bucket():
    return F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")


def add_to_index(opps: DataFrame, path: str) -> str:
    """Index a batch of documents as a new segment; returns its name.  Empty
    texts have no postings; ``id`` is unique over all segments."""
    segment = uuid.uuid4().hex
    # numbered once and kept, as both tables rest on the same numbers
    kept = f"{checkpoint_dir(opps.sparkSession).rstrip('/')}/lodestar-index-documents/{segment}"
    (opps.select("id", F.monotonically_increasing_id().alias("docno"), *[spaced_terms(F.col(c)).alias(c) for c in SEARCHED])
     .write.parquet(kept))
    docs = opps.sparkSession.read.parquet(kept)
    lists = (docs.drop("id").mapInArrow(_lists(BLOCK_BITS), "term string, block long, at array<int>").groupBy("term", "block")
             .agg(F.sort_array(F.flatten(F.collect_list("at"))).alias("at")))       # at most 2^BLOCK_BITS numbers
    gaps = F.transform("at", lambda x, i: F.when(i == 0, x).otherwise(x - F.get("at", i - 1)))
    (lists.select(_bucket().alias("bucket"), "term", "block", F.size("at").alias("n"), gaps.alias("gaps"))
     .repartitionByRange("bucket", "term", "block").sortWithinPartitions("bucket", "term", "block")
     .withColumn("segment", F.lit(segment))
     .write.partitionBy("bucket").mode("append").parquet(f"{path}/postings"))
    (docs.select(F.lit(segment).alias("segment"), "docno", "id")
     .write.partitionBy("segment").mode("append").parquet(f"{path}/documents"))
    return segment


@F.pandas_udf(ArrayType(IntegerType()))
def _numbers(gaps: pd.Series) -> pd.Series:
    return gaps.map(lambda g: np.cumsum(g, dtype=np.int32))


def query_terms(spark: SparkSession, query: str) -> list[tuple[str, int]]:
    """The distinct stems of a query without stop words, with their buckets."""
    words = spark.range(1).select(F.explode(F.array_distinct(terms(F.lit(query)))).alias("word"))
    found = stemmed(words.where(~F.col("word").isin(*STOP_WORDS)), "word", "term").select("term", _bucket().alias("bucket"))
    return sorted({(r["term"], r["bucket"]) for r in found.collect()})


def postings_of(spark: SparkSession, path: str, asked: list[tuple[str, int]]) -> DataFrame:
    """The rows of the asked (term, bucket) pairs: only their buckets are
    read, and within them only row groups whose term range fits."""
    return (spark.read.parquet(f"{path}/postings")
            .where(F.col("bucket").isin(*sorted({b for _, b in asked})) & F.col("term").isin(*[t for t, _ in asked])))


def search_index(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Q6: ids of the documents that hold every stem of the query.

    The rarest term's blocks come first; a commoner term's list is only joined
    where its block still has a hit, and lists meet inside their block.  A
    query without terms, or with a term that no document holds, gives no row."""
    asked = query_terms(spark, query)
    docs = spark.read.parquet(f"{path}/documents")
    if not asked:
        return docs.select("id").where(F.lit(False))
    rows = postings_of(spark, path, asked)
    counts = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}   # one row a query term
    if len(counts) < len(asked):
        return docs.select("id").where(F.lit(False))
    key = ["segment", "block"]

    def lists(term):
        return rows.where(F.col("term") == term).select(*key, "gaps")

    def meet(left, term):
        both = left.join(lists(term), key).withColumn("other", _numbers("gaps"))
        return both.select(*key, F.array_intersect("at", "other").alias("at")).where(F.size("at") > 0)

    rarest, *others = sorted(counts, key=lambda t: (counts[t], t))
    first = lists(rarest).select(*key, _numbers("gaps").alias("at"))
    hits = reduce(meet, others, first).select("segment", "block", F.explode("at").alias("offset"))
    docno = F.shiftleft("block", BLOCK_BITS) + F.col("offset")
    return hits.select("segment", docno.alias("docno")).join(docs, ["segment", "docno"]).select("id")
