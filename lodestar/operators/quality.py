"""Table rules as data-quality jobs, text search, row visibility and
referential checks (Q1–Q7, P4–P6, J6, J7)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.constants import (EDUCATION_LEVELS, LOG_STATUSES, RUN_STATUSES, SCAM_RISK_LEVELS,
                                STATUSES, TYPES, VERIFICATION_LEVELS)

# FIXED VALUES: the public English stop list of PostgreSQL's full-text search
# (english.stop, the list NLTK also ships), for the database's 'english'
# dictionary; no stemming.
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "as",
    "at", "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can",
    "did", "do", "does", "doing", "don", "down", "during", "each", "few", "for", "from", "further", "had",
    "has", "have", "having", "he", "her", "here", "hers", "herself", "him", "himself", "his", "how",
    "i", "if", "in", "into", "is", "it", "its", "itself", "just", "me", "more", "most", "my", "myself",
    "no", "nor", "not", "now", "of", "off", "on", "once", "only", "or", "other", "our", "ours",
    "ourselves", "out", "over", "own", "s", "same", "she", "should", "so", "some", "such", "t", "than",
    "that", "the", "their", "theirs", "them", "themselves", "then", "there", "these", "they", "this",
    "those", "through", "to", "too", "under", "until", "up", "very", "was", "we", "were", "what",
    "when", "where", "which", "while", "who", "whom", "why", "will", "with", "you", "your", "yours",
    "yourself", "yourselves",
]


def _violations(df: DataFrame, table: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """All broken rules of a table in one pass over its rows."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules.items()]))
    return df.select(F.lit(table).alias("table_name"), F.explode(broken).alias("rule"), F.col(key).cast("string").alias("row_key"))


def check_rules(opps: DataFrame, profiles: DataFrame, log: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Q1: rows breaking a CHECK rule (a NULL passes)."""
    out = _violations(opps, "opportunities", "id", {
        "type": F.col("type").isin(*TYPES),
        "status": F.col("status").isin(*STATUSES),
        "verification_level": F.col("verification_level").isin(*VERIFICATION_LEVELS),
        "scam_risk": F.col("scam_risk").isin(*SCAM_RISK_LEVELS),
        "completeness_score": F.col("completeness_score").between(0, 100),
    }).unionByName(_violations(profiles, "user_profiles", "id", {
        "education_level": F.col("education_level").isin(*EDUCATION_LEVELS)}))
    out = out.unionByName(_violations(log, "distribution_log", "id", {"status": F.col("status").isin(*LOG_STATUSES)}))
    if runs is not None:
        out = out.unionByName(_violations(runs, "scrape_runs", "id", {"status": F.col("status").isin(*RUN_STATUSES)}))
    return out


def required(df: DataFrame, table: str, key: str, columns: list[str]) -> DataFrame:
    """Q2 of one table: rows with a NULL in a required column."""
    return _violations(df, table, key, {f"{c} not null": F.col(c).isNotNull() for c in columns})


def not_null_rules(opps: DataFrame, log: DataFrame, flags: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Q2: rows with a NULL in a NOT NULL column."""
    nn = required
    out = (nn(opps, "opportunities", "id", ["title", "slug", "type", "source_url", "source_site"])
           .unionByName(nn(log, "distribution_log", "id", ["channel"]))
           .unionByName(nn(flags, "flagged_listings", "id", ["flag_reason"])))
    if runs is not None:
        out = out.unionByName(nn(runs, "scrape_runs", "id", ["source_site"]))
    return out


def unique_rules(opps: DataFrame, saved: DataFrame, log: DataFrame) -> DataFrame:
    """Q3: keys that occur more than once (partial-aggregated counts)."""
    def dup(df, table, name, cols):
        return (df.groupBy(*cols).count().where(F.col("count") > 1)
                .select(F.lit(table).alias("table_name"), F.lit(name).alias("rule"),
                        F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("row_key"),
                        F.col("count").alias("n")))
    return (dup(opps, "opportunities", "id unique", ["id"])
            .unionByName(dup(opps, "opportunities", "slug unique", ["slug"]))
            .unionByName(dup(saved, "saved_opportunities", "primary key", ["user_id", "opportunity_id"]))
            .unionByName(dup(log, "distribution_log", "id unique", ["id"])))


def terms(text: Column) -> Column:
    """Lower-cased alphanumeric tokens of a text (array, in order)."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda t: t != "")


WEIGHTS = {"title": "A", "description": "B", "organization": "C"}
RUN_BYTES = 1 << 22     # bytes of text grouped at a time; one longer row is one run


def spaced_terms(text: Column) -> Column:
    """The ``terms`` of a text as one string, a space between and maybe around them."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " ")


def token_runs(batch: pa.RecordBatch, columns: list[str], words: Callable[[list[str]], list[str]] | None = None):
    """Tokens of ``spaced_terms`` columns without empty ones and stop words,
    for runs of rows: (row, word number, column number) as arrays, and the
    words by number.  ``words`` maps the distinct words of a run."""
    n, lo = len(batch), 0
    size = np.cumsum([0, *sum(pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in columns)])
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + RUN_BYTES, side="right")) - 1)
        lists = [pc.split_pattern(batch.column(c).slice(lo, hi - lo), " ") for c in columns]
        count = [pc.list_value_length(x).to_numpy() for x in lists]
        values = pa.concat_arrays([x.flatten() for x in lists])
        row = np.concatenate([np.repeat(np.arange(lo, hi), k) for k in count])
        field = np.repeat(np.arange(len(columns)), [k.sum() for k in count])
        coded = values.dictionary_encode()
        code, known = coded.indices.to_numpy(), coded.dictionary
        dropped = pc.is_in(known, pa.array(["", *STOP_WORDS], known.type)).to_numpy(zero_copy_only=False)
        kept = ~dropped[code] if len(known) else np.zeros(0, bool)
        if words is not None:
            mapped = pa.array(words(known.to_pylist()), known.type).dictionary_encode()
            code, known = mapped.indices.to_numpy()[code], mapped.dictionary
        yield row[kept], code[kept].astype(np.int64), field[kept], known
        lo = hi


def _postings(words: Callable[[list[str]], list[str]] | None):
    weights = pa.array(list(WEIGHTS.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, code, field, known in token_runs(batch, list(WEIGHTS), words):
                m = max(len(known), 1)
                key = np.sort((row * m + code) * len(weights) + field)      # equal terms of a row in order of weight
                pair, field = np.divmod(key, len(weights))
                first = np.flatnonzero(np.diff(pair, prepend=-1))
                tf = np.diff(first, append=len(pair))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(pair[first] // m)), known.take(pa.array(pair[first] % m)),
                     weights.take(pa.array(field[first])), pa.array(tf, pa.int64())], names=["id", "term", "weight", "tf"])
    return run


def weighted_postings(opps: DataFrame, words: Callable[[list[str]], list[str]] | None = None) -> DataFrame:
    """Q5: (id, term, weight, tf): title = A, description = B, organization = C;
    a term keeps its best weight; stop words are dropped.  ``words`` maps
    distinct words to terms, each once for many rows.

    A posting never spans rows: Spark cuts the texts, and a task groups the
    tokens of a run of rows by sorting numbers.  No shuffle."""
    schema = T.StructType([T.StructField("id", opps.schema["id"].dataType), T.StructField("term", T.StringType()),
                           T.StructField("weight", T.StringType()), T.StructField("tf", T.LongType())])
    return opps.select("id", *[spaced_terms(F.col(c)).alias(c) for c in WEIGHTS]).mapInArrow(_postings(words), schema)


def text_search(opps: DataFrame, query: str) -> DataFrame:
    """Q6: ids of the rows whose title, description and organization together
    hold every query term (no ranking); a map-only filter."""
    q = [t for t in dict.fromkeys(_py_terms(query)) if t not in STOP_WORDS]
    if not q:
        return opps.select("id").where(F.lit(False))
    held = opps.select("id", F.explode(F.array(F.concat(*[terms(F.col(c)) for c in ("title", "description", "organization")]))).alias("_t"))
    return held.where(F.forall(F.array(*[F.lit(x) for x in q]), lambda x: F.array_contains("_t", x))).select("id")


def _py_terms(query: str) -> list[str]:
    import re
    return [t for t in re.split(r"[^\w]+|_", query.lower()) if t]


def review_queue(flags: DataFrame) -> DataFrame:
    """Q7: unreviewed flags."""
    return flags.where(~F.col("reviewed"))


def browse_filters(opps: DataFrame, type: str | None = None, region: str | None = None,
                   field: str | None = None, education_level: str | None = None,
                   is_fully_funded: bool | None = None, deadline_before: str | None = None,
                   search_ids: DataFrame | None = None) -> DataFrame:
    """AND of the given filters (array membership via array_contains)."""
    conds = []
    if type is not None:
        conds.append(F.col("type") == type)
    if region is not None:
        conds.append(F.array_contains("regions", region))
    if field is not None:
        conds.append(F.array_contains("fields", field))
    if education_level is not None:
        conds.append(F.array_contains("target_audience", education_level))
    if is_fully_funded is not None:
        conds.append(F.col("is_fully_funded") == is_fully_funded)
    if deadline_before is not None:
        conds.append(F.col("deadline") <= F.lit(deadline_before).cast("date"))
    out = opps.where(reduce(lambda a, b: a & b, conds)) if conds else opps
    return out.join(search_ids, "id", "left_semi") if search_ids is not None else out


def known_sources(requested: DataFrame, profiles: DataFrame, col: str = "source_site") -> DataFrame:
    """P5: requested source names that have a profile (others dropped)."""
    return requested.join(profiles.select(col).distinct(), col, "left_semi")


def unknown_sources(requested: DataFrame, profiles: DataFrame, col: str = "source_site") -> DataFrame:
    """P5 (warning side): requested names without a profile, to report."""
    return requested.join(profiles.select(col).distinct(), col, "left_anti")


def visible_rows(df: DataFrame, table: str, role: str, uid: str | None = None) -> DataFrame:
    """Row visibility — public sees active listings; a user sees own
    profile and saves (plus active listings); the service role sees all;
    log, runs and flags are service-only."""
    if role == "service":
        return df
    if table == "opportunities":
        return df.where(F.col("status") == "active")
    if role == "user" and uid is not None:
        if table == "user_profiles":
            return df.where(F.col("id") == uid)
        if table == "saved_opportunities":
            return df.where(F.col("user_id") == uid)
    return df.where(F.lit(False))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def cascade_delete_opportunities(deleted: DataFrame, saved: DataFrame, flags: DataFrame, log: DataFrame):
    """Deleting listings drops their saves and flags and nulls the log id."""
    d = deleted.select(F.col("id").alias("_del")).distinct()
    saved2 = saved.join(d.withColumnRenamed("_del", "opportunity_id"), "opportunity_id", "left_anti")
    flags2 = flags.join(d.withColumnRenamed("_del", "opportunity_id"), "opportunity_id", "left_anti")
    log2 = (log.join(d, log["opportunity_id"] == d["_del"], "left")
            .withColumn("opportunity_id", F.when(F.col("_del").isNull(), F.col("opportunity_id"))).drop("_del"))
    return saved2, flags2, log2


def cascade_delete_users(deleted: DataFrame, profiles: DataFrame, saved: DataFrame):
    """Deleting users drops their profile and saves."""
    d = deleted.select(F.col("id").alias("_del")).distinct()
    return (profiles.join(d.withColumnRenamed("_del", "id"), "id", "left_anti"),
            saved.join(d.withColumnRenamed("_del", "user_id"), "user_id", "left_anti"))
