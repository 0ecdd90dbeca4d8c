"""Structured extraction stage.

The model call itself is outside Spark; its text answer arrives as a
``raw_response`` column.  Parsing uses VARIANT (``try_parse_json``); the
object is read once into a row of (kind, value) per key, where an *absent*
key (NULL) stays apart from an explicit JSON ``null`` ('VOID') — defaults
apply only to the former.  Every rule is a Column over that row, all issues
of a row are joined into one message, and failing rows stay as data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.constants import AS_OF, EDUCATION_LEVELS, PROMPT_HTML_MAX, REGIONS, SUMMARY_CAP, TYPES
from lodestar.functions.text import js_trim

FENCE = "```"


PROMPT_HEAD = "Extract the listing fields from this page.\n\nPage title: "
PROMPT_URL, PROMPT_HTML = "\nSource URL: ", "\n\n<html>\n"
PROMPT_CUT, PROMPT_END = "\n[HTML TRUNCATED]", "\n</html>\n\nReturn only the JSON object."


def prompt(title="title", url="url", html="content", limit: int = PROMPT_HTML_MAX) -> Column:
    """Request text; HTML over 50,000 chars is cut and marked."""
    h = F.col(html)
    body = F.when(F.length(h) > limit, F.concat(F.substring(h, 1, limit), F.lit(PROMPT_CUT))).otherwise(h)
    return F.concat(F.lit(PROMPT_HEAD), F.col(title), F.lit(PROMPT_URL), F.col(url), F.lit(PROMPT_HTML), body, F.lit(PROMPT_END))


def strip_fence(raw="raw_response") -> Column:
    """Trimmed text; an opening fence (optional 'json', newline) and a
    closing fence are removed when the text starts with three backticks."""
    return _unfenced(js_trim(F.col(raw)))


def _unfenced(t: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\n?", ""), r"\n?```$", "")
    return F.when(t.startswith(FENCE), inner).otherwise(t)


STRINGS = ["title", "description", "summary", "type", "organization", "eligibility_text", "deadline", "funding_amount", "application_url"]
ARRAYS = ["fields", "regions", "countries", "target_audience"]
FLAGS = ["is_rolling", "is_fully_funded"]
REQUIRED = {"title": "Title is required", "description": "Description is required", "summary": "Summary is required",
            "organization": "Organization is required"}


def _fields(m: Column) -> Column:
    """One read of the object: (kind, s, items) per key; kind is NULL for an
    absent key and 'VOID' for an explicit null."""
    kind = lambda x: F.schema_of_variant(x)
    text = lambda x: F.try_variant_get(x, "$", "string")
    out = []
    for k in STRINGS + FLAGS:
        out.append(F.struct(kind(m[k]).alias("kind"), text(m[k]).alias("s")).alias(k))
    for k in ARRAYS:
        items = F.transform(F.try_variant_get(m[k], "$", "array<variant>"),
                            lambda e: F.struct(kind(e).alias("kind"), text(e).alias("s")))
        out.append(F.struct(kind(m[k]).alias("kind"), items.alias("items")).alias(k))
    return F.struct(*out)


def _received(kind: Column) -> Column:
    return (F.when(kind == "VOID", "null").when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object")
            .when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").otherwise("number"))


def _wrong(key: str, expected: str, kind: Column) -> Column:
    return F.concat(F.lit(f"{key}: Expected {expected}, received "), _received(kind))


def _choice(values: list[str]) -> str:
    return " | ".join(f"'{x}'" for x in values)


def _array_issues(key: str, f: Column, allowed: list[str] | None) -> Column:
    """All issues of one array: its own kind, then every element's."""
    expected = _choice(allowed) if allowed else "string"

    def one(e, i):
        at = F.concat(F.lit(f"{key}."), i.cast("string"), F.lit(": "))
        bad = F.when(F.coalesce(e["kind"], F.lit("VOID")) != "STRING",
                     F.concat(at, F.lit(f"Expected {expected}, received "), _received(F.coalesce(e["kind"], F.lit("VOID")))))
        if allowed:
            bad = bad.when(~e["s"].isin(*allowed), F.concat(at, F.lit(f"Invalid enum value. Expected {expected}, received '"), e["s"], F.lit("'")))
        return bad
    return (F.when(f["kind"].isNull(), F.array().cast("array<string>"))
            .when(~f["kind"].startswith("ARRAY"), F.array(_wrong(key, "array", f["kind"])))
            .otherwise(F.array_compact(F.transform(f["items"], one))))


def validate(df: DataFrame, raw: str = "raw_response") -> DataFrame:
    """Adds ``extraction`` (struct or NULL) and ``error`` (or NULL).

    Text that is no JSON is a parse failure; JSON that is no object, and an
    object that breaks a rule, are validation failures that name every issue.
    """
    # Each generator is a barrier: what is above reads its one result and
    # can't repeat the trim, the parse, the map or the field reads.  A
    # generator's own expression has no common parts taken out, so whatever
    # is used more than once has a generator of its own.
    once = lambda d, c, name: d.select("*", F.explode(F.array(c)).alias(name))
    d = once(df, js_trim(F.col(raw)), "_raw")
    d = once(d, F.try_parse_json(_unfenced(F.col("_raw"))), "_v")
    v = F.col("_v")
    d = d.withColumns({"_kind": F.schema_of_variant(v), "_raw": F.substring("_raw", 1, 200)})
    d = once(d, F.try_variant_get(v, "$", "map<string,variant>"), "_m")
    d = once(d, _fields(F.col("_m")), "_f")
    f = lambda k: F.col(f"_f.{k}")

    single = []
    for key, message in REQUIRED.items():
        single.append(F.when(f(key)["kind"].isNull(), F.lit(f"{key}: Required"))
                      .when(f(key)["kind"] != "STRING", _wrong(key, "string", f(key)["kind"]))
                      .when(F.length(f(key)["s"]) < 1, F.lit(f"{key}: {message}")))
    t, types = f("type"), _choice(TYPES)
    single.append(F.when(t["kind"].isNull(), F.lit("type: Required")).when(t["kind"] != "STRING", _wrong("type", types, t["kind"]))
                  .when(~t["s"].isin(*TYPES), F.concat(F.lit(f"type: Invalid enum value. Expected {types}, received '"), t["s"], F.lit("'"))))
    k = f("eligibility_text")["kind"]
    single.append(F.when(k.isNotNull() & (k != "STRING"), _wrong("eligibility_text", "string", k)))
    for key in ("deadline", "funding_amount"):
        k = f(key)["kind"]
        single.append(F.when(k.isNotNull() & ~k.isin("STRING", "VOID"), _wrong(key, "string", k)))
    for key in FLAGS:
        k = f(key)["kind"]
        single.append(F.when(k.isNotNull() & (k != "BOOLEAN"), _wrong(key, "boolean", k)))
    allowed = {"regions": REGIONS, "target_audience": EDUCATION_LEVELS}
    issues = F.concat(F.array_compact(F.array(*single)), *[_array_issues(x, f(x), allowed.get(x)) for x in ARRAYS])

    text = lambda key: js_trim(f(key)["s"])
    items = lambda key: F.transform(f(key)["items"], lambda e: e["s"])
    trimmed = lambda key: F.transform(f(key)["items"], lambda e: js_trim(e["s"]))
    arr = lambda key, values, default: F.when(f(key)["kind"].isNull(), F.array(*[F.lit(x) for x in default]).cast("array<string>")).otherwise(values)
    flag = lambda key: F.coalesce(f(key)["s"] == "true", F.lit(False))
    day, app, funding = f("deadline")["s"], f("application_url")["s"], text("funding_amount")
    day_ok = day.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    app_ok = (f("application_url")["kind"] == "STRING") & app.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s]+$")
    extraction = F.struct(
        text("title").alias("title"), text("description").alias("description"),
        F.substring(text("summary"), 1, SUMMARY_CAP).alias("summary"), t["s"].alias("type"),
        arr("fields", trimmed("fields"), []).alias("fields"),
        arr("regions", items("regions"), ["global"]).alias("regions"),
        arr("countries", trimmed("countries"), []).alias("countries"),
        arr("target_audience", items("target_audience"), ["any"]).alias("target_audience"),
        F.coalesce(text("eligibility_text"), F.lit("")).alias("eligibility_text"),
        F.when(day_ok, F.try_to_date(day, "yyyy-MM-dd")).alias("deadline"),
        flag("is_rolling").alias("is_rolling"), F.when(funding != "", funding).alias("funding_amount"),
        flag("is_fully_funded").alias("is_fully_funded"), text("organization").alias("organization"),
        F.when(app_ok, app).alias("application_url"))
    failed = lambda m: F.concat(F.lit("Validation failed: "), m)
    d = d.select("*", F.explode(F.array(issues)).alias("_issues"))
    err = (F.when(F.col("_kind").isNull(), F.concat(F.lit("JSON parse failed. Raw: "), F.coalesce("_raw", F.lit(""))))
           .when(~F.col("_kind").startswith("OBJECT"), failed(F.concat(F.lit("Expected object, received "), _received(F.col("_kind")))))
           .when(F.size("_issues") > 0, failed(F.array_join("_issues", "; "))))
    return (d.withColumn("error", err).withColumn("extraction", F.when(F.col("error").isNull(), extraction))
            .drop("_v", "_raw", "_kind", "_m", "_f", "_issues"))


def split_results(validated: DataFrame, url: str = "url", as_of: str = AS_OF) -> tuple[DataFrame, DataFrame]:
    """Successes flattened with source_url; failures as review flags."""
    ok = validated.where(F.col("extraction").isNotNull()).select("extraction.*", F.col(url).alias("source_url"))
    from lodestar.operators.store import flag_rows
    bad = validated.where(F.col("extraction").isNull()).withColumn("_details", F.concat(F.lit("Error: "), F.col("error")))
    flags = flag_rows(bad.withColumnRenamed(url, "source_url"), "extraction_failed", details_col="_details", as_of=as_of)
    return ok, flags


def extraction_summary(validated: DataFrame) -> DataFrame:
    """Total / succeeded / failed."""
    return validated.agg(F.count(F.lit(1)).alias("total"),
                         F.count_if(F.col("extraction").isNotNull()).alias("succeeded"),
                         F.count_if(F.col("extraction").isNull()).alias("failed"))


def with_responses(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """The scraped pages with their answers (page_id, raw_response); a page
    without an answer has a null one, which is a parse failure."""
    return pages.join(responses.select("page_id", "raw_response"), "page_id", "left")
