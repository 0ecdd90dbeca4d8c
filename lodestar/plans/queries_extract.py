"""Registered extraction-stage queries over text the tables hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import extract as X
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources import views
from lodestar.sources.tables import read_table


def _responses(spark, sf_dir):
    return views.responses(spark, sf_dir).withColumn("url", F.concat(F.lit("https://www.example.org/"), F.col("page_id").cast("string")))


_PROMPT = (f"'{X.PROMPT_HEAD}' || '' || '{X.PROMPT_URL}' || url || '{X.PROMPT_HTML}' || CASE WHEN length(html) > {X.PROMPT_HTML_MAX} "
           f"THEN substring(html, 1, {X.PROMPT_HTML_MAX}) || '{X.PROMPT_CUT}' ELSE html END || '{X.PROMPT_END}'").replace("\n", "' || chr(10) || '")


@register("x1_prompt_rows", f"SELECT page_id, md5(p) AS prompt_md5, length(p) AS prompt_chars FROM (SELECT page_id, {_PROMPT} AS p FROM pages)")
def x1_prompt_rows(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]).withColumn("title", F.lit(""))
    return p.select("page_id", X.prompt(html="html").alias("p")).select(
        "page_id", F.md5(F.col("p").cast("binary")).alias("prompt_md5"), F.length("p").cast("bigint").alias("prompt_chars"))


@register("x2_strip_fence", r"""
WITH t AS (SELECT conv_id, turn, regexp_replace(regexp_replace(coalesce(text, ''), '^\s+', ''), '\s+$', '') AS x FROM conversations)
SELECT conv_id, turn, md5(CASE WHEN starts_with(x, '```') THEN regexp_replace(regexp_replace(x, '^```(json)?\n?', ''), '\n?```$', '') ELSE x END) AS text_md5 FROM t""")
def x2_strip_fence(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"]).withColumn("text", F.coalesce("text", F.lit("")))
    return c.select("conv_id", "turn", F.md5(X.strip_fence("text").cast("binary")).alias("text_md5"))


_WS = r"[\t\n\x0B\f\r\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF} ]"
_TRIMMED = f"regexp_replace(title, '^{_WS}+|{_WS}+$', '', 'g')"
ISSUES = """r AS (SELECT doc_id AS page_id, list_filter([CASE WHEN title = '' THEN 'title: Title is required' END,
    CASE WHEN description = '' THEN 'description: Description is required' END, CASE WHEN summary = '' THEN 'summary: Summary is required' END,
    CASE WHEN organization IS NULL THEN 'organization: Required' WHEN organization = '' THEN 'organization: Organization is required' END],
    lambda x: x IS NOT NULL) AS issues, title, type, deadline, application_url FROM items)"""


def _with_items(extra):
    return V.with_views("items", extra=[ISSUES]) + extra


@register("x3_x5_validate", _with_items("""SELECT page_id, CASE WHEN len(issues) > 0 THEN 'Validation failed: ' || array_to_string(issues, '; ') END AS error,
  CASE WHEN len(issues) = 0 THEN """ + _TRIMMED + """ END AS title, CASE WHEN len(issues) = 0 THEN deadline END AS deadline FROM r"""))
def x3_x5_validate(spark, sf_dir):
    return X.validate(_responses(spark, sf_dir)).select("page_id", "error", F.col("extraction.title").alias("title"),
                                                        F.col("extraction.deadline").alias("deadline"))


@register("x6_split_results", _with_items("SELECT page_id, type, deadline, application_url FROM r WHERE len(issues) = 0"))
def x6_split_results(spark, sf_dir):
    ok, _ = X.split_results(X.validate(_responses(spark, sf_dir)))
    return ok.select(F.substring_index("source_url", "/", -1).cast("bigint").alias("page_id"), "type", "deadline", "application_url")


@register("x7_extraction_summary", _with_items(
    "SELECT count(*) AS total, count(*) FILTER (len(issues) = 0) AS succeeded, count(*) FILTER (len(issues) > 0) AS failed FROM r"))
def x7_extraction_summary(spark, sf_dir):
    return X.extraction_summary(X.validate(_responses(spark, sf_dir)))


@register("x3_parse_json", """SELECT event_id, CASE WHEN NOT json_valid(props) THEN 'no json' WHEN json_type(props) <> 'OBJECT' THEN 'no object' ELSE 'object' END AS outcome
FROM events WHERE props IS NOT NULL""")
def x3_parse_json(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "props"]).where("props is not null")
    v = X.validate(e.withColumnRenamed("props", "raw_response"))
    return v.select("event_id", F.when(F.col("error").startswith("JSON parse failed"), "no json")
                    .when(F.col("error").startswith("Validation failed: Expected object"), "no object").otherwise("object").alias("outcome"))


@register("x4_validate", _with_items("SELECT page_id, len(issues) = 0 AS valid, CASE WHEN len(issues) = 0 THEN type END AS type FROM r"))
def x4_validate(spark, sf_dir):
    v = X.validate(_responses(spark, sf_dir))
    return v.select("page_id", F.col("extraction").isNotNull().alias("valid"), F.col("extraction.type").alias("type"))


@register("x5_issues", _with_items(
    "SELECT page_id, 'Validation failed: ' || array_to_string(issues, '; ') AS error FROM r WHERE len(issues) > 0"))
def x5_issues(spark, sf_dir):
    v = X.validate(_responses(spark, sf_dir))
    return v.where(F.col("error").startswith("Validation failed")).select("page_id", "error")
