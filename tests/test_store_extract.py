"""Upsert idempotence, store counts and validation fixtures."""

from pyspark.sql import functions as F

from lodestar.operators import extract, store

ITEM_SCHEMA = ("item_order long, title string, description string, summary string, type string, "
               "fields array<string>, regions array<string>, countries array<string>, "
               "target_audience array<string>, eligibility_text string, deadline date, is_rolling boolean, "
               "funding_amount string, is_fully_funded boolean, source_url string, source_site string, "
               "organization string, application_url string")


def _items(spark):
    rows = [(i, f"Test Scholarship {n} 2026", "d" * 60, "s", "scholarship", [], ["global"], [], ["any"], "",
             None, False, None, False, f"https://example.com/{n.lower()}", "test-store", "Org", None)
            for i, n in enumerate(["Alpha", "Beta", "Gamma"])]
    return spark.createDataFrame(rows, ITEM_SCHEMA)


def _empty_target(spark, rows):
    t = store.fill_defaults(rows.limit(0)).drop("item_order")
    return t


def test_insert_then_update(spark):
    rows = store.to_row(_items(spark))
    target = _empty_target(spark, rows)
    c1 = store.store_summary(rows, target).first()
    assert (c1.inserted, c1.updated, c1.failed) == (3, 0, 0)
    t1 = store.upsert(target, rows).cache()
    assert t1.count() == 3
    c2 = store.store_summary(rows, t1).first()
    assert (c2.inserted, c2.updated, c2.failed) == (0, 3, 0)
    t2 = store.upsert(t1, rows)
    cols = ["id", "slug", "title", "status", "created_at", "verification_level"]
    assert sorted(t2.select(*cols).collect()) == sorted(t1.select(*cols).collect())   # applied twice = once
    flags = store.flag_rows(rows, "test_flag")
    assert flags.count() == 3


def _validate(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "page_id long, raw_response string")
    return {r.page_id: r for r in extract.validate(df).collect()}


GOOD = ('{"title": " T ", "description": "D", "summary": "S", "type": "grant", "organization": "O", '
        '"deadline": "2026-06-30", "application_url": "https://a.org/x"}')


def test_validation_fixture(spark):
    raws = [GOOD, "```json\n" + GOOD + "\n```", "not json",
            GOOD.replace('"grant"', '"phd"'), GOOD.replace('"type"', '"regions": ["mars"], "type"'),
            GOOD.replace('" T "', '""'), GOOD.replace('"type"', '"fields": null, "type"'),
            GOOD.replace('"type"', '"is_rolling": "true", "type"'),
            GOOD.replace('" T "', '"  "'),
            GOOD.replace("2026-06-30", "2026-02-30"), GOOD.replace('"https://a.org/x"', '"not a url"'),
            GOOD.replace('"S"', '"' + "x" * 400 + '"'), GOOD.replace('"type"', '"extra": 1, "type"')]
    out = _validate(spark, raws)
    assert out[0].error is None and out[0].extraction.title == "T"
    assert out[0].extraction.regions == ["global"] and out[0].extraction.target_audience == ["any"]
    assert out[0].extraction.fields == []
    assert out[1].error is None
    assert out[2].error.startswith("JSON parse failed")
    for i, field in [(3, "type"), (4, "regions"), (5, "title"), (6, "fields"), (7, "is_rolling")]:
        assert out[i].extraction is None and field in out[i].error, (i, out[i].error)
    assert out[8].error is None and out[8].extraction.title == ""
    assert out[9].extraction.deadline is None
    assert out[10].extraction.application_url is None
    assert len(out[11].extraction.summary) == 300
    assert out[12].error is None


def test_update_reactivates_unless_protected(spark):
    rows = store.to_row(_items(spark))
    t1 = store.upsert(_empty_target(spark, rows), rows)
    flagged = t1.withColumn("status", F.when(F.col("title").contains("Alpha"), "flagged").otherwise(F.col("status")))
    plain = {r.title: r.status for r in store.upsert(flagged, rows).collect()}
    kept = {r.title: r.status for r in store.upsert(flagged, rows, protect_status=True).collect()}
    assert plain["Test Scholarship Alpha 2026"] == "active"
    assert kept["Test Scholarship Alpha 2026"] == "flagged"
    assert kept["Test Scholarship Beta 2026"] == "active"
    c = store.store_summary(rows, t1).first()
    assert (c.existing_slugs, c.new_slugs) == (3, 0)


def test_visibility_roles(spark):
    from lodestar.operators import quality as qa
    opps = spark.createDataFrame([("a", "active"), ("b", "flagged")], "id string, status string")
    prof = spark.createDataFrame([("u1",), ("u2",)], "id string")
    log = spark.createDataFrame([("l1",)], "id string")
    assert [r.id for r in qa.visible_rows(opps, "opportunities", "anon").collect()] == ["a"]
    assert qa.visible_rows(opps, "opportunities", "service").count() == 2
    assert [r.id for r in qa.visible_rows(prof, "user_profiles", "user", "u2").collect()] == ["u2"]
    assert qa.visible_rows(prof, "user_profiles", "anon").count() == 0
    assert qa.visible_rows(log, "distribution_log", "user", "u1").count() == 0
    assert qa.visible_rows(log, "distribution_log", "service").count() == 1


def test_enum_messages_name_the_value(spark):
    out = _validate(spark, [GOOD.replace('"grant"', '"phd"'), GOOD.replace('"type"', '"regions": ["asia", "mars"], "type"')])
    assert out[0].error.endswith("received 'phd'")
    assert "regions.1: Invalid enum value." in out[1].error and out[1].error.endswith("received 'mars'")


def test_every_element_and_every_kind_is_checked(spark):
    out = _validate(spark, [GOOD.replace('"type"', '"regions": ["global", null], "type"'), GOOD.replace('"type"', '"fields": ["a", null, 3], "type"'),
                            "[1]", "null", "7", GOOD.replace('"type"', '"regions": "global", "type"'), None, "",
                            GOOD.replace('"type"', '"fields": [], "regions": [], "type"')])
    assert out[0].error.startswith("Validation failed: regions.1: Expected 'global'") and out[0].error.endswith("received null")
    assert out[1].error == "Validation failed: fields.1: Expected string, received null; fields.2: Expected string, received number"
    assert [out[i].error for i in (2, 3, 4)] == [f"Validation failed: Expected object, received {k}" for k in ("array", "null", "number")]
    assert out[5].error == "Validation failed: regions: Expected array, received string"
    assert out[6].error.startswith("JSON parse failed") and out[7].error.startswith("JSON parse failed")
    assert out[8].error is None and out[8].extraction.regions == []


def test_validate_reads_the_object_once(spark):
    """The map of the object is one generator's result, not one cast a key."""
    from lodestar.operators import extract as X
    d = spark.createDataFrame([("{}",)], "raw_response string")
    plan = X.validate(d)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapType(StringType,VariantType") == 1


def test_trim_looks_at_the_ends_only(spark):
    from lodestar.functions.text import js_trim
    rows = [(" a b\t", "a b"), ("\ufeff\u3000x\u2028\r\n", "x"), ("", ""), (" \u00a0", ""), ("\u200ba", "\u200ba"),
            ("a \u0085", "a \u0085"), (None, None)]
    d = spark.createDataFrame(rows, "given string, wanted string")
    assert d.where(~js_trim("given").eqNullSafe(d["wanted"])).count() == 0
    assert "regexp_replace" not in d.select(js_trim("given"))._jdf.queryExecution().optimizedPlan().toString()


def test_a_failed_parse_names_the_trimmed_beginning(spark):
    from lodestar.operators import extract as X
    rows = [(" \n no json" + "x" * 300,), (None,), ("null",), ("```json\n[1]\n``` ",)]
    got = [r["error"] for r in X.validate(spark.createDataFrame(rows, "raw_response string")).select("error").collect()]
    assert got == ["JSON parse failed. Raw: " + ("no json" + "x" * 300)[:200], "JSON parse failed. Raw: ",
                   "Validation failed: Expected object, received null", "Validation failed: Expected object, received array"]
