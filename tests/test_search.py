"""Stemming against published word pairs, the stored index against a scan."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from lodestar.functions import stem
from lodestar.functions.stem import stem_ctes, stemmed
from lodestar.operators import search

# FIXED VALUES: pairs of word and stem from the published description.
PAIRS = dict(p.split(":") for p in (
    "consign:consign consigned:consign consigning:consign consignment:consign consist:consist consisted:consist "
    "consistency:consist consistent:consist consistently:consist consists:consist consolation:consol "
    "consolations:consol consolatory:consolatori console:consol consoled:consol consoles:consol "
    "consolidate:consolid consolidated:consolid consolidating:consolid consoling:consol consolingly:consol "
    "conspicuous:conspicu conspicuously:conspicu conspiracy:conspiraci conspirator:conspir conspirators:conspir "
    "conspire:conspir constable:constabl constables:constabl constance:constanc constancy:constanc constant:constant "
    "knack:knack knackeries:knackeri knacks:knack knavish:knavish kneaded:knead kneading:knead knee:knee kneel:kneel "
    "kneeled:kneel kneeling:kneel kneels:kneel knees:knee knell:knell knelt:knelt knew:knew knick:knick knif:knif "
    "knife:knife knight:knight knightly:knight knights:knight knit:knit knits:knit knitted:knit knitting:knit "
    "knives:knive knob:knob knobs:knob knock:knock knocked:knock knocker:knocker knockers:knocker knocking:knock "
    "knot:knot knots:knot studies:studi study:studi ties:tie cries:cri gas:gas this:this gaps:gap kiwis:kiwi "
    "hopping:hop hoping:hope hoped:hope luxuriated:luxuri by:by say:say skies:sky dying:die news:news proceed:proceed "
    "innings:inning generously:generous communities:communiti rational:ration bed:bed sing:sing agreed:agre feed:feed").split())


def test_published_pairs(spark):
    words = spark.createDataFrame([(w,) for w in PAIRS], "word string")
    got = {r["word"]: r["stem"] for r in stemmed(words, "word", "stem").collect()}
    assert got == PAIRS


def test_the_sql_form_gives_the_same(spark):
    con = duckdb.connect()
    listed = ", ".join(f"('{w}')" for w in PAIRS)
    got = dict(con.sql(f"WITH given(t) AS (VALUES {listed}), {stem_ctes('given', 't')} SELECT word, stem FROM stems").fetchall())
    assert got == PAIRS


def test_other_words_stay(spark):
    words = spark.createDataFrame([("src1",), ("größes",), ("2024s",), ("",), (None,)], "word string")
    rows = stemmed(words, "word", "stem").collect()
    assert [r["stem"] for r in rows] == ["src1", "größes", "2024s", "", None]


def test_one_word_at_a_time_gives_the_same(spark):
    roots = ["gener", "hop", "yell", "syzyg", "arsen", "cri", "tr", "beauty", "toll", "log", "vis", "fee", "ay", "b"]
    ends = ["", "s", "ies", "ied", "sses", "us", "eedly", "eed", "ingly", "edly", "ing", "ed", "y", "e", "ll",
            *stem.DERIVED, *stem.ADJECTIVAL, *stem.DROPPED, "sion", "tion", "geli", "leli", "atively", "izations"]
    given = {*PAIRS, *stem.WHOLE_WORDS, *stem.KEPT_AFTER_PLURAL, "src1", "größes", "2024s", "", "ab",
             *(r + e for r in roots for e in ends), *(r + a + b for r in roots[:5] for a in stem.DROPPED for b in ("ly", "s", "ed", "ness"))}
    rows = stemmed(spark.createDataFrame([(w,) for w in given], "word string"), "word", "stem").collect()
    assert {r["word"]: stem.stem_word(r["word"]) for r in rows} == {r["word"]: r["stem"] for r in rows}


SCHEMA = "id string, title string, description string, organization string"
ROWS = [("a", "Studies of rivers", "the river studied", "Acme"), ("b", "River study", None, None),
        ("c", "Studying", "mountains and hills", "River Fund"), ("d", None, "", None),
        ("e", "mountain river", "river river rivers", "Studio")]


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_postings_by_stem(spark):
    got = {(r["id"], r["term"]): (r["weight"], r["tf"]) for r in search.stemmed_postings(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert got["a", "studi"] == ("A", 2) and got["a", "river"] == ("A", 2)
    assert got["c", "river"] == ("C", 1) and got["e", "river"] == ("A", 4)
    assert not any(k[1] in ("the", "of", "and") for k in got) and not any(k[0] == "d" for k in got)


def test_postings_of_repeated_ids_meet_by_stem(spark):
    rows = [("a", None, "studies", "River"), ("a", "study", "rivers", None), (None, "study", None, None), (None, None, "studies", None)]
    got = sorted(tuple(r) for r in search.stemmed_postings(spark.createDataFrame(rows, SCHEMA)).where("id is not null").collect())
    assert got == [("a", "river", "B", 2), ("a", "studi", "A", 2)]
    none = search.stemmed_postings(spark.createDataFrame(rows, SCHEMA)).where("id is null").collect()
    assert [tuple(r) for r in none] == [(None, "studi", "A", 2)]


def test_postings_of_unique_ids_need_no_shuffle_and_no_stem_a_posting(spark):
    plan = search.stemmed_postings(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ational" not in plan


def test_postings_in_short_runs(spark):
    from lodestar.operators import quality
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": ["a", "b", "c"], "title": ["x y x", "", " the "], "description": ["y z" * 3, "z  z", ""], "organization": ["", "q", ""]})
    run = quality._postings(None)
    whole = sorted(tuple(r.values()) for b in run(iter([batch])) for r in b.to_pylist())
    parts = sorted(tuple(r.values()) for i in range(3) for b in run(iter([batch.slice(i, 1)])) for r in b.to_pylist())
    assert whole == parts and ("a", "x", "A", 2) in whole and ("a", "y", "A", 2) in whole and ("b", "z", "B", 2) in whole
    assert not any(r[0] == "c" for r in whole)


def test_search_over_segments(spark, tmp_path):
    path = str(tmp_path / "index")
    search.add_to_index(spark.createDataFrame(ROWS[:3], SCHEMA), path)
    search.add_to_index(spark.createDataFrame(ROWS[3:], SCHEMA), path)
    find = lambda q: _ids(search.search_index(spark, path, q))
    assert find("study rivers") == ["a", "b", "c"]
    assert find("Mountain") == ["c", "e"] and find("the rivers") == ["a", "b", "c", "e"]
    assert find("river unknown") == [] and find("the") == [] and find("") == []


def test_a_hot_term_is_many_short_lists(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BITS", 4)
    rows = [(f"x{i}", "common " + ("rare" if i % 17 == 0 else "other"), None, None) for i in range(300)]
    path = str(tmp_path / "index")
    search.add_to_index(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    stored = spark.read.parquet(f"{path}/postings").where("term = 'common'")
    assert stored.agg(F.sum("n")).first()[0] == 300 and stored.agg(F.max("n")).first()[0] <= 16
    assert _ids(search.search_index(spark, path, "rare common")) == sorted(f"x{i}" for i in range(0, 300, 17))


def test_only_the_buckets_of_the_terms_are_read(spark, tmp_path):
    path = str(tmp_path / "index")
    search.add_to_index(spark.createDataFrame([(str(i), f"word{i} stone", None, None) for i in range(200)], SCHEMA), path)
    asked = search.query_terms(spark, "word7 stones")
    read = search.postings_of(spark, path, asked)
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} == {b for _, b in asked}
