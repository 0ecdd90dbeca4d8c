"""Scalar functions against fixture values and the plain-Python rule."""

import random

from pyspark.sql import functions as F

import seqref
from lodestar.functions import format as fm
from lodestar.functions import fuzzy as fz
from lodestar.functions import text as tx


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(col.alias("x")).first().x


def test_item_hash_fixture(spark):
    h = one(spark, tx.item_hash("t", "u"), t="Global Scholars Program 2026", u="https://globalscholars.org/program-2026")
    assert h == "98603c881ba3942df21723b83a3285fb4055472ff2d721a048e29f88341433c9"


def test_slug_fixture(spark):
    assert one(spark, tx.slug("t", "u"), t="Test Scholarship Alpha 2026",
               u="https://example.com/alpha") == "test-scholarship-alpha-2026-e83d4639"
    assert one(spark, tx.slug("t", "u"), t="Test Scholarship Beta 2026",
               u="https://example.com/beta") == "test-scholarship-beta-2026-0082a7e3"


def test_norm_hash_trims_before_stripping(spark):
    assert one(spark, tx.norm_hash("t"), t="! a") == " a"
    assert one(spark, tx.norm_hash("t"), t="A b") == "a b"   # NBSP counts as a space


def test_norm_title_rules(spark):
    assert one(spark, tx.norm_title("t"), t="The Best-of 2026 Programme") == "bestof programme"
    assert one(spark, tx.norm_title("t"), t="Prize é2026 x") == "prize x"   # é is not a word char
    for s in ["Global Scholars Program 2027", "  A  tour of   the 2030 Fair!! ", "an_and the_2026"]:
        assert one(spark, tx.norm_title("t"), t=s) == seqref.norm_title(s)


def test_lcs_kernel_matches_dp():
    rnd = random.Random(7)
    for _ in range(500):
        a = "".join(rnd.choice("ab cd") for _ in range(rnd.randint(0, 60)))
        b = "".join(rnd.choice("ab cd") for _ in range(rnd.randint(0, 60)))
        assert fz.lcs_length(a, b) == seqref.lcs_dp(a, b)
        r = fz.ratio(a, b)
        assert fz.ratio_if_match(a, b) == (r if r >= 85 else 0)


def test_filters_are_lossless():
    """Every pair scoring ≥ 85 passes the length and histogram bounds."""
    rnd = random.Random(3)
    from collections import Counter
    for _ in range(2000):
        a = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 80)))
        b = list(a)
        for _ in range(rnd.randint(0, 12)):
            if b and rnd.random() < 0.5:
                del b[rnd.randrange(len(b))]
            else:
                b.insert(rnd.randint(0, len(b)), rnd.choice("abcdex "))
        b = "".join(b)
        if not b or fz.ratio(a, b) < 85:
            continue
        la, lb = len(a), len(b)
        assert abs(la - lb) * 200 <= 31 * (la + lb)
        ca, cb = Counter(a), Counter(b)
        assert sum(abs(ca[c] - cb[c]) for c in set(ca) | set(cb)) * 200 <= 31 * (la + lb)


def test_formatting(spark):
    assert one(spark, fm.escape_html("t", True), t='a & <b> "c"') == "a &amp; &lt;b&gt; &quot;c&quot;"
    assert one(spark, fm.truncate("t", 3, "..."), t="abcdef") == "abc..."
    assert one(spark, fm.type_label("t"), t="internship") == "Internship"
    assert one(spark, fm.region_label(F.array(F.lit("latin_america"), F.lit("global")))) == "Latin America, Global"
    assert one(spark, fm.utf16_length("t"), t="🎓a") == 3
    df = spark.sql("SELECT DATE'2026-01-05' AS deadline, false AS is_rolling")
    assert df.select(fm.deadline_label()).first()[0] == "Jan 5, 2026"
    assert df.select(fm.deadline_label(long=True)).first()[0] == "January 5, 2026"
