"""Personal data against a plain scan in Python."""

import hashlib
import re

from pyspark.sql import functions as F

from lodestar.llm import queries, sanitise

SMALL = "/root/testdata/sf0.001"


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def plain(text):
    out = []
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    for k, (p, ok) in enumerate(rules):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text or "") if ok(m.group())]
    return sorted(out)


ODD = [None, "", "a@b.c+d@e.f x@y", "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3 001.2.3.4", "é 4111 1111 1111 1111, 4111-1111-1111-1112",
       "call +1 (555) 123-4567 or ++49 30 1234567- or +1", "9" * 3000 + "." + "8" * 2000, "aA." * 2000 + "@", "1 2 " * 8000,
       "日本 mail ü.x@y.z\n+33 1 23 45 67 89\nfoo", "a@b.c@d.e", "%@-.-", "12345678901234567890 123456789012"]


def test_base_spans_equal_a_plain_scan(spark):
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(ODD)], "doc_id long, text string, kind string")
    got = {r.doc_id: [tuple(s) for s in r.base] for r in sanitise.sanitise(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(ODD)}


def test_op7_on_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op7_disclosure_pii"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        text = ",".join(f"{sanitise.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for _, k, _ in base) for j in range(4))
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == [s for s in text.split(",") if s]


def test_disclosing_terms_are_removed_from_entity_lines_only(spark):
    rows = [(i, f"plain words here w{i}x\nkontakt mailbox: u{i}@x.org and words", None) for i in range(12)]
    rows += [(100 + i, "plain words here and there", None) for i in range(200)] + [(400, "kontakt without any", None)]
    got = {r.doc_id: r for r in sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string, term string")).collect()}
    assert len(got) == len(rows)
    assert got[0].sanitised.split("\n")[1].strip().startswith(":") and "[email]" in got[0].sanitised and "words" in got[0].sanitised
    assert got[400].sanitised is None and got[100].sanitised is None
    assert got[0].sanitised.split("\n")[0] == "plain words here w0x"
    assert sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string, term string").limit(0)).count() == 0


def test_copies_leave_the_disclosing_terms_as_they_are(spark):
    rows = [f"plain words here w{i}x\nkontakt mailbox: u{i}@x.org and words" for i in range(12)]
    rows += ["plain words here and there"] * 200 + ["kontakt without any"]
    rows += [f"zentrale at v{i % 2}@y.org" for i in range(40)]      # two lines in twenty copies each

    def found(texts):
        docs = spark.createDataFrame([(t,) for t in texts], "text string")
        lines = docs.select(F.explode(sanitise._entity_lines(F.col("text"))).alias("x")).select("x.line", "x.kinds")
        return {(r.term, r.kind): round(r.disclosure, 9) for r in sanitise.disclosing_terms(docs, lines).collect()}
    once = found(rows)
    assert {("kontakt", 0), ("mailbox", 0), ("zentrale", 0)} <= set(once) and ("plain", 0) not in once
    assert once["mailbox", 0] == once["zentrale", 0] == 1
    many = found(rows * 30)
    assert set(many) == set(once) and many == once


def test_long_texts_with_many_spans(spark):
    """Spans and the cut text of long lines and texts; time grows with the length."""
    import time
    text = "".join(f"näme{i}@site{i}.example.org {i} \n" if i % 3 else f"user{i}@x.org, +1 555 000 {i:04d} " for i in range(40_000))
    df = spark.createDataFrame([(1, text), (2, text[:90_000])], "doc_id long, text string")
    begun = time.time()
    got = {r.doc_id: r for r in sanitise.sanitise(df).collect()}
    assert time.time() - begun < 90
    for i, t in ((1, text), (2, text[:90_000])):
        assert [tuple(x) for x in got[i].base] == plain(t)
        want, at = [], 0
        for a, k, b in [tuple(x) for x in got[i].spans]:
            if a >= at:
                want += [t[at:a], f"[{sanitise.KINDS[k]}]" if k < 4 else ""]
                at = b
        assert got[i].sanitised == "".join(want) + t[at:]
