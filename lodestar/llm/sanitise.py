"""Personal data by information-theoretic sanitisation, in DataFrame
expressions only.

Base spans (e-mail, IP address, card, phone) are the protected entities.
The lines that hold an entity of a kind are the kind's context; all words of
all texts are the corpus, and both count every occurrence, copies too.  A term's disclosure
of a kind is its pointwise mutual information with the context over the
kind's information content: 1 if the term is found in that context only, 0 if
it is found there as often as anywhere.  Terms of at least ``DISCLOSES``
with at least ``SUPPORT`` occurrences in the context are removed from the
lines that hold the kind, next to the base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import written

SUPPORT, DISCLOSES = 5, 0.6
KINDS = ("email", "ip", "card", "phone", "term")
# The same matches as the plain forms, without their backtracking: a match can
# only begin where a run begins, or where the match before ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TERM = r"(?<!\S)\p{L}{3,}+(?=[.,;:!?]*+(?!\S))"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, c):
        at = total["n"] % 2 == 1
        d = c.cast("int") * F.when(at, 2).otherwise(1)
        return F.struct((total["s"] + d - F.when(d > 9, 9).otherwise(0)).alias("s"), (total["n"] + 1).alias("n"))
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    end = F.aggregate(chars, F.struct(F.lit(0).alias("s"), F.lit(0).alias("n")), add)
    return end["s"] % 10 == 0


def _card_ok(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False)


# kind number, a cheap condition on the text, pattern, condition on the match
_BASE = [
    (0, lambda t: F.contains(t, F.lit("@")), _EMAIL, lambda m: F.lit(True)),
    (1, lambda t: t.rlike(r"[0-9]\.[0-9]"), _IP, lambda m: F.forall(
        F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))),
    (2, lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), _CARD, _card_ok),
    (3, lambda t: F.contains(t, F.lit("+")), _PHONE, lambda m: F.length(_digits(m)).between(9, 15)),
]
_SPAN = "array<struct<start:int,kind:int,end:int>>"


CHUNK = 256     # elements that one array of a fold grows by
BLOCK = 1024    # code points of a piece of a text that is cut


def _let(x: Column, body) -> Column:
    """``body`` of ``x``, which is worked out once."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def _fold(items: Column, start: Column, state: str, out: str, step) -> Column:
    """Go through an array with a running state; ``step(state, item)`` gives
    the next state and an array of results.  All results, in order.

    Results grow in chunks, as appending to one array copies it every time."""
    zero = F.struct(start.cast(state).alias("at"), F.array().cast(f"array<{out}>").alias("found"))

    def one(a, x):
        at, more = step(a["at"], x)
        return F.struct(at.alias("at"), F.concat(a["found"], more).alias("found"))

    def chunk(done, part):
        last = F.coalesce(F.get(done, F.size(done) - 1)["at"], start.cast(state))
        return F.concat(done, F.array(F.aggregate(part, F.struct(last.alias("at"), F.array().cast(f"array<{out}>").alias("found")), one)))
    parts = _let(items, lambda x: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(x) - 1, F.lit(0)) / CHUNK).cast("int")),
                                              lambda i: F.slice(x, i * CHUNK + 1, CHUNK)))
    done = F.aggregate(parts, F.slice(F.array(zero), 1, 0), chunk)
    return F.flatten(F.transform(done, lambda d: d["found"]))


def _spans(text: Column, pattern: str, kind: int, ok) -> Column:
    """Spans of the pattern's passing matches: the texts between matches and
    the matches alternate, so their lengths add up to the positions."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast(_SPAN)

    def step(at, z):
        start = at + F.length(z["gaps"])
        end = start + F.length(z["hits"])
        return end, F.when(ok(z["hits"]), F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))).otherwise(empty)
    # the last gap has no match: it is dropped before the two arrays are put side by side
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gaps"), hits.alias("hits"))
    found = _fold(pairs, F.lit(0), "int", "struct<start:int,kind:int,end:int>", step)
    return F.when(F.size(hits) > 0, found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind."""
    empty = F.array().cast(_SPAN)
    parts = [F.when(maybe(text), _spans(text, pattern, kind, ok)).otherwise(empty) for kind, maybe, pattern, ok in _BASE]
    return F.sort_array(F.concat(*parts))


def _line_kinds(line: Column) -> Column:
    """The kinds found in a line (no base match crosses a line's end)."""
    return F.array_compact(F.array(*[
        F.when(maybe(line) & F.exists(F.regexp_extract_all(line, F.lit(pattern), F.lit(0)), ok), F.lit(kind))
        for kind, maybe, pattern, ok in _BASE]))


def _entity_lines(text: Column) -> Column:
    """array<struct<off, line, kinds>> of the lines with a base span."""
    kind = "struct<off:int,line:string,kinds:array<int>>"

    def step(at, line):
        found = F.transform(F.array(_line_kinds(line)), lambda k: F.struct(at.alias("off"), line.alias("line"), k.alias("kinds")))
        return at + F.length(line) + 1, F.filter(found, lambda x: F.size(x["kinds"]) > 0).cast(f"array<{kind}>")
    return _fold(F.split(text, "\n", -1), F.lit(0), "int", kind, step)


def _terms(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), lambda w: F.lower(w))


def disclosing_terms(docs: DataFrame, lines: DataFrame, support: int = SUPPORT, discloses: float = DISCLOSES) -> DataFrame:
    """(term, kind, disclosure) from all words of ``docs`` (text) and the
    entity ``lines`` (line, kinds).  A line that repeats is taken apart once
    and its words count as often as it occurs, as they do in the corpus."""
    once = lines.groupBy(F.xxhash64("line").alias("a"), F.xxhash64("line", F.lit(7)).alias("b")).agg(
        F.first("line").alias("line"), F.first("kinds").alias("kinds"), F.count(F.lit(1)).alias("times"))
    near = once.select("kinds", "times", F.explode(_terms(F.col("line"))).alias("term")).select("term", "times", F.explode("kinds").alias("kind"))
    joint = written(near.groupBy("term", "kind").agg(F.sum("times").alias("n_joint")), "pii-joint")
    corpus = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    corpus = written(corpus, "pii-terms")
    context = joint.groupBy("kind").agg(F.sum("n_joint").alias("n_kind"))
    total = corpus.agg(F.sum("n_term").alias("n_all"))
    x = joint.where(F.col("n_joint") >= support).join(corpus, "term").join(F.broadcast(context), "kind").crossJoin(F.broadcast(total))
    pmi = F.log(F.col("n_joint") * F.col("n_all") / (F.col("n_term") * F.col("n_kind").cast("double")))
    content = F.log(F.col("n_all") / F.col("n_kind").cast("double"))
    return x.withColumn("disclosure", pmi / content).where(F.col("disclosure") >= discloses).select("term", "kind", "disclosure")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced: base spans by their kind in
    brackets, terms by nothing.  Of spans that overlap the first one counts."""
    label = F.array(*[F.lit(f"[{k}]") for k in KINDS[:4]], F.lit(""))
    kind = "struct<from:int,to:int,end:int,label:string>"

    def step(at, s):
        cut = F.struct(at.alias("from"), s["start"].alias("to"), s["end"].alias("end"), F.element_at(label, s["kind"] + 1).alias("label"))
        first = s["start"] >= at
        return F.when(first, s["end"]).otherwise(at), F.when(first, F.array(cut)).otherwise(F.array().cast(f"array<{kind}>")).cast(f"array<{kind}>")

    def pieces(blocks, cuts):
        def piece(at, to):      # only the blocks that hold it are looked at
            b = F.floor(at / BLOCK).cast("int")
            near = F.array_join(F.slice(blocks, b + 1, F.floor(to / BLOCK).cast("int") - b + 1), "")
            return F.substring(near, at - b * BLOCK + 1, to - at)
        head = F.transform(cuts, lambda c: F.concat(piece(c["from"], c["to"]), c["label"]))
        end = F.coalesce(F.get(cuts, F.size(cuts) - 1)["end"], F.lit(0))
        return F.concat(F.array_join(head, ""), piece(end, F.length(text)))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    cuts = _fold(spans, F.lit(0), "int", kind, step)
    return _let(blocks, lambda x: _let(cuts, lambda c: pieces(x, c)))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to one row per input row: doc_id, ``base`` and
    ``spans`` (arrays of start, kind number, end in code points), and
    ``sanitised``, the text without them (null: unchanged).

    Null and empty texts have no spans.  doc_ids are only passed on: null and
    repeated ones are rows like any other.
    """
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text")))
    some = F.size("base") > 0
    rows = written(src.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "base",
                              F.when(some, F.col("text")).alias("text")), "pii-base")
    found = rows.where("text is not null")
    lines = written(found.select("rid", F.explode(_entity_lines(F.col("text"))).alias("x")).select("rid", "x.*"), "pii-lines")
    terms = disclosing_terms(docs.select("text"), lines.select("line", "kinds"))
    named = lines.select("rid", "off", "kinds", F.explode(F.array_distinct(_terms(F.col("line")))).alias("term"))
    hit = named.select("rid", "off", "term", F.explode("kinds").alias("kind")).join(terms.select("term", "kind"), ["term", "kind"])
    per = hit.groupBy("rid", "off").agg(F.collect_set("term").alias("terms"))      # words of one line
    at = lines.join(per, ["rid", "off"]).withColumn("local", _spans(F.col("line"), _TERM, 4, lambda m: F.array_contains("terms", F.lower(m))))
    more = at.select("rid", F.transform("local", lambda s: F.struct(
        (s["start"] + F.col("off")).alias("start"), s["kind"].alias("kind"), (s["end"] + F.col("off")).alias("end"))).alias("s"))
    more = more.groupBy("rid").agg(F.flatten(F.collect_list("s")).alias("more"))   # spans of one text
    out = rows.join(more, "rid", "left").withColumn("spans", F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(_SPAN)))))
    return out.select("doc_id", "base", "spans", F.when(F.size("spans") > 0, redact(F.col("text"), F.col("spans"))).alias("sanitised"))


def digest(found: DataFrame) -> DataFrame:
    """The counts per kind, the hash of the base spans and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id", *[count(k) for k in range(4)], F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_term"),
        F.crc32(F.col("sanitised").cast("binary")).alias("sanitised_crc32"))
