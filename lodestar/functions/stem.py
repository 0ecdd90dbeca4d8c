"""English suffix stemming (the published Porter2 rules) as SQL expressions.

Every step reads the column ``w`` and the region starts ``p1`` and ``p2`` and
gives the next ``w``.  The expressions use only what Spark SQL and ANSI-like
dialects share, so the same rules run as a chain of Spark projections
(``stemmed``) and as a chain of common table expressions (``stem_ctes``).
``stem_word`` says them once more for tasks that stem each distinct word of
many rows; the tests hold the three together.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: the suffixes and exceptions of the published algorithm.
VOWELS = "aeiouy"
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
LI_ENDINGS = "cdeghkmnrt"
LONG_PREFIXES = ["gener", "commun", "arsen"]
WHOLE_WORDS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
               "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
               "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
               "bias": "bias", "andes": "andes"}
KEPT_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
DERIVED = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize",
           "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al",
           "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive",
           "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": ""}
ADJECTIVAL = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic",
              "ful": "", "ness": "", "ative": ""}
DROPPED = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti",
           "ous", "ive", "ize", "ion"]

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"
# a syllable that counts as short at the end of a word
_SHORT = f"(^{_V}{_C}|{_C}{_V}[^{VOWELS}wxY])$"


def _like(dialect: str, text: str, pattern: str) -> str:
    return f"{'regexp_like' if dialect == 'spark' else 'regexp_matches'}({text}, '{pattern}')"


def _ends(suffix: str) -> str:
    return f"right(w, {len(suffix)}) = '{suffix}'"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _in(region: str, n: int) -> str:
    """The last n letters lie in a region."""
    return f"length(w) - {n} >= {region}"


def _longest(rules: dict[str, str], region: str, extra: dict[str, str]) -> str:
    """Only the longest suffix that the word ends with is looked at."""
    cases = []
    for s in sorted(rules, key=lambda x: (-len(x), x)):
        where = " AND ".join([_in(region, len(s)), *([extra[s]] if s in extra else [])])
        cases.append(f"WHEN {_ends(s)} THEN CASE WHEN {where} THEN {_cut(len(s))} || '{rules[s]}' ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def steps(dialect: str) -> list[dict[str, str]]:
    """Expressions per column, to be computed one list entry after the other
    from a row of (word, w = word)."""
    has = lambda text, pattern: _like(dialect, text, pattern)
    marked = "w"
    for v in VOWELS:
        marked = f"replace({marked}, '{v}y', '{v}Y')"
    first = f"regexp_extract(w, '^({'|'.join(LONG_PREFIXES)}|.*?{_V}{_C})', 0)"
    rest = f"regexp_extract(substring(w, p1 + 1), '^.*?{_V}{_C}', 0)"
    fixed = f"(w IN ({_quoted(KEPT_AFTER_PLURAL)}))"
    doubled = " OR ".join(_ends(d) for d in DOUBLES)
    before = lambda n, letters: f"position(substring(w, length(w) - {n}, 1) IN '{letters}') > 0 AND length(w) > {n}"
    verb = ["ingly", "edly", "ing", "ed"]
    cut_verb = " ".join(f"WHEN {_ends(s)} THEN CASE WHEN {has(_cut(len(s)), _V)} THEN {_cut(len(s))} || '+' ELSE w END" for s in verb)
    return [
        {"w": "CASE WHEN left(w, 1) = 'y' THEN 'Y' || substring(w, 2) ELSE w END"},
        {"w": marked},
        {"p1": f"CASE WHEN {first} = '' THEN length(w) ELSE length({first}) END"},
        {"p2": f"CASE WHEN {rest} = '' THEN length(w) ELSE p1 + length({rest}) END"},
        # plurals
        {"w": f"CASE WHEN {_ends('sses')} THEN {_cut(2)} "
              f"WHEN {_ends('ied')} OR {_ends('ies')} THEN CASE WHEN length(w) > 4 THEN {_cut(2)} ELSE {_cut(1)} END "
              f"WHEN {_ends('us')} OR {_ends('ss')} THEN w "
              f"WHEN {_ends('s')} AND {has('w', _V + '.+s$')} THEN {_cut(1)} ELSE w END"},
        {"fixed": fixed},
        # past and continuous forms; a cut one is marked and then mended
        {"w": f"CASE WHEN fixed THEN w WHEN {_ends('eedly')} THEN CASE WHEN {_in('p1', 5)} THEN {_cut(3)} ELSE w END "
              f"WHEN {_ends('eed')} THEN CASE WHEN {_in('p1', 3)} THEN {_cut(1)} ELSE w END {cut_verb} ELSE w END"},
        {"cut": f"{_ends('+')}"},
        {"w": f"CASE WHEN cut THEN {_cut(1)} ELSE w END"},
        {"w": f"CASE WHEN NOT cut THEN w WHEN {_ends('at')} OR {_ends('bl')} OR {_ends('iz')} THEN w || 'e' "
              f"WHEN {doubled} THEN {_cut(1)} WHEN p1 >= length(w) AND {has('w', _SHORT)} THEN w || 'e' ELSE w END"},
        {"w": f"CASE WHEN NOT fixed AND length(w) > 2 AND {has('w', _C + '[yY]$')} THEN {_cut(1)} || 'i' ELSE w END"},
        {"w": f"CASE WHEN fixed THEN w ELSE {_longest(DERIVED, 'p1', {'ogi': before(3, 'l'), 'li': before(2, LI_ENDINGS)})} END"},
        {"w": f"CASE WHEN fixed THEN w ELSE {_longest(ADJECTIVAL, 'p1', {'ative': _in('p2', 5)})} END"},
        {"w": f"CASE WHEN fixed THEN w ELSE {_longest(dict.fromkeys(DROPPED, ''), 'p2', {'ion': before(3, 'st')})} END"},
        {"w": f"CASE WHEN fixed THEN w WHEN {_ends('e')} THEN CASE WHEN {_in('p2', 1)} "
              f"OR ({_in('p1', 1)} AND NOT {has(_cut(1), _SHORT)}) THEN {_cut(1)} ELSE w END "
              f"WHEN {_ends('ll')} AND {_in('p2', 1)} THEN {_cut(1)} ELSE w END"},
        {"w": "replace(w, 'Y', 'y')"},
        # short words, words with other signs than letters and exceptions
        {"w": "CASE " + " ".join(f"WHEN word = '{k}' THEN '{v}'" for k, v in WHOLE_WORDS.items())
              + f" WHEN length(word) < 3 OR NOT {has('word', '^[a-z]+$')} THEN word ELSE w END"},
    ]


_FIRST = re.compile(f"{'|'.join(LONG_PREFIXES)}|.*?{_V}{_C}")
_REST = re.compile(f".*?{_V}{_C}")
_LETTERS, _VOWEL, _PLURAL = re.compile("[a-z]+"), re.compile(_V), re.compile(f"{_V}.+s$")
_SHORT_END, _LAST_Y = re.compile(_SHORT), re.compile(f"{_C}[yY]$")
_BY_LENGTH = {id(rules): sorted(rules, key=lambda x: (-len(x), x)) for rules in (DERIVED, ADJECTIVAL)}
_DROPPED = sorted(DROPPED, key=lambda x: (-len(x), x))


def _ending(w: str, suffixes: list[str]) -> str | None:
    return next((s for s in suffixes if w.endswith(s)), None)


def stem_word(word: str) -> str:
    """The stem of a lower-case word, by the rules of ``steps``."""
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    if len(word) < 3 or not _LETTERS.fullmatch(word):
        return word
    w = "Y" + word[1:] if word[0] == "y" else word
    for v in VOWELS:
        w = w.replace(v + "y", v + "Y")
    m = _FIRST.match(w)
    p1 = m.end() if m else len(w)
    m = _REST.match(w[p1:])
    p2 = p1 + m.end() if m else len(w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif not w.endswith(("us", "ss")) and _PLURAL.search(w):
        w = w[:-1]
    fixed = w in KEPT_AFTER_PLURAL
    if not fixed:
        verb = _ending(w, ["eedly", "eed", "ingly", "edly", "ing", "ed"])
        if verb in ("eedly", "eed"):
            if len(w) - len(verb) >= p1:
                w = w[:-3] if verb == "eedly" else w[:-1]
        elif verb and _VOWEL.search(w[:-len(verb)]):
            w = w[:-len(verb)]
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif w[-2:] in DOUBLES:
                w = w[:-1]
            elif p1 >= len(w) and _SHORT_END.search(w):
                w += "e"
        if len(w) > 2 and _LAST_Y.search(w):
            w = w[:-1] + "i"
        for rules, extra in ((DERIVED, {"ogi": "l", "li": LI_ENDINGS}), (ADJECTIVAL, {})):
            s = _ending(w, _BY_LENGTH[id(rules)])
            if s and len(w) - len(s) >= p1 and (s != "ative" or len(w) - 5 >= p2):
                if s not in extra or len(w) > len(s) and w[-len(s) - 1] in extra[s]:
                    w = w[:-len(s)] + rules[s]
        s = _ending(w, _DROPPED)
        if s and len(w) - len(s) >= p2 and (s != "ion" or len(w) > 3 and w[-4] in "st"):
            w = w[:-len(s)]
        if w.endswith("e"):
            if len(w) - 1 >= p2 or len(w) - 1 >= p1 and not _SHORT_END.search(w[:-1]):
                w = w[:-1]
        elif w.endswith("ll") and len(w) - 1 >= p2:
            w = w[:-1]
    return w.replace("Y", "y")


def stemmed(words: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out``, the stem of the lower-case word in ``column``: one
    projection per step, no shuffle and no Python.  Words with other signs
    than a to z stay as they are; null gives null."""
    cols = [c for c in words.columns if c != out]
    df = words.select(F.struct(*cols).alias("_row"), F.col(column).alias("word"), F.col(column).alias("w"))
    for step in steps("spark"):
        df = df.withColumns({name: F.expr(e) for name, e in step.items()})
    return df.select("_row.*", F.col("w").alias(out))


def stem_ctes(source: str, column: str) -> str:
    """Common table expressions that end in ``stems(word, stem)`` for the
    distinct words of ``source.column``."""
    out = [f"stem_0 AS (SELECT DISTINCT {column} AS word, {column} AS w FROM {source})"]
    known = ["word", "w"]
    for i, step in enumerate(steps("duckdb"), 1):
        kept = [c for c in known if c not in step]
        out.append(f"stem_{i} AS (SELECT {', '.join(kept + [f'{e} AS {n}' for n, e in step.items()])} FROM stem_{i - 1})")
        known = kept + list(step)
    return ",\n".join([*out, f"stems AS (SELECT word, w AS stem FROM stem_{len(out) - 1})"])
