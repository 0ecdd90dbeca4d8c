"""Title/URL normalisation, hashes and slugs as native Column expressions.

The listing model's rules are written for ECMAScript regular expressions:
``\\s`` includes Unicode spaces, ``\\w`` and ``\\b`` are ASCII-only.  Java
regex differs on both, so every function first maps the ECMAScript space set
to a plain space and then uses explicit ASCII classes and look-arounds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.constants import FILLER_WORDS

# The characters of ECMAScript \s.
JS_SPACES = ("\t\n\x0B\f\r \u00A0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202F\u205F\u3000\uFEFF")
# ECMAScript \s minus the plain space (which is already a space).
JS_SPACE = r"[\t\n\x0B\f\r\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
_W = "A-Za-z0-9_"
_NOT_W_BEFORE = rf"(?<![{_W}])"
_NOT_W_AFTER = rf"(?![{_W}])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_spaces(c) -> Column:
    """Map every ECMAScript whitespace character to ' '."""
    return F.regexp_replace(_col(c), JS_SPACE, " ")


def js_trim(c) -> Column:
    """ECMAScript ``trim()``: strips every ECMAScript whitespace character at
    both ends; what lies between is not searched."""
    return F.btrim(_col(c), F.lit(JS_SPACES))


def norm_hash(c) -> Column:
    """lower → trim → drop [^\\w\\s] → collapse whitespace."""
    s = F.trim(F.lower(js_spaces(c)))
    s = F.regexp_replace(s, rf"[^{_W} ]", "")
    return F.regexp_replace(s, " +", " ")


def norm_title(c) -> Column:
    """lower → drop 20xx years → drop punctuation → drop fillers → collapse → trim."""
    s = F.lower(js_spaces(c))
    s = F.regexp_replace(s, _NOT_W_BEFORE + r"20[0-9]{2}" + _NOT_W_AFTER, "")
    s = F.regexp_replace(s, rf"[^{_W} ]", "")
    s = F.regexp_replace(s, _NOT_W_BEFORE + "(" + "|".join(FILLER_WORDS) + ")" + _NOT_W_AFTER, "")
    s = F.regexp_replace(s, " +", " ")
    return F.trim(s)


def item_hash(title, url) -> Column:
    """sha256 hex of ``F1(title)|F1(url)``."""
    return F.sha2(F.concat(norm_hash(title), F.lit("|"), norm_hash(url)), 256)


def sort_key(normalised) -> Column:
    """Token-sorted form used by the token-sort ratio (F4 preprocessing).

    Every non-alphanumeric (including '_') becomes a separator, tokens are
    sorted by code unit and joined by one space.
    """
    s = F.trim(F.regexp_replace(F.lower(_col(normalised)), "[^a-z0-9]+", " "))
    return F.array_join(F.array_sort(F.split(s, " ")), " ")


def slug(title, url) -> Column:
    """lower, keep [a-z0-9 -], spaces→'-', collapse '-', 60 chars, one
    trailing '-' dropped, then '-' + first 8 hex of sha256(raw url)."""
    s = F.lower(js_spaces(title))
    s = F.regexp_replace(s, "[^a-z0-9 -]", "")
    s = F.regexp_replace(s, " +", "-")
    s = F.regexp_replace(s, "-+", "-")
    s = F.regexp_replace(F.substring(s, 1, 60), "-$", "")
    return F.concat(s, F.lit("-"), F.substring(F.sha2(_col(url), 256), 1, 8))


def present(c) -> Column:
    """JS truthiness of a string: not null and not empty."""
    c = _col(c)
    return c.isNotNull() & (F.length(c) > 0)


def completeness(title="title", description="description", deadline="deadline",
                 organization="organization", application_url="application_url",
                 funding_amount="funding_amount", eligibility_text="eligibility_text") -> Column:
    """weighted count of filled fields, capped at 100."""
    desc = _col(description)
    score = (F.when(present(title), 20).otherwise(0)
             + F.when(desc.isNotNull() & (F.length(desc) > 50), 20).otherwise(0)
             + F.when(_col(deadline).isNotNull(), 15).otherwise(0)
             + F.when(present(organization), 15).otherwise(0)
             + F.when(present(application_url), 15).otherwise(0)
             + F.when(present(funding_amount), 10).otherwise(0)
             + F.when(present(eligibility_text), 5).otherwise(0))
    return F.least(score, F.lit(100)).cast("int")
