"""Scalar formatting for messages and cards (F8–F18) as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.constants import (AS_OF, CALM_COLOUR, CARD_BADGE, CARD_EMOJI, ERROR_CLIP,
                                FALLBACK_BADGE, FALLBACK_EMOJI, POST_EMOJI, SITE_BASE,
                                URGENT_COLOUR)
from lodestar.functions.text import present

SUPPLEMENTARY = r"[\x{10000}-\x{10FFFF}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utf16_length(c) -> Column:
    """Length in UTF-16 code units (what the message limit counts): code
    points plus one for every character outside the BMP."""
    c = _col(c)
    return F.length(c) * 2 - F.length(F.regexp_replace(c, SUPPLEMENTARY, ""))


def escape_html(c, quotes: bool = False) -> Column:
    """F8: & first, then < and > (and " for the card form)."""
    s = F.replace(_col(c), F.lit("&"), F.lit("&amp;"))
    s = F.replace(s, F.lit("<"), F.lit("&lt;"))
    s = F.replace(s, F.lit(">"), F.lit("&gt;"))
    if quotes:
        s = F.replace(s, F.lit('"'), F.lit("&quot;"))
    return s


def truncate(c, n: int, ellipsis: str) -> Column:
    """over ``n`` characters → first ``n`` + ellipsis."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(ellipsis))).otherwise(c)


def deadline_label(deadline="deadline", is_rolling="is_rolling", long: bool = False) -> Column:
    """'Rolling' / 'Rolling / No deadline', else 'Jan 5, 2026' / 'January 5, 2026'."""
    d, r = _col(deadline), _col(is_rolling)
    none = "Rolling / No deadline" if long else "Rolling"
    fmt = "MMMM d, yyyy" if long else "MMM d, yyyy"
    return F.when(r | d.isNull(), F.lit(none)).otherwise(F.date_format(d, fmt))


def urgent(deadline="deadline", is_rolling="is_rolling", as_of: str = AS_OF) -> Column:
    """not rolling and the deadline (00:00 UTC) is less than 7 days after as_of."""
    d, r = _col(deadline), _col(is_rolling)
    soon = d.cast("timestamp_ntz") < F.expr(f"TIMESTAMP_NTZ '{as_of}' + INTERVAL 7 DAYS")
    return F.when(r | d.isNull(), F.lit(False)).otherwise(soon)


def deadline_colour(deadline="deadline", is_rolling="is_rolling", as_of: str = AS_OF) -> Column:
    return F.when(urgent(deadline, is_rolling, as_of), F.lit(URGENT_COLOUR)).otherwise(F.lit(CALM_COLOUR))


def _lookup(mapping: dict, key: Column, fallback: str) -> Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(m[key], F.lit(fallback))


def type_emoji(type_col="type", card: bool = False) -> Column:
    """F12 (emoji part): the card form differs from the message form for 'job'."""
    return _lookup(CARD_EMOJI if card else POST_EMOJI, _col(type_col), FALLBACK_EMOJI)


def badge_colours(type_col="type") -> tuple[Column, Column]:
    """F12 (badge part): background and text colour."""
    bg = _lookup({k: v[0] for k, v in CARD_BADGE.items()}, _col(type_col), FALLBACK_BADGE[0])
    fg = _lookup({k: v[1] for k, v in CARD_BADGE.items()}, _col(type_col), FALLBACK_BADGE[1])
    return bg, fg


def region_label(regions="regions") -> Column:
    """'latin_america' → 'Latin America', comma-joined (enum values)."""
    return F.array_join(F.transform(_col(regions), lambda r: F.initcap(F.replace(r, F.lit("_"), F.lit(" ")))), ", ")


def type_label(type_col="type") -> Column:
    """first letter upper-cased."""
    t = _col(type_col)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))


def item_url(slug_col="slug", base: str = SITE_BASE) -> Column:
    """F15."""
    return F.concat(F.lit(base + "/opportunities/"), _col(slug_col))


def duration_label(ms) -> Column:
    """F16: milliseconds → 'Xm Ys', floored."""
    total = F.floor(_col(ms) / 1000)
    return F.format_string("%dm %ds", F.floor(total / 60), total % 60)


def clip_error(c, n: int = ERROR_CLIP) -> Column:
    """over 500 chars → first 500 + '…'."""
    return truncate(c, n, "…")


def summary_or_description(summary="summary", description="description") -> Column:
    """summary when non-empty, else description."""
    s = _col(summary)
    return F.when(present(s), s).otherwise(_col(description))
