"""DuckDB SQL twins of ``lodestar.functions.format`` (oracle only)."""

from __future__ import annotations

from lodestar.constants import (AS_OF, CALM_COLOUR, CARD_BADGE, CARD_EMOJI, FALLBACK_BADGE,
                                FALLBACK_EMOJI, POST_EMOJI, SITE_BASE, URGENT_COLOUR)

SUPP = r"[\x{10000}-\x{10FFFF}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def utf16_length(x):
    return f"(2 * length({x}) - length(regexp_replace({x}, '{SUPP}', '', 'g')))"


def escape_html(x, quotes=False):
    s = f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"replace({s}, '\"', '&quot;')" if quotes else s


def truncate(x, n, ell):
    return f"(CASE WHEN length({x}) > {n} THEN substring({x}, 1, {n}) || {q(ell)} ELSE {x} END)"


def deadline_label(d="deadline", r="is_rolling", long=False):
    none = "Rolling / No deadline" if long else "Rolling"
    fmt = "%B %-d, %Y" if long else "%b %-d, %Y"
    return f"(CASE WHEN {r} OR {d} IS NULL THEN {q(none)} ELSE strftime({d}, '{fmt}') END)"


def urgent(d="deadline", r="is_rolling", as_of=AS_OF):
    return (f"(CASE WHEN {r} OR {d} IS NULL THEN false "
            f"ELSE CAST({d} AS TIMESTAMP) < TIMESTAMP '{as_of}' + INTERVAL 7 DAY END)")


def deadline_colour(d="deadline", r="is_rolling", as_of=AS_OF):
    return f"(CASE WHEN {urgent(d, r, as_of)} THEN {q(URGENT_COLOUR)} ELSE {q(CALM_COLOUR)} END)"


def _case(mapping, key, fallback):
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {key} {whens} ELSE {q(fallback)} END)"


def type_emoji(t="type", card=False):
    return _case(CARD_EMOJI if card else POST_EMOJI, t, FALLBACK_EMOJI)


def badge_colours(t="type"):
    return (_case({k: v[0] for k, v in CARD_BADGE.items()}, t, FALLBACK_BADGE[0]),
            _case({k: v[1] for k, v in CARD_BADGE.items()}, t, FALLBACK_BADGE[1]))


def region_label(r="regions"):
    word = "upper(w[1]) || lower(w[2:])"
    return (f"array_to_string(list_transform({r}, lambda x: array_to_string(list_transform("
            f"string_split(replace(x, '_', ' '), ' '), lambda w: {word}), ' ')), ', ')")


def type_label(t="type"):
    return f"(upper({t}[1]) || {t}[2:])"


def item_url(s="slug", base=SITE_BASE):
    return f"({q(base + '/opportunities/')} || {s})"


def duration_label(ms):
    tot = f"floor(({ms}) / 1000)"
    return f"(CAST(CAST(floor({tot} / 60) AS BIGINT) AS VARCHAR) || 'm ' || CAST(CAST({tot} % 60 AS BIGINT) AS VARCHAR) || 's')"


def clip_error(x, n=500):
    return truncate(x, n, "…")


def present(x):
    return f"({x} IS NOT NULL AND length({x}) > 0)"


def summary_or_description(s="summary", d="description"):
    return f"(CASE WHEN {present(s)} THEN {s} ELSE {d} END)"
