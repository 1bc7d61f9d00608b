"""Stations: identifiers, types and matching of sample descriptions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions.values import lookup, translate_or_keep


def alt_location(usgs_id: Column, win: Column, wrnum: Column) -> Column:
    """struct(altlocationid, altlocationcontext) from the first id that is present."""
    return F.struct(
        F.coalesce(usgs_id, win, wrnum).alias("altlocationid"),
        F.when(usgs_id.isNotNull(), "usgs_id")
        .when(win.isNotNull(), "Utah Well ID")
        .when(wrnum.isNotNull(), "Utah Water Rights Number")
        .alias("altlocationcontext"),
    )


def station_type(c: Column) -> Column:
    return translate_or_keep(c, vocab.STATION_TYPES)


def marker_icon(c: Column) -> Column:
    return F.coalesce(lookup(c, vocab.MARKER_ICONS), F.lit("bullseye"))


def required_texts(pattern: str) -> list[list[str]] | None:
    """For each alternative of a rule's pattern, the texts that a match must hold; None where
    the pattern uses more than alternatives, plain groups and ``.*?``."""
    plain = pattern.replace(".*?", "\0")
    grouped = re.search(r"\([^)]*\||\)\0?[*+?{]", plain)
    if grouped or re.search(r"[\[\]{}+*?^$.\\]", plain):
        return None
    return [[t for t in re.split(r"[\0()]", part) if t] for part in plain.split("|")]


def match_station_rules(
    description: Column, rules=None, corrected: bool = False, capitals: Column | None = None, numbered: Column | None = None
) -> Column:
    """Station id of the last rule whose pattern, or whose id, occurs in the description.

    The rules form one chain, last rule first, so each pattern is compiled once and a row
    stops at its first hit. ``corrected`` drops empty alternatives, which match any text.
    ``capitals``, the description in capitals, and ``numbered``, whether it may hold an id, come
    from an earlier step if given; then a pattern runs only on a row that holds the longest
    text which one of its alternatives needs, and most rows hold those of few rules.
    """
    chain = None
    for pattern, station in reversed(vocab.STATION_RULES if rules is None else rules):
        if corrected:
            pattern = "|".join(p for p in pattern.split("|") if p)
        hit = description.rlike(f"(?i){pattern}|{station}")
        needed = required_texts(pattern)
        if capitals is not None and needed is not None and all(needed):
            hit = any_of([*(capitals.contains(max(texts, key=len).upper()) for texts in needed), numbered]) & hit
        chain = F.when(hit, station) if chain is None else chain.when(hit, station)
    return chain


def match_station_exact(description: Column, names=None) -> Column:
    return lookup(description, vocab.STATION_NAMES if names is None else names)


def county_criterion(state: str, county: str) -> tuple[str, str]:
    """('US:ss', 'US:ss:ccc') of a county search; the state may be given by name."""
    number = vocab.STATE_FIPS.get(state, state)
    code = f"{int(number):02d}"
    return f"US:{code}", f"US:{code}:{county}"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
