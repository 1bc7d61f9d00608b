"""SQL text shared by the checks."""

from __future__ import annotations

from seepline import vocab
from seepline.functions import normal


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def number(c: str) -> str:
    """Text to double; only what is written as a plain number."""
    return (
        f"CASE WHEN regexp_matches({c}, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$') "
        f"THEN TRY_CAST(trim({c}) AS DOUBLE) END"
    )


def case_of(c: str, table: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v) if isinstance(v, str) else v}" for k, v in table.items())
    return f"CASE {c} {whens} ELSE {default} END"


def condition(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '%<%' THEN 'Below Reporting Limit' "
        f"WHEN {c} LIKE '%>%' THEN 'Above Reporting Limit' END"
    )


def limit_type(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '%<%' THEN 'Lower Reporting Limit' "
        f"WHEN {c} LIKE '%>%' THEN 'Upper Reporting Limit' END"
    )


def censored_value(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '%<%' OR {c} LIKE '%>%' THEN NULL "
        f"WHEN {c} LIKE '%[%' THEN {number(f'split_part({c}, chr(32), 1)')} ELSE {number(c)} END"
    )


def date_time(d: str, t: str) -> str:
    """Start date and time from their texts."""
    day = f"left(trim({d}), 10)"
    clock = f"lpad(left(trim({t}), 5), 5, '0')"
    ok = (
        f"regexp_full_match({clock}, '[0-9][0-9].[0-9][0-9]') "
        f"AND TRY_CAST({clock}[1:2] AS INT) < 24 AND TRY_CAST({clock}[4:5] AS INT) < 60"
    )
    return (
        f"TRY_CAST(try_strptime({day} || ' ' || CASE WHEN {ok} THEN {clock}[1:2] || ':' || {clock}[4:5] "
        f"ELSE '00:00' END, '%Y-%m-%d %H:%M') AS TIMESTAMP)"
    )


def nutrient(name: str, unit: str) -> str:
    """Number of the nutrient rule a name and unit fall under."""
    p, u = f"lower(trim({name}))", f"lower(trim({unit}))"
    return (
        f"CASE WHEN {p}='nitrate' AND {u}='mg/l as n' THEN 1 WHEN {p}='nitrite' AND {u}='mg/l as n' THEN 2 "
        f"WHEN {p} IN ('ammonia-nitrogen','ammonia-nitrogen as n','ammonia and ammonium') THEN 3 "
        f"WHEN {p}='ammonium' AND {u}='mg/l as n' THEN 3 WHEN {p}='sulfate as s' THEN 4 "
        f"WHEN {p} IN ('phosphate-phosphorus','phosphate-phosphorus as p','orthophosphate as p') THEN 5 "
        f"WHEN {p} IN ('phosphate','orthophosphate') AND {u}='mg/l as p' THEN 6 END"
    )


NUTRIENT_NAME = "CASE {r} WHEN 1 THEN 'Nitrate' WHEN 2 THEN 'Nitrite' WHEN 3 THEN 'Ammonium' WHEN 4 THEN 'Sulfate' WHEN 5 THEN 'Phosphate' WHEN 6 THEN 'Phosphate' ELSE {n} END"
NUTRIENT_FORM = "CASE WHEN {r} IN (1,2,3,5) THEN 'as N' WHEN {r}=4 THEN 'as S' WHEN {r}=6 THEN 'as P' END"
NUTRIENT_FACTOR = "CASE {r} WHEN 1 THEN 4.427::DOUBLE WHEN 2 THEN 3.285::DOUBLE WHEN 3 THEN 1.288::DOUBLE WHEN 4 THEN 2.996::DOUBLE ELSE 3.066::DOUBLE END"


def state_name(c: str) -> str:
    head = f"split_part(trim({c}), ' as ', 1)"
    return (
        f"CASE WHEN trim({head})='Alkalinity' THEN 'Alkalinity, total' "
        f"WHEN trim({c})='Total Phosphate' THEN 'Orthophosphate' ELSE {head} END"
    )


def state_form(c: str) -> str:
    return (
        f"CASE WHEN trim({c})='Total Phosphate' THEN 'as PO4' WHEN trim({c}) NOT LIKE '% as %' OR {c} IS NULL THEN NULL "
        f"ELSE CASE split_part(trim({c}), ' as ', 2) WHEN 'Calcium Carbonate' THEN 'as CaCO3' WHEN 'Carbonate' THEN 'as CO3' "
        f"WHEN 'Nitrogen' THEN 'as N' ELSE split_part(trim({c}), ' as ', 2) END END"
    )


def clean_method(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '%EPA%' THEN list_extract(string_split({c}, ' '), 2) "
        f"WHEN {c} LIKE '%/%' THEN split_part({c}, '/', 1) ELSE {c} END"
    )


def epa_name(c: str) -> str:
    return case_of(c, {k: v[0] for k, v in vocab.EPA_SPECIES.items()}, c)


def epa_form(c: str) -> str:
    return case_of(c, {k: v[1] for k, v in vocab.EPA_SPECIES.items()})


def rules_table(corrected: bool = False) -> str:
    rows = []
    for i, (pattern, station) in enumerate(vocab.STATION_RULES):
        if corrected:
            pattern = "|".join(p for p in pattern.split("|") if p)
        rows.append(f"({i}, {quote('(?i)' + pattern + '|' + station)}, {quote(station)})")
    return "(VALUES " + ", ".join(rows) + ") AS r(ord, pattern, station)"


def quantile(p: str) -> str:
    """Standard normal quantile (AS 241) of a column ``p`` in (0, 1)."""

    def poly(coefficients, x):
        text = f"{coefficients[-1]!r}::DOUBLE"
        for k in reversed(coefficients[:-1]):
            text = f"({text} * {x} + {k!r}::DOUBLE)"
        return text

    def ratio(pair, x):
        return f"({poly(pair[0], x)} / {poly(pair[1], x)})"

    q = f"({p} - 0.5::DOUBLE)"
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"CASE WHEN {r} <= 5 THEN {ratio(normal.MIDDLE, f'({r} - 1.6::DOUBLE)')} ELSE {ratio(normal.TAIL, f'({r} - 5)')} END"
    return (
        f"CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL "
        f"WHEN abs{q} <= 0.425 THEN {q} * {ratio(normal.CENTRAL, f'(0.180625::DOUBLE - {q} * {q})')} "
        f"WHEN {q} < 0 THEN -({tail}) ELSE {tail} END"
    )
