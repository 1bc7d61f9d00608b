"""Ion chemistry over whole tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from seepline import vocab
from seepline.operators import ions
from suite import patches
from suite.base import query

c = F.col
P = 9  # places compared

_H, _O = 0.5 * math.tan(math.pi / 3), vocab.PIPER_OFFSET
_OY = _O * math.tan(math.pi / 3)
_D = "::DOUBLE"


def _r(names):
    return ", ".join(f'round({n}, {P}) AS "{n}"' for n in names)


def _show(df, names, *ids):
    return df.select(*ids, *[F.round(n, P).alias(n) for n in names])


_BASE = "base AS (SELECT sampleid, monitoringlocationid, Ca, Mg, Na, K, HCO3, CO3, Cl, coalesce(SO4, 0) AS SO4, 0::DOUBLE AS NaK FROM wq_majors)"
_MEQ = "meq AS (SELECT *, " + ", ".join(f"{i}*{vocab.MEQ_FACTORS[i]!r}{_D} AS {i}_q" for i in vocab.ION_COLUMNS) + " FROM base)"
_NAK = "nak AS (SELECT * REPLACE (CASE WHEN Na_q=0 AND NaK_q>0 THEN NaK_q ELSE Na_q+K_q END AS NaK_q) FROM meq)"
_BAL = "bal AS (SELECT *, Cl_q+HCO3_q+CO3_q+SO4_q AS anions, Na_q+K_q+Ca_q+Mg_q+NaK_q AS cations, Ca_q+Mg_q+NaK_q AS cations_once FROM nak)"


def ions_in(t):
    return t.majors.select("sampleid", "monitoringlocationid", *vocab.PIPER_IONS)


query("fill_ions", f"WITH {_BASE} SELECT * FROM base")(lambda t: ions.fill_ions(ions_in(t)))
query("ion_meq", f"WITH {_BASE}, {_MEQ} SELECT sampleid, " + ", ".join(f'round({i}_q, {P}) AS "{i}_meq"' for i in vocab.ION_COLUMNS) + " FROM meq")(
    lambda t: _show(ions.ion_meq(ions.fill_ions(ions_in(t))), [f"{i}_meq" for i in vocab.ION_COLUMNS], "sampleid")
)


def _with_nak(t):
    """Every third sample reports sodium and potassium together."""
    rows = ions.fill_ions(ions_in(t))
    joint = c("K") > 6
    return rows.withColumns({"NaK": F.when(joint, c("Na") + c("K")).otherwise(0.0), "Na": F.when(joint, 0.0).otherwise(c("Na"))})


query("nak_meq", f"""WITH {_BASE}, two AS (SELECT sampleid, K, CASE WHEN K>6 THEN 0 ELSE Na END AS Na, CASE WHEN K>6 THEN Na+K ELSE 0 END AS NaK FROM base)
 SELECT sampleid, round(CASE WHEN Na=0 AND NaK>0 THEN NaK*0.043497608{_D} ELSE Na*0.043497608{_D}+K*0.02557656{_D} END, {P}) AS "NaK_meq" FROM two""")(
    lambda t: _show(ions.nak_meq(ions.ion_meq(_with_nak(t))), ["NaK_meq"], "sampleid")
)


def _balance_sql(cations: str) -> str:
    return f"""WITH {_BASE}, {_MEQ}, {_NAK}, {_BAL} SELECT sampleid, round(anions, {P}) AS anions, round({cations}, {P}) AS cations, round(anions+{cations}, {P}) AS total_ions,
    round(anions-{cations}, {P}) AS "EC", round((anions-{cations})/(anions+{cations}), {P}) AS "CBE" FROM bal"""


def _balanced(t, corrected):
    df = ions.charge_balance(ions.nak_meq(ions.ion_meq(ions.fill_ions(ions_in(t)))), corrected)
    return _show(df, ["anions", "cations", "total_ions", "EC", "CBE"], "sampleid")


query("charge_balance", _balance_sql("cations"))(lambda t: _balanced(t, False))
query("charge_balance_corrected", _balance_sql("cations_once"))(lambda t: _balanced(t, True))


def _largest_sql(names):
    return "CASE greatest(" + ", ".join(f"{n}_q" for n in names) + ") " + " ".join(f"WHEN {n}_q THEN '{n}'" for n in names) + " END"


query("water_type", f"""WITH {_BASE}, {_MEQ}, {_NAK}, big AS (SELECT sampleid, {_largest_sql(vocab.CATION_SEARCH)} AS maj_cation, {_largest_sql(vocab.ANION_SEARCH)} AS maj_anion FROM nak)
 SELECT *, maj_cation || '-' || maj_anion AS water_type FROM big""")(
    lambda t: ions.water_type(ions.nak_meq(ions.ion_meq(ions.fill_ions(ions_in(t))))).select("sampleid", "maj_cation", "maj_anion", "water_type")
)
_EC = [f"{i}EC" for i in vocab.ANIONS + vocab.CATIONS] + ["SO4ClEC"]
query("ion_percent", f"WITH {_BASE}, {_MEQ}, {_NAK}, {_BAL} SELECT sampleid, " + ", ".join(
    [f'round(100*{i}_q/anions, {P}) AS "{i}EC"' for i in vocab.ANIONS] + [f'round(100*{i}_q/cations, {P}) AS "{i}EC"' for i in vocab.CATIONS]
) + f', round(100*Cl_q/anions+100*SO4_q/anions, {P}) AS "SO4ClEC" FROM bal')(
    lambda t: _show(ions.balance(ions_in(t)), _EC, "sampleid")
)

_G = {i: f"({i}/{vocab.PIPER_GMOL[i]!r}{_D}*{vocab.PIPER_CHARGE[i]!r}{_D})" for i in vocab.PIPER_IONS}
_CAT, _AN = "+".join(_G[i] for i in ("Ca", "Mg", "Na", "K")), "+".join(_G[i] for i in ("HCO3", "CO3", "Cl", "SO4"))
_FRAC = f"""frac AS (SELECT sampleid, monitoringlocationid, {_G['Ca']}/({_CAT}) AS cat_ca, {_G['Mg']}/({_CAT}) AS cat_mg, ({_G['Na']}+{_G['K']})/({_CAT}) AS cat_nak,
 ({_G['HCO3']}+{_G['CO3']})/({_AN}) AS an_hco3, {_G['SO4']}/({_AN}) AS an_so4, {_G['Cl']}/({_AN}) AS an_cl FROM wq_majors WHERE SO4 IS NOT NULL)"""
_XY = f"""tri AS (SELECT *, 0.5{_D}*(2*cat_nak+cat_mg) AS cat_x, {_H!r}{_D}*cat_mg AS cat_y, {1 + 2 * _O!r}{_D}+0.5{_D}*(2*an_cl+an_so4) AS an_x, {_H!r}{_D}*an_so4 AS an_y FROM frac),
 xy AS (SELECT *, an_y/{4 * _H!r}{_D}+0.5{_D}*an_x-cat_y/{4 * _H!r}{_D}+0.5{_D}*cat_x AS d_x, 0.5{_D}*an_y+{_H!r}{_D}*an_x+0.5{_D}*cat_y-{_H!r}{_D}*cat_x AS d_y FROM tri)"""
_X0, _Y0, _R = 0.5, 0.5 * math.tan(math.pi / 6), 1 + 2 * _O


def _wrap(angle):
    return f"(CASE WHEN {angle} - pi()/6 < 0 THEN {angle} - pi()/6 + 2*pi() ELSE {angle} - pi()/6 END)"


_HUE = f"""hue AS (SELECT *, {_wrap(f'(pi()+atan2(cat_y-{_Y0!r}{_D}, cat_x-{_X0!r}{_D}))')} AS hue_cat, {_wrap(f'(pi()+atan2(an_y-{_Y0!r}{_D}, an_x-{_X0 + _R!r}{_D}))')} AS hue_an,
 pi()+atan2(d_y-{_H + _OY!r}{_D}, d_x-{1 + _O!r}{_D}) AS hue_d FROM xy)"""
_FRACS = ["cat_ca", "cat_mg", "cat_nak", "an_hco3", "an_so4", "an_cl"]
_POINTS = ["cat_x", "cat_y", "an_x", "an_y", "d_x", "d_y"]

query("piper_fractions", f"WITH {_FRAC} SELECT sampleid, {_r(_FRACS)} FROM frac")(lambda t: _show(ions.piper_fractions(ions_in(t)), _FRACS, "sampleid"))
query("piper_xy", f"WITH {_FRAC}, {_XY} SELECT sampleid, {_r(_POINTS)} FROM xy")(lambda t: _show(ions.piper(ions_in(t)), _POINTS, "sampleid"))
query("piper_hue", f"WITH {_FRAC}, {_XY}, {_HUE} SELECT sampleid, {_r(['hue_cat', 'hue_an', 'hue_d'])} FROM hue")(
    lambda t: _show(ions.piper_hue(ions.piper(ions_in(t))), ["hue_cat", "hue_an", "hue_d"], "sampleid")
)


def _channel(field: str, full: str, part: str) -> str:
    k, s = f"floor(hue_{field}/(pi()/3))", f"s_{field}"
    x = f"{s}*(1-abs((hue_{field}/(pi()/3)) % 2 - 1))"
    return f"(1-{s} + CASE WHEN {k} IN ({full}) THEN {s} WHEN {k} IN ({part}) THEN {x} ELSE 0 END)"


_RGB = [f"{f}_{x}" for f in ("cat", "an", "d") for x in "rgb"]
_CHANNELS = {"r": ("0,5", "1,4"), "g": ("1,2", "0,3"), "b": ("3,4", "2,5")}
_SAT_B = {
    "cat": ("greatest(cat_ca,cat_mg,cat_nak)-least(cat_ca,cat_mg,cat_nak)", "1-greatest(cat_ca,cat_mg,cat_nak)-2*least(cat_ca,cat_mg,cat_nak)"),
    "an": ("greatest(an_hco3,an_so4,an_cl)-least(an_hco3,an_so4,an_cl)", "1-greatest(an_hco3,an_so4,an_cl)-2*least(an_hco3,an_so4,an_cl)"),
    "d": (f"abs(d_x-{1 + _O!r}{_D})/0.5{_D}", f"abs(d_y-{_H + _OY!r}{_D})/{_H!r}{_D}"),
}
_PATCHES = {
    "cat": patches.field([(0.0, 0.0), (0.5, _H), (1.0, 0.0)], (0.5, _H / 3)), "an": patches.field([(0.0, 0.0), (0.5, _H), (1.0, 0.0)], (0.5, _H / 3)),
    "d": patches.field([(-0.5, 0.0), (0.0, _H), (0.5, 0.0), (0.0, -_H)], (0.0, 0.0)),
}
query("piper_color", f"""WITH {_FRAC}, {_XY}, {_HUE}, bary AS (SELECT *, {', '.join(f'{x} AS {f}_b{i}' for f, pair in _SAT_B.items() for i, x in enumerate(pair, 1))} FROM hue),
 sat AS (SELECT *, {', '.join(f'sqrt(greatest(0, {patches.sql(_PATCHES[f], f"{f}_b1", f"{f}_b2")})) AS s_{f}' for f in _SAT_B)} FROM bary)
 SELECT sampleid, {', '.join(f'round({_channel(f, *_CHANNELS[x])}, 6) AS {f}_{x}' for f in ('cat', 'an', 'd') for x in 'rgb')} FROM sat""")(
    lambda t: ions.piper(ions_in(t), color=True).select("sampleid", *[F.round(n, 6).alias(n) for n in _RGB])
)
query("piper_groups", f"WITH {_FRAC}, {_XY} SELECT sampleid, monitoringlocationid AS label, {_r(_POINTS)} FROM xy")(
    lambda t: _show(ions.piper_groups(ions_in(t), "monitoringlocationid"), _POINTS, "sampleid", "label")
)
_CORNERS = [("-NaK_q", 3), ("-Ca_q", 2), ("-Mg_q", 1), ("SO4_q", 1), ("HCO3_q", 2), ("Cl_q", 3), ("-NaK_q", 3)]
query("stiff_polygon", f"""WITH {_BASE}, {_MEQ}, {_NAK} """ + " UNION ALL ".join(
    f"SELECT sampleid, {i} AS corner, round({x}, {P}) AS x, {y} AS y, CASE CAST(K AS INT) WHEN 1 THEN 'r' WHEN 2 THEN 'b' WHEN 3 THEN 'c' WHEN 4 THEN 'g' WHEN 5 THEN 'm' END AS fill, round(5*CO3/10, {P}) AS marker_x, 1 AS marker_y FROM nak"
    for i, (x, y) in enumerate(_CORNERS)
))(
    lambda t: ions.stiff_points(
        ions.stiff_polygon(
            ions.nak_meq(ions.ion_meq(ions.fill_ions(ions_in(t)))).withColumns({"watertype": c("K").cast("int"), "NO3": c("CO3") / 10.0})
        )
    ).select("sampleid", "corner", F.round("x", P).alias("x"), "y", "fill", F.round("marker_x", P).alias("marker_x"), "marker_y")
)
