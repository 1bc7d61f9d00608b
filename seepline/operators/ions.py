"""Ion chemistry: equivalents, balance, water type, Piper and Stiff coordinates.

Everything is a projection; a plan over these operators has no shuffle. Steps are
separate projections so that shared terms are computed once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import colors
from seepline.functions.surface import field_patch, height_column

_H = 0.5 * math.tan(math.pi / 3)
_OFF = vocab.PIPER_OFFSET
_OFF_Y = _OFF * math.tan(math.pi / 3)
_X0 = 0.5
_Y0 = _X0 * math.tan(math.pi / 6)
# left end of the anion triangle
_RIGHT = 1 + 2 * _OFF
# saturation surfaces, with corners in order around the centre
_TRIANGLE = field_patch([(0.0, 0.0), (_X0, _H), (1.0, 0.0)], (_X0, _Y0))
_DIAMOND = field_patch([(-_X0, 0.0), (0.0, _H), (_X0, 0.0), (0.0, -_H)], (0.0, 0.0))


def fill_ions(df: DataFrame) -> DataFrame:
    """The nine ion columns, 0 where a value or the whole column is missing."""
    have = {c.lower(): c for c in df.columns}
    filled = {}
    for ion in vocab.ION_COLUMNS:
        column = have.get(ion.lower())
        if column is None:
            filled[ion] = F.lit(0.0)
        else:
            value = F.col(column).cast("double")
            filled[ion] = F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)
    return df.withColumns(filled)


def ion_meq(df: DataFrame) -> DataFrame:
    """mg/L to meq/L as ``<ion>_meq``."""
    return df.withColumns({f"{i}_meq": F.col(i) * F.lit(vocab.MEQ_FACTORS[i]) for i in vocab.ION_COLUMNS})


def nak_meq(df: DataFrame) -> DataFrame:
    """Sodium plus potassium: as reported when sodium is missing, else the sum of both."""
    na, k, nak = F.col("Na_meq"), F.col("K_meq"), F.col("NaK_meq")
    return df.withColumn("NaK_meq", F.when((na == 0) & (nak > 0), nak).otherwise(na + k))


def _sum(ions: list[str]) -> Column:
    total = F.col(f"{ions[0]}_meq")
    for ion in ions[1:]:
        total = total + F.col(f"{ion}_meq")
    return total


def charge_balance(df: DataFrame, corrected: bool = False) -> DataFrame:
    """Sums and balance. The sum of cations holds Na, K and NaK, as in existing records;
    ``corrected`` counts sodium and potassium once."""
    cations = ["Ca", "Mg", "NaK"] if corrected else vocab.CATIONS
    return (
        df.withColumns({"anions": _sum(vocab.ANIONS), "cations": _sum(cations)})
        .withColumns({"total_ions": F.col("cations") + F.col("anions"), "EC": F.col("anions") - F.col("cations")})
        .withColumn("CBE", F.try_divide(F.col("EC"), F.col("total_ions")))
    )


def _largest(ions: list[str]) -> Column:
    top = F.greatest(*[F.col(f"{i}_meq") for i in ions])
    return F.coalesce(*[F.when(F.col(f"{i}_meq") == top, i) for i in ions])


def water_type(df: DataFrame) -> DataFrame:
    """Largest cation and anion, such as ``Ca-HCO3``; the first in search order wins a tie."""
    return df.withColumns(
        {"maj_cation": _largest(vocab.CATION_SEARCH), "maj_anion": _largest(vocab.ANION_SEARCH)}
    ).withColumn("water_type", F.concat_ws("-", "maj_cation", "maj_anion"))


def ion_percent(df: DataFrame) -> DataFrame:
    """Share of each ion in the sum of its kind, in percent, and sulfate plus chloride."""
    shares = {
        f"{i}EC": F.try_divide(F.lit(100.0) * F.col(f"{i}_meq"), F.col(total))
        for total, ions in (("anions", vocab.ANIONS), ("cations", vocab.CATIONS))
        for i in ions
    }
    return df.withColumns(shares).withColumn("SO4ClEC", F.col("ClEC") + F.col("SO4EC"))


def balance(df: DataFrame, corrected: bool = False) -> DataFrame:
    """The whole chain from ion concentrations to percentages."""
    return ion_percent(water_type(charge_balance(nak_meq(ion_meq(fill_ions(df))), corrected)))


# --- Piper diagram -----------------------------------------------------------


def piper_fractions(df: DataFrame) -> DataFrame:
    """Fractions of the cation (Ca, Mg, NaK) and anion (HCO3 + CO3, SO4, Cl) equivalents.

    Samples that lack one of the eight ions are left out.
    """
    rows = df.dropna(how="any", subset=vocab.PIPER_IONS)
    eq = {
        f"_{i}": F.col(i) / F.lit(vocab.PIPER_GMOL[i]) * F.lit(vocab.PIPER_CHARGE[i])
        for i in vocab.PIPER_IONS
    }
    e = {i: F.col(f"_{i}") for i in vocab.PIPER_IONS}
    return (
        rows.withColumns(eq)
        .withColumns(
            {
                "_cat": e["Ca"] + e["Mg"] + e["Na"] + e["K"],
                "_an": e["HCO3"] + e["CO3"] + e["Cl"] + e["SO4"],
            }
        )
        .withColumns(
            {
                "cat_ca": F.try_divide(e["Ca"], F.col("_cat")),
                "cat_mg": F.try_divide(e["Mg"], F.col("_cat")),
                "cat_nak": F.try_divide(e["Na"] + e["K"], F.col("_cat")),
                "an_hco3": F.try_divide(e["HCO3"] + e["CO3"], F.col("_an")),
                "an_so4": F.try_divide(e["SO4"], F.col("_an")),
                "an_cl": F.try_divide(e["Cl"], F.col("_an")),
            }
        )
        .drop(*eq, "_cat", "_an")
    )


def piper_xy(df: DataFrame) -> DataFrame:
    """Positions in the cation triangle, the anion triangle and the diamond."""
    cx, cy, ax, ay = F.col("cat_x"), F.col("cat_y"), F.col("an_x"), F.col("an_y")
    return df.withColumns(
        {
            "cat_x": 0.5 * (2 * F.col("cat_nak") + F.col("cat_mg")),
            "cat_y": F.lit(_H) * F.col("cat_mg"),
            "an_x": F.lit(_RIGHT) + 0.5 * (2 * F.col("an_cl") + F.col("an_so4")),
            "an_y": F.lit(_H) * F.col("an_so4"),
        }
    ).withColumns(
        {
            "d_x": ay / F.lit(4 * _H) + 0.5 * ax - cy / F.lit(4 * _H) + 0.5 * cx,
            "d_y": 0.5 * ay + F.lit(_H) * ax + 0.5 * cy - F.lit(_H) * cx,
        }
    )


def piper_hue(df: DataFrame) -> DataFrame:
    """Angle around the centre of each field; in the triangles turned by 30 degrees."""

    def angle(x: str, y: str, x0: float, y0: float) -> Column:
        return F.lit(math.pi) + F.atan2(F.col(y) - F.lit(y0), F.col(x) - F.lit(x0))

    def turned(c: Column) -> Column:
        return F.pmod(c - F.lit(math.pi / 6), F.lit(2 * math.pi))

    return df.withColumns(
        {
            "hue_cat": turned(angle("cat_x", "cat_y", _X0, _Y0)),
            "hue_an": turned(angle("an_x", "an_y", _X0 + _RIGHT, _Y0)),
            "hue_d": angle("d_x", "d_y", 1 + _OFF, _H + _OFF_Y),
        }
    )


def piper_color(df: DataFrame) -> DataFrame:
    """Red, green and blue (0..1) of each sample in the three fields.

    Saturation is the square root of a smooth cubic surface that is 0 at the centre of a
    field and 1 at its corners. A point is placed in the triangle of the centre and its two
    nearest corners by that triangle's barycentric coordinates.
    """
    one = F.lit(1.0)
    dx, dy = F.col("d_x") - F.lit(1 + _OFF), F.col("d_y") - F.lit(_H + _OFF_Y)
    place = {}
    for field, parts in (("cat", ("cat_ca", "cat_mg", "cat_nak")), ("an", ("an_hco3", "an_so4", "an_cl"))):
        low, high = F.least(*parts), F.greatest(*parts)
        place |= {f"_b1_{field}": high - low, f"_b2_{field}": one - high - 2 * low, f"_b3_{field}": 3 * low}
    across, up = F.abs(dx) / F.lit(_X0), F.abs(dy) / F.lit(_H)
    place |= {"_b1_d": across, "_b2_d": up, "_b3_d": one - across - up}
    surface = {
        f: height_column(patch, [F.col(f"_b{i}_{f}") for i in (1, 2, 3)])
        for f, patch in (("cat", _TRIANGLE), ("an", _TRIANGLE), ("d", _DIAMOND))
    }
    df = df.withColumns(place)
    turn = {f"_sixth_{f}": F.coalesce(F.col(f"hue_{f}") / F.lit(math.pi / 3), F.lit(0.0)) for f in surface}
    shade = {f"sat_{f}": F.sqrt(F.greatest(x, F.lit(0.0))) for f, x in surface.items()}
    painted = df
    for name, shown in shade.items():
        painted = painted.withColumn(name, shown)
    painted = painted.drop(*place).withColumns(turn).withColumns(
        {f"_out_{f}": colors.outside_turn(F.col(f"_sixth_{f}")) for f in surface}
    )
    for f in surface:
        painted = painted.withColumns(
            {
                f"{f}_{x}": colors.hsv_channel(F.col(f"_sixth_{f}"), F.col(f"_out_{f}"), F.col(f"sat_{f}"), one, x)
                for x in "rgb"
            }
        )
    return painted.drop(*turn, *[f"_out_{f}" for f in surface])


def piper(df: DataFrame, color: bool = False) -> DataFrame:
    placed = piper_xy(piper_fractions(df))
    return piper_color(piper_hue(placed)) if color else placed


def piper_groups(df: DataFrame, group_col: str) -> DataFrame:
    """Piper positions with the group each sample is drawn with."""
    return piper(df).withColumn("label", F.coalesce(F.col(group_col).cast("string"), F.lit("data")))


# --- Stiff diagram -----------------------------------------------------------


def stiff_polygon(df: DataFrame) -> DataFrame:
    """Outline, marker and colour of each sample's Stiff diagram.

    Expects ``<ion>_meq`` columns. The marker shows nitrate at height 1 when the table has
    a column NO3, else the calcite index at height 2 when it has a column CaCO3.
    """
    corners = [-F.col("NaK_meq"), -F.col("Ca_meq"), -F.col("Mg_meq"), F.col("SO4_meq"),
               F.col("HCO3_meq"), F.col("Cl_meq"), -F.col("NaK_meq")]
    outline = F.array(
        *[F.struct(x.alias("x"), F.lit(y).alias("y")) for x, y in zip(corners, vocab.STIFF_HEIGHTS)]
    )
    have = {c.lower() for c in df.columns}
    if "no3" in have:
        mark, height = 5.0 * F.col("NO3"), F.lit(1)
    elif "caco3" in have:
        mark, height = 2.0 * F.col("CaCO3"), F.lit(2)
    else:
        mark, height = F.lit(None).cast("double"), F.lit(None).cast("int")
    color = F.lit(None).cast("string")
    if "watertype" in have:
        color = F.try_element_at(
            F.create_map(*[F.lit(x) for kv in vocab.STIFF_COLORS.items() for x in kv]), F.col("watertype").cast("int")
        )
    return df.withColumns({"outline": outline, "marker_x": mark, "marker_y": height, "fill": color})


def stiff_points(df: DataFrame) -> DataFrame:
    """One row per corner of the outline."""
    rest = [c for c in df.columns if c != "outline"]
    return df.select(*rest, F.posexplode("outline").alias("corner", "_point")).select(
        *rest, "corner", F.col("_point.x").alias("x"), F.col("_point.y").alias("y")
    )
