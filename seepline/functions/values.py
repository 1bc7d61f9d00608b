"""Numbers, censor marks, units and dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from seepline import vocab

_BLANKS = " \t\n\r\x0b\x0c"
_NUMERIC = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(_BLANKS))


def map_literal(table: Mapping) -> Column:
    """A small table as a constant map; the optimizer folds it to one literal."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def lookup(c: Column, table: Mapping) -> Column:
    """Value of ``c`` in ``table``, NULL when absent."""
    return F.try_element_at(map_literal(table), c)


def translate_or_keep(c: Column, table: Mapping) -> Column:
    return F.coalesce(lookup(c, table), c)


def parse_number(c: Column) -> Column:
    """Text to double. What is not a plain number is NULL ('1.5d' and 'nan' are not)."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMERIC), text.try_cast("double"))


def split_censored(c: Column) -> Column:
    """struct(value, condition, limit_type) of a laboratory result such as ``<0.5``."""
    text = c.cast("string")
    below, above, noted = text.contains("<"), text.contains(">"), text.contains("[")
    return F.struct(
        F.when(below | above, None)
        .when(noted, parse_number(F.substring_index(text, " ", 1)))
        .otherwise(parse_number(text))
        .alias("value"),
        F.when(below, "Below Reporting Limit").when(above, "Above Reporting Limit").alias("condition"),
        F.when(below, "Lower Reporting Limit").when(above, "Upper Reporting Limit").alias("limit_type"),
    )


def result_qualifier(condition: Column, qualifier: Column) -> Column:
    return F.coalesce(qualifier, F.when(condition == "Below Reporting Limit", "BRL"))


def state_detection(problem: Column, code: Column) -> Column:
    return (
        F.when(problem == "<", "Below Reporting Limit")
        .when(problem == ">", "Above Operating Range")
        .when(problem.isNull() & (code == "U"), "Not Detected")
    )


def clean_method(c: Column) -> Column:
    """Method number: second word of an EPA name, else what precedes a slash."""
    return (
        F.when(c.contains("EPA"), F.get(F.split(c, " "), F.lit(1)))
        .when(c.contains("/"), F.substring_index(c, "/", 1))
        .otherwise(c)
    )


def method_context(agency: Column) -> Column:
    return F.when(agency == "SM", "APHA").otherwise("USEPA")


def state_sample_fraction(matrix: Column) -> Column:
    return F.when(strip(matrix) == "Water, Filtered", "Dissolved").otherwise("Total")


def epa_sample_fraction(analysis_class: Column, corrected: bool = False) -> Column:
    """'Total' for every row; ``corrected`` limits that to classes that contain WET."""
    if not corrected:
        return F.lit("Total")
    return F.when(analysis_class.contains("WET"), "Total").otherwise(analysis_class)


def normalize_lab_unit(unit: Column, lab: str) -> Column:
    return translate_or_keep(unit, {"epa": vocab.EPA_UNITS, "state": vocab.STATE_UNITS}[lab])


def ugl_to_mgl(value: Column, unit: Column) -> Column:
    return F.when(F.lower(rstrip(unit)) == "ug/l", value / F.lit(1000.0)).otherwise(value)


def unit_label(unit: Column) -> Column:
    return F.when(F.lower(unit).isin("ug/l", "mg/l"), "mg/l").otherwise(unit)


def fix_datetime(date: Column, time: Column) -> Column:
    """Start date and time as timestamp without zone.

    The time is read from its first five characters, padded on the left; what cannot be
    an hour and minute counts as midnight. What cannot be a date is NULL.
    """
    d = F.left(strip(date.cast("string")), F.lit(10))
    t = F.lpad(F.left(strip(time.cast("string")), F.lit(5)), 5, "0")
    hour, minute = F.substring(t, 1, 2), F.substring(t, 4, 2)
    usable = (
        hour.rlike("^[0-9]{2}$")
        & minute.rlike("^[0-9]{2}$")
        & (hour.try_cast("int") <= 23)
        & (minute.try_cast("int") <= 59)
    )
    clock = F.when(usable, F.concat_ws(":", hour, minute)).otherwise("00:00")
    return F.when(
        d.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
        F.concat(d, F.lit(" "), clock, F.lit(":00")).try_cast("timestamp_ntz"),
    )


def sample_date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def sample_time_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def date_before_blank(c: Column) -> Column:
    """Date in front of the first blank of ``2019-03-04 00:00:00``; bad text is NULL."""
    return F.substring_index(c.cast("string"), " ", 1).try_cast("date")


def vertical_measure(c: Column) -> Column:
    """Elevation to one place, half to even; 0 stands for unknown."""
    return round_half_even(F.nullif(c, F.lit(0.0)), 1)


def round_half_even(c: Column, places: int) -> Column:
    """Round the exact binary value of a double, ties to even.

    ``bround`` works on the shortest decimal text, so 0.35 (in binary slightly below)
    becomes 0.4 there and 0.3 here. The product with 10**places is taken together with
    its rounding error, obtained by splitting the factor's operand in two halves.
    """
    scale = F.lit(float(10**places))
    big = F.lit(134217729.0) * c
    high = big - (big - c)
    low = c - high
    product = c * scale
    error = (high * scale - product) + low * scale
    floor = F.floor(product).cast("double")
    tie = (product - floor) == 0.5
    whole = (
        F.when(tie & (error > 0), floor + 1)
        .when(tie & (error < 0), floor)
        .otherwise(F.rint(product))
    )
    return F.when(F.abs(c) >= F.lit(4503599627370496.0), c).otherwise(whole / scale)


def station_id_text(c: Column) -> Column:
    """Id read as a number, back to its digits."""
    return F.bround(c, 0).cast("decimal(20,0)").cast("string")


def key_part(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def unique_id(location: Column, activity: Column, characteristic: Column) -> Column:
    return F.concat_ws("-", key_part(location), key_part(activity), key_part(characteristic))


def result_id(activity: Column, characteristic: Column) -> Column:
    return F.concat_ws("-", key_part(activity), key_part(characteristic))


def strip_wqx(c: Column) -> Column:
    return F.replace(c, F.lit("_WQX-"), F.lit("-"))


def strip_org_prefix(c: Column, prefix: str = "UTAHGS-") -> Column:
    return F.replace(c, F.lit(prefix), F.lit(""))


def activity_type(activity: Column) -> Column:
    return F.when(activity.contains("-FM"), "Field Msr/Obs").otherwise("Sample-Routine")


def field_activity_id(activity: Column) -> Column:
    return F.concat(activity, F.lit("-FM"))


def distance_to_miles(value: Column, unit: Column) -> Column:
    return value * lookup(unit, vocab.MILES_PER_UNIT)


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # a point without coordinates has no distance: least() would pass over the NULL
    return F.lit(2 * vocab.EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.when(a > 1.0, 1.0).otherwise(a)))
