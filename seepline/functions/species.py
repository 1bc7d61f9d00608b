"""Chemical names: speciation, symbols and species conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions.values import lookup, rstrip, strip


def _nutrient(name: Column, unit: Column) -> Column:
    """Which nutrient rule, if any, a (name, unit) pair falls under."""
    p, u = F.lower(strip(name)), F.lower(strip(unit))
    as_n = u == "mg/l as n"
    return (
        F.when((p == "nitrate") & as_n, "NO3-N")
        .when((p == "nitrite") & as_n, "NO2-N")
        .when(p.isin("ammonia-nitrogen", "ammonia-nitrogen as n", "ammonia and ammonium"), "NH4")
        .when((p == "ammonium") & as_n, "NH4")
        .when(p == "sulfate as s", "SO4-S")
        .when(p.isin("phosphate-phosphorus", "phosphate-phosphorus as p", "orthophosphate as p"), "PO4-P")
        .when(p.isin("phosphate", "orthophosphate") & (u == "mg/l as p"), "PO4-P unit")
    )


# nutrient rule -> reported name
_NAMES = {
    "NO3-N": "Nitrate", "NO2-N": "Nitrite", "NH4": "Ammonium", "SO4-S": "Sulfate",
    "PO4-P": "Phosphate", "PO4-P unit": "Phosphate",
}
_FORMS = {
    "NO3-N": "as N", "NO2-N": "as N", "NH4": "as N", "SO4-S": "as S",
    "PO4-P": "as N", "PO4-P unit": "as P",
}


def method_speciation(name: Column, unit: Column, corrected: bool = False) -> Column:
    """struct(name, speciation, unit).

    Phosphate phosphorus is labelled 'as N' by default, as in existing records;
    ``corrected`` labels it 'as P'.
    """
    rule = _nutrient(name, unit)
    forms = {**_FORMS, "PO4-P": "as P"} if corrected else _FORMS
    return F.struct(
        F.coalesce(lookup(rule, _NAMES), name).alias("name"),
        lookup(rule, forms).alias("speciation"),
        F.when(rule.isNotNull(), "mg/l").otherwise(unit).alias("unit"),
    )


def convert_species(name: Column, value: Column, unit: Column) -> Column:
    """struct(name, value, unit) with nutrients converted to the ion they stand for."""
    rule = _nutrient(name, unit)
    factors = {**vocab.SPECIES_FACTORS, "PO4-P unit": vocab.SPECIES_FACTORS["PO4-P"]}
    micro = F.lower(strip(unit)) == "ug/l"
    return F.struct(
        F.coalesce(lookup(rule, _NAMES), name).alias("name"),
        F.when(rule.isNotNull(), value * lookup(rule, factors))
        .when(micro, value / F.lit(1000.0))
        .otherwise(value)
        .alias("value"),
        F.when(rule.isNotNull() | micro, "mg/l").otherwise(rstrip(unit)).alias("unit"),
    )


def epa_speciation(name: Column) -> Column:
    """struct(name, speciation); a form that is not listed keeps its name."""
    formed = name.contains(" as")
    names = {k: v[0] for k, v in vocab.EPA_SPECIES.items()}
    forms = {k: v[1] for k, v in vocab.EPA_SPECIES.items()}
    return F.struct(
        F.when(formed, F.coalesce(lookup(name, names), name)).otherwise(name).alias("name"),
        F.when(formed, lookup(name, forms)).alias("speciation"),
    )


def state_speciation(parameter: Column, corrected: bool = False) -> Column:
    """struct(name, speciation) of a state laboratory parameter.

    Abbreviations stay as they are by default; ``corrected`` spells them out first.
    """
    text = strip(parameter)
    if corrected:
        text = F.coalesce(lookup(text, vocab.STATE_ABBREVIATIONS), text)
    parts = F.split(text, " as ")
    head, form = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    name = F.when(strip(head) == "Alkalinity", "Alkalinity, total").otherwise(head)
    bare_phosphate = (name == "Total Phosphate") & form.isNull()
    return F.struct(
        F.when(bare_phosphate, "Orthophosphate").otherwise(name).alias("name"),
        F.when(form == "Calcium Carbonate", "as CaCO3")
        .when(form == "Carbonate", "as CO3")
        .when(form == "Nitrogen", "as N")
        .when(bare_phosphate, "as PO4")
        .otherwise(form)
        .alias("speciation"),
    )


def param_abbrev(name: Column) -> Column:
    return F.coalesce(lookup(strip(name), vocab.PARAMETER_SYMBOLS), F.lit(""))
