"""Cleaning of portal extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import places, species, values
from seepline.operators import projection, reshape


def clean_results(df: DataFrame, corrected: bool = False, ordered: bool = False) -> DataFrame:
    """Canonical names, dates, numbers, units and species of a portal results extract.

    All steps are projections; nothing is shuffled unless ``ordered`` asks for a global order
    by location and date.
    """
    rows = projection.rename_result(df)
    rows = rows.withColumn("sampledate", values.fix_datetime(F.col("sampledate"), F.col("sampletime")))
    rows = projection.drop_if_present(rows, vocab.PORTAL_RESULT_UNUSED)
    rows = rows.withColumns(
        {
            "resultvalue": values.parse_number(F.col("resultvalue")),
            "detecquantlimitmeasure": values.parse_number(F.col("detecquantlimitmeasure")),
            "monitoringlocationid": values.strip_wqx(F.col("monitoringlocationid")),
        }
    )
    rows = projection.move_front(rows, ["sampledate", "sampleid", "monitoringlocationid"])
    rows = rows.withColumns(
        {
            "resultvalue": values.ugl_to_mgl(F.col("resultvalue"), F.col("resultunit")),
            "resultunit": values.unit_label(values.rstrip(F.col("resultunit"))),
        }
    )
    rows = rows.withColumn(
        "_species", species.method_speciation(F.col("characteristicname"), F.col("resultunit"), corrected)
    )
    rows = rows.withColumns(
        {
            "characteristicname": F.col("_species.name"),
            "methodspeciation": F.col("_species.speciation"),
            "resultunit": F.col("_species.unit"),
        }
    ).drop("_species")
    return reshape.sort_results(rows) if ordered else rows


def clean_stations(df: DataFrame) -> DataFrame:
    """Canonical names, types and elevations of a station extract, one row per station."""
    rows = projection.drop_if_present(projection.rename_station(df), vocab.PORTAL_STATION_UNUSED)
    rows = rows.withColumns(
        {
            "locationtype": places.station_type(F.col("locationtype")),
            "verticalmeasure": values.vertical_measure(F.col("verticalmeasure")),
        }
    )
    return reshape.dedupe_stations(rows)


def wide_samples(results: DataFrame, chems="") -> DataFrame:
    """Portal extract to one row per sample."""
    return reshape.pivot_samples(clean_results(results), chems)
