"""Laboratory files to canonical rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import species, values
from seepline.operators import joins, projection


def epa_lab_job(sheet: DataFrame, domain: DataFrame, corrected: bool = False) -> DataFrame:
    """EPA laboratory sheet to canonical rows."""
    rows = projection.rename_epa_lab(sheet)
    rows = rows.withColumns(
        {
            "_parts": values.split_censored(F.col("resultvalue")),
            "_species": species.epa_speciation(F.col("characteristicname")),
            "resultsamplefraction": values.epa_sample_fraction(F.col("resultsamplefraction"), corrected),
            "resultanalyticalmethodid": values.clean_method(F.col("resultanalyticalmethodid")),
            "resultunit": values.normalize_lab_unit(F.col("resultunit"), "epa"),
            "monitoringlocationid": F.col("monitoringlocationid").cast("string"),
            "activitystartdate": F.col("Sampled").cast("date"),
            "activitystarttime": values.sample_time_text(F.col("Sampled")),
            "analysisstartdate": F.col("Analyzed").cast("date"),
        }
    )
    rows = rows.withColumns(
        {
            "resultvalue": F.col("_parts.value"),
            "resultdetectioncondition": F.col("_parts.condition"),
            "resultdetecquantlimittype": F.col("_parts.limit_type"),
            "resultqualifier": values.result_qualifier(F.col("_parts.condition"), F.col("resultqualifier")),
            "characteristicname": F.col("_species.name"),
            "methodspeciation": F.col("_species.speciation"),
            "resultid": values.result_id(F.col("activityid"), F.col("_species.name")),
            "resultdetecquantlimitunit": F.col("resultunit"),
            "resultanalyticalmethodcontext": F.lit("USEPA"),
            "projectid": F.lit("UNGWMN"),
            "inwqx": F.lit(0),
            "personnel": F.lit(None).cast("string"),
            "notes": F.lit(None).cast("string"),
        }
    ).drop("_parts", "_species")
    rows = joins.characteristic_group(rows, domain)
    return projection.drop_if_present(rows, vocab.EPA_UNUSED)


def state_lab_job(
    lab: DataFrame,
    domain: DataFrame,
    stations: DataFrame,
    matches: DataFrame | None = None,
    corrected: bool = False,
) -> DataFrame:
    """State laboratory rows to canonical rows.

    Stations come from the list of sample numbers when one is given, else from the
    description rules. ``stations`` needs ``locationid`` and ``qwnetworkname``.
    """
    # what gets shorter does so before the lookups move the rows, the rest after them
    rows = lab.withColumns(
        {
            "Matrix Description": values.state_sample_fraction(F.col("Matrix Description")),
            "Sample Date": values.date_before_blank(F.col("Sample Date")),
            "Analysis Date": values.date_before_blank(F.col("Analysis Date")),
            "Result Value": values.parse_number(F.col("Result Value")),
        }
    )
    if matches is not None:
        rows = joins.sample_station_lookup(rows, matches)
    else:
        rows = joins.match_stations(rows, corrected=corrected)
    rows = joins.project_code(rows, stations, "Station ID")
    rows = rows.withColumns(
        {
            "resultdetectioncondition": values.state_detection(F.col("Problem Identifier"), F.col("Result Code")),
            "Units": values.normalize_lab_unit(F.col("Units"), "state"),
            "Method Agency": values.method_context(F.col("Method Agency")),
            "_species": species.state_speciation(F.col("Param Description"), corrected),
        }
    )
    rows = projection.rename_state_lab(rows)
    rows = rows.withColumns(
        {
            "characteristicname": F.col("_species.name"),
            "methodspeciation": F.col("_species.speciation"),
            "resultid": values.result_id(F.col("activityid"), F.col("_species.name")),
            "resultdetecquantlimittype": F.lit("Lower Reporting Limit"),
            "resultdetecquantlimitunit": F.col("resultunit"),
            "resultvaluetype": F.lit("Actual"),
            "resultstatusid": F.lit("Final"),
            "inwqx": F.lit(0),
        }
    ).drop("_species")
    rows = joins.characteristic_group(rows, domain)
    return projection.drop_if_present(rows, vocab.STATE_UNUSED)


def database_rows(
    lab: DataFrame, activities: DataFrame, results: DataFrame, user: str, when: str
) -> dict[str, DataFrame]:
    """New activities and results of a laboratory table, stamped for insertion."""
    stamped = projection.stamp_audit(lab, user, when)
    return {
        "Activity": joins.new_activities(stamped, activities),
        "Result": joins.new_results(stamped, results),
    }
