"""Summary of local results by location and characteristic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.functions import species, values
from seepline.operators import joins


def location_summary(results: DataFrame, activities: DataFrame) -> DataFrame:
    """Counts, censored counts and mean concentration of cleaned results.

    The aggregate is combined in the map tasks, so a location with a large share of the
    results sends one row per characteristic and task.
    """
    rows = results.withColumn("_parts", values.split_censored(F.col("resultvalue"))).withColumns(
        {"resultvalue": F.col("_parts.value"), "resultdetectioncondition": F.col("_parts.condition")}
    )
    rows = rows.withColumns(
        {
            "resultvalue": values.ugl_to_mgl(F.col("resultvalue"), F.col("resultunit")),
            "resultunit": values.unit_label(values.rstrip(F.col("resultunit"))),
        }
    )
    rows = rows.withColumn("_species", species.method_speciation(F.col("characteristicname"), F.col("resultunit")))
    rows = rows.withColumn("characteristicname", F.col("_species.name")).drop("_parts", "_species")
    below = F.col("resultdetectioncondition") == "Below Reporting Limit"
    return (
        joins.result_activity(rows, activities)
        .groupBy("monitoringlocationid", "characteristicname")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(below).alias("n_below"),
            F.count("activitystartdate").alias("n_dated"),
            F.round(F.avg("resultvalue"), 6).alias("mean_value"),
        )
    )
