"""Numbers behind the station map and the plot legends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.functions import places
from seepline.operators.joins import _keys


def _mark_selected(stations: DataFrame, selected: DataFrame) -> DataFrame:
    chosen = _keys(selected, "locationid")
    return (
        stations.join(chosen, stations["locationid"] == chosen["_key"], "left")
        .withColumn("selected", F.col("_key").isNotNull())
        .drop("_key")
    )


def station_extent(stations: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """Centre of all stations; corners of the selection if there is any, else of all."""
    if selected is None:
        marked = stations.withColumn("selected", F.lit(False))
    else:
        marked = _mark_selected(stations, selected)
    chosen = F.col("selected")

    def corner(pick, c: str):
        return F.coalesce(pick(F.when(chosen, F.col(c))), pick(F.col(c)))

    return marked.agg(
        F.avg("latitude").alias("center_lat"),
        F.avg("longitude").alias("center_lon"),
        corner(F.min, "latitude").alias("south"),
        corner(F.min, "longitude").alias("west"),
        corner(F.max, "latitude").alias("north"),
        corner(F.max, "longitude").alias("east"),
    )


def station_markers(stations: DataFrame, selected: DataFrame) -> DataFrame:
    """Position, popup text, colour and icon of each station."""

    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    return _mark_selected(stations, selected).select(
        "latitude",
        "longitude",
        F.concat(
            F.lit("Name = "), shown("locationname"),
            F.lit("<br>Type = "), shown("locationtype"),
            F.lit("<br>ID = "), shown("locationid"),
        ).alias("popup"),
        F.when(F.col("selected"), "red").otherwise("blue").alias("color"),
        places.marker_icon(F.col("locationtype")).alias("icon"),
    )


def type_counts(df: DataFrame, type_col: str = "locationtype") -> DataFrame:
    """Rows per type and the legend label, which shows counts above one."""
    name = F.col(type_col)
    return df.groupBy(type_col).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "label",
        F.when(F.col("n") > 1, F.concat(F.coalesce(name, F.lit("None")), F.lit(" n= "), F.col("n").cast("string")))
        .otherwise(name),
    )


def variable_range(df: DataFrame, var_col: str) -> DataFrame:
    """Least and greatest value and each row's place between them (0 when they agree).

    The two bounds come from a scalar subquery, so no row is shuffled for them.
    """
    bounds = df.agg(F.struct(F.min(var_col).alias("low"), F.max(var_col).alias("high"))).scalar()
    return (
        df.withColumn("_bounds", bounds)
        .withColumns({"var_min": F.col("_bounds.low"), "var_max": F.col("_bounds.high")})
        .withColumn(
            "var_norm",
            F.when(F.col("var_max") == F.col("var_min"), F.lit(0.0)).otherwise(
                (F.col(var_col) - F.col("var_min")) / (F.col("var_max") - F.col("var_min"))
            ),
        )
        .drop("_bounds")
    )
