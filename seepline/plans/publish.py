"""What is still to be uploaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.functions import places
from seepline.operators import filters, joins, projection, reshape
from seepline.sources.keyed import KeyedTable


def prep_stations(stations: DataFrame, published: DataFrame) -> DataFrame:
    """Upload-ready stations: not published, marked for sending, outside the atmosphere."""
    rows = filters.not_atmosphere(filters.select_send(joins.to_upload(stations, published, "locationid")))
    rows = rows.withColumns({"triballandind": F.lit("No"), "triballandname": F.lit(None).cast("string")})
    alternative = places.alt_location(F.col("usgs_id"), F.col("win"), F.col("wrnum"))
    rows = rows.withColumn("_alt", alternative).withColumns(
        {"altlocationid": F.col("_alt.altlocationid"), "altlocationcontext": F.col("_alt.altlocationcontext")}
    )
    return reshape.sort_stations(projection.project_fields(rows, "Station"))


def prep_result_activity(
    results: DataFrame, activities: DataFrame, published: DataFrame, stations: DataFrame | None = None
) -> DataFrame:
    """Upload-ready results with their activity.

    ``published`` holds portal results; they are compared by location, activity and
    characteristic. Rows need a project and, when stations are given, a sending station.
    """
    joined = projection.add_unique_id(joins.result_activity(results, activities))
    rows = joins.to_upload(joined, joins.published_results(published), "uniqueid")
    rows = filters.require_project(projection.none_to_null(rows))
    if stations is not None:
        rows = joins.senders_only(rows, stations)
    return projection.project_fields(rows, "Upload")


def mark_published(table: KeyedTable, published: DataFrame) -> int:
    """Set the flag of a stored table's rows whose key is published, as ``apply_inwqx`` does in
    a projection; returns the table's new version. Parts without such a key are not read."""
    keys = published.select(table.key).distinct().withColumn("inwqx", F.lit(1))
    return table.merge(keys, ["inwqx"])
