"""Writers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_dated_csv(df: DataFrame, folder: str, stem: str, when: datetime | None = None) -> str:
    """CSV parts with headers below ``folder/stem_yyyymmddHHMMSS``; returns that path.

    Every task writes its own part, so the upload never passes through one place.
    """
    path = f"{folder.rstrip('/')}/{stem}_{when or datetime.now():%Y%m%d%H%M%S}"
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("errorifexists")
        .csv(path)
    )
    return path


def to_geojson(stations: DataFrame, lat: str = "latitude", lon: str = "longitude", crs: str = "EPSG:4326") -> DataFrame:
    """One GeoJSON feature per row as ``feature``, and its point as WKT.

    Written with ``df.select("feature").write.text(...)`` the rows are a line-delimited
    GeoJSON file. A station without coordinates has a null geometry.
    """
    properties = F.struct(*[F.col(c) for c in stations.columns])
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    point = F.when(placed, F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")))
    feature = F.struct(
        F.lit("Feature").alias("type"), point.alias("geometry"), properties.alias("properties")
    )
    return stations.withColumns(
        {
            "feature": F.to_json(feature, {"ignoreNullFields": "false"}),
            "wkt": F.when(
                placed, F.concat(F.lit("POINT ("), F.col(lon).cast("string"), F.lit(" "), F.col(lat).cast("string"), F.lit(")"))
            ),
            "crs": F.lit(crs),
        }
    )
