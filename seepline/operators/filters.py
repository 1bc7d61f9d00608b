"""Row filters. All are plain predicates, so parquet and JDBC scans receive them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import places, values


def select_send(stations: DataFrame) -> DataFrame:
    return stations.where(F.col("send") == 1)


def not_atmosphere(stations: DataFrame) -> DataFrame:
    """Everything but atmosphere stations; an unknown type stays."""
    return stations.where(~F.col("locationtype").eqNullSafe(F.lit("Atmosphere")))


def require_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.dropna(how="any", subset=[lat, lon])


def require_project(df: DataFrame) -> DataFrame:
    return df.where(F.col("projectid").isNotNull())


def method_qc(df: DataFrame) -> DataFrame:
    """Rows that name a method context but no method."""
    return df.where(
        F.col("resultanalyticalmethodcontext").isNotNull() & F.col("resultanalyticalmethodid").isNull()
    )


def alt_id_above(stations: DataFrame, threshold: float = 1000) -> DataFrame:
    return stations.where(values.parse_number(F.col("altlocationid")) > F.lit(float(threshold))).select(
        "locationname", "altlocationid", "offset", "barologgertype"
    )


def filter_location(df: DataFrame, location: str) -> DataFrame:
    """One location in order of date; remaining columns settle ties."""
    rest = [c for c in df.columns if c not in ("monitoringlocationid", "activitystartdate")]
    return df.where(F.col("monitoringlocationid") == location).orderBy("activitystartdate", *rest)


def portal_bbox(stations: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    return stations.where(
        F.col("latitude").between(south, north) & F.col("longitude").between(west, east)
    )


def portal_radius(stations: DataFrame, distance: float, unit: str, lat: float, lon: float) -> DataFrame:
    """Stations within a great-circle distance; bounds of latitude, and of longitude where
    the circle holds neither a pole nor the date line, reach the scan first."""
    miles = distance * vocab.MILES_PER_UNIT[unit]
    reach = math.degrees(miles / vocab.EARTH_RADIUS_MILES) * 1.000001
    here = values.haversine_miles(F.col("latitude"), F.col("longitude"), F.lit(float(lat)), F.lit(float(lon)))
    rows = stations.where(F.col("latitude").between(lat - reach, lat + reach))
    if abs(lat) + reach < 90:
        side = math.degrees(math.asin(math.sin(math.radians(reach)) / math.cos(math.radians(lat)))) * 1.000001
        if -180 <= lon - side and lon + side <= 180:
            rows = rows.where(F.col("longitude").between(lon - side, lon + side))
    return rows.where(here <= F.lit(miles))


def portal_county(stations: DataFrame, state: str, county: str) -> DataFrame:
    """Stations of one county; states and counties carry the codes US:ss and US:ss:ccc."""
    state_code, county_code = places.county_criterion(state, county)
    return stations.where((F.col("state") == state_code) & (F.col("county") == county_code))


def portal_org(df: DataFrame, organizations: list[str], column: str = "organization") -> DataFrame:
    return df.where(F.col(column).isin(organizations))


def portal_huc(stations: DataFrame, codes: list[str], column: str = "huc8") -> DataFrame:
    """Stations in any of the hydrologic units; a shorter code stands for all units below it."""
    return stations.where(places.any_of([F.col(column).startswith(code) for code in codes]))


def portal_sites(df: DataFrame, sites: list[str], column: str = "locationid") -> DataFrame:
    return df.where(F.col(column).isin(sites))


def portal_dates(df: DataFrame, low: str, high: str, column: str = "activitystartdate") -> DataFrame:
    return df.where(F.col(column).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def filter_group(domain: DataFrame, group: str) -> DataFrame:
    return domain.where(F.col("CHARACTERISTIC_GROUP_TYPE") == group)


def list_groups(domain: DataFrame) -> DataFrame:
    return domain.select("CHARACTERISTIC_GROUP_TYPE").distinct()
