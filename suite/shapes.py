"""Dedupe, pivot, unpivot, counts, stacking and sorting over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seepline import vocab
from seepline.operators import reshape, stations
from suite import frames
from suite.base import numbered, query
from suite.relations import _LOCAL

c = F.col

_UNIQUE_COLS = "activityid, monitoringlocationid, characteristicname, resultvalue, resultunit, detecquantlimitmeasure, resultline"
query("dedupe_unique_id", f"SELECT {_UNIQUE_COLS}, uniqueid FROM (SELECT *, row_number() OVER (PARTITION BY uniqueid ORDER BY {_UNIQUE_COLS}) AS rn FROM {_LOCAL}) WHERE rn=1")(
    lambda t: reshape.dedupe_unique_id(frames.local_results(t))
)
query("dedupe_stations", """SELECT locationid, name, typ, huc, lat, lon, elev, aquifer, country, provider FROM (
 SELECT *, row_number() OVER (PARTITION BY locationid ORDER BY name NULLS LAST, typ NULLS LAST, lat, lon, elev) AS rn
 FROM (SELECT *, replace(loc,'_WQX-','-') AS locationid FROM wq_portal_stations)) WHERE rn=1""")(
    lambda t: reshape.dedupe_stations(t.portal_stations.withColumnRenamed("loc", "locationid"))
)
query("distinct_projects", "SELECT DISTINCT projectid FROM wq_activities")(lambda t: reshape.distinct_projects(t.activities))

_NAMES = {"Ca": "Calcium", "Mg": "Magnesium", "Na": "Sodium", "K": "Potassium", "HCO3": "Bicarbonate", "CO3": "Carbonate",
          "Cl": "Chloride", "SO4": "Sulfate", "pH": "pH"}


def long_majors(t):
    return t.majors.unpivot(
        ["sampleid", "monitoringlocationid", "sampledate"], list(_NAMES), "ion", "resultvalue"
    ).select(
        "sampleid", "monitoringlocationid", "sampledate", "resultvalue",
        F.create_map(*[F.lit(x) for kv in _NAMES.items() for x in kv])[c("ion")].alias("characteristicname"),
        F.when((c("ion") == "K") & (c("resultvalue") > 6), "Not Detected").alias("resultdetectioncondition"),
    )


def _pivot_sql(required: list[str]) -> str:
    long = " UNION ALL ".join(
        f"SELECT sampleid, monitoringlocationid, sampledate, '{n}' AS chr, '{i}' AS sym, {i} AS v FROM wq_majors" + (" WHERE K <= 6" if i == "K" else "") for i, n in _NAMES.items()
    )
    cols = ", ".join(
        f'max(v) FILTER (WHERE sym=\'{s}\' AND rn=1) AS "{s}"' if s in _NAMES else f'CAST(NULL AS DOUBLE) AS "{s}"' for s in vocab.SYMBOLS
    )
    keep = " AND ".join(f'"{r}" IS NOT NULL' for r in required) or "TRUE"
    return f"""SELECT * FROM (SELECT arg_min(sampledate, ordering) AS sampledate, arg_min(monitoringlocationid, ordering) AS monitoringlocationid, sampleid, {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY sampleid, sym ORDER BY monitoringlocationid, sampledate, chr, v NULLS LAST) AS rn, monitoringlocationid || sampledate::VARCHAR AS ordering
    FROM ({long})) GROUP BY sampleid) WHERE {keep}"""


query("pivot_samples", _pivot_sql(vocab.PIPER_REQUIRED))(lambda t: reshape.pivot_samples(long_majors(t)))
query("pivot_samples_all", _pivot_sql([]))(lambda t: reshape.pivot_samples(long_majors(t), chems=""))
query("unpivot_field", """SELECT activityid || '-FM' AS activityid, temperature_c AS resultvalue, 'Temperature, water' AS characteristicname, 'deg C' AS resultunit FROM wq_activities WHERE temperature_c IS NOT NULL
 UNION ALL SELECT activityid || '-FM', conduct_uscm, 'Specific conductance', 'uS/cm' FROM wq_activities WHERE conduct_uscm IS NOT NULL
 UNION ALL SELECT activityid || '-FM', ph, 'pH', 'None' FROM wq_activities WHERE ph IS NOT NULL""")(lambda t: reshape.unpivot_field(t.activities))

_EXTENT = """SELECT round(avg(latitude), 9) AS center_lat, round(avg(longitude), 9) AS center_lon, coalesce(min(latitude) FILTER (WHERE sel), min(latitude)) AS south,
 coalesce(min(longitude) FILTER (WHERE sel), min(longitude)) AS west, coalesce(max(latitude) FILTER (WHERE sel), max(latitude)) AS north, coalesce(max(longitude) FILTER (WHERE sel), max(longitude)) AS east
 FROM (SELECT *, {sel} AS sel FROM wq_sites)"""


def _rounded(df):
    return df.withColumns({k: F.round(k, 9) for k in ("center_lat", "center_lon")})


query("station_extent", _EXTENT.format(sel="FALSE"))(lambda t: _rounded(stations.station_extent(t.sites)))
query("station_extent_selected", _EXTENT.format(sel="(organization='UTAHDWQ')"))(
    lambda t: _rounded(stations.station_extent(t.sites, t.sites.where("organization = 'UTAHDWQ'")))
)
query("station_markers", """SELECT latitude, longitude, 'Name = ' || locationname || '<br>Type = ' || coalesce(locationtype,'None') || '<br>ID = ' || locationid AS popup,
 CASE WHEN usgs_id IS NOT NULL THEN 'red' ELSE 'blue' END AS color,
 CASE locationtype WHEN 'Spring' THEN 'star-empty' WHEN 'Well' THEN 'heart-empty' WHEN 'Stream' THEN 'tint' WHEN 'Land' THEN 'globe' ELSE 'bullseye' END AS icon FROM wq_stations""")(
    lambda t: stations.station_markers(t.stations, t.stations.where("usgs_id is not null"))
)
query("type_counts", """SELECT typ, n, CASE WHEN n > 1 THEN coalesce(typ,'None') || ' n= ' || n ELSE typ END AS label FROM (SELECT typ, count(*) AS n FROM wq_portal_stations GROUP BY 1)""")(
    lambda t: stations.type_counts(t.portal_stations, "typ")
)
query("variable_range", """SELECT sampleid, Cl, lo AS var_min, hi AS var_max, (Cl-lo)/(hi-lo) AS var_norm FROM wq_majors, (SELECT min(Cl) AS lo, max(Cl) AS hi FROM wq_majors)""")(
    lambda t: stations.variable_range(t.majors.select("sampleid", "Cl"), "Cl")
)
query("append_tables", "SELECT * FROM wq_stations UNION ALL BY NAME SELECT * FROM wq_sites")(lambda t: reshape.append_tables(t.stations, t.sites))
query("sort_results", "SELECT sampleid, monitoringlocationid, sampledate, Ca, row_number() OVER (ORDER BY monitoringlocationid, sampledate, sampleid, Ca) - 1 AS position FROM wq_majors")(
    lambda t: numbered(reshape.sort_results(t.majors.select("sampleid", "monitoringlocationid", "sampledate", "Ca")))
)
query("sort_stations", "SELECT *, row_number() OVER (ORDER BY locationid) - 1 AS position FROM wq_stations")(lambda t: numbered(reshape.sort_stations(t.stations)))
