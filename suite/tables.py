"""Headers, projections and filters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seepline import schemas
from seepline.operators import filters, projection
from suite import frames
from suite.base import numbered, query

c = F.col

query("rename_result", """SELECT org AS "OrganizationIdentifier", act AS sampleid, act_date AS sampledate, act_time AS sampletime, loc AS monitoringlocationid,
 chr AS characteristicname, val AS resultvalue, unit AS resultunit, cond AS resultdetectioncondition, lim AS detecquantlimitmeasure,
 provider AS "ProviderName", qual AS resultqualifier FROM wq_portal""")(
    lambda t: projection.rename_result(frames.portal_results(t))
)
query("rename_result_local", """SELECT org AS "OrganizationIdentifier", act AS activityid, act_date AS "ActivityStartDate", act_time AS "ActivityStartTime/Time", loc AS monitoringlocationid,
 chr AS characteristicname, val AS resultvalue, unit AS resultunit, cond AS resultdetectioncondition, lim AS detecquantlimitmeasure,
 provider AS "ProviderName", qual AS resultqualifier FROM wq_portal""")(
    lambda t: projection.rename_result(frames.portal_results(t), side="local")
)
query("rename_activity", """SELECT activityid, projectid, monitoringlocationid, activitystartdate, activitystarttime FROM wq_activities""")(
    lambda t: projection.rename_activity(
        frames.headed(t.activities, {
            "activityid": "ActivityIdentifier", "projectid": "ProjectIdentifier", "monitoringlocationid": "MonitoringLocationIdentifier",
            "activitystartdate": "ActivityStartDate", "activitystarttime": "ActivityStartTime/Time",
        })
    )
)
query("rename_station", """SELECT loc AS locationid, name AS locationname, typ AS locationtype, huc AS huc8, lat AS latitude, lon AS longitude,
 elev AS verticalmeasure, aquifer AS aquifername, country AS "CountryCode", provider AS "ProviderName" FROM wq_portal_stations""")(
    lambda t: projection.rename_station(frames.portal_stations(t))
)
query("rename_epa_lab", """SELECT laboratory AS laboratoryname, lab_number AS activityid, sample_name AS monitoringlocationid, method AS resultanalyticalmethodid,
 analyte AS characteristicname, report_limit AS detecquantlimitmeasure, val AS resultvalue, qual AS resultqualifier, class AS resultsamplefraction,
 units AS resultunit, sampled AS "Sampled", analyzed AS "Analyzed", batch AS "Batch" FROM wq_epa_lab""")(
    lambda t: projection.rename_epa_lab(frames.epa_lab(t))
)
query("rename_state_lab", """SELECT sample_number AS activityid, sample_date AS activitystartdate, sample_time AS activitystarttime, description AS notes, collector AS personnel,
 agency AS resultanalyticalmethodcontext, method AS resultanalyticalmethodid, matrix AS resultsamplefraction, val AS resultvalue, low_limit AS detecquantlimitmeasure,
 detect_limit AS resultdetecquantlimitunit, units AS resultunit, analysis_date AS analysisstartdate, param AS "Param Description", problem AS "Problem Identifier", code AS "Result Code" FROM wq_state_lab""")(
    lambda t: projection.rename_state_lab(frames.state_lab(t))
)


@query(
    "harmonize_lab_headers",
    """SELECT sample_number AS "Sample Number", collector AS "Collector", param AS "Param Description", val AS "Result Value", units AS "Units", CAST(NULL AS VARCHAR) AS "Method ID", CAST(NULL AS VARCHAR) AS "Date Collected" FROM wq_state_lab
    UNION ALL SELECT lab_number, NULL, analyte, val, NULL, method, sampled FROM wq_epa_lab""",
)
def _(t):
    new = frames.headed(t.state_lab, {
        "sample_number": "Sample Number", "collector": "Collected By", "param": "Method Reported Name", "val": "Result Entry", "units": "Result Units",
    })
    old = frames.headed(t.epa_lab, {
        "lab_number": "Sample#Number", "analyte": "Param#Description", "val": "Result#Value", "method": "Method#ID", "sampled": "Sample#Date", "qual": "Result#Code",
    }).withColumn("Lab#Code", F.lit("x"))
    return projection.harmonize_lab_headers(new, old)


query("drop_if_present", "SELECT org, act, loc, chr, val, unit, lim, qual FROM wq_portal")(
    lambda t: projection.drop_if_present(t.portal, ["act_date", "act_time", "cond", "provider", "NoSuchColumn"])
)
query("drop_empty_columns", "SELECT loc, name, typ, huc, lat, lon, elev, country, provider FROM wq_portal_stations")(
    lambda t: projection.drop_empty_columns(t.portal_stations)
)
query("move_front", "SELECT org, chr, loc, act, act_date, act_time, val, unit, cond, lim, provider, qual FROM wq_portal")(
    lambda t: projection.move_front(t.portal, ["act", "loc", "chr"])
)
query("add_upload_constants", """SELECT *, 'Water' AS activitymedia, 'MDT' AS activitytimezone, 'Water Bottle' AS sampcollectionequip, 'GRAB' AS sampcollectmethod,
 'Actual' AS resultvaluetype, 'Final' AS resultstatusid FROM wq_results""")(lambda t: projection.add_upload_constants(t.results))


@query("project_fields", """SELECT activityid, projectid, monitoringlocationid, activitystartdate, activitystarttime, NULL::VARCHAR AS notes, NULL::VARCHAR AS personnel,
 'lab' AS created_user, TIMESTAMP '2020-01-02 03:04:05' AS created_date, 'lab' AS last_edited_user, TIMESTAMP '2020-01-02 03:04:05' AS last_edited_date FROM wq_activities""")
def _(t):
    stamped = projection.stamp_audit(t.activities, "lab", "2020-01-02 03:04:05")
    return projection.project_fields(
        stamped.withColumns({n: F.lit(None).cast("string") for n in ("notes", "personnel")}), "Activity"
    )


query("none_to_null", "SELECT locationid, nullif(barologgertype, 'none') AS barologgertype, n FROM (SELECT *, 1 AS n FROM wq_sites)")(
    lambda t: projection.none_to_null(
        t.sites.select("locationid", F.when(c("barologgertype") == "none", "None").otherwise(c("barologgertype")).alias("barologgertype"), F.lit(1).alias("n"))
    )
)
query("select_send", "SELECT * FROM wq_stations WHERE send = 1")(lambda t: filters.select_send(t.stations))
query("not_atmosphere", "SELECT * FROM wq_stations WHERE locationtype IS DISTINCT FROM 'Atmosphere'")(lambda t: filters.not_atmosphere(t.stations))
query("require_coords", "SELECT * FROM wq_sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL")(lambda t: filters.require_coords(t.sites))
query("require_project", "SELECT * FROM wq_activities WHERE projectid IS NOT NULL")(lambda t: filters.require_project(t.activities))
query("method_qc", "SELECT lab_number, units, NULL::VARCHAR AS resultanalyticalmethodid, class AS resultanalyticalmethodcontext FROM wq_epa_lab WHERE method IS NULL AND class IS NOT NULL")(
    lambda t: filters.method_qc(
        t.epa_lab.select("lab_number", "units", c("method").alias("resultanalyticalmethodid"), c("class").alias("resultanalyticalmethodcontext"))
    )
)
query("alt_id_above", 'SELECT locationname, altlocationid, "offset", barologgertype FROM wq_sites WHERE TRY_CAST(altlocationid AS DOUBLE) > 1000')(
    lambda t: filters.alt_id_above(t.sites)
)
query("filter_location", "SELECT *, row_number() OVER (ORDER BY activitystartdate, activityid) - 1 AS position FROM wq_activities WHERE monitoringlocationid = '1017'")(
    lambda t: numbered(filters.filter_location(t.activities, "1017"))
)
query("portal_bbox", "SELECT * FROM wq_sites WHERE longitude >= -113.5 AND longitude <= -111 AND latitude >= 38 AND latitude <= 40.5")(
    lambda t: filters.portal_bbox(t.sites, -113.5, 38.0, -111.0, 40.5)
)
query("portal_radius", """SELECT * FROM wq_sites WHERE 2*3958.7613*asin(sqrt(least(1, pow(sin(radians(latitude-39.5)/2),2)
 + cos(radians(latitude))*cos(radians(39.5))*pow(sin(radians(longitude+112)/2),2)))) <= 150*0.621371""")(
    lambda t: filters.portal_radius(t.sites, 150, "km", 39.5, -112.0)
)
query("portal_county", "SELECT * FROM wq_sites WHERE state='US:04' AND county='US:04:049'")(lambda t: filters.portal_county(t.sites, "Arizona", "049"))
query("portal_org", "SELECT * FROM wq_portal WHERE org='UTAHGS' OR org='USGS-UT'")(lambda t: filters.portal_org(t.portal, ["UTAHGS", "USGS-UT"], "org"))
query("portal_huc", "SELECT * FROM wq_sites WHERE huc8 LIKE '1602%' OR huc8='14010005'")(lambda t: filters.portal_huc(t.sites, ["1602", "14010005"]))
query("portal_sites", "SELECT * FROM wq_portal WHERE loc='UTAHGS-1007' OR loc='UTAHGS_WQX-1011'")(
    lambda t: filters.portal_sites(t.portal, ["UTAHGS-1007", "UTAHGS_WQX-1011"], "loc")
)
query("portal_dates", "SELECT * FROM wq_activities WHERE activitystartdate >= DATE '1997-03-01' AND activitystartdate <= DATE '1998-06-30'")(
    lambda t: filters.portal_dates(t.activities, "1997-03-01", "1998-06-30")
)
_DOMAIN = 'pk_isn AS "PK_ISN", registry_name AS "REGISTRY_NAME", characteristic_group_type AS "CHARACTERISTIC_GROUP_TYPE", srs_id AS "SRS_ID", cas_number AS "CAS_NUMBER", extra AS "EXTRA"'
query("filter_group", f"SELECT {_DOMAIN} FROM wq_domain WHERE characteristic_group_type='Nutrient'")(lambda t: filters.filter_group(frames.domain(t), "Nutrient"))
query("list_groups", 'SELECT DISTINCT characteristic_group_type AS "CHARACTERISTIC_GROUP_TYPE" FROM wq_domain')(lambda t: filters.list_groups(frames.domain(t)))
query("stamp_audit", """SELECT *, 'lab' AS created_user, 'lab' AS last_edited_user, TIMESTAMP '2020-01-02 03:04:05' AS created_date, TIMESTAMP '2020-01-02 03:04:05' AS last_edited_date FROM wq_results""")(
    lambda t: projection.stamp_audit(t.results, "lab", "2020-01-02 03:04:05")
)
