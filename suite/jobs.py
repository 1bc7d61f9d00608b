"""Whole jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seepline import schemas, vocab
from seepline.functions import values
from seepline.plans import lab, portal, publish, summary
from suite import frames, sql
from suite.base import query
from suite.relations import _TYPES, _null, numeric_results, joined_sql

c = F.col

_PORTAL = f"""portal AS (SELECT act, org, loc, chr, cond, qual, act_time, {sql.date_time('act_date', 'act_time')} AS sampledate, {sql.number('lim')} AS lim,
 CASE WHEN lower(rtrim(unit))='ug/l' THEN ({sql.number('val')})/1000 ELSE {sql.number('val')} END AS val,
 CASE WHEN lower(rtrim(unit)) IN ('ug/l','mg/l') THEN 'mg/l' ELSE rtrim(unit) END AS unit FROM wq_portal),
 portal2 AS (SELECT *, {sql.nutrient('chr', 'unit')} AS k FROM portal)"""
_CLEAN = f"""SELECT org AS "OrganizationIdentifier", replace(loc,'_WQX-','-') AS monitoringlocationid, act AS sampleid, sampledate, act_time AS sampletime, {sql.NUTRIENT_NAME.format(r='k', n='chr')} AS characteristicname,
 val AS resultvalue, CASE WHEN k IS NOT NULL THEN 'mg/l' ELSE unit END AS resultunit, cond AS resultdetectioncondition, lim AS detecquantlimitmeasure, qual AS resultqualifier,
 {sql.NUTRIENT_FORM.format(r='k')} AS methodspeciation FROM portal2"""
query("clean_results", f"WITH {_PORTAL} {_CLEAN}")(lambda t: portal.clean_results(frames.portal_results(t)))
query("clean_stations", f"""SELECT locationid, locationname, locationtype, huc8, latitude, longitude, verticalmeasure, aquifername FROM (
 SELECT *, row_number() OVER (PARTITION BY locationid ORDER BY locationname, locationtype NULLS LAST, huc8, latitude, longitude, verticalmeasure NULLS LAST) AS rn FROM (
 SELECT replace(loc,'_WQX-','-') AS locationid, name AS locationname, {sql.case_of('typ', vocab.STATION_TYPES, 'typ')} AS locationtype, huc AS huc8, lat AS latitude, lon AS longitude,
 CASE WHEN elev<>0 THEN CAST(format('{{:.1f}}', elev) AS DOUBLE) END AS verticalmeasure, aquifer AS aquifername FROM wq_portal_stations)) WHERE rn=1""")(
    lambda t: portal.clean_stations(frames.portal_stations(t))
)


def _wide_sql():
    cols = ", ".join(f'max(resultvalue) FILTER (WHERE sym=\'{s}\' AND rn=1) AS "{s}"' for s in vocab.SYMBOLS)
    order = "monitoringlocationid, sampledate NULLS LAST, characteristicname NULLS LAST, resultvalue NULLS LAST"
    return f"""WITH {_PORTAL}, clean AS ({_CLEAN}), named AS (SELECT *, {sql.case_of('trim(characteristicname)', vocab.PARAMETER_SYMBOLS, "''")} AS sym FROM clean WHERE sampleid IS NOT NULL AND resultdetectioncondition IS NULL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY sampleid, sym ORDER BY {order}) AS rn, row_number() OVER (PARTITION BY sampleid ORDER BY {order}) AS first FROM named)
    SELECT max(sampledate) FILTER (WHERE first=1) AS sampledate, max(monitoringlocationid) FILTER (WHERE first=1) AS monitoringlocationid, sampleid, {cols} FROM ranked GROUP BY sampleid"""


query("wide_samples", _wide_sql())(lambda t: portal.wide_samples(frames.portal_results(t)))


def _prep_stations_sql():
    have = {"locationid": "locationid", "locationname": "locationname", "locationtype": "locationtype", "latitude": "latitude", "longitude": "longitude",
            "verticalmeasure": "verticalmeasure", "triballandind": "'No'", "altlocationid": "coalesce(usgs_id, win, wrnum)",
            "altlocationcontext": "CASE WHEN usgs_id IS NOT NULL THEN 'usgs_id' WHEN win IS NOT NULL THEN 'Utah Well ID' WHEN wrnum IS NOT NULL THEN 'Utah Water Rights Number' END"}
    cols = ", ".join(f"{have[n]} AS {n}" if n in have else _null(n) for n in schemas.FIELDS["Station"])
    return f"""SELECT {cols} FROM wq_stations s WHERE send=1 AND locationtype IS DISTINCT FROM 'Atmosphere'
    AND NOT EXISTS (SELECT 1 FROM wq_portal_stations p WHERE CASE WHEN p.typ='Spring' THEN replace(replace(p.loc,'_WQX-','-'),'UTAHGS-','') ELSE 'other-' || p.loc END = s.locationid)"""


def _stations_full(t):
    rows = t.stations
    missing = {n: F.lit(None).cast(schemas.field_type(n)) for n in schemas.FIELDS["Station"] if n not in rows.columns}
    return rows.withColumns(missing)


query("prep_stations", _prep_stations_sql())(
    lambda t: publish.prep_stations(
        _stations_full(t),
        # other stations stand under another key, so that some of ours are unknown there
        t.portal_stations.select(
            F.when(c("typ") == "Spring", values.strip_org_prefix(values.strip_wqx(c("loc")))).otherwise(F.concat(F.lit("other-"), "loc")).alias("locationid")
        ),
    )
)
query("prep_result_activity", f"""SELECT {', '.join(schemas.FIELDS['Upload'])} FROM ({joined_sql('LEFT')}) j WHERE projectid IS NOT NULL
 AND EXISTS (SELECT 1 FROM wq_stations s WHERE s.locationid=j.monitoringlocationid AND s.send=1)
 AND NOT EXISTS (SELECT 1 FROM wq_published p WHERE replace(p.monitoringlocationid,'UTAHGS-','')=j.monitoringlocationid AND replace(p.activityid,'UTAHGS-','')=j.activityid AND p.characteristicname=j.characteristicname)""")(
    lambda t: publish.prep_result_activity(numeric_results(t), t.activities, t.published, t.stations)
)

_GROUPS = "(SELECT registry_name AS n, max(characteristic_group_type) AS g FROM wq_domain GROUP BY 1)"
query("epa_lab_job", f"""SELECT e.*, d.g AS characteristicgroup FROM (SELECT laboratory AS laboratoryname, lab_number AS activityid, sample_name AS monitoringlocationid, {sql.clean_method('method')} AS resultanalyticalmethodid,
 {sql.epa_name('analyte')} AS characteristicname, {sql.epa_form('analyte')} AS methodspeciation, report_limit AS detecquantlimitmeasure, {sql.censored_value('val')} AS resultvalue,
 CASE WHEN qual IS NOT NULL THEN qual WHEN val LIKE '%<%' THEN 'BRL' END AS resultqualifier, 'Total' AS resultsamplefraction, {sql.case_of('units', vocab.EPA_UNITS, 'units')} AS resultunit,
 {sql.case_of('units', vocab.EPA_UNITS, 'units')} AS resultdetecquantlimitunit, CAST(left(sampled,10) AS DATE) AS activitystartdate, substr(sampled,12,5) AS activitystarttime, CAST(left(analyzed,10) AS DATE) AS analysisstartdate,
 {sql.condition('val')} AS resultdetectioncondition, {sql.limit_type('val')} AS resultdetecquantlimittype, lab_number || '-' || {sql.epa_name('analyte')} AS resultid, 'USEPA' AS resultanalyticalmethodcontext,
 'UNGWMN' AS projectid, 0 AS inwqx, NULL::VARCHAR AS personnel, NULL::VARCHAR AS notes FROM wq_epa_lab) e LEFT JOIN {_GROUPS} d ON d.n = e.characteristicname""")(
    lambda t: lab.epa_lab_job(_epa_sheet(t), frames.domain(t))
)


def _epa_sheet(t):
    return frames.epa_lab(t).withColumns({n: c(n).cast("timestamp_ntz") for n in ("Sampled", "Analyzed")})


def _state_sql(station: str, ctes: str = "") -> str:
    return f"""{ctes} SELECT b.*, p.code AS projectid, d.g AS characteristicgroup FROM (SELECT sample_number AS activityid, {station} AS monitoringlocationid, CAST(left(sample_date,10) AS DATE) AS activitystartdate, sample_time AS activitystarttime,
    description AS notes, collector AS personnel, CASE WHEN agency='SM' THEN 'APHA' ELSE 'USEPA' END AS resultanalyticalmethodcontext, method AS resultanalyticalmethodid,
    CASE WHEN trim(matrix)='Water, Filtered' THEN 'Dissolved' ELSE 'Total' END AS resultsamplefraction, {sql.number('val')} AS resultvalue, low_limit AS detecquantlimitmeasure,
    {sql.case_of('units', vocab.STATE_UNITS, 'units')} AS resultunit, {sql.case_of('units', vocab.STATE_UNITS, 'units')} AS resultdetecquantlimitunit, CAST(left(analysis_date,10) AS DATE) AS analysisstartdate,
    CASE WHEN problem='<' THEN 'Below Reporting Limit' WHEN problem='>' THEN 'Above Operating Range' WHEN problem IS NULL AND code='U' THEN 'Not Detected' END AS resultdetectioncondition,
    {sql.state_name('param')} AS characteristicname, {sql.state_form('param')} AS methodspeciation, sample_number || '-' || coalesce({sql.state_name('param')}, 'None') AS resultid,
    'Lower Reporting Limit' AS resultdetecquantlimittype, 'Actual' AS resultvaluetype, 'Final' AS resultstatusid, 0 AS inwqx FROM wq_state_lab s LEFT JOIN m ON m.k = {{key}}) b
    LEFT JOIN (SELECT locationid, max({sql.case_of('qwnetworkname', vocab.PROJECT_CODES)}) AS code FROM wq_networks GROUP BY 1) p ON p.locationid = b.monitoringlocationid
    LEFT JOIN {_GROUPS} d ON d.n = b.characteristicname"""


query("state_lab_job", _state_sql("m.s", "WITH m AS (SELECT sample_number AS k, max(CAST(CAST(station_id AS BIGINT) AS VARCHAR)) AS s FROM wq_matches GROUP BY 1)").replace("{key}", "s.sample_number"))(
    lambda t: lab.state_lab_job(frames.state_lab(t), frames.domain(t), t.networks, frames.matches(t))
)
query("state_lab_job_rules", _state_sql("m.s", f"WITH m AS (SELECT d.description AS k, arg_max(r.station, r.ord) AS s FROM (SELECT DISTINCT description FROM wq_state_lab) d, {sql.rules_table()} WHERE regexp_matches(d.description, r.pattern) GROUP BY 1)").replace("{key}", "s.description"))(
    lambda t: lab.state_lab_job(frames.state_lab(t), frames.domain(t), t.networks)
)
query("location_summary", f"""WITH r AS (SELECT *, CASE WHEN lower(rtrim(resultunit)) IN ('ug/l','mg/l') THEN 'mg/l' ELSE rtrim(resultunit) END AS u,
 CASE WHEN lower(rtrim(resultunit))='ug/l' THEN ({sql.censored_value('resultvalue')})/1000 ELSE {sql.censored_value('resultvalue')} END AS v FROM wq_results), k AS (SELECT *, {sql.nutrient('characteristicname', 'u')} AS k FROM r)
 SELECT k.monitoringlocationid, {sql.NUTRIENT_NAME.format(r='k.k', n='k.characteristicname')} AS characteristicname, count(*) AS n, count(*) FILTER (WHERE k.resultvalue LIKE '%<%') AS n_below,
 count(a.activitystartdate) AS n_dated, round(avg(v), 6) AS mean_value FROM k LEFT JOIN wq_activities a ON a.activityid=k.activityid GROUP BY 1, 2""")(
    lambda t: summary.location_summary(t.results, t.activities)
)
