"""Joins, membership and lookups over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seepline import schemas, vocab
from seepline.functions import values
from seepline.operators import joins, projection
from suite import frames, sql
from suite.base import numbered, query, read_table

c = F.col

_NUM_RESULTS = f"(SELECT *, {sql.number('resultvalue')} AS num FROM wq_results)"
_TYPES = {"double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}


def _null(name: str) -> str:
    return f"CAST(NULL AS {_TYPES[schemas.field_type(name).simpleString()]}) AS {name}"


def numeric_results(t):
    return t.results.withColumn("resultvalue", values.parse_number(c("resultvalue")))


def joined_sql(kind: str) -> str:
    have = {"monitoringlocationid": "r.monitoringlocationid", "activityid": "r.activityid", "characteristicname": "r.characteristicname",
            "resultvalue": "r.num", "resultunit": "r.resultunit", "detecquantlimitmeasure": "r.detecquantlimitmeasure",
            "activitystartdate": "a.activitystartdate", "activitystarttime": "a.activitystarttime", "projectid": "a.projectid"}
    names = schemas.JOINED_RESULT_FIELDS + schemas.JOINED_ACTIVITY_FIELDS
    cols = ", ".join(f"{have[n]} AS {n}" if n in have else _null(n) for n in names)
    return f"""SELECT {cols}, 'Water' AS activitymedia, 'MDT' AS activitytimezone, 'Water Bottle' AS sampcollectionequip, 'GRAB' AS sampcollectmethod,
    'Actual' AS resultvaluetype, 'Final' AS resultstatusid, CASE WHEN r.activityid LIKE '%-FM%' THEN 'Field Msr/Obs' ELSE 'Sample-Routine' END AS activitytype
    FROM {_NUM_RESULTS} r {kind} JOIN wq_activities a ON r.activityid = a.activityid"""


query("result_activity", joined_sql("LEFT"))(lambda t: joins.result_activity(numeric_results(t), t.activities))


def _view_sql():
    have = {"characteristicname": "r.characteristicname", "resultvalue": "r.num", "resultunit": "r.resultunit", "detecquantlimitmeasure": "r.detecquantlimitmeasure"}
    cols = [f"a.{n}" for n in schemas.VIEW_ACTIVITY_FIELDS]
    cols += [f"{have[n]} AS {n}" if n in have else _null(n) for n in schemas.VIEW_RESULT_FIELDS]
    return f"SELECT {', '.join(cols)} FROM {_NUM_RESULTS} r JOIN wq_activities a ON r.activityid = a.activityid"


query("result_activity_view", _view_sql())(lambda t: joins.result_activity_view(numeric_results(t), t.activities))

_LOCAL = "(SELECT *, monitoringlocationid || '-' || activityid || '-' || characteristicname AS uniqueid FROM wq_results)"
_KNOWN = "(SELECT replace(monitoringlocationid,'UTAHGS-','') || '-' || replace(activityid,'UTAHGS-','') || '-' || characteristicname AS k FROM wq_published)"

query("flag_inwqx", f"SELECT l.*, CASE WHEN EXISTS (SELECT 1 FROM {_KNOWN} p WHERE p.k = l.uniqueid) THEN 1 ELSE 0 END AS inwqx FROM {_LOCAL} l")(
    lambda t: joins.flag_inwqx(frames.local_results(t), joins.published_results(t.published), "uniqueid")
)
query("flag_inwqx_activities", "SELECT a.*, CASE WHEN EXISTS (SELECT 1 FROM wq_published p WHERE replace(p.activityid,'UTAHGS-','') = a.activityid) THEN 1 ELSE 0 END AS inwqx FROM wq_activities a")(
    lambda t: joins.flag_inwqx(t.activities, joins.published_results(t.published), "activityid")
)
query("flag_inwqx_stations", "SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM wq_published p WHERE p.monitoringlocationid = 'UTAHGS-' || s.locationid) THEN 1 ELSE 0 END AS inwqx FROM wq_stations s")(
    lambda t: joins.flag_inwqx(
        t.stations, t.published.select(values.strip_org_prefix(c("monitoringlocationid")).alias("locationid")), "locationid"
    )
)
query("to_upload", f"SELECT l.* FROM {_LOCAL} l WHERE NOT EXISTS (SELECT 1 FROM {_KNOWN} p WHERE p.k = l.uniqueid)")(
    lambda t: joins.to_upload(frames.local_results(t), joins.published_results(t.published), "uniqueid")
)
query("apply_inwqx", f"""SELECT l.activityid, l.monitoringlocationid, l.characteristicname, l.resultvalue, l.resultunit, l.detecquantlimitmeasure, l.resultline, l.uniqueid,
 CASE WHEN EXISTS (SELECT 1 FROM {_KNOWN} p WHERE p.k = l.uniqueid) THEN 1 ELSE l.resultline % 2 END AS inwqx FROM {_LOCAL} l""")(
    lambda t: joins.apply_inwqx(
        frames.local_results(t).withColumn("inwqx", c("resultline") % 2), joins.published_results(t.published), "uniqueid"
    )
)

_FRESH = "SELECT sample_number AS activityid, loc AS monitoringlocationid FROM (SELECT 'A' || o_orderkey AS sample_number, CAST(1000+o_custkey%60 AS VARCHAR) AS loc FROM orders) WHERE NOT EXISTS (SELECT 1 FROM {there} x WHERE x.activityid = sample_number)"


def lab_rows(t):
    orders = read_table(t.spark, t.folder, "orders")
    return orders.select(
        F.concat(F.lit("A"), c("o_orderkey").cast("string")).alias("activityid"),
        (1000 + c("o_custkey") % 60).cast("string").alias("monitoringlocationid"),
    )


def _fields_sql(kind: str, body: str, grouped: bool) -> str:
    cols = ", ".join(
        n if n == "activityid" else (f"min({n}) AS {n}" if grouped else n) if n == "monitoringlocationid" else _null(n) for n in schemas.FIELDS[kind]
    )
    return f"SELECT {cols} FROM ({body})" + (" GROUP BY activityid" if grouped else "")


query("new_activities", _fields_sql("Activity", _FRESH.format(there="wq_activities"), True))(lambda t: joins.new_activities(lab_rows(t), t.activities))
query("new_results", _fields_sql("Result", _FRESH.format(there="wq_results"), False))(lambda t: joins.new_results(lab_rows(t), t.results))
query("senders_only", "SELECT r.* FROM wq_results r WHERE EXISTS (SELECT 1 FROM wq_stations s WHERE s.locationid=r.monitoringlocationid AND s.send=1)")(
    lambda t: joins.senders_only(t.results, t.stations)
)

_SEL = {
    "results": ("wq_results", "r.activityid LIKE '%-FM%' AND r.resultvalue LIKE '<%'", "monitoringlocationid"),
    "activities": ("wq_activities", "r.activitystartdate < DATE '1996-01-01' AND r.conduct_uscm > 1000", "monitoringlocationid"),
    "stations": ("wq_stations", "r.locationtype = 'Spring'", "locationid"),
}


def _cross(source: str, target: str) -> None:
    table, cond, key = _SEL[source]
    other, _, other_key = _SEL[target]
    text = f"SELECT t.* FROM {other} t WHERE t.{other_key} IN (SELECT r.{key} FROM {table} r WHERE {cond})"

    def run(t):
        selected = getattr(t, source).alias("r").where(cond)
        return joins.cross_select(selected, getattr(t, target), key, other_key)

    query(f"cross_select_{source}_{target}", text)(run)


for _a in _SEL:
    for _b in _SEL:
        if _a != _b:
            _cross(_a, _b)

query("characteristic_group", """SELECT r.*, d.g AS characteristicgroup FROM wq_results r LEFT JOIN
 (SELECT registry_name AS n, max(characteristic_group_type) AS g FROM wq_domain GROUP BY 1) d ON d.n = r.characteristicname""")(
    lambda t: joins.characteristic_group(t.results, frames.domain(t))
)
query("missing_characteristics", "SELECT DISTINCT characteristicname FROM wq_results r WHERE NOT EXISTS (SELECT 1 FROM wq_domain d WHERE d.registry_name = r.characteristicname)")(
    lambda t: joins.missing_characteristics(t.results, frames.domain(t))
)
query("sample_station_lookup", """SELECT l.sample_number AS "Sample Number", l.param AS "Param Description", m.s AS "Station ID" FROM wq_state_lab l LEFT JOIN
 (SELECT sample_number, max(CAST(CAST(station_id AS BIGINT) AS VARCHAR)) AS s FROM wq_matches GROUP BY 1) m ON m.sample_number = l.sample_number""")(
    lambda t: joins.sample_station_lookup(
        frames.state_lab(t).select("Sample Number", "Param Description"), frames.matches(t)
    )
)
query("project_code", f"""SELECT r.*, s.code AS projectid FROM wq_results r LEFT JOIN
 (SELECT locationid, max({sql.case_of('qwnetworkname', vocab.PROJECT_CODES)}) AS code FROM wq_networks GROUP BY 1) s ON s.locationid = r.monitoringlocationid""")(
    lambda t: joins.project_code(t.results, t.networks)
)
query("substance_lookup", """SELECT r.*, s.epaname, s.w AS molecularweight, s.f AS molecularformula, s.k AS currentcasnumber FROM wq_results r LEFT JOIN
 (SELECT epaname, molecularweight AS w, molecularformula AS f, currentcasnumber AS k FROM wq_substances
  QUALIFY row_number() OVER (PARTITION BY epaname ORDER BY molecularweight DESC NULLS LAST, molecularformula DESC NULLS LAST, currentcasnumber DESC NULLS LAST) = 1) s ON s.epaname = r.characteristicname""")(
    lambda t: joins.substance_lookup(t.results, t.substances)
)
query("county_lookup", "SELECT name, county, row_number() OVER (ORDER BY name, county) - 1 AS position FROM wq_counties WHERE state='49'")(lambda t: numbered(joins.county_lookup(t.counties, "Utah")))
query("organization_lookup", 'SELECT descr AS "desc", value, row_number() OVER (ORDER BY descr, value) - 1 AS position FROM wq_organizations')(
    lambda t: numbered(joins.organization_lookup(t.organizations.withColumnRenamed("descr", "desc")))
)
