"""Cleaning rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import colors, places, species, values
from seepline.functions.normal import normal_quantile
from seepline.operators import joins
from suite import sql
from suite.base import query, read_table

c = F.col


@query("fix_datetime", f"SELECT act, act_date, act_time, {sql.date_time('act_date', 'act_time')} AS sampledate FROM wq_portal")
def _(t):
    return t.portal.select("act", "act_date", "act_time", values.fix_datetime(c("act_date"), c("act_time")).alias("sampledate"))


@query("parse_number", f"SELECT val, {sql.number('val')} AS num, {sql.number('lim')} AS lim_num FROM wq_portal")
def _(t):
    return t.portal.select("val", values.parse_number(c("val")).alias("num"), values.parse_number(c("lim")).alias("lim_num"))


@query(
    "split_censored",
    f"""SELECT activityid AS id, resultvalue AS txt, {sql.censored_value('resultvalue')} AS value, {sql.condition('resultvalue')} AS condition,
    {sql.limit_type('resultvalue')} AS limit_type FROM wq_results
    UNION ALL SELECT lab_number, val, {sql.censored_value('val')}, {sql.condition('val')}, {sql.limit_type('val')} FROM wq_epa_lab""",
)
def _(t):
    rows = t.results.select(c("activityid").alias("id"), c("resultvalue").alias("txt")).unionByName(
        t.epa_lab.select(c("lab_number").alias("id"), c("val").alias("txt"))
    )
    return rows.withColumn("s", values.split_censored(c("txt"))).select("id", "txt", "s.*")


@query(
    "result_qualifier",
    f"SELECT lab_number, CASE WHEN qual IS NOT NULL THEN qual WHEN val LIKE '%<%' THEN 'BRL' END AS resultqualifier FROM wq_epa_lab",
)
def _(t):
    condition = values.split_censored(c("val")).getField("condition")
    return t.epa_lab.select("lab_number", values.result_qualifier(condition, c("qual")).alias("resultqualifier"))


@query(
    "state_detection",
    """SELECT problem, code, CASE WHEN problem='<' THEN 'Below Reporting Limit' WHEN problem='>' THEN 'Above Operating Range'
    WHEN problem IS NULL AND code='U' THEN 'Not Detected' END AS condition FROM wq_state_lab""",
)
def _(t):
    return t.state_lab.select("problem", "code", values.state_detection(c("problem"), c("code")).alias("condition"))


@query("clean_method", f"SELECT lab_number, method, {sql.clean_method('method')} AS cleaned FROM wq_epa_lab")
def _(t):
    return t.epa_lab.select("lab_number", "method", values.clean_method(c("method")).alias("cleaned"))


@query("method_context", "SELECT agency, CASE WHEN agency='SM' THEN 'APHA' ELSE 'USEPA' END AS context FROM wq_state_lab")
def _(t):
    return t.state_lab.select("agency", values.method_context(c("agency")).alias("context"))


@query(
    "sample_fraction",
    """SELECT matrix AS txt, CASE WHEN trim(matrix)='Water, Filtered' THEN 'Dissolved' ELSE 'Total' END AS fraction, CAST(NULL AS VARCHAR) AS corrected FROM wq_state_lab
    UNION ALL SELECT class, 'Total', CASE WHEN class LIKE '%WET%' THEN 'Total' ELSE class END FROM wq_epa_lab""",
)
def _(t):
    state = t.state_lab.select(
        c("matrix").alias("txt"), values.state_sample_fraction(c("matrix")).alias("fraction"),
        F.lit(None).cast("string").alias("corrected"),
    )
    epa = t.epa_lab.select(
        c("class").alias("txt"), values.epa_sample_fraction(c("class")).alias("fraction"),
        values.epa_sample_fraction(c("class"), corrected=True).alias("corrected"),
    )
    return state.unionByName(epa)


@query(
    "normalize_lab_unit",
    f"""SELECT 'state' AS lab, units, {sql.case_of('units', vocab.STATE_UNITS, 'units')} AS unit FROM wq_state_lab
    UNION ALL SELECT 'epa', units, {sql.case_of('units', vocab.EPA_UNITS, 'units')} FROM wq_epa_lab""",
)
def _(t):
    def one(df, lab):
        return df.select(F.lit(lab).alias("lab"), "units", values.normalize_lab_unit(c("units"), lab).alias("unit"))

    return one(t.state_lab, "state").unionByName(one(t.epa_lab, "epa"))


@query(
    "ugl_to_mgl",
    f"SELECT unit, {sql.number('lim')} AS raw, CASE WHEN lower(rtrim(unit))='ug/l' THEN ({sql.number('lim')})/1000 ELSE {sql.number('lim')} END AS mgl FROM wq_portal",
)
def _(t):
    raw = values.parse_number(c("lim"))
    return t.portal.select("unit", raw.alias("raw")).withColumn("mgl", values.ugl_to_mgl(c("raw"), c("unit")))


@query(
    "unit_label",
    "SELECT unit, CASE WHEN lower(rtrim(unit)) IN ('ug/l','mg/l') THEN 'mg/l' ELSE rtrim(unit) END AS label FROM wq_portal",
)
def _(t):
    return t.portal.select("unit", values.unit_label(values.rstrip(c("unit"))).alias("label"))


def _speciation_sql():
    r = sql.nutrient("chr", "unit")
    return f"""SELECT chr, unit AS given, {sql.NUTRIENT_NAME.format(r='k', n='chr')} AS name, {sql.NUTRIENT_FORM.format(r='k')} AS speciation,
    CASE WHEN k IN (3,5) AND k=5 THEN 'as P' ELSE {sql.NUTRIENT_FORM.format(r='k')} END AS corrected,
    CASE WHEN k IS NOT NULL THEN 'mg/l' ELSE unit END AS unit FROM (SELECT *, {r} AS k FROM wq_portal)"""


@query("method_speciation", _speciation_sql())
def _(t):
    return t.portal.select(
        "chr", c("unit").alias("given"),
        species.method_speciation(c("chr"), c("unit")).alias("s"),
        species.method_speciation(c("chr"), c("unit"), corrected=True).getField("speciation").alias("corrected"),
    ).select("chr", "given", "s.*", "corrected")


@query(
    "convert_species",
    f"""SELECT chr, {sql.NUTRIENT_NAME.format(r='k', n='chr')} AS name,
    CASE WHEN k IS NOT NULL THEN num * {sql.NUTRIENT_FACTOR.format(r='k')} WHEN lower(trim(unit))='ug/l' THEN num/1000 ELSE num END AS value,
    CASE WHEN k IS NOT NULL OR lower(trim(unit))='ug/l' THEN 'mg/l' ELSE rtrim(unit) END AS unit
    FROM (SELECT *, {sql.nutrient('chr', 'unit')} AS k, {sql.number('lim')} AS num FROM wq_portal)""",
)
def _(t):
    num = t.portal.select("chr", "unit", values.parse_number(c("lim")).alias("num"))
    return num.select("chr", species.convert_species(c("chr"), c("num"), c("unit")).alias("s")).select("chr", "s.*")


@query("epa_speciation", f"SELECT lab_number, {sql.epa_name('analyte')} AS name, {sql.epa_form('analyte')} AS speciation FROM wq_epa_lab")
def _(t):
    return t.epa_lab.select("lab_number", species.epa_speciation(c("analyte")).alias("s")).select("lab_number", "s.*")


@query(
    "state_speciation",
    f"""SELECT param, {sql.state_name('param')} AS name, {sql.state_form('param')} AS speciation,
    {sql.state_name('full_name')} AS corrected_name, {sql.state_form('full_name')} AS corrected_speciation
    FROM (SELECT param, {sql.case_of('trim(param)', vocab.STATE_ABBREVIATIONS, 'param')} AS full_name FROM wq_state_lab)""",
)
def _(t):
    return t.state_lab.select(
        "param", species.state_speciation(c("param")).alias("s"), species.state_speciation(c("param"), corrected=True).alias("k")
    ).select("param", "s.*", c("k.name").alias("corrected_name"), c("k.speciation").alias("corrected_speciation"))


@query("param_abbrev", f"SELECT chr, {sql.case_of('trim(chr)', vocab.PARAMETER_SYMBOLS, chr(39) * 2)} AS symbol FROM wq_portal")
def _(t):
    return t.portal.select("chr", species.param_abbrev(c("chr")).alias("symbol"))


@query("activity_type", "SELECT activityid, CASE WHEN activityid LIKE '%-FM%' THEN 'Field Msr/Obs' ELSE 'Sample-Routine' END AS activitytype FROM wq_activities")
def _(t):
    return t.activities.select("activityid", values.activity_type(c("activityid")).alias("activitytype"))


@query(
    "alt_location",
    """SELECT locationid, CASE WHEN usgs_id IS NOT NULL THEN usgs_id WHEN win IS NOT NULL THEN win ELSE wrnum END AS altlocationid,
    CASE WHEN usgs_id IS NOT NULL THEN 'usgs_id' WHEN win IS NOT NULL THEN 'Utah Well ID' WHEN wrnum IS NOT NULL THEN 'Utah Water Rights Number' END AS altlocationcontext FROM wq_stations""",
)
def _(t):
    return t.stations.select("locationid", places.alt_location(c("usgs_id"), c("win"), c("wrnum")).alias("a")).select("locationid", "a.*")


@query("station_type", f"SELECT name, {sql.case_of('typ', vocab.STATION_TYPES, 'typ')} AS locationtype FROM wq_portal_stations")
def _(t):
    return t.portal_stations.select("name", places.station_type(c("typ")).alias("locationtype"))


# the text of a double with one digit is rounded exactly, half to even
@query("vertical_measure", "SELECT name, CASE WHEN elev<>0 THEN CAST(format('{:.1f}', elev) AS DOUBLE) END AS verticalmeasure FROM wq_portal_stations")
def _(t):
    return t.portal_stations.select("name", values.vertical_measure(c("elev")).alias("verticalmeasure"))


@query("strip_wqx", "SELECT replace(loc, '_WQX-', '-') AS locationid FROM wq_portal")
def _(t):
    return t.portal.select(values.strip_wqx(c("loc")).alias("locationid"))


@query("strip_org_prefix", "SELECT replace(activityid, 'UTAHGS-', '') AS activityid, replace(monitoringlocationid, 'UTAHGS-', '') AS monitoringlocationid FROM wq_published")
def _(t):
    return t.published.select(
        values.strip_org_prefix(c("activityid")).alias("activityid"),
        values.strip_org_prefix(c("monitoringlocationid")).alias("monitoringlocationid"),
    )


@query("unique_id", "SELECT coalesce(loc,'None') || '-' || coalesce(act,'None') || '-' || coalesce(chr,'None') AS uniqueid FROM wq_portal")
def _(t):
    return t.portal.select(values.unique_id(c("loc"), c("act"), c("chr")).alias("uniqueid"))


@query("result_id", "SELECT sample_number || '-' || coalesce(param,'None') AS resultid FROM wq_state_lab")
def _(t):
    return t.state_lab.select(values.result_id(c("sample_number"), c("param")).alias("resultid"))


@query(
    "split_sample_time",
    """SELECT lab_number AS id, strftime(CAST(sampled AS TIMESTAMP), '%Y-%m-%d') AS day, strftime(CAST(sampled AS TIMESTAMP), '%H:%M') AS clock, CAST(left(analyzed, 10) AS DATE) AS analysis FROM wq_epa_lab
    UNION ALL SELECT sample_number, left(sample_date, 10), sample_time, CAST(left(analysis_date, 10) AS DATE) FROM wq_state_lab""",
)
def _(t):
    when = c("sampled").cast("timestamp_ntz")
    epa = t.epa_lab.select(
        c("lab_number").alias("id"), values.sample_date_text(when).alias("day"), values.sample_time_text(when).alias("clock"),
        values.date_before_blank(c("analyzed")).alias("analysis"),
    )
    state = t.state_lab.select(
        c("sample_number").alias("id"), values.date_before_blank(c("sample_date")).cast("string").alias("day"),
        c("sample_time").alias("clock"), values.date_before_blank(c("analysis_date")).alias("analysis"),
    )
    return epa.unionByName(state)


@query("station_id_text", "SELECT sample_number, CAST(CAST(400000000000000 + station_id AS BIGINT) AS VARCHAR) AS station FROM wq_matches")
def _(t):
    return t.matches.select("sample_number", values.station_id_text(F.lit(4e14) + c("station_id")).alias("station"))


@query("field_activity_id", "SELECT activityid || '-FM' AS activityid FROM wq_activities")
def _(t):
    return t.activities.select(values.field_activity_id(c("activityid")).alias("activityid"))


@query("marker_icon", f"SELECT locationid, {sql.case_of('locationtype', vocab.MARKER_ICONS, chr(39) + 'bullseye' + chr(39))} AS icon FROM wq_stations")
def _(t):
    return t.stations.select("locationid", places.marker_icon(c("locationtype")).alias("icon"))


@query(
    "distance_to_miles",
    """SELECT l_quantity AS distance, u AS unit, l_quantity * CASE u WHEN 'mi' THEN 1::DOUBLE WHEN 'km' THEN 0.621371::DOUBLE WHEN 'm' THEN 0.000621371::DOUBLE WHEN 'ft' THEN 0.000189394::DOUBLE END AS miles
    FROM (SELECT l_quantity, CASE l_partkey%5 WHEN 0 THEN 'mi' WHEN 1 THEN 'km' WHEN 2 THEN 'm' WHEN 3 THEN 'ft' ELSE 'yd' END AS u FROM lineitem)""",
)
def _(t):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("mi", "km", "m", "ft", "yd")]), (c("l_partkey") % 5 + 1).cast("int"))
    rows = read_table(t.spark, t.folder, "lineitem").select(c("l_quantity").alias("distance"), unit.alias("unit"))
    return rows.withColumn("miles", values.distance_to_miles(c("distance"), c("unit")))


@query("rgb_hex", "SELECT sampleid, format('#{:02x}{:02x}{:02x}', CAST(Ca AS INT), CAST(HCO3 AS INT), CAST(K AS INT)) AS hex FROM wq_majors")
def _(t):
    return t.majors.select("sampleid", colors.rgb_hex(c("Ca"), c("HCO3"), c("K")).alias("hex"))


def _hsv_sql():
    return """SELECT sampleid, round(r, 9) AS r, round(g, 9) AS g, round(b, 9) AS b FROM (
    SELECT sampleid, v - cc + CASE WHEN k IN (0,5) THEN cc WHEN k IN (1,4) THEN x ELSE 0 END AS r,
    v - cc + CASE WHEN k IN (1,2) THEN cc WHEN k IN (0,3) THEN x ELSE 0 END AS g,
    v - cc + CASE WHEN k IN (3,4) THEN cc WHEN k IN (2,5) THEN x ELSE 0 END AS b
    FROM (SELECT sampleid, v, v*s AS cc, v*s*(1-abs((h/(pi()/3)) % 2 - 1)) AS x, floor(h/(pi()/3)) AS k
    FROM (SELECT sampleid, HCO3/37::DOUBLE AS h, Cl/100 AS s, Mg/40 AS v FROM wq_majors)))"""


@query("hsv_to_rgb", _hsv_sql())
def _(t):
    rgb = colors.hsv_to_rgb(c("HCO3") / 37.0, c("Cl") / 100.0, c("Mg") / 40.0)
    return t.majors.select("sampleid", rgb.alias("k")).select("sampleid", *[F.round(f"k.{x}", 9).alias(x) for x in "rgb"])


@query("normal_quantile", f"SELECT sampleid, p, round({sql.quantile('p')}, 9) AS z FROM (SELECT sampleid, (Ca-20.5::DOUBLE)/50 AS p FROM wq_majors)")
def _(t):
    rows = t.majors.select("sampleid", ((c("Ca") - 20.5) / 50.0).alias("p"))
    return normal_quantile(rows, "p", "z").withColumn("z", F.round("z", 9))


_RULES = f"""WITH d AS (SELECT DISTINCT description FROM wq_state_lab), m AS (SELECT d.description, arg_max(r.station, r.ord) AS station FROM d, {sql.rules_table()} WHERE regexp_matches(d.description, r.pattern) GROUP BY 1),
    k AS (SELECT d.description, arg_max(r.station, r.ord) AS station FROM d, {sql.rules_table(True)} WHERE regexp_matches(d.description, r.pattern) GROUP BY 1)
    SELECT s.sample_number, s.description, m.station, k.station AS corrected FROM wq_state_lab s LEFT JOIN m ON s.description=m.description LEFT JOIN k ON s.description=k.description"""


@query("match_station_rules", _RULES)
def _(t):
    once = joins.match_stations(t.state_lab.select("sample_number", "description"), "description", "station")
    return joins.match_stations(once, "description", "corrected", corrected=True)


@query("match_station_rules_by_row", _RULES)
def _(t):
    once = joins.match_stations_by_row(t.state_lab.select("sample_number", "description"), "description", "station")
    return joins.match_stations_by_row(once, "description", "corrected", corrected=True)


@query(
    "match_station_exact",
    f"SELECT sample_number, description, {sql.case_of('description', vocab.STATION_NAMES)} AS station FROM wq_state_lab",
)
def _(t):
    return t.state_lab.select("sample_number", "description", places.match_station_exact(c("description")).alias("station"))
