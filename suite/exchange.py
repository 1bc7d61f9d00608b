"""Sources and sinks: views written to the shared folder and read back."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from seepline import vocab
from seepline.session import fresh_path
from seepline.sources import readers, writers
from suite import frames
from suite.base import query, read_table

c = F.col


def _landed_csv(t, df, stem, sep=","):
    path = fresh_path(t.spark, stem)
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', sep=sep, **kept).csv(path)
    return path


def _base(t, kind, df):
    root = fresh_path(t.spark, "base")
    df.write.parquet(f"{root}/{kind}")
    return readers.read_base_tables(
        t.spark, root, fields={"Result": ["activityid", "characteristicname", "resultvalue"]}, where={"Result": "resultunit = 'ug/L'"}, kinds=[kind]
    )[kind]


query("read_base_tables", "SELECT activityid, characteristicname, TRY_CAST(resultvalue AS DOUBLE) AS resultvalue FROM wq_results WHERE resultunit='ug/L'")(
    lambda t: _base(t, "Result", t.results)
)
query("read_base_tables_stations", "SELECT * FROM wq_stations")(lambda t: _base(t, "Station", t.stations))


@query(
    "read_lab_tsv",
    """SELECT 'SL' || l_orderkey AS "Sample Number", 'P' || l_partkey AS "Param Description", CASE WHEN l_returnflag<>'A' OR l_linenumber > 1 THEN CAST(l_quantity/4 AS VARCHAR) END AS "Result Value" FROM lineitem""",
)
def _(t):
    """File sets by return flag: with short rows, with columns in another order and one
    more, and plain; a file of other rows (one for each region) is excluded by name."""
    names = ["Sample Number", "Param Description", "Result Value"]
    rows = read_table(t.spark, t.folder, "lineitem").select(
        F.concat(F.lit("SL"), c("l_orderkey")).alias(names[0]), F.concat(F.lit("P"), c("l_partkey")).alias(names[1]),
        (c("l_quantity") / 4).cast("string").alias(names[2]), "l_returnflag", "l_linenumber",
    )
    flagged = {f: rows.where(c("l_returnflag") == f) for f in "ANR"}
    # a short row ends after its second field
    line = F.concat_ws("\t", *[c(n) for n in names[:2]], F.when(c("l_linenumber") > 1, c(names[2])))

    def headed(batches):
        for i, batch in enumerate(batches):
            if not i:
                yield pa.RecordBatch.from_pydict({"value": ["\t".join(names)]}, schema=batch.schema)
            yield batch

    short = fresh_path(t.spark, "lab-A")
    flagged["A"].select(line.alias("value")).mapInArrow(headed, "value string").write.text(short)
    other = read_table(t.spark, t.folder, "region").select(*[c("r_name").alias(n) for n in names]).coalesce(1)
    paths = [
        short,
        _landed_csv(t, flagged["R"].select(names[2], F.lit("x").alias("Lab"), names[0], names[1]), "lab-R", "\t"),
        _landed_csv(t, flagged["N"].select(*names), "lab-N", "\t"),
        _landed_csv(t, other, "lab-other", "\t"),
    ]
    file = F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1)
    left_out = t.spark.read.format("binaryFile").load(paths[-1]).select(file).first()[0]
    return readers.read_lab_tsv(t.spark, paths, names, exclude=[left_out]).drop("source_file")


@query(
    "read_portal_results",
    """SELECT org AS "OrganizationIdentifier", act AS "ActivityIdentifier", loc AS "MonitoringLocationIdentifier", chr AS "CharacteristicName", val AS "ResultMeasureValue",
    CAST(lim AS VARCHAR) AS "DetectionQuantitationLimitMeasure/MeasureValue", length(val)/2::DOUBLE AS "ActivityDepthHeightMeasure/MeasureValue" FROM wq_portal""",
)
def _(t):
    given = frames.portal_results(t).withColumn("ActivityDepthHeightMeasure/MeasureValue", F.length("ResultMeasureValue") / 2)
    blank = {n: F.lit(None).cast("string") for n in vocab.PORTAL_RESULT_COLUMNS if n not in given.columns}
    whole = given.withColumns(blank).select(*[F.col(f"`{n}`") for n in vocab.PORTAL_RESULT_COLUMNS])
    half = c("ActivityIdentifier").endswith("1")
    turned = whole.where(half).select(F.lit("-").alias("Added"), *[F.col(f"`{n}`") for n in reversed(whole.columns)])
    rows = readers.read_portal_results(
        t.spark, [_landed_csv(t, whole.where(~F.coalesce(half, F.lit(False))), "results"), _landed_csv(t, turned, "results-turned")]
    )
    shown = ["OrganizationIdentifier", "ActivityIdentifier", "MonitoringLocationIdentifier", "CharacteristicName", "ResultMeasureValue",
             "DetectionQuantitationLimitMeasure/MeasureValue", "ActivityDepthHeightMeasure/MeasureValue"]
    return rows.select(*[F.col(f"`{n}`") for n in shown])


query("read_portal_stations", """SELECT loc AS "MonitoringLocationIdentifier", name AS "MonitoringLocationName", typ AS "MonitoringLocationTypeName", huc AS "HUCEightDigitCode",
 lat AS "LatitudeMeasure", lon AS "LongitudeMeasure", elev AS "VerticalMeasure/MeasureValue", aquifer AS "AquiferName", country AS "CountryCode", provider AS "ProviderName" FROM wq_portal_stations""")(
    lambda t: readers.read_portal_stations(t.spark, _landed_csv(t, frames.portal_stations(t), "stations"), frames.portal_stations(t).columns)
)
query("read_lab_sheet", """SELECT laboratory AS "Laboratory", lab_number AS "LabNumber", sample_name AS "SampleName", method AS "Method", analyte AS "Analyte", report_limit AS "ReportLimit",
 nullif(val, '') AS "Result", qual AS "AnalyteQual", class AS "AnalysisClass", units AS "Units", CAST(sampled AS TIMESTAMP) AS "Sampled", CAST(analyzed AS TIMESTAMP) AS "Analyzed", batch AS "Batch" FROM wq_epa_lab""")(
    lambda t: readers.read_lab_sheet(t.spark, _landed_csv(t, frames.epa_lab(t), "sheet"), list(frames.EPA_LAB_HEADERS.values()))
)
query("read_characteristic_domain", """SELECT CAST(pk_isn AS VARCHAR) AS "PK_ISN", registry_name AS "REGISTRY_NAME", characteristic_group_type AS "CHARACTERISTIC_GROUP_TYPE", srs_id AS "SRS_ID", cas_number AS "CAS_NUMBER"
 FROM (SELECT *, row_number() OVER (PARTITION BY registry_name ORDER BY CAST(pk_isn AS VARCHAR) DESC) AS rn FROM wq_domain) WHERE rn=1""")(
    lambda t: readers.read_characteristic_domain(t.spark, _landed_csv(t, frames.domain(t), "domain"), frames.domain(t).columns)
)


@query(
    "flatten_features",
    "SELECT activityid, monitoringlocationid, temperature_c, conduct_uscm FROM wq_activities",
)
def _(t):
    """Pages of an answer, by location and range of 400 keys, so that none grows with its location."""
    feature = F.struct(F.struct("activityid", "monitoringlocationid", "temperature_c", "conduct_uscm").alias("attributes"))
    page = F.floor(F.regexp_extract("activityid", "([0-9]+)", 1).cast("long") / 400)
    answers = t.activities.groupBy("monitoringlocationid", page.alias("page")).agg(F.collect_list(feature).alias("features"))
    answers = answers.select(F.to_json(F.struct("features")).alias("answer"))
    return readers.flatten_features(
        answers, "answer", "activityid STRING, monitoringlocationid STRING, temperature_c DOUBLE, conduct_uscm DOUBLE"
    )


@query("write_dated_csv", "SELECT *, 'sheet_to_result_20200102030405' AS folder FROM wq_results")
def _(t):
    path = writers.write_dated_csv(t.results, fresh_path(t.spark, "out"), "sheet_to_result", datetime(2020, 1, 2, 3, 4, 5))
    return t.spark.read.schema(t.results.schema).option("header", True).csv(path).withColumn("folder", F.lit(path.rsplit("/", 1)[1]))


@query(
    "to_geojson",
    """SELECT locationid, 'EPSG:4326' AS crs, CASE WHEN latitude IS NOT NULL THEN 'POINT (' || longitude || ' ' || latitude || ')' END AS wkt,
    '{"type":"Feature","geometry":' || CASE WHEN latitude IS NULL THEN 'null' ELSE '{"type":"Point","coordinates":[' || longitude || ',' || latitude || ']}' END
    || ',"properties":{"locationid":"' || locationid || '","locationname":"' || locationname || '","latitude":' || coalesce(latitude::VARCHAR, 'null') || ',"longitude":' || longitude || '}}' AS feature FROM wq_sites""",
)
def _(t):
    return writers.to_geojson(t.sites.select("locationid", "locationname", "latitude", "longitude")).select("locationid", "feature", "wkt", "crs")
