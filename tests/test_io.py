"""Readers and writers on files as the sources deliver them."""

import gzip
import json
from datetime import datetime

import pytest

from seepline import vocab
from seepline.plans import lab as lab_plan
from seepline.plans import portal
from seepline.sources import readers, writers


def test_lab_tsv_drops_long_rows_and_excluded_files(spark, tmp_path):
    (tmp_path / "EDD_1.txt").write_text("A\tB\n1\tx\n2\ty\tz\tq\n3\tw\n4\n5\tv\t\n")
    (tmp_path / "EDD_2.txt").write_text("A\tB\n9\tx\n")
    (tmp_path / "EDD_3.txt").write_text("")
    df = readers.read_lab_tsv(spark, str(tmp_path / "*.txt"), ["A", "B"], exclude=["EDD_2"])
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x", "EDD_1"), ("3", "w", "EDD_1"), ("4", None, "EDD_1")]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_lab_tsv(spark, str(tmp_path / "*.txt"), ["A", "B"], drop_bad=False).collect()


def test_lab_files_are_read_by_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("A\tB\n1\tx\n")
    (tmp_path / "b.txt").write_text("B\tNew\tA\ny\tn\t2\nz\n")
    (tmp_path / "c.txt").write_text("A\n3\n")
    df = readers.read_lab_tsv(spark, str(tmp_path / "*.txt"), ["A", "B"])
    assert {tuple(r) for r in df.collect()} == {("1", "x", "a"), ("2", "y", "b"), (None, "z", "b"), ("3", None, "c")}


def test_stations_are_read_by_header(spark, tmp_path):
    names = ["MonitoringLocationIdentifier", "LatitudeMeasure", "LongitudeMeasure"]
    (tmp_path / "a.csv").write_text(",".join(names) + "\nX-1,40.5,-112\n")
    (tmp_path / "b.csv").write_text('Extra,LongitudeMeasure,"LatitudeMeasure",MonitoringLocationIdentifier\n"a,b",-111,39.5,X-2\n')
    got = readers.read_portal_stations(spark, str(tmp_path), names)
    assert {tuple(r) for r in got.collect()} == {("X-1", 40.5, -112.0), ("X-2", 39.5, -111.0)}
    assert got.columns == names and dict(got.dtypes)["LatitudeMeasure"] == "double"


def test_no_files_with_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert readers.read_portal_stations(spark, str(tmp_path), ["MonitoringLocationIdentifier"]).count() == 0


def test_connection_options_by_table():
    source = {"url": "jdbc:x", "fetchsize": "100", "Result": {"partitionColumn": "objectid", "numPartitions": "40", "fetchsize": "9"}, "Station": {"partitionColumn": "sid"}}
    assert readers._options(source, "Activity") == {"url": "jdbc:x", "fetchsize": "100"}
    assert readers._options(source, "Result") == {"url": "jdbc:x", "fetchsize": "9", "partitionColumn": "objectid", "numPartitions": "40"}
    assert readers._options(source, "Station") == {"url": "jdbc:x", "fetchsize": "100", "partitionColumn": "sid"}


def test_base_tables_take_the_types_of_their_schema(spark, tmp_path):
    spark.createDataFrame([("1", "7", "x")], "locationid string, latitude string, other string").write.parquet(str(tmp_path / "Station"))
    got = readers.read_base_tables(spark, str(tmp_path), kinds=["Station"])["Station"]
    assert dict(got.dtypes) == {"locationid": "string", "latitude": "double", "other": "string"} and got.first()["latitude"] == 7.0
    spark.createDataFrame([((1,),)], "latitude struct<a:int>").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(TypeError, match="latitude"):
        readers.read_base_tables(spark, str(tmp_path), names={"Station": "bad"}, kinds=["Station"])


def test_portal_results_from_gzip(spark, tmp_path):
    row = {n: "" for n in vocab.PORTAL_RESULT_COLUMNS}
    row.update({
        "ActivityIdentifier": "A1", "ActivityStartDate": "2019-03-04", "ActivityStartTime/Time": "9:30", "MonitoringLocationIdentifier": "X_WQX-1",
        "CharacteristicName": "Nitrate", "ResultMeasureValue": "2.5", "ResultMeasure/MeasureUnitCode": "mg/l as N",
        "ResultCommentText": '"a ""quoted"" note, with comma"', "ActivityDepthHeightMeasure/MeasureValue": "1.5",
    })
    text = ",".join(row) + "\n" + ",".join(row.values()) + "\n"
    with gzip.open(tmp_path / "r.csv.gz", "wt") as f:
        f.write(text)
    df = readers.read_portal_results(spark, str(tmp_path / "r.csv.gz"))
    got = df.first()
    assert got["ResultCommentText"] == 'a "quoted" note, with comma' and got["ActivityDepthHeightMeasure/MeasureValue"] == 1.5
    clean = portal.clean_results(df).first()
    assert clean["sampledate"] == datetime(2019, 3, 4, 9, 30) and clean["monitoringlocationid"] == "X-1"
    assert (clean["characteristicname"], clean["methodspeciation"], clean["resultunit"]) == ("Nitrate", "as N", "mg/l")
    assert "sampletime" in clean.asDict() and "ProviderName" not in clean.asDict()


def test_dated_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, " padded "), (2, None)], "n int, t string")
    path = writers.write_dated_csv(df, str(tmp_path), "upload", datetime(2020, 1, 2, 13, 4, 5))
    assert path.endswith("upload_20200102130405")
    back = spark.read.option("header", True).csv(path).orderBy("n").collect()
    assert [tuple(r) for r in back] == [("1", " padded "), ("2", None)]


def test_geojson(spark):
    df = spark.createDataFrame([("a", 38.5, -112.0), ("b", None, None)], "locationid string, latitude double, longitude double")
    got = [json.loads(r["feature"]) for r in writers.to_geojson(df).orderBy("locationid").collect()]
    assert got[0]["geometry"] == {"type": "Point", "coordinates": [-112.0, 38.5]} and got[1]["geometry"] is None
    assert got[0]["properties"] == {"locationid": "a", "latitude": 38.5, "longitude": -112.0}


def test_features(spark):
    text = json.dumps({"features": [{"attributes": {"NAME": "Utah", "COUNTY": "049"}}, {"attributes": {"NAME": "Kane", "COUNTY": "025"}}]})
    df = spark.createDataFrame([(text,), ('{"features": []}',)], "j string")
    assert [tuple(r) for r in readers.flatten_features(df, "j", "NAME STRING, COUNTY STRING").collect()] == [("Utah", "049"), ("Kane", "025")]


def test_database_rows(spark):
    sheet = spark.createDataFrame(
        [("E1", "10", "EPA 300.0", "Nitrate as N", 0.1, "<0.5", None, "WET", "mg/L", "2019-03-04 09:05:00", "2019-03-06 00:00:00"),
         ("E1", "10", "2320B", "Iron", 0.1, "4.5", "J", "MET", "ug/L", "2019-03-04 09:05:00", "2019-03-06 00:00:00")],
        "LabNumber string, SampleName string, Method string, Analyte string, ReportLimit double, Result string, AnalyteQual string, AnalysisClass string, Units string, Sampled string, Analyzed string",
    ).selectExpr("* except (Sampled, Analyzed)", "cast(Sampled as timestamp_ntz) Sampled", "cast(Analyzed as timestamp_ntz) Analyzed", "'EPA' as Laboratory")
    domain = spark.createDataFrame([("Iron", "Metals")], "REGISTRY_NAME string, CHARACTERISTIC_GROUP_TYPE string")
    rows = lab_plan.epa_lab_job(sheet, domain)
    none = spark.createDataFrame([], "activityid string")
    out = lab_plan.database_rows(rows, none, none, "me", "2020-01-02 03:04:05")
    acts, results = out["Activity"].collect(), {r["characteristicname"]: r for r in out["Result"].collect()}
    assert len(acts) == 1 and acts[0]["activitystarttime"] == "09:05" and acts[0]["created_user"] == "me"
    assert results["Nitrate"]["resultvalue"] is None and results["Nitrate"]["resultdetectioncondition"] == "Below Reporting Limit"
    assert results["Iron"]["characteristicgroup"] == "Metals" and results["Iron"]["resultvalue"] == 4.5
    known = spark.createDataFrame([("E1",)], "activityid string")
    assert lab_plan.database_rows(rows, known, known, "me", "2020-01-02 03:04:05")["Result"].count() == 0
