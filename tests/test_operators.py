"""Operators on small tables: ties, NULL keys, hot keys and plan shape."""

import pytest
from pyspark.sql import functions as F

from seepline.operators import filters, ions, joins, projection, reshape, stations
from seepline.operators.ranking import order_groups, repeat_rows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_membership_keeps_rows_without_key(spark):
    local = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "k string, n int")
    there = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(joins.to_upload(local, there, "k")) == [("b", 2), (None, 4)]
    assert rows(joins.flag_inwqx(local, there, "k")) == [("a", 1, 1), ("a", 3, 1), ("b", 2, 0), (None, 4, 0)]
    flagged = local.withColumn("inwqx", F.when(F.col("n") == 2, 1).otherwise(0))
    assert rows(joins.apply_inwqx(flagged, there, "k")) == [("a", 1, 1), ("a", 3, 1), ("b", 2, 1), (None, 4, 0)]
    # what is to upload and what is published cover the local rows
    left = joins.to_upload(local, there, "k").count()
    assert left + joins.cross_select(there, local, "k", "k").count() == local.count()


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 9), ("a", "x", 2), (None, "y", 5)], "k string, s string, n int")
    assert rows(reshape.one_per_key(df, ["k"])) == [("a", "x", 2), (None, "y", 5)]
    assert rows(reshape.one_per_key(df, ["k"], last=True)) == [("a", "x", 9), (None, "y", 5)]
    # combined in the map tasks, so a hot key is one row per task
    assert "partial_min" in plan(reshape.one_per_key(df, ["k"])) and "Window" not in plan(reshape.one_per_key(df, ["k"]))


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, None, "None")], "a int, b int, c int, e int, t string")
    assert projection.move_front(df, ["c", "b"]).columns == ["a", "b", "c", "e", "t"]
    assert projection.drop_empty_columns(df).columns == ["a", "b", "c", "t"]
    assert projection.none_to_null(df).first()["t"] is None


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([("1", "Well", 38.0, -112.0), ("2", None, 39.0, -111.0)],
                          "locationid string, locationtype string, latitude double, longitude double").write.parquet(path)
    df = spark.read.parquet(path)
    assert "PushedFilters: [IsNotNull(latitude)" in plan(filters.portal_bbox(df, -113, 37, -111.5, 40).select("locationid"))
    assert rows(filters.not_atmosphere(df).select("locationid")) == [("1",), ("2",)]
    assert rows(filters.portal_radius(df, 1, "mi", 38.0, -112.0).select("locationid")) == [("1",)]


def test_result_activity_fans_out(spark):
    results = spark.createDataFrame([("a", "pH"), ("b", "pH"), (None, "pH")], "activityid string, characteristicname string")
    acts = spark.createDataFrame([("a", "P1"), ("a", "P2")], "activityid string, projectid string")
    got = joins.result_activity(results, acts)
    assert rows(got.select("activityid", "projectid")) == [("a", "P1"), ("a", "P2"), ("b", None), (None, None)]
    assert {r["activitytype"] for r in got.collect()} == {"Sample-Routine"}
    assert joins.result_activity_view(results, acts).count() == 2


def test_pivot(spark):
    schema = "sampleid string, monitoringlocationid string, sampledate string, characteristicname string, resultvalue double, resultdetectioncondition string"
    data = [
        ("s", "2", "d1", "Calcium", 9.0, None), ("s", "1", "d2", "Calcium", 5.0, None), ("s", "1", "d2", " Chloride", 7.0, None),
        ("s", "1", "d0", "unknown", 1.0, None), ("s", "0", "d0", "Sulfate", 8.0, "Not Detected"), (None, "1", "d", "Calcium", 3.0, None),
        ("u", "1", "d", "unknown", 3.0, None),
    ]
    df = spark.createDataFrame(data, schema)
    got = {r["sampleid"]: r for r in reshape.pivot_samples(df, "").collect()}
    assert set(got) == {"s", "u"}
    s = got["s"]
    assert (s["sampledate"], s["monitoringlocationid"], s["Ca"], s["Cl"], s["SO4"]) == ("d0", "1", 5.0, 7.0, None)
    assert reshape.pivot_samples(df, ["Ca", "Cl"]).count() == 1 and reshape.pivot_samples(df).count() == 0


def test_water_type_ties_and_zero_ions(spark):
    df = spark.createDataFrame([(0.0, 0.0, None)], "Ca double, Mg double, Cl double")
    row = ions.balance(df).first()
    assert row["maj_cation"] == "Ca" and row["water_type"] == "Ca-Cl" and row["ClEC"] is None


def test_fractions_sum_to_one_and_corners_are_saturated(spark):
    df = spark.createDataFrame([(10.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0, 0.0), (3.0, 2.0, 5.0, 1.0, 5.0, 1.0, 4.0, 9.0)],
                               "Ca double, Mg double, Na double, K double, HCO3 double, CO3 double, Cl double, SO4 double")
    got = ions.piper(df, color=True).collect()
    for r in got:
        assert r["cat_ca"] + r["cat_mg"] + r["cat_nak"] == pytest.approx(1) and r["an_hco3"] + r["an_so4"] + r["an_cl"] == pytest.approx(1)
    assert got[0]["sat_cat"] == 1.0 and got[0]["sat_an"] == 1.0
    assert "Exchange" not in plan(ions.piper(df, color=True))


def test_stiff(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 2)], "NaK_meq double, Ca_meq double, Mg_meq double, SO4_meq double, HCO3_meq double, Cl_meq double, watertype int")
    got = ions.stiff_points(ions.stiff_polygon(df)).orderBy("corner").collect()
    assert [(r["x"], r["y"]) for r in got] == [(-1, 3), (-2, 2), (-3, 1), (4, 1), (5, 2), (6, 3), (-1, 3)]
    assert got[0]["fill"] == "b" and got[0]["marker_x"] is None


def test_extent_and_range(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 6.0)], "locationid string, latitude double, longitude double")
    none = df.where("locationid = 'z'")
    assert tuple(stations.station_extent(df, none).first()) == (2.0, 4.0, 1.0, 2.0, 3.0, 6.0)
    assert tuple(stations.station_extent(df, df.where("locationid = 'b'")).first()) == (2.0, 4.0, 3.0, 6.0, 3.0, 6.0)
    assert [r["var_norm"] for r in stations.variable_range(df, "latitude").orderBy("latitude").collect()] == [0.0, 1.0]


def test_segments_agree_with_windows(spark):
    from pyspark.sql import Window as W

    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), (F.col("id") * 7919 % 1009).cast("double").alias("v"))
    d, g = order_groups(df, ["k"], "v")
    d = g.add(d, [F.col("v").asc()], totals={"t": ("sum", F.col("v")), "m": ("max", F.col("v"))}, running={"up": ("sum", F.lit(1))})
    d = g.add(d, [F.col("v").desc()], running={"down": ("sum", F.col("v"))}, descending=True)
    group = W.partitionBy("k")
    want = df.select("k", "v", F.sum("v").over(group), F.max("v").over(group), F.count("v").over(group.orderBy("v")), F.sum("v").over(group.orderBy(F.desc("v"))))
    assert rows(d.select("k", "v", "t", "m", "up", "down")) == rows(want)


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 5), ("b", 1), ("c", 12)], "k string, n bigint")
    got = rows(repeat_rows(df, "n", "i", 18, ["k"], chunk=4).groupBy("k").agg(F.count("*"), F.min("i"), F.max("i"), F.count_distinct("i")))
    assert got == [("a", 5, 1, 5, 5), ("b", 1, 1, 1, 1), ("c", 12, 1, 12, 12)]


def test_lookups(spark):
    facts = spark.createDataFrame([("Iron",), ("Lead",), (None,)], "characteristicname string")
    dom = spark.createDataFrame([("Iron", "Metals"), ("Iron", "Metals")], "REGISTRY_NAME string, CHARACTERISTIC_GROUP_TYPE string")
    assert rows(joins.characteristic_group(facts, dom)) == [("Iron", "Metals"), ("Lead", None), (None, None)]
    assert rows(joins.missing_characteristics(facts, dom)) == [("Lead",), (None,)]
    lab = spark.createDataFrame([("1", "mud hole 2"), ("2", None)], "n string, d string")
    got = rows(joins.match_stations(lab, "d", "s").select("n", "s"))
    assert got == [("1", "395214112140301"), ("2", None)]


def test_attached_value_wins_over_null(spark):
    from seepline.operators import joins

    rows = spark.createDataFrame([("Nitrate",), ("Other",), (None,)], "characteristicname string")
    domain = spark.createDataFrame([("Nitrate", "Nutrient"), ("Nitrate", None), (None, "x")], "REGISTRY_NAME string, CHARACTERISTIC_GROUP_TYPE string")
    got = {tuple(r) for r in joins.characteristic_group(rows, domain).collect()}
    assert got == {("Nitrate", "Nutrient"), ("Other", None), (None, None)}


def test_attached_row_is_the_last_listed(spark):
    from seepline.operators import joins

    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    listed = spark.createDataFrame([("a", "z", 1), ("a", "b", 2), ("b", "q", None), ("b", "c", 0)], "k string, v string, line int")
    got = {tuple(r) for r in joins.attach(rows, listed, "k", "k", {"v": "v"}, order="line").collect()}
    assert got == {("a", "b"), ("b", "c")}


def test_radius_near_the_date_line(spark):
    from seepline.operators import filters

    rows = spark.createDataFrame([("a", 0.0, 179.9), ("b", 0.0, -179.9), ("c", 0.0, 170.0), ("d", 89.9, 10.0)], "locationid string, latitude double, longitude double")
    near = filters.portal_radius(rows, 30, "mi", 0.0, 179.95)
    assert {r["locationid"] for r in near.collect()} == {"a", "b"}
    assert {r["locationid"] for r in filters.portal_radius(rows, 30, "mi", 89.95, -170.0).collect()} == {"d"}
    assert {r["locationid"] for r in filters.portal_radius(rows, 30, "mi", 0.0, 170.1).collect()} == {"c"}


def test_a_pivot_makes_one_row_of_a_sample_before_it_moves_any(spark, monkeypatch):
    names = ["Calcium", " Calcium", "Calcium ", "Chloride", "Total Organic Carbon", "Alkalinity", "Alkalinity, total", "unknown", None]
    data = [
        (f"s{i % 40}", None if i % 13 == 0 else f"l{i % 3 if i % 40 > 30 else 1}", None if i % 17 == 0 else f"d{i % 5 if i % 40 > 20 else 2}",
         names[(i * 7 + i // 40) % 9], None if i % 5 == 0 else float(i * 37 % 11), "Not Detected" if i % 29 == 0 else None)
        for i in range(600)
    ]
    df = spark.createDataFrame(data, "sampleid string, monitoringlocationid string, sampledate string, characteristicname string, resultvalue double, resultdetectioncondition string")
    wide = reshape.pivot_samples(df, "")
    assert "SortAggregate" not in plan(wide)
    got = rows(wide)
    assert len(got) == 40
    first = {}
    for s, place, date, name, value, condition in data:
        if condition is None:
            key = tuple((x is None, x or 0) for x in (place, date, name, value))
            symbol = reshape.vocab.PARAMETER_SYMBOLS.get((name or "").strip(), "")
            first[s, symbol] = min(first.get((s, symbol), (key, value)), (key, value))
    symbols = reshape.vocab.SYMBOLS
    assert {(r["sampleid"], s): r[s] for r in wide.collect() for s in symbols if r[s] is not None} == {k: v for k, (_, v) in first.items() if k[1] and v is not None}
    # as many names as one likes
    monkeypatch.setattr(reshape, "NAMES_AT_ONCE", 2)
    assert rows(reshape.pivot_samples(df, "")) == got
    assert reshape.pivot_samples(df.where("characteristicname = 'unknown'"), "").count() == len({r[0] for r in data if r[3] == "unknown" and r[5] is None})


def test_laboratory_texts_are_read_before_the_lookups_move_rows(spark):
    from seepline.plans import lab

    headers = ["Sample Number", "Sample Date", "Sample Time", "Sample Description", "Collector", "Method Agency", "Method ID", "Matrix Description",
               "Result Value", "Lower Report Limit", "Method Detect Limit", "Units", "Analysis Date", "Param Description", "Problem Identifier", "Result Code"]
    sheet = spark.createDataFrame([("a", "2020-01-02 00:00:00", "9:30", "x", None, "SM", "1", "Water", "1.5", "1", "1", "MG-L", "2020-01-03 00:00:00", "Chloride", None, None)], ", ".join(f"`{h}` string" for h in headers))
    domain = spark.createDataFrame([("Chloride", "Inorganics")], "REGISTRY_NAME string, CHARACTERISTIC_GROUP_TYPE string")
    stations = spark.createDataFrame([("7", "Bryce")], "locationid string, qwnetworkname string")
    matches = spark.createDataFrame([("a", 7.0)], "`Sample Number` string, `Station ID` double")
    got = lab.state_lab_job(sheet, domain, stations, matches)
    row = got.first()
    assert (str(row["activitystartdate"]), row["resultvalue"], row["resultsamplefraction"], row["monitoringlocationid"]) == ("2020-01-02", 1.5, "Total", "7")
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = lines[max(i for i, line in enumerate(lines) if "Join " in line) :]
    assert any("AS Sample Date#" in line for line in below)
