"""Tables landed by date and place, and tables updated by key."""

import json
import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from seepline import vocab
from seepline.operators import filters, joins, reshape
from seepline.plans import publish
from seepline.sources import buckets, keyed, landing, readers

c = F.col


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(df):
    """Files that the scan opens after its folders are pruned, by its own count."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    scan = run.executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numFiles").value()


# --- by date


def test_dates_open_only_their_folders(spark, tmp_path):
    data = [(i, date(2000 + i % 6, 1 + i % 12, 1 + i % 28)) for i in range(2000)] + [(9999, None)]
    df = spark.createDataFrame(data, "n int, activitystartdate date")
    for unit in ("day", "month", "year"):
        path = str(tmp_path / unit)
        landing.land_by_date(df, path, unit=unit)
        for low, high in (("2001-03-05", "2001-03-20"), ("2000-12-31", "2002-01-01"), ("1990-01-01", "2030-01-01"), ("2003-05-01", "2003-04-01")):
            got = landing.landed_dates(spark, path, low, high, unit=unit)
            assert got.columns == ["n", "activitystartdate"]
            assert rows(got) == rows(filters.portal_dates(df, low, high))
        one = landing.landed_dates(spark, path, "2001-03-05", "2001-03-20", unit=unit)
        assert "PartitionFilters: [isnotnull(landed_day" in plan(one)
        assert files(one) < files(spark.read.parquet(path)) / 5
    # rows without a date are kept
    assert spark.read.parquet(str(tmp_path / "day")).count() == len(data)


# --- by place


def far(lat1, lon1, lat2, lon2):
    return vocab.EARTH_RADIUS_MILES * landing._angle(math.radians(lat1), math.radians(lat2), math.radians(lon1 - lon2))


def covered(runs, cell):
    return any(a <= cell <= b for a, b in runs)


@pytest.mark.parametrize("lat,lon", [(39.5, -112.0), (0.0, 179.95), (0.0, -180.0), (89.9, 12.0), (-89.99, -170.0), (66.0, 180.0), (90.0, 0.0), (-45.0, 0.0)])
def test_cells_of_a_circle_hold_all_of_it(lat, lon):
    """Points in the circle, at its edge above all, are in its cells; few far ones are."""
    rng = random.Random(3)
    for miles in (0.01, 1.0, 30.0, 400.0, 5000.0, 13000.0):
        runs = landing.circle_cells(lat, lon, miles)
        assert 0 < len(runs) <= landing.RANGES
        for _ in range(300):
            angle = miles / vocab.EARTH_RADIUS_MILES * rng.choice([1.0, 0.999999, rng.random()])
            turn, phi = rng.random() * 2 * math.pi, math.radians(lat)
            at = math.asin(max(-1, min(1, math.sin(phi) * math.cos(angle) + math.cos(phi) * math.sin(angle) * math.cos(turn))))
            side = math.atan2(math.sin(turn) * math.sin(angle) * math.cos(phi), math.cos(angle) - math.sin(phi) * math.sin(at))
            p = (math.degrees(at), (lon + math.degrees(side) + 180) % 360 - 180)
            assert covered(runs, plain_cell(*p)), (miles, p)
        share = sum(b - a + 1 for a, b in runs) / 4**landing.BITS
        if abs(lat) < 80 and miles <= 400:
            assert share < 0.02


def plain_cell(lat, lon):
    size = 1 << landing.BITS
    x = min(int((lon + 180) % 360 / 360 * size), size - 1)
    y = max(0, min(int((lat + 90) / 180 * size), size - 1))
    return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(landing.BITS))


def test_distance_to_a_box():
    rng = random.Random(1)
    for _ in range(300):
        s, w = rng.uniform(-90, 80), rng.uniform(-180, 170)
        box = (s, w, rng.uniform(s, 90), rng.uniform(w, 180))
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        least = min(far(lat, lon, box[0] + (box[2] - box[0]) * i / 40, box[1] + (box[3] - box[1]) * j / 40) for i in range(41) for j in range(41)) / vocab.EARTH_RADIUS_MILES
        got = landing._distance(lat, lon, box)
        assert got <= least + 1e-9 and least - got < 0.12


@pytest.fixture(scope="module")
def stations(spark, tmp_path_factory):
    rng = random.Random(9)
    data = [(i, rng.uniform(37, 42), rng.uniform(-114, -109)) for i in range(6000)]
    data += [(10_000 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(2000)]
    data += [(20_000 + i, rng.choice([90.0, -90.0, 89.97, 0.0, 66.0]), rng.choice([180.0, -180.0, 179.99, -179.99, 0.0, 190.0])) for i in range(200)]
    data += [(30_000, None, 5.0), (30_001, 5.0, None), (30_002, None, None), (30_003, float("nan"), 1.0)] + [(40_000 + i, 39.5, -112.0) for i in range(500)]
    df = spark.createDataFrame(data, "locationid int, latitude double, longitude double").repartition(4)
    path = str(tmp_path_factory.mktemp("places") / "landed")
    landing.land_by_place(df, path)
    return df, path


@pytest.mark.parametrize("lat,lon,distance", [(39.5, -112.0, 15), (39.5, -112.0, 150), (0.0, 179.95, 60), (89.95, -170.0, 400), (-90.0, 0.0, 900), (66.0, -180.0, 1200), (10.0, 10.0, 25_000)])
def test_same_stations_as_the_distance(spark, stations, lat, lon, distance):
    df, path = stations
    got = landing.landed_radius(spark, path, distance, "km", lat, lon)
    assert rows(got) == rows(filters.portal_radius(df, distance, "km", lat, lon))
    assert got.columns == df.columns


@pytest.mark.parametrize("box", [(-113.5, 38.0, -111.0, 40.5), (-180, -90, 180, 90), (170.0, -10.0, 180.0, 10.0), (150.0, -90.0, 200.0, 100.0), (185.0, 0.0, 195.0, 90.0), (5.0, 5.0, 4.0, 6.0), (-112.0, 39.5, -112.0, 39.5)])
def test_same_stations_as_the_box(spark, stations, box):
    df, path = stations
    assert rows(landing.landed_bbox(spark, path, *box)) == rows(filters.portal_bbox(df, *box))


def test_files_are_skipped_by_place(spark, stations):
    df, path = stations
    near = landing.landed_radius(spark, path, 15, "km", 39.5, -112.0)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = plan(near)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [((tile" in text or "PartitionFilters: [(((tile" in text or "PartitionFilters: [isnotnull(tile" in text
    assert "GreaterThanOrEqual(cell," in text and "LessThanOrEqual(cell," in text
    assert files(near) < files(spark.read.parquet(path)) / 10
    assert spark.read.parquet(path).count() == df.count()


# --- by key


SCHEMA = "k string, v int, flag int"


def table(spark, tmp_path, data, **more):
    df = spark.createDataFrame(data, SCHEMA)
    made = keyed.KeyedTable(spark, str(tmp_path / "t"), "k", df.schema, **more)
    made.create(df)
    return made


def plain_merge(data, changes, update, insert):
    first = {}
    for row in sorted(changes, key=lambda r: tuple((x is None, x) for x in r)):
        if row[0] is not None:
            first.setdefault(row[0], dict(zip(("k", "v", "flag"), row, strict=True)))
    out = []
    for k, v, f in data:
        row = {"k": k, "v": v, "flag": f}
        if k in first:
            row |= {u: first[k][u] for u in update}
        out.append(tuple(row.values()))
    if insert:
        out += [tuple(r.values()) for k, r in first.items() if k not in {d[0] for d in data}]
    return sorted(out, key=str)


@pytest.mark.parametrize("insert", [False, True])
@pytest.mark.parametrize("part", [keyed.by_hash(8), lambda key: F.length(key)])
def test_merge_equals_a_plain_rewrite(spark, tmp_path, insert, part):
    rng = random.Random(2)
    data = [(rng.choice([None, f"k{rng.randrange(60)}"]), rng.randrange(9), rng.choice([0, 1, None])) for _ in range(300)]
    held = table(spark, tmp_path, data, part=part)
    assert rows(held.read()) == sorted(data, key=str)
    want = sorted(data, key=str)
    for step in range(3):
        changes = [(rng.choice([None, f"k{rng.randrange(90)}"]), rng.randrange(100, 200), rng.choice([5, None])) for _ in range(25)]
        update = [["v"], ["v", "flag"], ["flag"]][step]
        want = plain_merge(want, changes, update, insert)
        assert held.merge(spark.createDataFrame(changes, SCHEMA), update, insert) == step + 2
        assert rows(held.read()) == want
    assert held.versions() == [1, 2, 3, 4] and rows(held.read(1)) == sorted(data, key=str)


def test_untouched_parts_are_not_written(spark, tmp_path):
    held = table(spark, tmp_path, [(f"{i:04d}", i, 0) for i in range(1000)], part=lambda key: F.substring(key, 1, 2).cast("int"))
    held.merge(spark.createDataFrame([("0311", -1, 1), ("0398", -2, 1), ("9999", 0, 0)], SCHEMA), ["v"])
    before, after = held._state(1), held._state(2)
    assert {p for p in after if after[p] != before[p]} == {3}
    text = plan(held.read().where("v < 0"))
    assert "PartitionFilters" in text and "PushedFilters: [IsNotNull(v), LessThan(v,0)]" in text
    assert rows(held.read().where("v < 0")) == [("0311", -1, 0), ("0398", -2, 0)]
    assert held.read().count() == 1000
    assert held.merge(spark.createDataFrame([("9999", 0, 0), (None, 1, 1)], SCHEMA), ["v"]) == 2


def test_a_failed_update_leaves_the_old_table(spark, tmp_path):
    data = [(f"k{i}", i, 0) for i in range(100)]
    held = table(spark, tmp_path, data)
    changes = spark.createDataFrame([(f"k{i}", -i, 1) for i in range(100)], SCHEMA)
    bad = changes.withColumn("v", F.when(c("k") == "k77", F.raise_error(F.lit("broken delivery")).cast("int")).otherwise(c("v")))
    with pytest.raises(Exception, match="broken delivery"):
        held.merge(bad, ["v"])
    assert held.versions() == [1] and rows(held.read()) == sorted(data, key=str)
    assert held.merge(changes, ["v"]) == 2 and held.read().agg(F.sum("v")).first()[0] == -sum(range(100))


def test_an_update_reads_what_another_wrote(spark, tmp_path):
    """A reader that began before an update keeps its rows."""
    held = table(spark, tmp_path, [("a", 1, 0), ("b", 2, 0)])
    before = held.read()
    held.merge(spark.createDataFrame([("a", 5, 5)], SCHEMA), ["v", "flag"])
    assert rows(before) == [("a", 1, 0), ("b", 2, 0)] and rows(held.read()) == [("a", 5, 5), ("b", 2, 0)]
    with pytest.raises(Exception, match="(?i)already exists"):
        held.create(before)


def test_empty_tables(spark, tmp_path):
    held = table(spark, tmp_path, [])
    assert rows(held.read()) == [] and held.read().columns == ["k", "v", "flag"]
    held.merge(spark.createDataFrame([("a", 1, 1)], SCHEMA), ["v"], insert=True)
    assert rows(held.read()) == [("a", 1, 1)]
    held.merge(spark.createDataFrame([], SCHEMA), ["v"], insert=True)
    assert rows(held.read()) == [("a", 1, 1)]


def test_published_flags(spark, tmp_path):
    data = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), (None, 0), ("c", 0)], "uniqueid string, inwqx int")
    held = keyed.KeyedTable(spark, str(tmp_path / "flags"), "uniqueid", data.schema)
    held.create(data)
    published = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "uniqueid string")
    publish.mark_published(held, published)
    assert rows(held.read()) == rows(joins.apply_inwqx(data, published, "uniqueid").select("uniqueid", "inwqx"))


# --- by sample


def test_a_pivot_of_buckets_moves_no_rows(spark, tmp_path):
    names = ["Calcium", "Chloride", "Sodium", "Magnesium", "Nothing known"]
    data = [(f"S{i % 300}" if i % 11 else None, f"L{i % 7}", i, names[i % 5], float(i % 97), None if i % 13 else "Not Detected") for i in range(4000)]
    df = spark.createDataFrame(data, "sampleid string, monitoringlocationid string, sampledate int, characteristicname string, resultvalue double, resultdetectioncondition string")
    held = buckets.land_samples(df, "test_samples", str(tmp_path / "samples"), buckets=4)
    try:
        wide = reshape.pivot_samples(held, "")
        assert "Exchange" not in plan(wide) and "Exchange" in plan(reshape.pivot_samples(df, ""))
        assert rows(wide) == rows(reshape.pivot_samples(df, ""))
        # a lookup in another table that is dealt alike
        stations = buckets.land_samples(df.select("sampleid", "sampledate").dropDuplicates(["sampleid"]), "test_dates", str(tmp_path / "dates"), buckets=4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        met = wide.drop("sampledate").join(stations, "sampleid")
        assert "Exchange" not in plan(met) and met.count() == wide.count()
        assert held.count() + buckets.loose_rows(spark, str(tmp_path / "samples")).count() == len(data)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS test_samples")
        spark.sql("DROP TABLE IF EXISTS test_dates")


# --- answers


def test_large_answers_are_read_by_element(spark, tmp_path):
    odd = ['a "quoted" {brace}', "a, b]}", 'say \\"attributes\\": {', "", None, "é😀"]
    features = [{"attributes": {"NAME": odd[i % 6], "N": i, "SUB": i / 4}, "geometry": {"x": i, "rings": [[1, 2]]}} for i in range(3000)]
    plain = json.dumps({"displayFieldName": "", "fields": [{"name": "N"}], "features": features})
    (tmp_path / "one.json").write_text(plain)
    (tmp_path / "indented.json").write_text(json.dumps({"features": features[:50]}, indent=2, ensure_ascii=False))
    (tmp_path / "none.json").write_text('{"features": []}')
    (tmp_path / "empty.json").write_text("")
    schema = "NAME STRING, N INT, SUB DOUBLE"
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = readers.read_features(spark, str(tmp_path), schema)
        assert got.rdd.getNumPartitions() > 5
        want = [(f["attributes"]["NAME"], f["attributes"]["N"], f["attributes"]["SUB"]) for f in [*features, *features[:50]]]
        assert rows(got) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    text = spark.createDataFrame([(plain,)], "j string")
    assert rows(readers.flatten_features(text, "j", schema)) == sorted(want[:3000], key=str)


def test_an_answer_that_would_lose_an_element_stops(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"features": [{"attributes": {"NAME": "attributes", "N": 1}}]}')
    with pytest.raises(Exception, match="equal to .attributes."):
        readers.read_features(spark, str(tmp_path), "NAME STRING, N INT").collect()


def test_buckets_grow_in_number_and_not_in_size(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('S', id % 500) AS sampleid", "id AS n")
    many = buckets.land_samples(df, "test_many", str(tmp_path / "many"), buckets=4, rows_per_bucket=100)
    same = buckets.land_samples(df, "test_same", str(tmp_path / "same"), buckets=4, rows_per_bucket=None)
    few = buckets.land_samples(df, "test_few", str(tmp_path / "few"), buckets=4)
    assert [len(list((tmp_path / n).glob("*.parquet"))) for n in ("many", "same", "few")] == [16, 4, 4]
    assert rows(many) == rows(same) == rows(few) and many.count() == 1000
