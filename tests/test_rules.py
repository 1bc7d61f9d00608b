"""Column rules on edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import colors, places, species, values

c = F.col


def one(spark, schema, rows, *cols):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*cols).collect()]


def test_fix_datetime(spark):
    cases = [
        ("2019-03-04", "9:30", (9, 30)), ("2019-03-04", "9:30:00", (0, 0)), ("2019-03-04", "930", (0, 30)),
        ("2019-03-04", "25:10", (0, 0)), ("2019-03-04", "10:75", (0, 0)), ("2019-03-04", None, (0, 0)),
        (" 2019-03-04 08:00", "10:05:59", (10, 5)), ("bad", "10:00", None), ("2019-13-01", "10:00", None),
        (None, "10:00", None), ("2019-02-30", "10:00", None),
    ]
    got = one(spark, "d string, t string", [x[:2] for x in cases], values.fix_datetime(c("d"), c("t")))
    want = [None if x[2] is None else dt.datetime(2019, 3, 4, *x[2]) for x in cases]
    assert [g[0] for g in got] == want


def test_split_censored(spark):
    below = (None, "Below Reporting Limit", "Lower Reporting Limit")
    above = (None, "Above Reporting Limit", "Upper Reporting Limit")
    cases = {
        "<0.5": below, ">9": above, "4.2 [x]": (4.2, None, None), "1.5d": (None, None, None), "": (None, None, None),
        "[<1]": below, "7": (7.0, None, None), " -1e3 ": (-1000.0, None, None), "nan": (None, None, None), "x [": (None, None, None),
    }
    got = one(spark, "x string", [(k,) for k in cases] + [(None,)], values.split_censored(c("x")).alias("s"))
    assert [tuple(g[0]) for g in got] == [*cases.values(), (None, None, None)]


def test_qualifier_method_fraction(spark):
    got = one(spark, "a string, b string", [("Below Reporting Limit", None), ("Below Reporting Limit", "J"), (None, None)],
              values.result_qualifier(c("a"), c("b")))
    assert got == [("BRL",), ("J",), (None,)]
    got = one(spark, "m string", [("EPA 300.0",), ("SM4500/B",), ("2320B",), ("EPA200",), (None,)], values.clean_method(c("m")))
    assert got == [("300.0",), ("SM4500",), ("2320B",), (None,), (None,)]
    got = one(spark, "m string", [(" Water, Filtered ",), ("Water",), (None,)], values.state_sample_fraction(c("m")))
    assert got == [("Dissolved",), ("Total",), ("Total",)]
    got = one(spark, "m string", [("DIS WET",), ("MET",)], values.epa_sample_fraction(c("m")), values.epa_sample_fraction(c("m"), True))
    assert got == [("Total", "Total"), ("Total", "MET")]


@pytest.mark.parametrize("places_", [0, 1, 2])
def test_rounding_follows_the_binary_value(spark, places_):
    xs = [0.25, 0.35, 0.15, 2.5, 3.5, -0.35, -2.5, 1234.45, 0.05, 1e17, 7e-5, 99.95, 2.675, 1.005]
    got = one(spark, "x double", [(x,) for x in xs], values.round_half_even(c("x"), places_))
    assert [g[0] for g in got] == [round(x, places_) for x in xs]


def test_vertical_measure(spark):
    assert one(spark, "x double", [(0.0,), (0.25,), (None,)], values.vertical_measure(c("x"))) == [(None,), (0.2,), (None,)]


def test_units(spark):
    rows = [(5.0, "UG/L "), (5.0, "mg/L"), (5.0, None), (None, "ug/l")]
    got = one(spark, "v double, u string", rows, values.ugl_to_mgl(c("v"), c("u")), values.unit_label(c("u")))
    assert got == [(0.005, "UG/L "), (5.0, "mg/l"), (5.0, None), (None, "mg/l")]


def test_ids(spark):
    assert one(spark, "x double", [(401043111361801.0,), (None,)], values.station_id_text(c("x"))) == [("401043111361801",), (None,)]
    got = one(spark, "a string, b string", [("1", None)], values.unique_id(c("a"), c("b"), F.lit("pH")), values.result_id(c("a"), c("b")))
    assert got == [("1-None-pH", "1-None")]
    got = one(spark, "a string", [("UTAHGS_WQX-1",), ("UTAHGS-1",)], values.strip_wqx(c("a")), values.strip_org_prefix(c("a")))
    assert got == [("UTAHGS-1", "UTAHGS_WQX-1"), ("UTAHGS-1", "1")]


def test_speciation(spark):
    rows = [("nitrate ", "MG/L as N"), ("Phosphate-phosphorus", "x"), ("Orthophosphate", "mg/l as P"), ("Ammonia and ammonium", None), ("Iron", "ug/l"), (None, None)]
    got = one(spark, "n string, u string", rows, species.method_speciation(c("n"), c("u")).alias("s"),
              species.method_speciation(c("n"), c("u"), corrected=True).alias("k"))
    assert [tuple(g[0]) for g in got] == [
        ("Nitrate", "as N", "mg/l"), ("Phosphate", "as N", "mg/l"), ("Phosphate", "as P", "mg/l"), ("Ammonium", "as N", "mg/l"),
        ("Iron", None, "ug/l"), (None, None, None),
    ]
    assert got[1][1]["speciation"] == "as P"
    rows = [("Sulfate as S", 2.0, "q"), ("Iron", 5.0, "ug/l"), ("Iron", 5.0, "mg/l ")]
    got = one(spark, "n string, v double, u string", rows, species.convert_species(c("n"), c("v"), c("u")).alias("s"))
    assert [tuple(g[0]) for g in got] == [("Sulfate", 2 * 2.996, "mg/l"), ("Iron", 0.005, "mg/l"), ("Iron", 5.0, "mg/l")]


def test_lab_names(spark):
    got = one(spark, "n string", [("Nitrate as N",), ("Mercury as Hg",), ("Iron",), (None,)], species.epa_speciation(c("n")).alias("s"))
    assert [tuple(g[0]) for g in got] == [("Nitrate", "as N"), ("Mercury as Hg", None), ("Iron", None), (None, None)]
    rows = [("Alkalinity as Calcium Carbonate",), ("Total Phosphate",), ("Silica as SiO2",), ("Ca",), ("NO3-N",), (None,)]
    got = one(spark, "n string", rows, species.state_speciation(c("n")).alias("s"), species.state_speciation(c("n"), True).alias("k"))
    assert [tuple(g[0]) for g in got] == [
        ("Alkalinity, total", "as CaCO3"), ("Orthophosphate", "as PO4"), ("Silica", "SiO2"), ("Ca", None), ("NO3-N", None), (None, None),
    ]
    assert tuple(got[3][1]) == ("Calcium", None) and tuple(got[4][1]) == ("Nitrate", "as N")


def test_stations(spark):
    rows = [(None, "W4", "WR20"), (None, None, None), ("U", "W", "R"), (None, None, "R")]
    got = one(spark, "a string, b string, c string", rows, places.alt_location(c("a"), c("b"), c("c")).alias("s"))
    assert [tuple(g[0]) for g in got] == [("W4", "Utah Well ID"), (None, None), ("U", "usgs_id"), ("R", "Utah Water Rights Number")]
    rows = [("porcupine",), ("nothing",), ("BRYCE CANYON BC22W RUBY 3",), ("see 402050112330201",), ("T8",), (None,)]
    got = one(spark, "d string", rows, places.match_station_rules(c("d")), places.match_station_rules(c("d"), corrected=True))
    assert [g[0] for g in got] == ["390714112200401", "390714112200401", "390714112200401", "390714112200401", "395132112124901", None]
    assert [g[1] for g in got] == ["383453109200601", None, "374138112103102", "402050112330201", "395132112124901", None]
    assert places.county_criterion("Utah", "049") == ("US:49", "US:49:049")
    assert places.county_criterion("Arizona", "001") == ("US:04", "US:04:001")


def test_colors(spark):
    import colorsys
    import math

    rows = [(h / 12 * 2 * math.pi, s, v) for h in range(12) for s in (0.0, 0.4, 1.0) for v in (0.5, 1.0)]
    got = one(spark, "h double, s double, v double", rows, colors.hsv_to_rgb(c("h"), c("s"), c("v")).alias("k"))
    for (h, s, v), (k,) in zip(rows, got):
        assert tuple(k) == pytest.approx(colorsys.hsv_to_rgb(h / (2 * math.pi), s, v), abs=1e-12)
    (k,), = one(spark, "h double", [(7.0,)], colors.hsv_to_rgb(c("h"), F.lit(0.25), F.lit(1.0)).alias("k"))
    assert tuple(k) == (0.75, 0.75, 0.75)
    assert one(spark, "r int, g int, b int", [(0, 10, 255)], colors.rgb_hex(c("r"), c("g"), c("b"))) == [("#000aff",)]


def test_tables_are_complete():
    assert len(vocab.STATION_RULES) == 87 and len(vocab.STATION_NAMES) == 91
    assert len(vocab.PORTAL_RESULT_COLUMNS) == 63 and len(vocab.SYMBOLS) == 45


def test_rules_by_row_equal_the_chain(spark):
    """Descriptions made of pieces of the patterns, in any case, with ids and odd letters."""
    import random

    from seepline.operators import joins

    rng = random.Random(8)
    pieces = sorted({t for p, s in vocab.STATION_RULES for texts in places.required_texts(f"{p}|{s}") for t in texts})
    made = {" ".join(rng.choice([str.upper, str.lower, str])(rng.choice(pieces)) for _ in range(rng.randint(1, 5))) for _ in range(3000)}
    made |= {"", "ſp timpie", "clover ſp", "HUNTıNG", "straße 67 x 3499", "67\n3499", "38403040109281201", "x383040109281201", "nothing at all"}
    rows = spark.createDataFrame([*((d,) for d in sorted(made)), (None,)], "d string")
    for corrected in (False, True):
        plain = rows.select("d", places.match_station_rules(c("d"), corrected=corrected).alias("s"))
        both = joins.match_stations_by_row(rows, "d", "s", corrected)
        assert both.columns == ["d", "s"]
        want = {r["d"]: r["s"] for r in plain.collect()}
        assert {r["d"]: r["s"] for r in both.collect()} == want and len(set(want.values())) > (15 if not corrected else 60)


def test_required_texts():
    assert places.required_texts("AM.*?FK|wl|") == [["AM", "FK"], ["wl"], []]
    assert places.required_texts("(C-19-.*?4)31ada-.*?1") == [["C-19-", "4", "31ada-", "1"]]
    for other in ("a(b|c)d", "a(bc)?d", "a+b", "a.b", "(a).*?b|(c)*", r"a\d", "[ab]", "a{2}"):
        assert places.required_texts(other) is None
