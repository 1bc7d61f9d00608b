"""Imputation kept up to date by deliveries equals imputation of all rows at once."""

import random

import pytest
from pyspark.sql import types as T

from seepline.operators import ranking, ros
from seepline.plans.censored import CensoredStore

KEYS = T.StructType([T.StructField("site", T.StringType()), T.StructField("chem", T.IntegerType())])
SCHEMA = "site string, chem int, result double, censorship boolean, more string"


def rows(df):
    shown = df.select("site", "chem", "result", "censorship", "final").collect()
    return sorted(((r["site"], r["chem"], r["result"], r["censorship"], None if r["final"] is None else round(r["final"], 8)) for r in shown), key=str)


def measurements(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        site = rng.choice(["A", "B", "C", None])
        value = rng.choice([0.5, 1.0, 2.0, 5.0, round(rng.lognormvariate(0, 1), 2)])
        out.append((site, rng.randrange(6), rng.choice([value, value, value, None, float("nan")]), rng.choice([True, False, False, None]), "x"))
    return out


def store(spark, path, **options):
    made = CensoredStore(spark, str(path), KEYS, options=options, parts=8)
    made.create()
    return made


def test_deliveries_add_up(spark, tmp_path):
    options = {"floor": 0.7, "transform": "none"}
    held = store(spark, tmp_path, **options)
    assert rows(held.read()) == []
    seen = []
    # ties by the thousand, a group that was all uncensored and one that gets valid late
    late = [("new", 1, float(i), False, "x") for i in range(1, 6)]
    for name, part in (("a", [*measurements(1, 300), ("new", 1, 3.0, True, "x")]), ("b", [("A", 1, 1.0, False, "x")] * 4000 + measurements(2, 10) + late)):
        held.add(spark.createDataFrame(part, SCHEMA), name)
        seen += part
        want = ros.ros_impute(spark.createDataFrame(seen, SCHEMA), "result", "censorship", KEYS.names, **options)
        assert rows(held.read()) == rows(want)


def test_only_touched_groups_are_imputed(spark, tmp_path, monkeypatch):
    held = store(spark, tmp_path)
    held.add(spark.createDataFrame(measurements(3, 400), SCHEMA), "a")
    before, tables = rows(held.read()), (held.tallies.state(), held.finals.state())
    asked = []
    plain = ros.impute_tally
    monkeypatch.setattr(ros, "impute_tally", lambda counted, *a, **k: asked.extend(counted.select("site", "chem").distinct().collect()) or plain(counted, *a, **k))
    held.add(spark.createDataFrame([("B", 2, 7.0, False, "x")], SCHEMA), "b")
    assert [tuple(r) for r in asked] == [("B", 2)]
    after = rows(held.read())
    assert [r for r in after if r[:2] != ("B", 2)] == [r for r in before if r[:2] != ("B", 2)] and len(after) == len(before) + 1
    for old, new in zip(tables, (held.tallies.state(), held.finals.state()), strict=True):
        assert sum(old.get(p) != run for p, run in new.items()) == 1


def test_a_delivery_counts_once_and_a_broken_run_is_made_good(spark, tmp_path, monkeypatch):
    held = store(spark, tmp_path)
    first, second = (spark.createDataFrame(measurements(s, 120), SCHEMA) for s in (4, 5))
    held.add(first, "a")
    held.add(first, "a")
    assert rows(held.read()) == rows(ros.ros_impute(first, "result", "censorship", KEYS.names))
    with monkeypatch.context() as m:
        m.setattr(CensoredStore, "_impute", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            held.add(second, "b")
    held.add(second, "b")
    assert rows(held.read()) == rows(ros.ros_impute(first.unionByName(second), "result", "censorship", KEYS.names))


def test_a_tied_group_is_written_out_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", 500)
    held = store(spark, tmp_path)
    tied = [("A", 1, 2.0, False, "x")] * 3000 + [("A", 1, 1.0, True, "x")] * 2000 + [("A", 1, 3.0, False, "x")]
    for name, part in (("a", tied[:2500]), ("b", tied[2500:])):
        held.add(spark.createDataFrame(part, SCHEMA), name)
    assert held.tallies.read().count() == 3 and held.read().count() == len(tied)
    assert rows(held.read()) == rows(ros.ros_impute(spark.createDataFrame(tied, SCHEMA), "result", "censorship", KEYS.names))


def test_deliveries_send_no_side_of_the_places_whole(spark, tmp_path, monkeypatch):
    # the tallies are a few rows that stand for many: the planner takes both sides of the join for small
    made, plain = [], ros.impute_tally

    def kept(*a, **k):
        made.append(plain(*a, **k))
        return made[-1]

    monkeypatch.setattr(ros, "impute_tally", kept)
    held = store(spark, tmp_path)
    tied = [("A", chem, v, v <= 30 and i % 3 == 0, "x") for chem in range(2) for v in (10.0, 20.0, 30.0, 40.0, 50.0) for i in range(3000)]
    for name, part in (("a", tied[::2]), ("b", tied[1::2])):
        held.add(spark.createDataFrame(part, SCHEMA), name)
    assert held.read().count() == len(tied) and [df.count() for df in made] == [len(tied) // 2, len(tied)]
    for df in made:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line and "_place" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)
