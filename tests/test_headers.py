"""Headers found in tasks, and rows of files with different headers read in one scan."""

import gzip
import random

import pytest

from seepline.sources import headers, readers

STATION = "MonitoringLocationIdentifier"


def jobs(spark, name, work):
    """The answer of ``work`` and the number of Spark jobs it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def station_files(folder, n, seed=1):
    """``n`` small files in three orders of columns; returns their rows."""
    rng = random.Random(seed)
    orders = [[STATION, "LatitudeMeasure", "LongitudeMeasure"], ["Extra", "LongitudeMeasure", STATION, "LatitudeMeasure"], ["LatitudeMeasure", STATION]]
    folder.mkdir()
    rows = set()
    for i in range(n):
        names = orders[0 if i % 7 else rng.randrange(3)]
        row = {STATION: f"S-{i}", "LatitudeMeasure": str(i / 8), "LongitudeMeasure": str(-i / 4), "Extra": '"a,b"'}
        (folder / f"f{i}.csv").write_text(",".join(names) + "\n" + ",".join(row[c] for c in names) + "\n")
        rows.add((f"S-{i}", i / 8, -i / 4 if "LongitudeMeasure" in names else None))
    return rows


def test_ten_thousand_small_files(spark, tmp_path):
    few, many = station_files(tmp_path / "few", 40), station_files(tmp_path / "many", 10_000)
    columns = [STATION, "LatitudeMeasure", "LongitudeMeasure"]

    def read(folder):
        return {tuple(r) for r in readers.read_portal_stations(spark, str(tmp_path / folder), columns).collect()}

    got, n_few = jobs(spark, "few", lambda: read("few"))
    assert got == few
    got, n_many = jobs(spark, "many", lambda: read("many"))
    assert got == many
    # listing more than 32 files is a job of Spark's own; none is started for a file
    assert n_many <= n_few + 1 and n_many < 20


def test_one_header_is_a_plain_scan(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"{STATION},LatitudeMeasure,Unread\nS-{i},{i},x\n")
    df = readers.read_portal_stations(spark, str(tmp_path), [STATION, "LatitudeMeasure"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ReadSchema: struct<_0:string,_1:string>" in plan
    assert {tuple(r) for r in df.collect()} == {(f"S-{i}", float(i)) for i in range(3)}


def test_large_files_are_read_by_their_first_lines(spark, tmp_path, monkeypatch):
    """Large, zipped, empty and odd files together; large ones are cut into many splits."""
    monkeypatch.setattr(headers, "SMALL_FILE", 500)
    want = set()
    for k, names in enumerate((["A", "B"], ["B", "New", "A"], ["A"])):
        lines = ["\t".join(names)]
        for i in range(3000):
            row = {"A": f"a{k}-{i}", "B": f"b{i}", "New": "n"}
            lines.append("\t".join(row[c] for c in names))
            want.add((row["A"], row["B"] if "B" in names else None, f"large{k}"))
        (tmp_path / f"large{k}.txt").write_text("\n".join(lines) + "\n")
    with gzip.open(tmp_path / "packed.txt.gz", "wt") as f:
        f.write("B\tA\n" + "".join(f"b{i}\tz{i}\n" for i in range(3000)))
    want |= {(f"z{i}", f"b{i}", "packed.txt") for i in range(3000)}
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "blank.txt").write_text("\n\n")
    (tmp_path / "headed.txt").write_text("A\tB\n")
    (tmp_path / "marked.txt").write_text("\ufeffA\tB\nmark\tx\nlong\ty\tz\n", encoding="utf-8")
    want.add(("mark", "x", "marked"))
    (tmp_path / "late.txt").write_text("\nB\tA\nq\tlate\n")
    want.add(("late", "q", "late"))
    (tmp_path / "twice.txt").write_text("A\tA\tB\nfirst\tsecond\tx\n")
    want.add(("first", "x", "twice"))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_lab_tsv(spark, str(tmp_path / "*"), ["A", "B"])
        assert df.count() == len(want) and {tuple(r) for r in df.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_every_file_may_have_its_own_header(spark, tmp_path):
    names = [f"c{i}" for i in range(12)]
    want = set()
    for i in range(40):
        rng = random.Random(i)
        own = rng.sample(names, rng.randint(1, 12))
        (tmp_path / f"{i}.txt").write_text("\t".join(own) + "\n" + "\t".join(f"{c}={i}" for c in own) + "\n")
        want.add((*(f"{c}={i}" if c in own else None for c in names), str(i)))
    assert {tuple(r) for r in readers.read_lab_tsv(spark, str(tmp_path), names).collect()} == want


def test_a_long_row_of_a_narrow_file_stops_a_strict_read(spark, tmp_path):
    (tmp_path / "wide.txt").write_text("A\tB\tC\n1\t2\t3\n")
    (tmp_path / "narrow.txt").write_text("A\tB\n1\t2\t3\n")
    assert readers.read_lab_tsv(spark, str(tmp_path), ["A"]).count() == 1
    with pytest.raises(Exception, match="(?i)malformed row.* in narrow"):
        readers.read_lab_tsv(spark, str(tmp_path), ["A"], drop_bad=False).collect()
