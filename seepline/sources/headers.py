"""Which file lists its columns in which order, found inside tasks.

Files of one source may list their columns in different orders, or have more or fewer. Their
first lines are read by two jobs, whatever the number of files: small files many to a task and
whole; of a larger file, which is a task of its own, no more than the first batch of lines. The
lines are reduced to distinct headers in Spark, and only those reach the driver. Rows are then
read in one scan by place, not by name. Files with the most frequent header need no entry; the
others are named in a table that a row's file is looked up in.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seepline.session import fresh_path

#: bytes up to which a file is read whole for its first line, with others in one task
SMALL_FILE = 1 << 20
#: lines that a task takes of a file at a time
_LINES = 64
_ONE_FILE = {
    # a partition is closed by the cost of its first file, and no file is cut
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(_LINES),
}


def _first_lines(lone: bool):
    """The first line with text of each file. ``lone``: there is one file, and it need not be
    read beyond that line."""

    def found(batches):
        seen = None
        for batch in batches:
            for file, line in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if file != seen and line.strip():
                    seen = file
                    yield pa.RecordBatch.from_pydict({"file": [file], "line": [line]})
                    if lone:
                        return

    return found


def _lines(spark: SparkSession, paths: str | list[str], small: bool) -> DataFrame:
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size")
    )
    # the size is known when files are listed, so that the others are not opened
    mine = lines.where(F.col("size") <= SMALL_FILE if small else F.col("size") > SMALL_FILE)
    return mine.where("start = 0").select("file", "value").mapInArrow(_first_lines(not small), "file string, line string")


@dataclass
class Headers:
    """Distinct headers, the most frequent one first, and the files that have another."""

    names: list[list[str]]
    others: DataFrame | None

    @property
    def width(self) -> int:
        return max(map(len, self.names), default=0)

    def of_row(self, rows: DataFrame, file: str) -> DataFrame:
        """``rows`` with ``_header``, the number of the header of the file they come from."""
        if self.others is None:
            return rows.withColumn("_header", F.lit(0))
        met = rows.join(self.others, rows[file] == self.others["_file"], "left")
        return met.withColumn("_header", F.coalesce("_number", F.lit(0))).drop("_file", "_number")

    def pick(self, values: list) -> Column:
        """Of ``values``, a Column or None for each header, the one of the row's header."""
        values = [F.lit(None) if v is None else v for v in values]
        kinds: dict[str, tuple[Column, list[int]]] = {}
        for i, v in enumerate(values):
            kinds.setdefault(str(v), (v, []))[1].append(i)
        (most, _), *rest = sorted(kinds.values(), key=lambda kind: -len(kind[1]))
        picked = most
        for value, numbers in rest:
            picked = F.when(F.col("_header").isin(numbers), value).otherwise(picked)
        return picked

    def column(self, name: str, places: list[str]) -> Column:
        """The column ``name`` of rows read by place; NULL where the header lacks it, the first
        of equal names where it repeats it."""
        return self.pick([F.col(places[names.index(name)]) if name in names else None for names in self.names])


def _split(line: str, sep: str) -> list[str]:
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])
    return [n.strip() for n in names]


def read_headers(spark: SparkSession, paths: str | list[str], sep: str) -> Headers:
    """The headers of all files; files without a line of text have none, and no rows."""
    path = fresh_path(spark, "headers")
    _lines(spark, paths, True).write.parquet(path)
    apart = spark.newSession()
    for key, value in _ONE_FILE.items():
        apart.conf.set(key, value)
    _lines(apart, paths, False).write.mode("append").parquet(path)
    found = spark.read.schema("file string, line string").parquet(path)
    counts = sorted(found.groupBy("line").count().collect(), key=lambda r: (-r["count"], r["line"]))
    names, numbers = [], []
    for row in counts:
        own = _split(row["line"], sep)
        numbers.append((row["line"], names.index(own) if own in names else len(names)))
        if own not in names:
            names.append(own)
    others = [(line, number) for line, number in numbers if number]
    if not others:
        return Headers(names, None)
    numbered = spark.createDataFrame(others, "line string, _number int")
    out = fresh_path(spark, "header-numbers")
    found.join(numbered, "line").select(F.col("file").alias("_file"), "_number").write.parquet(out)
    return Headers(names, spark.read.schema("_file string, _number int").parquet(out))
