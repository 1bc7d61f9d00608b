"""A table that is updated by key: touched parts are written anew, then all change at once.

A keyed table is a folder with ``data/run=<id>/part=<n>`` (rows) and ``log/version=<n>`` (for
every part, the run that holds it). An update reads the parts that its keys fall in and no
others, joins the changes, writes those parts under a new run, and last appends one log file.
The file that a Spark job commits appears by a single rename, so readers see all of an update
or nothing of it, and an update that fails at any point leaves the table as it was. An update may
carry a note, such as the name of a delivery. Parts of earlier versions stay until they are
removed by hand, and can be read by ``version``.

There must be one writer at a time. Only the log, a row per part, reaches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seepline.operators.reshape import one_per_key

#: parts by hash of the key
PARTS = 64
_LOG = "part int, run string, version long, note string"


def by_hash(parts: int = PARTS) -> Callable[[Column], Column]:
    return lambda key: F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class KeyedTable:
    """Rows of ``schema`` below ``root``, dealt into parts by ``part``, a function of ``key``.

    ``part`` gives whole numbers, few enough that the driver can list them; by default a hash.
    One under which the keys of an update lie together (of a running number, its thousands)
    leaves more of the table untouched. Keys may repeat in the table. Rows without a key are
    part -1, which no update changes.
    """

    spark: SparkSession
    root: str
    key: str
    schema: T.StructType
    part: Callable[[Column], Column] = by_hash()

    def create(self, rows: DataFrame) -> None:
        """The first version; a table that is there already is an error."""
        run = self._write(rows)
        held = {r["part"]: run for r in self._stored(run).select("part").distinct().collect()}
        self._commit(1, held or {-1: run}, "errorifexists", None)

    def versions(self) -> list[int]:
        return sorted(r["version"] for r in self._log().select("version").distinct().collect())

    def notes(self) -> set[str]:
        return {r["note"] for r in self._log().select("note").distinct().collect()} - {None}

    def read(self, version: int | None = None, parts: Iterable[int] | None = None) -> DataFrame:
        """The rows, or those of some parts, now or in an earlier version."""
        state = self.state(version)
        return self._rows(state if parts is None else {p: state[p] for p in parts if p in state}).drop("part")

    def state(self, version: int | None = None) -> dict[int, str]:
        """For every part, the run that holds it."""
        return self._state(self.versions()[-1] if version is None else version)

    def parts_of(self, rows: DataFrame) -> set[int]:
        """The parts that rows with this table's key fall in."""
        return {r["part"] for r in rows.select(self._part(F.col(self.key)).alias("part")).distinct().collect()}

    def replace(self, parts: set[int], rows: DataFrame, note: str | None = None) -> int:
        """Put ``rows``, all of which belong to ``parts``, in place of what those parts hold;
        returns the new version."""
        version = self.versions()[-1]
        run = self._write(rows)
        self._commit(version + 1, self._state(version) | dict.fromkeys(parts, run), "append", note)
        return version + 1

    def merge(self, changes: DataFrame, update: list[str], insert: bool = False) -> int:
        """Take the columns ``update`` of rows whose key is in ``changes`` from there, and with
        ``insert`` add the changes whose key the table lacks; returns the new version.

        A change without key is left out. Of several with one key the first counts, in the order
        of their columns. A column that inserted changes lack is NULL; a value NULL is a value.
        """
        version = self.versions()[-1]
        state = self._state(version)
        wanted = [f.name for f in self.schema.fields if f.name in changes.columns] if insert else [self.key, *(c for c in update if c != self.key)]
        given = one_per_key(changes.where(F.col(self.key).isNotNull()).select(*wanted), [self.key])
        given = given.withColumn("part", self._part(F.col(self.key)))
        touched = self.parts_of(given)
        if not insert:
            touched &= set(state)
        if not touched:
            return version
        old = self._rows({p: r for p, r in state.items() if p in touched}).withColumn("_here", F.lit(True))
        new = given.where(F.col("part").isin(sorted(touched))).select(*[F.col(c).alias(f"_new_{c}") for c in given.columns])
        met = old.join(new, (old["part"] == new["_new_part"]) & (old[self.key] == new[f"_new_{self.key}"]), "full" if insert else "left")
        here, there = F.col("_here").isNotNull(), F.col("_new_part").isNotNull()

        def value(field: T.StructField) -> Column:
            own, name = F.col(field.name), f"_new_{field.name}"
            other = F.col(name) if name in new.columns else F.lit(None)
            taken = F.when(here & there, other).otherwise(own) if field.name in update else own
            return (F.when(here, taken).otherwise(other) if insert else taken).cast(field.dataType).alias(field.name)

        return self.replace(touched, met.select(*map(value, self.schema.fields)))

    def _part(self, key: Column) -> Column:
        return F.coalesce(F.when(key.isNotNull(), self.part(key)).cast("int"), F.lit(-1))

    def _write(self, rows: DataFrame) -> str:
        """Rows below a new run. Rebalancing splits a part that is large and joins what is small."""
        run = uuid.uuid4().hex
        placed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], self._part(F.col(self.key)).alias("part"))
        placed.hint("rebalance", "part").write.partitionBy("part").parquet(f"{self.root}/data/run={run}")
        return run

    def _stored(self, *runs: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("run", T.StringType()), T.StructField("part", T.IntegerType())])
        paths = [f"{self.root}/data/run={run}" for run in runs]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def _state(self, version: int) -> dict[int, str]:
        return {r["part"]: r["run"] for r in self._log().where(F.col("version") == version).collect()}

    def _rows(self, state: dict[int, str]) -> DataFrame:
        runs: dict[str, list[int]] = {}
        for part, run in state.items():
            runs.setdefault(run, []).append(part)
        if not runs:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("part", T.IntegerType())]))
        current = [(F.col("run") == run) & F.col("part").isin(sorted(parts)) for run, parts in runs.items()]
        # names of columns as they are given: of a file, only those that are asked for are read
        return self._stored(*runs).where(reduce(lambda a, b: a | b, current)).drop("run")

    def _commit(self, version: int, state: dict[int, str], mode: str, note: str | None) -> None:
        rows = self.spark.createDataFrame([(p, r, version, note) for p, r in sorted(state.items())], _LOG)
        rows.coalesce(1).write.mode(mode).parquet(f"{self.root}/log")
