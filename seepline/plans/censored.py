"""Imputed values of censored data, kept up to date as files arrive."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seepline.operators import ros
from seepline.session import checkpointed
from seepline.sources.keyed import KeyedTable, by_hash

GROUP = "group_key"
PARTS = 64


@dataclass(frozen=True)
class CensoredStore:
    """Measurements of many groups as a tally, and every measurement's final value.

    Both are tables below ``root``, dealt into parts by group. A delivery is tallied, added to
    the tallies of its groups, and only those groups are imputed again; all others, and the
    parts without such a group, are carried over. ``options`` are those of ``ros_impute``.

    A delivery has a name, and one that is there already is not added again. If a run ends
    between the two tables, the next one first brings the values up to the tally.
    """

    spark: SparkSession
    root: str
    keys: T.StructType
    result: str = "result"
    censored: str = "censorship"
    options: dict = field(default_factory=dict)
    parts: int = PARTS

    @property
    def names(self) -> list[str]:
        return self.keys.names

    @property
    def tallies(self) -> KeyedTable:
        return self._table("tally", [T.StructField("_v", T.DoubleType()), T.StructField("_c", T.BooleanType()), T.StructField("_n", T.LongType())])

    @property
    def finals(self) -> KeyedTable:
        return self._table("final", [T.StructField(self.result, T.DoubleType()), T.StructField(self.censored, T.BooleanType()), T.StructField("final", T.DoubleType())])

    def _table(self, name: str, columns: list[T.StructField]) -> KeyedTable:
        schema = T.StructType([*self.keys.fields, *columns, T.StructField(GROUP, T.StringType())])
        return KeyedTable(self.spark, f"{self.root}/{name}", GROUP, schema, by_hash(self.parts))

    def create(self) -> None:
        for table in (self.tallies, self.finals):
            table.create(self.spark.createDataFrame([], table.schema))

    def _grouped(self, df: DataFrame) -> DataFrame:
        # NULL keys are groups, too
        return df.withColumn(GROUP, F.to_json(F.struct(*self.names), {"ignoreNullFields": "false"}))

    def add(self, df: DataFrame, name: str) -> None:
        """Take in the measurements of one delivery."""
        self.catch_up()
        if name in self.tallies.notes():
            return
        fresh = checkpointed(self._grouped(ros.tally(df, self.names, self.result, self.censored)))
        parts = self.tallies.parts_of(fresh)
        old = self.tallies.read(parts=parts)
        both = old.unionByName(fresh).groupBy(GROUP, *self.names, "_v", "_c").agg(F.sum("_n").alias("_n"))
        self.tallies.replace(parts, both, name)
        self._impute(parts, fresh.select(GROUP).distinct())

    def _impute(self, parts: set[int], groups: DataFrame | None) -> None:
        """Final values of the ``groups``, or of all, in these parts; the others' stay."""
        held = self.tallies.read(parts=parts)
        changed = held if groups is None else held.join(groups, GROUP, "left_semi")
        new = ros.impute_tally(changed.drop(GROUP), self.result, self.censored, self.names, **self.options)
        new = self._grouped(new)
        if groups is not None:
            new = self.finals.read(parts=parts).join(groups, GROUP, "left_anti").unionByName(new)
        self.finals.replace(parts, new, str(self.tallies.versions()[-1]))

    def catch_up(self) -> None:
        """Impute what a run that ended early has left behind; else nothing."""
        latest = self.tallies.versions()[-1]
        done = max((int(n) for n in self.finals.notes()), default=1)
        if done < latest:
            before, now = self.tallies.state(done), self.tallies.state(latest)
            self._impute({p for p, run in now.items() if before.get(p) != run}, None)

    def read(self) -> DataFrame:
        """Every kept measurement with its final value."""
        return self.finals.read().drop(GROUP)
