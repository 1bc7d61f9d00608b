"""Ranks and running totals within groups of any size.

A window needs all rows of a group in one task. Rows are therefore range-partitioned by
(group, value) and written once; a *segment* is a group's share of one partition. Totals and
running totals are taken per segment, carried over the segments of the group, and added
back. A large group spans many partitions, a partition holds many small groups, and there is
one plan for both. Counts and sums of whole numbers do not depend on the partitioning;
products of fractions may differ in their last digits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seepline.session import checkpointed

SEGMENT = "_segment"
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "product": F.product}
_ADD = {"sum": lambda a, b: a + b, "product": lambda a, b: a * b}
_EMPTY = {"sum": 0, "product": 1.0}


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on keys of the same name, where a NULL key matches a NULL key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])


@dataclass(frozen=True)
class OrderedGroups:
    keys: list[str]

    @property
    def parts(self) -> list[str]:
        return self.keys + [SEGMENT]

    def add(
        self,
        df: DataFrame,
        order: list[Column] = (),
        totals: dict[str, tuple[str, Column]] | None = None,
        running: dict[str, tuple[str, Column]] | None = None,
        descending: bool = False,
    ) -> DataFrame:
        """Add totals over the whole group, and totals up to and including each row.

        ``order`` starts with the value the groups are cut by; ``descending`` says that it
        runs downwards. Segments are summed up once for both, and their sums joined back.
        """
        totals, running = totals or {}, running or {}
        whole = W.partitionBy(*self.keys)
        along = F.col(SEGMENT).desc() if descending else F.col(SEGMENT).asc()
        before = whole.orderBy(along).rowsBetween(W.unboundedPreceding, -1)
        here = W.partitionBy(*self.parts).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        pieces = df.groupBy(*self.parts).agg(
            *[_MERGE[k](c).alias(n) for n, (k, c) in totals.items()],
            *[_MERGE[k](c).alias(f"_o_{n}") for n, (k, c) in running.items()],
        )
        pieces = pieces.withColumns(
            {n: _MERGE[k](n).over(whole) for n, (k, _) in totals.items()}
            | {f"_o_{n}": F.coalesce(_MERGE[k](f"_o_{n}").over(before), F.lit(_EMPTY[k])) for n, (k, _) in running.items()}
        )
        local = df.withColumns({n: _MERGE[k](c).over(here) for n, (k, c) in running.items()}) if running else df
        return (
            join_on(local, pieces, self.parts)
            .withColumns({n: _ADD[k](F.col(n), F.col(f"_o_{n}")) for n, (k, _) in running.items()})
            .drop(*[f"_o_{n}" for n in running])
        )


def order_groups(df: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, OrderedGroups]:
    """``df`` in segments: range-partitioned by group and value, and written once, so that
    every later use sees the same segments. Equal values of a group share a segment."""
    ranged = df.repartitionByRange(*keys, value).withColumn(SEGMENT, F.spark_partition_id())
    return checkpointed(ranged), OrderedGroups(keys)


#: rows written out by one task of :func:`repeat_rows`, beyond what the cores take
ROWS_PER_TASK = 1_000_000


def repeat_rows(
    df: DataFrame, count: str, index: str, total: int, spread: list[str], chunk: int = 50_000
) -> DataFrame:
    """Each row ``count`` times, numbered from 1 in ``index``; ``total`` rows in all.

    Few rows can stand for many, so bytes say little about the work ahead. Counts are cut
    into chunks, and chunks are dealt out to a number of tasks that grows with the total.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(total / ROWS_PER_TASK))
    size = F.lit(chunk).cast("long")
    one = F.lit(1).cast("long")
    last = F.floor((F.col(count) - one) / size)
    cut = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return (
        cut.repartition(tasks, *spread, "_chunk")
        .withColumn(
            index,
            F.explode(
                F.sequence(F.col("_chunk") * size + one, F.least(F.col(count), (F.col("_chunk") + one) * size))
            ),
        )
        .drop("_chunk")
    )
