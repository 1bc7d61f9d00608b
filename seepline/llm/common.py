"""Helpers of the text operators: inputs, bounded slices of Arrow batches, components.

A *row key* is ``(doc_id, text_hash)``: rows that repeat a ``doc_id`` with another text stay
apart, while equal rows share one key and one answer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seepline.session import checkpointed, fresh_path

#: text that a Python task holds as objects at a time
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (NULL text is empty): no other column takes part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, stem: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder, for intermediate rows that are many
    and read more than once."""
    path = fresh_path(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text: Column | str = "text") -> Column:
    return F.xxhash64(text)


def slices(batches: Iterable[pa.RecordBatch], sized: str = "text", most: int = SLICE_BYTES) -> Iterator[dict[str, list]]:
    """Columns as Python lists, in runs of rows whose ``sized`` column stays near ``most``
    bytes. A single longer row is a run of its own; every row is in exactly one run."""
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(sized)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start).to_pydict()
                start, held = i, 0
            held += n + 64
        if start < batch.num_rows:
            yield batch.slice(start).to_pydict()


def place(column: str, bits: int) -> Column:
    """Where ``bitmap`` marks a value: XXH64 of seed 42 modulo ``bits``, which is a power of two."""
    return F.pmod(F.xxhash64(column), F.lit(bits))


def bitmap(values: DataFrame, column: str, bits: int) -> bytes:
    """A bitmap of ``bits`` bits with the places of all values: its size does not grow with
    their number. Reduced to bytes in Spark; the driver reads one number per byte at most."""
    marks = values.select(place(column, bits).alias("place")).selectExpr("cast(place div 8 as int) AS byte", "shiftleft(1, cast(place % 8 as int)) AS bit")
    held = bytearray(bits // 8)
    for row in marks.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        held[row["byte"]] = row["bits"]
    return bytes(held)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node that links reach, for each node with a link.

    ``edges`` has the long columns ``a`` and ``b``. Alternating large and small stars: each
    round hangs all larger neighbours of a node on its smallest one, which keeps components
    and halves distances. A node's smallest neighbour is a partial aggregate, so a node with
    very many links costs no more than its rows; the join back can be split by adaptive
    execution. Each round is written by ``checkpoint()``. Empty links give an empty table.
    """
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = checkpointed(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    hung = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
