"""Measurements stored by sample, so that pivots and lookups by sample move no rows.

A bucketed table is dealt by a hash of the sample once, when it is landed. Aggregates by sample
and joins with tables that are dealt alike then run on each bucket where it lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: least buckets of a table; each is one task of every later pivot
BUCKETS = 64
#: rows of a bucket; a larger table gets twice the buckets, or four times, and so on
ROWS_PER_BUCKET = 2_000_000
#: what Spark allows by default (``spark.sql.sources.bucketing.maxBuckets``)
_MOST = 100_000


def land_samples(
    df: DataFrame, table: str, path: str, key: str = "sampleid", buckets: int = BUCKETS, rows_per_bucket: int | None = ROWS_PER_BUCKET
) -> DataFrame:
    """Store the rows of ``df`` that have a sample as the catalog table ``table`` below ``path``,
    one sorted file per bucket; returns it.

    ``buckets`` are doubled until one holds about ``rows_per_bucket`` rows, so that tasks get
    more and not longer as tables grow. Without it there are just so many: a table that is to
    be dealt like another one takes that one's number.

    Rows without a sample belong to no bucket. They are stored as plain files below
    ``path`` + ``-loose``, spread over tasks, and ``loose_rows`` reads them.
    """
    known = F.col(key).isNotNull()
    if rows_per_bucket:
        rows = df.where(known).count()
        while buckets * rows_per_bucket < rows and 2 * buckets <= _MOST:
            buckets *= 2
    dealt = df.where(known).repartition(buckets, key)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    df.where(~known).write.parquet(f"{path}-loose")
    return df.sparkSession.table(table)


def loose_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}-loose")
