"""Lines shared by several documents, dropped by hash (DataFrame operations only).

Hashes of lines are range-partitioned by (hash, document from the largest down): a very common
line is spread over as many partitions as its documents fill, and within a partition the rows
of a hash lie together in document and position order. They are read as a stream: a sort
aggregate over the sorted rows, which holds one document of one hash at a time, yields the
first occurrence of each hash in each document. Per hash only a partial count and the first of
these leave a partition, and the answer meets the lines of a hash in several salted places.
What is returned is one run-length bitmap of kept lines per document, no text.

NULL text is one empty line. Rows without ``doc_id`` count for nothing and keep all lines.
Rows that repeat a ``doc_id`` count as one document; each is judged on its own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import text_hash, texts

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
SALTS = 8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends, A-Z lower-cased (other letters stay)."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def first_occurrences(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``h1, h2, back, at`` in sorted range partitions, and of each hash and document the first
    ``at`` with the number of ``lines``. ``back`` is the complement of ``doc_id``, so that the
    largest document comes first."""
    # no NULL is left in doc_id; a column that cannot be NULL gets no filter of its own from a join
    back = F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long"))
    hashed = lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), back.alias("back"), "at")
    ranged = hashed.repartitionByRange("h1", "h2", "back").sortWithinPartitions("h1", "h2", "back", "at")
    # "first" keeps the order of the rows below it, and a struct is aggregated by sorting only:
    # the rows are sorted already, so nothing is hashed or sorted again
    return ranged, ranged.groupBy("h1", "h2", "back").agg(F.first("at").alias("at"), F.count(F.lit(1)).alias("lines"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, only_first: bool = False) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, keep``: one row per text that loses a line.

    ``keep`` is the bitmap of kept lines as runs ``(start, length)`` of ones. A key of at
    least ``min_chars`` code points found in at least ``min_docs`` documents is kept only in
    the largest ``doc_id`` that holds it; there every line with it stays or, with
    ``only_first``, the first one (of rows that repeat the ``doc_id``, the first in order of
    position, then of text hash). Texts without a row keep all their lines.
    """
    rows = texts(docs).where("doc_id IS NOT NULL").select("doc_id", text_hash().alias("text_hash"), lines_of(F.col("text")).alias("lines"))
    keyed = rows.select("doc_id", "text_hash", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    ranged, firsts = first_occurrences(keyed.where(F.char_length("key") >= min_chars).withColumn("at", F.struct("pos", "text_hash", "n")))
    # firsts and lines are read from one exchange, as both use all of its columns
    totals = firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("back", "at")).alias("kept"), F.sum("lines").alias("lines"))
    shared = totals.where((F.col("docs") >= min_docs) & (F.col("lines") >= min_docs))
    # the lines of a shared hash meet what is kept of it in SALTS places; a salt that cannot be
    # NULL needs no filter below the exchange, which so stays the one of the totals
    salted = shared.select("h1", "h2", "kept", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    spread = ranged.withColumn("salt", F.coalesce(F.pmod("back", F.lit(SALTS)).cast("int"), F.lit(0)))
    gone = F.col("back") != F.col("kept.back")
    gone = gone | (F.col("at") != F.col("kept.at")) if only_first else gone
    lost = spread.join(salted, ["h1", "h2", "salt"]).where(gone).select(F.bitwise_not("back").alias("doc_id"), "at")
    per_text = lost.groupBy("doc_id", F.col("at.text_hash").alias("text_hash"), F.col("at.n").alias("n_lines")).agg(
        F.sort_array(F.collect_set(F.col("at.pos"))).alias("pos")
    )
    gaps = F.zip_with(
        F.concat(F.array(F.lit(-1)), F.col("pos")),
        F.concat(F.col("pos"), F.array(F.col("n_lines"))),
        lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")),
    )
    return per_text.select(
        "doc_id", "text_hash", "n_lines", F.size("pos").alias("n_dropped"), F.filter(gaps, lambda r: r["length"] > 0).alias("keep")
    )


def kept_text(text: Column, keep: Column) -> Column:
    """``text`` reduced to the runs of lines in ``keep``; a NULL bitmap keeps everything."""
    lines = lines_of(text)
    return F.when(keep.isNull(), text).otherwise(
        F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    )


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) and the bitmap's columns."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
    )
    return packed.join(bitmaps, ["doc_id", "text_hash"], "left")


def dedup_lines(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` with shared lines dropped from ``text`` (``n_chars``, if there,
    follows); a row that loses all its lines has an empty text."""
    met = with_bitmaps(docs, keep_bitmaps(docs, **limits)).withColumn("kept", kept_text(F.col("row.text"), F.col("keep")))
    lost = F.col("keep").isNotNull()
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept")}
    return met.select(
        *[
            (F.when(lost, new[c]).otherwise(F.col("row")[c]).cast(docs.schema[c].dataType) if c in new else F.col("row")[c]).alias(c)
            for c in docs.columns
        ]
    )
