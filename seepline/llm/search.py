"""Ranked lexical search by pipelined term partitioning.

One pass over the documents files the postings of all terms that a query may hold under blocks
of documents. Terms have owners by rarity; an owner's postings are met only in that owner's
stage. *Bundles* travel through the stages, rarest terms first: a bundle is a group of items
in one block of documents with the sparse scores found so far. In each stage bundles and the
owner's postings are cogrouped by block and item group, and integer contributions are added.

Between stages a lower bound of each item's tenth score is taken over all blocks. Scores that
cannot reach it with all terms still to come leave the bundle, and no score is opened any more
once the terms to come could not reach it alone. Both are exact: such a document cannot be
among the results, ties included.

Memory: a cogroup holds one block (``BLOCK`` documents), one group of items and the postings
between them. The filter of terms is a bitmap of fixed size; terms it lets pass by chance fall
away at the join with the items' terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seepline.llm.common import bitmap, slices, written
from seepline.session import checkpointed, fresh_path

#: documents of a block; offsets within one are written as 16 bits
BLOCK = 1024
#: postings after which a block ends early
BLOCK_POSTINGS = 200_000
#: items of a bundle, on average
GROUP = 128
#: bits of the filter of terms
BITS = 1 << 23
#: bytes of a text that are cut into words at a time
PIECE = 1 << 20
SEED = 42
#: a term is owned by the first stage whose share of the documents it does not exceed
SHARES = [64, 16, 4, 1]
#: classes over which a lower bound of the k-th score is taken
SALTS = 64
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(ord(chr(i).lower()) if i < 128 and chr(i).lower().encode() in [bytes([c]) for c in _WORD] else i if i > 127 else 32 for i in range(256))


def terms_of(text: bytes) -> Counter:
    """The terms of a whole UTF-8 text with their occurrences."""
    found: Counter = Counter()
    at, size = 0, len(text)
    while at < size:
        stop = min(at + PIECE, size)
        piece = text[at:stop].translate(_TABLE)
        if stop < size:
            cut = piece.rfind(b" ")
            while cut < 0 and stop < size:  # one term longer than a piece
                start, stop = stop, min(stop + PIECE, size)
                more = text[start:stop].translate(_TABLE)
                cut = more.find(b" ")
                cut = cut if cut < 0 else cut + len(piece)
                piece += more
            if cut >= 0:
                piece, stop = piece[:cut], at + cut + 1
        found.update(piece.split())
        at = stop
    return found


def _bytes_of(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term, mult``: repeated rows are one item; an id with several texts has the terms
    of all of them; rows without ``item_id`` are no items."""

    def split(batches):
        for part in slices(batches):
            for item, text in zip(part["id"], part["text"], strict=True):
                found = terms_of(text)
                if found:
                    yield pa.RecordBatch.from_pydict(
                        {"item": pa.array([item] * len(found), pa.int64()), "term": pa.array(list(found), pa.binary()), "mult": pa.array(list(found.values()), pa.int64())}
                    )

    distinct = _bytes_of(items, "item_id").where("id IS NOT NULL").distinct()
    return distinct.mapInArrow(split, "item long, term binary, mult long").groupBy("item", "term").agg(F.sum("mult").alias("mult"))


class _Block:
    def __init__(self, number: int):
        self.number, self.ids, self.named, self.lengths = number, [], [], []
        self.postings: dict[bytes, tuple[list, list]] = {}
        self.held = 0

    def add(self, doc: int | None, found: Counter, hits: list[bytes]) -> None:
        at = len(self.ids)
        self.ids.append(doc or 0)
        self.named.append(doc is not None)
        self.lengths.append(found.total())
        for term in hits:
            where, tf = self.postings.setdefault(term, ([], []))
            where.append(at)
            tf.append(found[term])
        self.held += len(hits)

    def rows(self) -> Iterator[dict]:
        lengths = np.array(self.lengths, "<i8")
        yield {
            "block": self.number, "ids": np.array(self.ids, "<i8").tobytes(), "named": np.array(self.named, "u1").tobytes(), "lengths": lengths.tobytes(),
            "docs": int((lengths > 0).sum()), "total": int(lengths.sum()),
        }
        for term, (where, tf) in self.postings.items():
            yield {"block": self.number, "term": term, "at": np.array(where, "<u2").tobytes(), "tf": np.array(tf, "<u4").tobytes(), "docs": len(where), "total": max(tf)}


_POSTED = pa.schema(
    [("block", pa.int64()), ("term", pa.binary()), ("at", pa.binary()), ("tf", pa.binary()), ("ids", pa.binary()), ("named", pa.binary()), ("lengths", pa.binary()), ("docs", pa.int64()), ("total", pa.int64())]
)


def post(docs: DataFrame, wanted: bytes) -> DataFrame:
    """Blocks of documents and, under a ``term``, their postings of terms that pass ``wanted``.

    A row without ``term`` is a block: ids, lengths, its number of documents with a term and
    of terms. A row with one has offsets in the block, occurrences, their number and maximum.
    """
    bits = docs.sparkSession.sparkContext.broadcast(wanted)

    def posted(batches):
        import xxhash

        known: dict[bytes, bool] = {}

        def passes(term: bytes) -> bool:
            hit = known.get(term)
            if hit is None:
                if len(known) > 200_000:
                    known.clear()
                place = xxhash.xxh64_intdigest(term, SEED) & (BITS - 1)
                hit = known[term] = bool(bits.value[place >> 3] >> (place & 7) & 1)
            return hit

        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for part in slices(batches):
            for doc, text in zip(part["id"], part["text"], strict=True):
                found = terms_of(text)
                block.add(doc, found, [t for t in found if passes(t)])
                if len(block.ids) == BLOCK or block.held >= BLOCK_POSTINGS:
                    yield pa.RecordBatch.from_pylist(list(block.rows()), _POSTED)
                    block = _Block(block.number + 1)
        if block.ids:
            yield pa.RecordBatch.from_pylist(list(block.rows()), _POSTED)

    schema = "block long, term binary, at binary, tf binary, ids binary, named binary, lengths binary, docs long, total long"
    return _bytes_of(docs, "doc_id").mapInArrow(posted, schema)


def _terms(asked: DataFrame, posted: DataFrame, n: int, groups: int) -> DataFrame:
    """The items' terms with weight, owner and bound, for each group of items that asks for them."""
    df = posted.where("term IS NOT NULL").groupBy("term").agg(F.sum("docs").alias("df"), F.max("total").alias("most"))
    weight = F.floor(1000 * F.log((F.lit(2 * n + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner = F.lit(len(SHARES) - 1)
    for stage in range(len(SHARES) - 2, -1, -1):
        owner = F.when(F.col("df") * SHARES[stage] <= n, stage).otherwise(owner)
    # a document's m is at least 25
    bound = F.col("weight") * F.expr("(1000000000 * most) div (1000 * most + 200)")
    group = F.pmod(F.xxhash64("item"), F.lit(groups))
    met = asked.join(df, "term").withColumn("weight", weight).withColumn("owner", owner).withColumn("bound", bound)
    return met.groupBy("term", group.alias("g"), "weight", "owner", "bound").agg(F.collect_list(F.struct("item", "mult")).alias("asks"))


def _numbers(table: pa.Table, column: str, kind: str) -> np.ndarray:
    parts = [np.frombuffer(x, kind) for x in table.column(column).to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


class _Scores:
    """Scores of the items of a group in one block: dense while a stage adds to them."""

    def __init__(self, bundle: dict, rows: list[dict], n: int, total: int):
        self.items = np.frombuffer(bundle["floor_item"], "<i8")
        self.ids, self.named = np.frombuffer(bundle["ids"], "<i8"), np.frombuffer(bundle["named"], "u1").astype(bool)
        floor, rest = np.frombuffer(bundle["floor"], "<i8"), np.frombuffer(bundle["rest"], "<i8")
        self.s = np.zeros((len(self.items), len(self.ids)), np.int64)
        who, at, held = (np.frombuffer(bundle[c], k) for c, k in (("acc_item", "<u2"), ("acc_at", "<u2"), ("acc", "<i8")))
        stay = held + rest[who] >= floor[who]
        self.s[who[stay], at[stay]] = held[stay]
        shut = rest < floor
        closed = shut[:, None] & (self.s == 0)
        m = 25 + 75 * np.frombuffer(bundle["lengths"], "<i8") * n // max(total, 1)
        for row in rows:
            where, tf = np.frombuffer(row["at"], "<u2"), np.frombuffer(row["tf"], "<u4").astype(np.int64)
            part = row["weight"] * (1_000_000_000 * tf // (1000 * tf + 8 * m[where]))
            asks = row["asks"]
            who = np.searchsorted(self.items, [a["item"] for a in asks])
            mult = np.array([a["mult"] for a in asks], np.int64)
            self.s[np.ix_(who, where)] += mult[:, None] * part
        self.s[closed] = 0

    def best(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(item index, offset) of the ``k`` best of each item, by score and then id."""
        found = []
        for i, row in enumerate(self.s):
            at = np.flatnonzero((row > 0) & self.named)
            if len(at) > k:
                at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
            at = at[np.lexsort((self.ids[at], -row[at]))][:k]
            found.append((np.full(len(at), i), at))
        who, where = zip(*found, strict=True) if found else ((np.zeros(0, int),), (np.zeros(0, int),))
        return np.concatenate(who), np.concatenate(where)


_BUNDLE = "block long, g long, ids binary, named binary, lengths binary, acc_item binary, acc_at binary, acc binary, tops array<struct<item: long, rank: int, score: long>>"


def _stage_task(n: int, total: int, k: int, last: bool):
    kept = ["block", "g", "ids", "named", "lengths"]
    tops_type = pa.list_(pa.struct([("item", pa.int64()), ("rank", pa.int32()), ("score", pa.int64())]))
    out = pa.schema([("block", pa.int64()), ("g", pa.int64())] + [(c, pa.binary()) for c in ("ids", "named", "lengths", "acc_item", "acc_at", "acc")] + [("tops", tops_type)])
    found = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def stage(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.select(["at", "tf", "weight", "asks"]).to_pylist()
        results = []
        for bundle in left.to_pylist():  # one
            scores = _Scores(bundle, rows, n, total)
            who, at = scores.best(k)
            values = scores.s[who, at]
            if last:
                results.append(pa.table([scores.items[who], scores.ids[at], values], schema=found))
                continue
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            tops = [{"item": int(scores.items[w]), "rank": int(r), "score": int(v)} for w, r, v in zip(who, rank, values, strict=True)]
            item, where = np.nonzero(scores.s)
            row = {c: bundle[c] for c in kept} | {
                "acc_item": item.astype("<u2").tobytes(), "acc_at": where.astype("<u2").tobytes(), "acc": scores.s[item, where].astype("<i8").tobytes(), "tops": tops,
            }
            results.append(pa.Table.from_pylist([row], out))
        return pa.concat_tables(results) if results else (found if last else out).empty_table()

    return stage


def _floors(spark: SparkSession, terms: DataFrame, bundles: DataFrame | None, stage: int, k: int) -> DataFrame:
    """For each group, its items in order, the lower bound of their ``k``-th score after the
    stages before ``stage``, and the most that ``stage`` and later ones can add."""
    asks = terms.select("g", "owner", "bound", F.explode("asks").alias("ask")).select("g", "owner", "ask.item", (F.col("bound") * F.col("ask.mult")).alias("most"))
    rest = asks.groupBy("g", "item").agg(F.sum(F.when(F.col("owner") >= stage, F.col("most")).otherwise(0)).alias("rest"))
    if bundles is None:
        rows = rest.withColumn("floor", F.lit(0).cast("long"))
    else:
        tops = bundles.select("g", "block", F.explode("tops").alias("top")).select("g", "block", "top.item", "top.rank", "top.score")
        # the best of each of many classes of documents are different documents
        salt = F.pmod(F.xxhash64("block", "rank"), F.lit(SALTS)).alias("salt")
        classes = tops.groupBy("g", "item", salt).agg(F.max("score").alias("score"))
        kth = classes.groupBy("g", "item").agg(F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).alias("floor"))
        rows = rest.join(kth, ["g", "item"], "left").withColumn("floor", F.coalesce("floor", F.lit(0)))
    return rows.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("item", "floor", "rest"))).alias("floors"))


def _with_floors(bundles: DataFrame, floors: DataFrame, salts: int = 16) -> DataFrame:
    salted = floors.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return bundles.withColumn("salt", F.pmod("block", F.lit(salts))).join(salted, ["g", "salt"]).drop("salt")


def _unpacked(stage):
    """Turn the ``floors`` of a bundle into columns of numbers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        floors = left.column("floors").to_pylist()
        left = left.drop_columns("floors")
        for name, field in (("floor_item", "item"), ("floor", "floor"), ("rest", "rest")):
            left = left.append_column(name, pa.array([np.array([f[field] for f in fs], "<i8").tobytes() for fs in floors], pa.binary()))
        return stage(left, right)

    return run


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for each
    item, equal scores by ascending ``doc_id``.

    NULL or empty texts have no term. Rows without ``doc_id`` count in the statistics and are
    not returned; rows that repeat a ``doc_id`` are documents of their own. Repeated rows of
    ``items`` are one item; rows without ``item_id`` are none. Other columns take no part.
    """
    spark = docs.sparkSession
    asked = checkpointed(item_terms(items))
    posted = written(post(docs, bitmap(asked, "term", BITS)), "postings")
    stats = posted.where("term IS NULL").agg(F.sum("docs"), F.sum("total")).first()
    n, total = stats[0] or 0, stats[1] or 0
    groups = max(1, -(-asked.select("item").distinct().count() // GROUP))
    path = fresh_path(spark, "terms")
    _terms(asked, posted, n, groups).write.partitionBy("owner").parquet(path)
    terms = spark.read.schema("term binary, g long, weight long, bound long, asks array<struct<item: long, mult: long>>, owner int").parquet(path)

    empty = [F.lit(b"").alias(c) for c in ("acc_item", "acc_at", "acc")]
    group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g")
    bundles = posted.where("term IS NULL").select("block", group, "ids", "named", "lengths", *empty)
    results = None
    for stage in range(len(SHARES)):
        last = stage == len(SHARES) - 1
        left = _with_floors(bundles, _floors(spark, terms, bundles if stage else None, stage, k))
        left = left.select("block", "g", "ids", "named", "lengths", "acc_item", "acc_at", "acc", "floors")
        owned = terms.where(F.col("owner") == stage).drop("owner", "bound")
        right = posted.where("term IS NOT NULL").select(F.col("block").alias("block"), "term", "at", "tf").join(owned, "term").drop("term")
        schema = "item_id long, doc_id long, score long" if last else _BUNDLE
        met = left.groupBy("block", "g").cogroup(right.groupBy("block", "g")).applyInArrow(_unpacked(_stage_task(n, total, k, last)), schema)
        if last:
            results = met
        else:
            bundles = written(met, f"bundles-{stage}")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
