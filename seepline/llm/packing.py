"""Packing token pieces into sequences: dominance reduction, then best fit.

Sizes are whole numbers up to the capacity, so the whole instance is a histogram of at most
``capacity`` counts. The driver reduces and packs that histogram, never the items: a group of
equal bins is one record with a count, and every step places a whole run of equal items.
Items then find their place by their rank within their size; items that fill a sequence need
no rank and are numbered where they lie.

Reduction (Martello and Toth): a small set of items that dominates every other set containing
its largest item is fixed for good. Here: an item alone if nothing fits beside it; an item
with the largest partner, if they fill the bin exactly or no second partner could fit; an
item with its largest partner and a third, if no more could fit and every other pair has a
member no larger than the third. What remains is packed by best fit, largest size first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seepline.llm.common import slices, text_hash, texts
from seepline.llm.tokens import PieceEncoder
from seepline.session import checkpointed

CAPACITY = 2048
#: pieces of one size are ranked in parts of about so many
RANK_ROWS = 100_000


@dataclass
class Plan:
    """Runs of equal items: size, first rank, items, items per bin, offset, first bin."""

    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: int = 0


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Places ``histogram`` (size -> count) into bins of ``capacity``."""
    left = {s: n for s, n in histogram.items() if n > 0}
    if any(s < 1 or s > capacity for s in left):
        raise ValueError("sizes must lie between 1 and the capacity")
    used = dict.fromkeys(left, 0)
    out = Plan()

    def place(size: int, count: int, each: int, offset: int, first: int) -> None:
        out.runs.append((size, used[size], count, each, offset, first))
        used[size] += count
        left[size] -= count
        if not left[size]:
            del left[size]

    def fix(sizes: list[int], times: int) -> None:
        offset = 0
        for s in sizes:
            place(s, times, 1, offset, out.bins)
            offset += s
        out.bins += times

    for size, partners, times in _dominating(left, capacity):
        fix([size, *partners], times)
    _best_fit(left, capacity, out, place)
    return out


def _dominating(left: dict[int, int], capacity: int):
    """Sets that may be fixed and how often, largest item first; the caller takes them out of
    ``left`` before it asks on. A set stays dominating while others are taken away, so it is
    fixed as often as its items last, and the number of steps is bounded by the sizes."""
    for size in sorted(left, reverse=True):
        while left.get(size):
            partners = _partners(left, size, capacity - size)
            if partners is None:
                break
            chosen = [size, *partners]
            yield size, partners, min(left[s] // chosen.count(s) for s in chosen)


def _partners(left: dict[int, int], size: int, room: int) -> list[int] | None:
    """What dominates every other company of an item of ``size``; None if nothing is known to."""
    others = sorted(s for s in left if s <= room and (s != size or left[s] > 1))
    if not others:
        return []
    best = others[-1]

    def spare(s: int) -> int:
        return left[s] - (s == size)

    def two_least(above: int) -> int | None:
        """Sum of the two smallest other items larger than ``above``."""
        found = [s for s in others[bisect_left(others, above + 1) :][:2] for _ in range(min(2, spare(s)))][:2]
        return sum(found) if len(found) == 2 else None

    least = two_least(0)
    if best == room or least is None or least > room:
        return [best]
    third = [s for s in others[:3] for _ in range(min(3, spare(s)))][:3]
    if len(third) == 3 and sum(third) <= room:
        return None
    # at most two others fit: a pair with the largest one serves if every pair has a member
    # no larger than its second
    second = [s for s in others[: bisect_left(others, room - best + 1)] if s != best or spare(s) > 1]
    if second:
        beyond = two_least(second[-1])
        return [best, second[-1]] if beyond is None or beyond > room else None
    return None


def _best_fit(left: dict[int, int], capacity: int, out: Plan, place) -> None:
    """Best fit, largest first. Bins with the same room and the same past form a group;
    a size fills whole groups, from the smallest room that takes it, and splits at most one."""
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins)
    rooms: list[int] = []

    def put(room: int, first: int, bins: int) -> None:
        if room and bins:
            if room not in groups:
                groups[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            groups[room].append((first, bins))

    for size in sorted(left, reverse=True):
        while left.get(size):
            at = bisect_left(rooms, size)
            if at == len(rooms):
                first, bins, room = out.bins, -(-left[size] // (capacity // size)), capacity
                out.bins += bins
            else:
                room = rooms[at]
                first, bins = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            each = room // size
            full = min(bins, left[size] // each)
            if full:
                place(size, full * each, each, capacity - room, first)
                put(room - each * size, first, full)
            rest = left.get(size, 0) if full < bins else 0
            if rest:
                place(size, rest, rest, capacity - room, first + full)
                put(room - rest * size, first + full, 1)
                full += 1
            put(room, first + full, bins - full)


def pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end: int = 0, with_ids: bool = False) -> DataFrame:
    """``doc_id, text_hash, piece, start, length, ids_crc32`` (and ``ids``): the token ids of
    every text with ``end`` added, cut from the back into pieces of ``capacity``.

    NULL text is empty and is one piece that holds ``end`` alone; repeated rows are packed
    each by itself.
    """
    schema = "doc_id long, text_hash long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def cut(batches):
        encode = PieceEncoder(tokenizer)
        for part in slices(batches):
            rows: dict[str, list] = {k: [] for k in ("doc_id", "text_hash", "piece", "start", "length", "ids_crc32")}
            ids = []
            for doc, mark, raw in zip(part["doc_id"], part["text_hash"], encode.batch(part["text"]), strict=True):
                raw += int(end).to_bytes(4, "little")
                total = len(raw) // 4
                at, k = 0, 0
                while at < total:
                    n = capacity if at or total % capacity == 0 else min(total, total % capacity)
                    own = raw[4 * at : 4 * (at + n)]
                    for name, value in (("doc_id", doc), ("text_hash", mark), ("piece", k), ("start", at), ("length", n), ("ids_crc32", zlib.crc32(own))):
                        rows[name].append(value)
                    if with_ids:
                        ids.append(np.frombuffer(own, "<u4").astype(np.int32))
                    at, k = at + n, k + 1
            types = {"piece": pa.int32()}
            arrays = {k: pa.array(v, types.get(k, pa.int64())) for k, v in rows.items()}
            if with_ids:
                arrays["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(arrays)

    return texts(docs).select("doc_id", text_hash().alias("text_hash"), "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """The pieces of ``docs`` with their ``sequence_id`` and ``offset``.

    The driver gets one count per size (fewer than ``capacity``) and one per part of a size (one
    more for each ``RANK_ROWS`` pieces). The run table that tasks search is bounded by the sizes:
    each adds at most two runs for every group of bins, and at most three groups.
    """
    cut = checkpointed(pieces(docs, tokenizer, capacity, end))
    rest = cut.where(F.col("length") < capacity)
    histogram = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    many = {size: -(-n // RANK_ROWS) for size, n in histogram.items()}
    parts = cut.sparkSession.createDataFrame(sorted(many.items()), "length long, parts long")
    dealt = rest.join(parts, "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "text_hash", "piece"), F.col("parts"))).drop("parts")
    # the pieces of a size in the parts before each part
    first = np.cumsum([0, *(many.get(size, 0) for size in range(capacity))])
    base = np.zeros(first[-1] + 1, np.int64)
    for r in dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).collect():
        base[first[r["length"]] + r["part"]] = r["n"]
    base = np.cumsum(base) - base
    base -= base[np.repeat(first, np.diff(np.r_[first, len(base)]))]
    made = plan(histogram, capacity)
    runs = np.array(made.runs, np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    places = cut.sparkSession.sparkContext.broadcast((first, base, runs))
    within = W.partitionBy("length", "part").orderBy("doc_id", "text_hash", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1)

    def placed(batches):
        first, base, runs = places.value
        high = runs[:, 0] << 44 | runs[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            size, part, rank = (b.column(c).to_numpy().astype(np.int64) for c in ("length", "part", "rank"))
            rank = rank + base[first[size] + part]
            run = runs[np.searchsorted(high, size << 44 | rank, "right") - 1]
            at = rank - run[:, 1]
            each = run[:, 3]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(run[:, 5] + at // each), pa.array(run[:, 4] + at % each * size)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    shared = ranked.mapInArrow(placed, schema)
    full = cut.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.monotonically_increasing_id() + made.bins).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return shared.unionByName(full)
