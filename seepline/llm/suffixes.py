"""Repeated byte strings, removed by a sparse, range-partitioned suffix sort.

Every byte covered by a ``length``-byte string that also starts elsewhere goes. Sorting all
suffixes would move ``length`` times the text, so each string is first filed under an
*anchor*: the smallest-hashed ``gram``-byte piece inside it (leftmost of equals). Equal
strings have equal anchors at equal offsets, and the strings of one anchor start at adjacent
bytes; an anchor with its starts is a *run*, and the bytes its strings span are its
*context*. A byte stands in about two runs of 85 starts each.

1. Runs are counted by anchor hash (partial aggregates). An anchor that occurs once holds no
   repeat. If all contexts of an anchor are equal, all its strings repeat.
2. Only anchors with different contexts need their strings compared, and of equal contexts
   only one. Contexts are range-partitioned by the leading bytes at their anchor, with
   splitters that Spark samples. A bucket orders the suffixes of its contexts by multikey
   quicksort (the next key is looked at only among equals) and compares neighbours.
3. An anchor with more than ``HOT_CONTEXTS`` different contexts would fill a bucket alone. Its
   suffixes are range-partitioned themselves, by leading bytes, digest and place, so that
   even a string with very many places spreads; the first and last string of each bucket are
   compared across the boundary.
4. What repeats is joined back to all runs, merged into spans per document, and cut out.

Contexts and strings count as equal if a 64-bit digest and the anchor hash, or the leading
eight bytes, agree. NULL text is empty; rows with equal ``doc_id`` and text are places of
their own, so that their strings repeat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import slices, text_hash, texts, written
from seepline.session import checkpointed

LENGTH = 200
GRAM = 32
#: starts of one long text looked at in one go
_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
#: different contexts of one anchor that a bucket takes
HOT_CONTEXTS = 16_384
#: suffixes of a bucket, on average, where they are range-partitioned one by one
BUCKET_SUFFIXES = 500_000
#: suffixes that a bucket orders at a time, or those of one anchor
_AT_ONCE = 1_000_000
# a run is packed into a long: its start, how far its anchor is from it, its number of starts
_FIELD = 12
_MASK = (1 << _FIELD) - 1


def packed(start, offset, many):
    return start << 2 * _FIELD | offset << _FIELD | many


def unpacked(run: int) -> tuple[int, int, int]:
    return run >> 2 * _FIELD, run >> _FIELD & _MASK, run & _MASK


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit polynomial hash of the ``gram`` bytes from each position on."""
    n = len(data)
    powers = np.empty(n + 1, np.uint64)
    powers[0], powers[1:] = 1, _BASE
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    back = np.empty(n - gram + 1, np.uint64)
    back[0], back[1:] = 1, pow(_BASE, -1, 1 << 64)
    np.multiply.accumulate(back, out=back)
    h = (sums[gram:] - sums[: n - gram + 1]) * back
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, from running minima of blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def runs_of(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, first start (in ``data``), anchor's distance, starts and anchor hash of
    every run."""
    gram = min(gram, length)
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    h = gram_hashes(data, gram)
    low = np.uint64((1 << 24) - 1)
    ranked = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_least(ranked, length - gram + 1) & low).astype(np.int64)
    count = np.maximum(sizes - length + 1, 0)
    row = np.repeat(np.arange(len(sizes)), count)
    start = begins[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = anchor[start]
    head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, np.int64)
    return row[head], start[head], at[head] - start[head], np.diff(np.r_[head, len(row)]), h[at[head]]


def _pieces(data: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces that overlap by ``length - 1`` bytes: each start is in one piece."""
    yield 0, data[: _PIECE + length - 1]
    for at in range(_PIECE, max(_PIECE, len(data) - length + 1), _PIECE):
        yield at, data[at : at + _PIECE + length - 1]


def _run_task(length: int, gram: int):
    def runs(batches):
        import xxhash

        for part in slices(batches):
            held = [(k, at, piece) for k, t in enumerate(part["text"]) for at, piece in _pieces(t.encode(), length) if len(piece) >= length]
            while held:
                size, take = 0, 0
                while take < len(held) and (take == 0 or size + len(held[take][2]) < 2 * _PIECE):
                    size += len(held[take][2])
                    take += 1
                now, held = held[:take], held[take:]
                raw = b"".join(p for _, _, p in now)
                sizes = np.array([len(p) for _, _, p in now], np.int64)
                begins = np.cumsum(sizes) - sizes
                row, start, offset, many, anchor = runs_of(np.frombuffer(raw, np.uint8), begins, sizes, length, gram)
                view, digest = memoryview(raw), xxhash.xxh3_64_intdigest
                context = np.array([digest(view[s : s + n + length - 1]) for s, n in zip(start.tolist(), many.tolist(), strict=True)], np.uint64)
                own = np.array([k for k, _, _ in now], np.int64)[row]
                place = start - begins[row] + np.array([at for _, at, _ in now], np.int64)[row]
                ids = pa.array(part["doc_id"], pa.int64()).take(pa.array(own))
                marks = pa.array(part["text_hash"], pa.int64()).take(pa.array(own))
                for i in range(0, len(row), 50_000):
                    j = slice(i, i + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [ids[j], marks[j], pa.array(packed(place[j], offset[j], many[j])), pa.array(anchor[j].view(np.int64)), pa.array(context[j].view(np.int64))],
                        names=["doc_id", "text_hash", "run", "anchor", "context"],
                    )

    return runs


def runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, text_hash, run, anchor, context`` of every run of every text."""
    if length > _MASK:
        raise ValueError("length is too large for the packed runs")
    rows = texts(docs).where(F.octet_length("text") >= length).select("doc_id", text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(_run_task(length, gram), "doc_id long, text_hash long, run long, anchor long, context long")


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """An order by several keys in which a later key is read only among equals of the earlier."""
    order = np.argsort(keys[0], kind="stable")
    tied = np.zeros(len(order), np.int64)
    for depth in range(1, len(keys)):
        before = keys[depth - 1][order]
        tied = np.cumsum(np.r_[False, (before[1:] != before[:-1]) | (tied[1:] != tied[:-1])]) if len(order) else tied
        sizes = np.bincount(tied) if len(tied) else np.zeros(0, np.int64)
        open_ = np.flatnonzero(sizes[tied] > 1)
        if not len(open_):
            return order
        own = order[open_]
        order[open_] = own[np.lexsort((keys[depth][own], tied[open_]))]
    return order


def _leading(raw: bytes) -> np.ndarray:
    """The eight bytes from each position on (the last seven positions left out), as longs
    that order like the bytes."""
    heads = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), 8)
    return (np.ascontiguousarray(heads).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _context_task(length: int):
    """The bytes of chosen runs, with the leading bytes at their anchor."""

    def contexts(batches):
        for part in slices(batches):
            out: dict[str, list] = {k: [] for k in ("lead", "anchor", "context", "bytes")}
            for text, chosen in zip(part["text"], part["chosen"], strict=True):
                raw = text.encode()
                for c in chosen:
                    start, offset, many = unpacked(c["run"])
                    at = start + offset
                    out["lead"].append(int.from_bytes(raw[at : at + 8], "big") - (1 << 63))
                    out["anchor"].append(c["anchor"])
                    out["context"].append(c["context"])
                    out["bytes"].append(raw[start : start + many + length - 1])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(out[k], pa.int64()) for k in ("lead", "anchor", "context")), pa.array(out["bytes"], pa.binary())], names=list(out)
            )

    return contexts


def repeated_offsets(rows: list[bytes], group: np.ndarray, length: int) -> list[np.ndarray]:
    """Per context, where a string starts that some context of the same group holds too."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    counts = np.array([len(r) - length + 1 for r in rows], np.int64)
    lead = np.concatenate([_leading(r)[:n] for r, n in zip(rows, counts, strict=True)])
    whole = np.array([digest(v[i : i + length]) for r, n in zip(rows, counts, strict=True) for v in (memoryview(r),) for i in range(n)], np.uint64).view(np.int64)
    owner = np.repeat(np.asarray(group, np.int64), counts)
    order = multikey_order([lead, whole, owner])
    same = (lead[order][1:] == lead[order][:-1]) & (whole[order][1:] == whole[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.zeros(len(order), bool)
    repeated[order] = np.r_[False, same] | np.r_[same, False]
    ends = np.cumsum(counts)
    return [np.flatnonzero(repeated[e - n : e]) for e, n in zip(ends, counts, strict=True)]


def _group_task(length: int):
    """Reads contexts sorted by anchor; orders the suffixes of whole anchors, some at a time."""

    def offsets(batches):
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            for anchor, context, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "bytes")), strict=True):
                if size >= _AT_ONCE and held[-1][0] != anchor:
                    yield _offset_rows(held, length)
                    held, size = [], 0
                held.append((anchor, context, raw))
                size += len(raw) - length + 1
        if held:
            yield _offset_rows(held, length)

    return offsets


def _offset_rows(held: list[tuple[int, int, bytes]], length: int) -> pa.RecordBatch:
    found = repeated_offsets([r for _, _, r in held], np.array([a for a, _, _ in held], np.int64), length)
    some = [i for i, f in enumerate(found) if len(f)]
    return pa.RecordBatch.from_arrays(
        [pa.array([held[i][0] for i in some], pa.int64()), pa.array([held[i][1] for i in some], pa.int64()), pa.array([_islands(found[i]) for i in some], pa.list_(pa.int32()))],
        names=["anchor", "context", "offsets"],
    )


def _islands(offsets: np.ndarray) -> np.ndarray:
    """Sorted offsets as packed runs ``first << 12 | many``."""
    first = np.flatnonzero(np.r_[True, np.diff(offsets) > 1])
    many = np.diff(np.r_[first, len(offsets)])
    return (offsets[first] << _FIELD | many).astype(np.int32)


def _suffix_task(length: int):
    """The strings of chosen runs one by one: leading bytes, digest, and whose they are."""

    def suffixes(batches):
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for part in slices(batches):
            for text, chosen in zip(part["text"], part["chosen"], strict=True):
                raw = text.encode()
                view = memoryview(raw)
                for c in chosen:
                    at, _, n = unpacked(c["run"])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_leading(raw[at : at + n + 7])),
                            pa.array(np.array([digest(view[s : s + length]) for s in range(at, at + n)], np.uint64).view(np.int64)),
                            pa.array(np.full(n, c["anchor"], np.int64)),
                            pa.array(np.full(n, c["context"], np.int64)),
                            pa.array(np.arange(n, dtype=np.int32)),
                        ],
                        names=["lead", "digest", "anchor", "context", "offset"],
                    )

    return suffixes


def _batched(task, rows: int = 50_000):
    """The record batches of ``task`` joined to fewer, larger ones."""

    def joined(batches):
        held, size = [], 0
        for b in task(batches):
            held.append(b)
            size += b.num_rows
            if size >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


_BUCKET = "anchor long, context long, offset int, repeated boolean, bucket int, end int, lead long, digest long"


def _bucket_task(batches):
    """Sorts one bucket and yields the strings that equal a neighbour, and its two ends."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    lead, digest = (table.column(c).to_numpy() for c in ("lead", "digest"))
    order = multikey_order([lead, digest])
    same = np.r_[False, (lead[order][1:] == lead[order][:-1]) & (digest[order][1:] == digest[order][:-1])]
    repeated = same | np.r_[same[1:], False]
    end = np.zeros(len(order), np.int32)
    end[0], end[-1] = 1, end[-1] | 2
    if len(order) == 1:
        end[0] = 3
    keep = np.flatnonzero(repeated | (end > 0))
    found = table.take(pa.array(order[keep]))
    for i in range(0, len(keep), 50_000):
        j = slice(i, i + 50_000)
        part = found.slice(i, 50_000).combine_chunks()
        n = part.num_rows
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c).combine_chunks() for c in ("anchor", "context", "offset")), pa.array(repeated[keep[j]]),
             pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), pa.array(end[keep[j]]),
             *(part.column(c).combine_chunks() for c in ("lead", "digest"))],
            names=["anchor", "context", "offset", "repeated", "bucket", "end", "lead", "digest"],
        )


def repeated_strings(suffixes: DataFrame, total: int) -> DataFrame:
    """``anchor, context, offset`` of the strings with an equal elsewhere among ``suffixes``.

    There are ``total`` of them; the buckets grow with that number, so that a bucket does not.
    """
    buckets = max(1, math.ceil(total / BUCKET_SUFFIXES))
    ranged = suffixes.repartitionByRange(buckets, "lead", "digest", "anchor", "context", "offset")
    found = checkpointed(ranged.mapInArrow(_bucket_task, _BUCKET))
    # two rows per bucket: the strings at its ends
    ends = sorted(found.where("end > 0").collect(), key=lambda r: r["bucket"])
    last = {r["bucket"]: r for r in ends if r["end"] & 2}
    first = {r["bucket"]: r for r in ends if r["end"] & 1}
    across = set()
    for a, b in zip(sorted(last), sorted(last)[1:], strict=False):
        if (last[a]["lead"], last[a]["digest"]) == (first[b]["lead"], first[b]["digest"]):
            across |= {tuple(r[c] for c in ("anchor", "context", "offset")) for r in (last[a], first[b])}
    inside = found.where("repeated").select("anchor", "context", "offset")
    met = suffixes.sparkSession.createDataFrame(sorted(across), "anchor long, context long, offset int")
    return inside.unionByName(met).distinct()


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("text_hash", text_hash())


def _same_row(rows: DataFrame, other: DataFrame):
    return (rows["text_hash"] == other["text_hash"]) & rows["doc_id"].eqNullSafe(other["doc_id"])


def _holding(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """``text`` with the chosen runs of each document that has any."""
    chosen = contexts.groupBy("at.doc_id", "at.text_hash").agg(F.collect_list(F.struct("anchor", "context", "at.run")).alias("chosen"))
    return rows.join(chosen, _same_row(rows, chosen)).select("text", "chosen")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, text_hash, marks``: for each text with a repeated string, the packed runs of
    such strings' starts."""
    found = runs(docs, length, gram)
    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("mixed")).where("n > 1")
    # a written table, so that adaptive execution can split the runs of a hot anchor
    anchors = written(anchors.select("anchor", "mixed"), "anchors")
    marked = written(found.join(anchors, "anchor"), "runs")
    mixed = marked.where("mixed")
    contexts = mixed.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash", "run")).alias("at"))
    contexts = written(contexts, "contexts")
    rows = keyed(docs)
    starts = F.col("at.run").bitwiseAND(F.lit(_MASK))
    sizes = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(starts).alias("starts"))
    hot = checkpointed(sizes.where(F.col("n") > HOT_CONTEXTS).select("anchor", "starts"))
    some_hot = hot.agg(F.sum("starts")).first()[0]
    usual = contexts.join(hot, "anchor", "left_anti") if some_hot else contexts
    held = _holding(rows, usual).mapInArrow(_context_task(length), "lead long, anchor long, context long, bytes binary")
    ranged = held.repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor", "context")
    strings = ranged.select("anchor", "context", "bytes").mapInArrow(_group_task(length), "anchor long, context long, offsets array<int>")
    if some_hot:
        suffixes = _holding(rows, contexts.join(hot, "anchor", "left_semi"))
        suffixes = suffixes.mapInArrow(_batched(_suffix_task(length)), "lead long, digest long, anchor long, context long, offset int")
        many = repeated_strings(suffixes, some_hot).groupBy("anchor", "context").agg(F.collect_list(F.shiftleft("offset", _FIELD) + 1).alias("offsets"))
        strings = strings.unionByName(many)
    # of a context that occurs more than once every string repeats; of others there is one
    # run each, and its strings are those found in the buckets
    whole = mixed.join(contexts.where("copies > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    alone = contexts.where("copies = 1").join(strings, ["anchor", "context"])
    start = F.shiftright("at.run", 2 * _FIELD)
    single = F.transform(
        F.col("offsets"), lambda o: F.shiftleft(start + F.shiftright(o, _FIELD), 2 * _FIELD).bitwiseOR(o.bitwiseAND(F.lit(_MASK)).cast("long"))
    )
    partial = alone.select("at.doc_id", "at.text_hash", F.explode(single).alias("run"))
    every = marked.where("NOT mixed").unionByName(whole).select("doc_id", "text_hash", "run").unionByName(partial)
    return every.groupBy("doc_id", "text_hash").agg(F.collect_set("run").alias("marks"))


def covered(marks: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal spans of bytes covered by strings of ``length`` that start at ``marks``."""
    out: list[tuple[int, int]] = []
    for start, _, many in sorted(map(unpacked, marks)):
        end = start + many - 1 + length
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed spans and the remaining bytes of each row."""
    marks = repeats(docs, length, gram)
    rows = keyed(docs)
    met = rows.join(marks, _same_row(rows, marks), "left").select(rows["doc_id"], "text", "marks")

    def cut(batches):
        for part in slices(batches):
            spans = [covered(m or [], length) for m in part["marks"]]
            raws = [t.encode() for t in part["text"]]
            kept = []
            for raw, gone in zip(raws, spans, strict=True):
                ends = [0, *(e for _, e in gone)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in gone), len(raw)], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part["doc_id"], pa.int64()),
                    pa.array([len(r) for r in raws], pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in g] for g in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return met.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
