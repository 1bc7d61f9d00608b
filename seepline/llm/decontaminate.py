"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

Texts are compared as lower-cased characters with every run of other signs as one space. A
passage of ``m`` characters that occurs with at most ``e`` edits shares at least
``m + 1 - q * (e + 1)`` q-grams with its place in the document, all within ``e`` diagonals of
one another. Shared q-grams are counted in diagonal bands of width ``2 * e + 1`` that overlap
by half, so each such place lies in one band whole; bands at or above the bound are aligned
with a banded edit distance whose band covers them.

An item is looked for whole and in parts: windows of ``window(m)`` characters, one every
``STEPS`` of their length and one at the end, and its lines of ``LEAST_LINE`` or more. Each part
is a passage of its own with its own budget and bound; its shared q-grams are counted where the
item itself shares enough for one of its parts, and parts are aligned where the item is not
found whole. An item counts if it is found whole, or
if the parts found cover at least ``window(m)`` of its characters. So any run of 94 characters
(58 of an item below 200) is found, and so are lines that together are as long as a window.
Items not longer than a window must be found whole.

Passages are taken in blocks of bounded size; every block's q-gram table is sent to the tasks
and every document is held against all blocks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import SLICE_BYTES, slices, texts

Q = 8
#: edits allowed for each character of a passage
EDIT_RATE = 0.1
#: characters of a window of items from so many characters on
WINDOWS = ((200, 79), (0, 49))
#: a window begins after this part of the one before it
STEPS = 5
#: the shortest line that is looked for on its own
LEAST_LINE = 29
#: characters of items in one block, the bound of what is broadcast at a time
BLOCK_CHARS = 2_000_000
#: shared q-grams, and candidate cells of the alignment, that a task looks at in one go
_AT_ONCE = 2_000_000
_BITS = 22
_FAR = 1 << 20
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters or digits."""
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def normal(text: str) -> np.ndarray:
    """Code points of the lower-cased text; each run of other signs is one space, none at
    either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    word = _letters()[points]
    begins = np.r_[False, word[:-1]] & ~word if len(word) else word
    kept = np.where(word, points, np.uint32(32))[word | begins]
    return kept[:-1] if len(kept) and kept[-1] == 32 else kept


def qgrams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the ``q`` code points from each position on, by doubling."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    held, size = points.astype(np.uint64) * _MIX[0], 1
    held ^= held >> np.uint64(31)
    while size < q:
        step = min(size, q - size)
        held = (held[: len(held) - step] * _MIX[1] + held[step:]) * _MIX[2]
        held ^= held >> np.uint64(29)
        size += step
    return held


def edits_allowed(m: int, q: int = Q, rate: float = EDIT_RATE, least: int = 1) -> int:
    """The budget of a passage: ``rate`` of its length, and never so much that the lemma
    asks for fewer than ``least`` shared q-grams."""
    return max(0, min(int(rate * m), (m + 1 - least - q) // q))


def window(m: int) -> int:
    """Characters of the windows of an item of ``m`` characters."""
    return next(w for least, w in WINDOWS if m >= least)


def parts(text: str, points: np.ndarray) -> list[tuple[int, int]]:
    """Start and end, in the compared characters, of an item's windows and lines."""
    m, w = len(points), window(len(points))
    if m <= w:
        return []
    out = {(s, s + w) for s in [*range(0, m - w, w // STEPS + 1), m - w]}
    at = 0
    for line in text.split("\n"):
        n = len(normal(line))
        if LEAST_LINE <= n < m:
            out.add((at, at + n))
        at += n + (n > 0)
    return sorted(out)


class Block:
    """Passages, their q-grams sorted by hash, and a bit table that sorts out most others.
    With ``cut`` the items' parts are passages too."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float, cut: bool = False):
        self.q = q
        whole = [(i, t, p) for i, t, p in ((i, t, normal(t)) for i, t in items) if len(p)]
        spans = [(k, 0, len(p)) for k, (_, _, p) in enumerate(whole)]
        spans += [(k, *span) for k, (_, t, p) in enumerate(whole) if cut for span in parts(t, p)]
        kept = [(whole[k][0], whole[k][2][s:e]) for k, s, e in spans]
        self.ids = np.array([i for i, _ in kept], np.int64)
        #: the text a passage belongs to, and its place there; the first passages are whole texts
        self.spans = np.array(spans, np.int64).reshape(-1, 3)
        self.whole = len(whole)
        self.points = [p for _, p in kept]
        self.sizes = np.array([len(p) for p in self.points], np.int64)
        least = [1 if n < self.whole else q + 1 for n in range(len(kept))]
        self.edits = np.array([edits_allowed(len(p), q, rate, k) for p, k in zip(self.points, least, strict=True)], np.int64)
        self.needed = np.maximum(1, self.sizes + 1 - q * (self.edits + 1))
        grams = [qgrams(p, q) for p in self.points[: self.whole]]
        self.hash = np.concatenate([*grams, np.zeros(0, np.uint64)])
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        self.at = np.concatenate([*map(np.arange, map(len, grams)), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(self.hash, kind="stable")
        # the parts that hold each q-gram, in runs
        base = np.cumsum([0, *map(len, grams)])
        own, starts, ends = self.spans[self.whole :].T
        held = np.maximum(0, ends - starts - q + 1)
        gram = np.repeat(base[own] + starts, held) + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        by_gram = np.argsort(gram, kind="stable")
        self.part = np.repeat(np.arange(self.whole, len(kept)), held)[by_gram].astype(np.int32)
        self.parts = np.bincount(gram, minlength=len(self.hash))[order]
        self.first_part = np.searchsorted(gram[by_gram], order).astype(np.int64)
        # what all parts of a text have in common
        self.part_edits, self.part_needed = np.zeros(self.whole, np.int64), np.full(self.whole, _FAR)
        np.maximum.at(self.part_edits, own, self.edits[self.whole :])
        np.minimum.at(self.part_needed, own, self.needed[self.whole :])
        self.hash, self.item, self.at = self.hash[order], self.item[order], self.at[order]
        self.table = np.zeros(1 << _BITS, bool)
        self.table[self.hash >> np.uint64(64 - _BITS)] = True
        #: passages shorter than a q-gram are looked up as they are
        self.short = [(i, p) for i, p in zip(self.ids[: self.whole], self.points, strict=False) if len(p) < q]


def held_against(block: Block, points: np.ndarray, begins: np.ndarray, align) -> None:
    """Calls ``align`` with the document, passage, first diagonal and width of each band with
    enough shared q-grams: whole texts first, and then the parts of those that ``align`` does not
    return as found whole, as ``document * block.whole + text``. ``points`` holds the documents one
    after another, with a sign that no passage has between them; they start at ``begins``."""
    grams = qgrams(points, block.q)
    place = np.flatnonzero(block.table[grams >> np.uint64(64 - _BITS)])
    first = np.searchsorted(block.hash, grams[place], "left")
    count = np.searchsorted(block.hash, grams[place], "right") - first
    place, first, count = place[count > 0], first[count > 0], count[count > 0]
    doc = np.searchsorted(begins, place, "right") - 1
    # all votes for one place of a passage are so near one another
    reach = int((block.sizes + 3 * block.edits).max(initial=0)) + block.q
    for start, stop in _runs(doc, place, count, reach):
        part = slice(start, stop)
        row, entry = _spread(np.arange(start, stop), first[part], count[part])
        item, offset = block.item[entry], block.at[entry]
        here = place[row] - begins[doc[row]]
        pair = doc[row] * block.whole + item
        done = align(_candidates(block, _enough(pair, here, offset, block.edits[item], lambda p: block.needed[p % block.whole]), block.whole))
        # a part has its q-grams in one band of the text, too
        key, bits = _keys(pair, here - offset, block.part_edits[item])
        some, n = _tally(key)
        some = some[n >= block.part_needed[(some >> bits) % block.whole]]
        near = _among(key, some).reshape(2, -1).any(axis=0) & ~np.isin(pair, done)
        own, entry, here = doc[row[near]], entry[near], here[near]
        for a, b in _runs(own, place[row[near]], block.parts[entry], reach):
            line, at = _spread(np.arange(a, b), block.first_part[entry[a:b]], block.parts[entry[a:b]])
            passage = block.part[at].astype(np.int64)
            offset = block.at[entry[line]] - block.spans[passage, 1]
            pairs, pair = np.unique(own[line] * len(block.ids) + passage, return_inverse=True)
            found = _enough(pair, here[line], offset, block.edits[passage], lambda p, pairs=pairs: block.needed[pairs[p] % len(block.ids)])
            align(_candidates(block, (pairs[found[0]], found[1]), len(block.ids)))


def _runs(doc: np.ndarray, place: np.ndarray, count: np.ndarray, reach: int):
    """Start and end of runs of rows, in order of place, with about ``_AT_ONCE`` counts. A
    document with more is cut into runs that overlap by ``reach`` places, so that the votes for
    one place of a passage are together in one of them."""
    start, ends = 0, np.cumsum(count)
    while start < len(doc):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _AT_ONCE, "right")))
        first, last = (int(np.searchsorted(doc, doc[stop - 1], side)) for side in ("left", "right"))
        if last == stop or first > start:
            stop = stop if last == stop else first
        else:
            stop = min(last, max(stop, int(np.searchsorted(place, place[start] + 2 * reach, "right"))))
        yield start, stop
        start = stop if stop == len(doc) or doc[stop] != doc[stop - 1] else int(np.searchsorted(place, place[stop] - reach))


def _spread(row: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row ``count`` times, with the numbers from ``first`` on."""
    out = np.repeat(row, count)
    return out, np.repeat(first, count) + np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count)


def _keys(pair: np.ndarray, diagonal: np.ndarray, edits: np.ndarray) -> tuple[np.ndarray, int]:
    """The two bands of each vote below its pair, and the bits that a band takes: as few as
    these diagonals need, so that any number of pairs has room above them."""
    band = diagonal // (edits + 1)
    bits = int(np.abs(band).max(initial=0) + 2).bit_length() + 1
    key = (pair << bits) + (1 << bits - 1)
    return np.concatenate([key + band, key + band - 1]), bits


def _tally(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ranked = np.sort(key)
    heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)])
    return ranked[heads], np.diff(np.r_[heads, len(ranked)])


def _among(key: np.ndarray, some: np.ndarray) -> np.ndarray:
    return some[np.minimum(np.searchsorted(some, key), len(some) - 1)] == key if len(some) else np.zeros(len(key), bool)


def _enough(pair: np.ndarray, here: np.ndarray, offset: np.ndarray, edits: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
    """Pair and band of the bands with as many shared q-grams as ``needed`` says of a pair."""
    key, bits = _keys(pair, here - offset, edits)
    # all votes first, as few bands have enough; then a place, or an offset, counts once
    some, n = _tally(key)
    some = some[n >= needed(some >> bits)]
    if len(some):
        near = _among(key, some)
        key, here, offset = key[near], np.tile(here, 2)[near], np.tile(offset, 2)[near]
        both = np.minimum(_distinct(key, here), _distinct(key, offset))
        some = some[both >= needed(some >> bits)]
    return some >> bits, (some & (1 << bits) - 1) - (1 << bits - 1)


def _candidates(block: Block, found: tuple[np.ndarray, np.ndarray], ids: int) -> tuple[np.ndarray, ...]:
    pair, band = found
    passage = pair % max(1, ids)
    step = block.edits[passage] + 1
    return pair // max(1, ids), passage, band * step, 2 * step - 1


def _distinct(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Distinct values of each key, in key order."""
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (value[1:] != value[:-1])]
    return np.add.reduceat(new, np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), dtype=np.int64)


def banded_distances(block: Block, points: np.ndarray, begins: np.ndarray, sizes: np.ndarray, found: tuple[np.ndarray, ...]):
    """``candidate, edits, start, end`` of the places within budget; the band of each candidate
    reaches its budget beyond the counted diagonals on both sides. Candidates advance
    together, one passage character at a time, and leave when their budget is spent."""
    doc, item, low, width = found
    out = [np.zeros((4, 0), np.int64)]
    order = np.argsort(block.sizes[item], kind="stable")
    per = max(1, _AT_ONCE // int((width + 2 * block.edits[item]).max(initial=1)))
    for begin in range(0, len(order), per):
        own = order[begin : begin + per]
        m, most = block.sizes[item[own]], block.edits[item[own]]
        wide = int((width[own] + 2 * most).max())
        lane = np.arange(wide)
        passages = np.zeros((len(own), int(m.max())), np.uint32)
        for k, c in enumerate(own):
            passages[k, : m[k]] = block.points[item[c]]
        column = (low[own] - most)[:, None] + lane
        n, at0 = sizes[doc[own]][:, None], begins[doc[own]][:, None]
        in_band = lane < (width[own] + 2 * most)[:, None]
        cost = np.where(in_band & (column >= 0) & (column <= n), 0, _FAR)
        start = column.copy()
        for i in range(passages.shape[1]):
            at = column + i
            inside = in_band & (at >= 0) & (at < n)
            other = points[np.where(inside, at + at0, 0)] != passages[:, i : i + 1]
            new = np.where(inside, cost + other, _FAR)
            gap = np.full_like(cost, _FAR)
            gap[:, :-1] = cost[:, 1:] + 1
            from_gap = gap < new
            new = np.where(from_gap, gap, new)
            moved = np.empty_like(start)
            moved[:, :-1], moved[:, -1] = start[:, 1:], 0
            begun = np.where(from_gap, moved, start)
            reach = new - lane
            best = np.minimum.accumulate(reach, axis=1)
            source = np.maximum.accumulate(np.where(reach == best, lane, 0), axis=1)
            valid = in_band & (at + 1 >= 0) & (at + 1 <= n)
            cost = np.where(valid, best + lane, _FAR)
            start = np.take_along_axis(begun, source, axis=1)
            lowest = cost.min(axis=1)
            ended = (m == i + 1) & (lowest <= most)
            if ended.any():
                k = np.flatnonzero(ended)
                lanes = cost[k].argmin(axis=1)
                out.append(np.stack([own[k], lowest[k], start[k, lanes], column[k, lanes] + m[k]]))
            stay = (m > i + 1) & (lowest <= most)
            if not stay.all():
                own, m, most, column, n, at0, in_band, cost, start, passages = (
                    x[stay] for x in (own, m, most, column, n, at0, in_band, cost, start, passages)
                )
                if not len(own):
                    break
    return np.concatenate(out, axis=1)


def find(block: Block, documents: list[str]) -> list[tuple[int, int, int, int, int]]:
    """``document number, item, start, end, edits`` of the best place of each item found; places
    count in the compared characters."""
    return [row[:5] for row in places(block, documents)]


def places(block: Block, documents: list[str]) -> list[tuple[int, ...]]:
    """As ``find``, with ``item_start, item_end, covered``: the part of the item that is there,
    and how many of its characters the parts found cover. The whole item goes before its parts,
    then the longest part, then the fewest edits."""
    plain = [normal(t) for t in documents]
    sizes = np.array([len(p) for p in plain], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    points = np.concatenate([x for p in plain for x in (p, np.zeros(1, np.uint32))]) if plain else np.zeros(0, np.uint32)
    # of each text in each document: the best place of every passage found
    seen: dict[tuple[int, int], dict[int, tuple[int, int, int]]] = {}
    best: dict[tuple[int, int], tuple[int, ...]] = {}
    done: set[int] = set()

    def align(found: tuple[np.ndarray, ...]) -> np.ndarray:
        for c, edits, start, end in banded_distances(block, points, begins, sizes, found).T.tolist():
            d, n = int(found[0][c]), int(found[1][c])
            k = int(block.spans[n, 0])
            held = seen.setdefault((d, k), {})
            held[n] = min(held.get(n, (edits, start, end)), (edits, start, end))
            if n < block.whole:
                done.add(d * block.whole + k)
        return np.fromiter(done, np.int64, len(done))

    if block.whole and len(points):
        held_against(block, points, begins, align)
    for (d, k), held in seen.items():
        covered = last = 0
        for s, e in sorted(block.spans[list(held), 1:].tolist()):
            covered, last = covered + max(0, e - max(s, last)), max(e, last)
        m = int(block.sizes[k])
        if covered < min(m, window(m)):
            continue
        n = min(held, key=lambda n: (-block.sizes[n], held[n]))
        row = (n >= block.whole, -int(block.sizes[n]), *held[n], *block.spans[n, 1:].tolist(), covered)
        key = (d, int(block.ids[n]))
        best[key] = min(best.get(key, row), row)
    for item, passage in block.short:
        word = "".join(map(chr, passage))
        for d, p in enumerate(plain):
            at = f" {''.join(map(chr, p))} ".find(f" {word} ")
            if at >= 0:
                row = (False, -len(word), 0, at, at + len(word), 0, len(word), len(word))
                best[d, int(item)] = min(best.get((d, int(item)), row), row)
    return [(d, i, s, e, n, *at) for (d, i), (_, _, n, s, e, *at) in sorted(best.items())]


def blocks(benchmark: DataFrame, limit: int | None = None):
    """The passages in runs of at most ``limit`` characters (or a single longer one). They
    reach the driver one block at a time; rows without text or id are no passages."""
    limit = limit or BLOCK_CHARS
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    held, size = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if held and size + len(r["text"]) > limit:
            yield held
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if held:
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, start, end, edits, item_start, item_end, covered``: the best place of
    each item found in each document, whole or in parts (places count in compared characters).
    Documents without an item have no row.

    An edit budget is ``rate`` of the length of the item or part. Items shorter than a q-gram must
    occur as whole words. NULL texts hold nothing; repeated rows give their rows each.
    """
    names = ["doc_id", "item_id", "start", "end", "edits", "item_start", "item_end", "covered"]
    schema = ", ".join(f"{n} long" for n in names)
    out = None
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def found(batches, sent=sent):
            block = Block(sent.value, q, rate, cut=True)
            for part in slices(batches):
                rows = [(part["doc_id"][hit[0]], *hit[1:]) for hit in places(block, part["text"])]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=names)

        one = texts(docs).mapInArrow(found, schema)
        out = one if out is None else out.unionByName(one)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no item, whole or in parts, with their columns."""
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        docs = docs.where(~F.pandas_udf(_holds(sent, q, rate), "boolean")(F.coalesce(F.col("text"), F.lit(""))))
    return docs


def _holds(sent, q: int, rate: float):
    state: dict = {}

    def holds(text: pd.Series) -> pd.Series:
        if not state:
            state["block"] = Block(sent.value, q, rate, cut=True)
        hit = np.zeros(len(text), bool)
        at = 0
        while at < len(text):  # runs of rows of bounded size
            size, stop = 0, at
            while stop < len(text) and (stop == at or size < SLICE_BYTES):
                size += len(text.iloc[stop])
                stop += 1
            for row in find(state["block"], text.iloc[at:stop].tolist()):
                hit[at + row[0]] = True
            at = stop
        return pd.Series(hit)

    return holds
