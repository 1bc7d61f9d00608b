"""SimHash near-duplicates by a segment-popcount embedding and a grid join.

A fingerprint's 64 bits are cut into 32 segments of two bits; the bit counts of its segments
are its point. The Manhattan distance of two points never exceeds the Hamming distance of
their fingerprints, so points farther apart than ``max_bits`` need no look at the bits.

Grid: with six groups of segments, ``max_bits`` = 3 differing bits leave at least three groups
with equal counts. Each fingerprint therefore enters 20 cells, one for each choice of three
groups, keyed by their counts; two linked fingerprints share a cell for certain, two random
ones with a chance of about 20 * 0.375**16 = 3e-6. Within a cell, pairs are compared in numpy
(Manhattan bound, then bits) and only a spanning forest of the links leaves the task. Cells
above ``BLOCK`` members are cut into blocks by hash, and blocks meet in pairs, so that no task
holds more than two blocks of a cell. Equal fingerprints are one member from the start.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import components, slices, texts
from seepline.session import checkpointed

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: members of a cell that are compared in one piece
BLOCK = 2048
_LOW = 0x5555555555555555
_CHUNK = 1 << 16


def _counts(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes have each bit set, and how many shingles there are."""
    import xxhash

    digest = xxhash.xxh64_digest
    if len(words) < size:
        shingles = iter([b" ".join(words)] if words else [])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    ones, n = np.zeros(64, np.int64), 0
    while True:
        part = b"".join(digest(s, SEED) for _, s in zip(range(_CHUNK), shingles))  # noqa: B905
        if not part:
            return ones, n
        bits = np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(bits)


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text; a text without words has 0."""
    ones, n = _counts(text.encode("utf-8", "surrogatepass").lower().split(), size)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` for every row; NULL text is empty."""

    def made(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(part["doc_id"], pa.int64()), "fp": pa.array([fingerprint(t, size) for t in part["text"]], pa.int64())}
            )

    return texts(docs).mapInArrow(made, "doc_id long, fp long")


def embedding(fp: Column) -> Column:
    """The segment counts, each written as ones from the right (0 -> 00, 1 -> 01, 2 -> 11):
    differing bits of two embeddings are their Manhattan distance."""
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW)), fp.bitwiseAND(F.lit(_LOW))
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseOR(low))


def cell_masks(max_bits: int) -> list[int]:
    """Bit masks of the cells: every choice of ``groups - max_bits`` groups of segments."""
    groups = 2 * max_bits if max_bits else 1
    cuts = [2 * round(32 * i / groups) for i in range(groups + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:], strict=False)]
    chosen = [sum(c) for c in combinations(masks, groups - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


class Forest:
    """Links among ``n`` members, reduced to a forest whenever many have gathered."""

    def __init__(self, n: int):
        self.n, self.a, self.b, self.held = n, [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > 1_000_000:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        root = _roots(self.n, np.concatenate(self.a), np.concatenate(self.b))
        leaf = np.flatnonzero(root != np.arange(self.n))
        self.a, self.b, self.held = [leaf], [root[leaf]], len(leaf)
        return leaf, root[leaf]


def linked(fp: np.ndarray, emb: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs are near: first the Manhattan bound, then the bits."""
    near = np.bitwise_count(emb[i] ^ emb[j]) <= max_bits
    where = np.flatnonzero(near)
    near[where] = np.bitwise_count(fp[i[where]] ^ fp[j[where]]) <= max_bits
    return near


def cell_links(cell: np.ndarray, block: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within runs of equal ``cell``; of members of a run that holds
    two blocks, only pairs from different blocks are compared."""
    high, low = (fp >> np.uint64(1)) & np.uint64(_LOW), fp & np.uint64(_LOW)
    emb = ((high & low) << np.uint64(1)) | high | low
    n = len(fp)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.r_[starts[1:], n]
    forest = Forest(n)
    end_of = np.repeat(ends, ends - starts)
    left = np.flatnonzero(end_of - np.arange(n) > 1)
    lag = 1
    while len(left):
        i, j = left, left + lag
        two = np.searchsorted(starts, i, "right") - 1
        mixed = block[ends[two] - 1] != block[starts[two]]
        use = ~mixed | (block[i] != block[j])
        i, j = i[use], j[use]
        for at in range(0, len(i), 1 << 20):
            a, b = i[at : at + (1 << 20)], j[at : at + (1 << 20)]
            near = linked(fp, emb, a, b, max_bits)
            forest.add(a[near], b[near])
        lag += 1
        left = left[left + lag < end_of[left]]
    return forest.reduce()


def _cell_task(max_bits: int):
    """Reads rows sorted by cell; a cell cut by a batch waits for its rest."""

    def links(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            key = _keys(table)
            whole = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])
            rest = table.slice(whole)
            yield from _linked_rows(table.slice(0, whole), max_bits)
        if rest is not None:
            yield from _linked_rows(rest, max_bits)

    return links


def _keys(table: pa.Table) -> np.ndarray:
    fields = [table.column(c).to_numpy() for c in ("mask", "cell", "i", "j")]
    new = np.zeros(table.num_rows, bool)
    for f in fields:
        new[1:] |= f[1:] != f[:-1]
    return np.cumsum(new)


def _linked_rows(table: pa.Table, max_bits: int):
    if table.num_rows < 2:
        return
    rep = table.column("rep").to_numpy()
    a, b = cell_links(_keys(table), table.column("block").to_numpy(), table.column("fp").to_numpy().view(np.uint64), max_bits)
    if len(a):
        pairs = np.unique(np.stack([rep[a], rep[b]]), axis=1)
        yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` that join the near ones of ``classes`` (``fp, rep``, distinct ``fp``)
    into the same components as all links would."""
    masks = cell_masks(max_bits)
    emb = classes.select("fp", "rep", embedding(F.col("fp")).alias("emb"))
    cells = emb.select("fp", "rep", F.posexplode(F.array(*[F.col("emb").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "cell"))
    full = cells.groupBy("mask", "cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = cells.join(full, ["mask", "cell"])
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = met.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("mask", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "rep")
    key = ["mask", "cell", "i", "j"]
    return dealt.repartition(*key).sortWithinPartitions(*key, "block", "fp").mapInArrow(_cell_task(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest ``doc_id`` reachable over
    links of at most ``max_bits`` differing bits.

    Rows without ``doc_id`` have a fingerprint and join its class; where no row of a
    component has an id, ``component_id`` is NULL. Repeated rows are one document.
    """
    made = checkpointed(fingerprints(docs, size))
    classes = made.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = checkpointed(classes)
    joined = components(links(classes, max_bits))
    named = classes.join(joined, classes["rep"] == joined["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return made.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its group, with their columns.
    Rows without ``doc_id`` stay; equal ids are one document, so all its rows stay."""
    gone = near_duplicates(docs, size, max_bits).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == gone["_gone"], "left_anti")
