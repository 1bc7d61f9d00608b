"""MinHash near-duplicates by an inverted join of signature coordinates.

Documents with equal shingle sets are one class from the start. Each class is posted under its
``PERMS`` coordinate-value pairs. Two sets with a Jaccard similarity of ``PERCENT`` share at least
``MATCHES`` of them but for a chance of about 1e-9, which gives the two filters of the count:

* *Prefix*: with the pairs of a class in order of rarity, two classes that share ``MATCHES`` of
  them share one of their first ``PERMS - MATCHES + 1``. Only those lists are merged; the longest
  lists, those of shared passages, are not. Pairs that occur once come first and cost nothing,
  and a class with fewer than ``MATCHES`` pairs that occur elsewhere has no list at all.
* *Skip*: within a list, members are in order of size. A member meets only those that its size
  allows, and none it is already joined with. What is left of the count is read off the signatures.

Pairs above the match threshold pass one more bound before sets are fetched: a parity sketch,
one bit or less per shingle, whose differing bits never exceed the shingles in which two sets
differ. Links are confirmed on whole sets, in two rounds. The first takes only a spanning forest
of the pairs within that bound from blocks of each list, likely ones first, so that a large group
of near copies gives about as many rows as it has members. The second takes every pair within the
bound whose members are still in different components, once, from the first list they share;
lists whose members are all joined take no part. No pair is left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import bitmap, components, place, slices, written
from seepline.session import checkpointed

SHINGLE = 5
PERCENT = 85
PERMS = 48
MATCHES = 24
SEED = 42
#: members of a list that are compared in one piece, per side
BLOCK = 2048
#: links of one class that are confirmed in one piece
UNIT = 1024
#: bytes of a text that are cut into words at a time
PIECE = 1 << 20
#: bits of the filter of documents whose sets are fetched
BITS = 1 << 24
_WORDS = 50_000
_CHUNK = 4096
_SPACE = b" \t\n\v\f\r"
_ODD = np.random.default_rng(5).integers(1 << 62, 1 << 63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)
_PERM = np.random.default_rng(11).integers(0, 1 << 63, (2, PERMS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words(dict):
    """Hashes of words, kept for the first ones that are met."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        made = xxhash.xxh64_intdigest(word, SEED)
        if len(self) < _WORDS:
            self[word] = made
        return made


def _pieces(text: bytes):
    """Lists of the words of ``text``, cut at white space."""
    at, size = 0, len(text)
    while at < size:
        stop = min(at + PIECE, size)
        if stop < size:
            cut = max(text.rfind(bytes([c]), at, stop) for c in _SPACE)
            stop = cut if cut > at else min(x for x in (text.find(bytes([c]), stop) % (size + 1) for c in _SPACE))
        yield text[at:stop].lower().split()
        at = stop


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: Words) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit hashes; with fewer words than a
    shingle has, the whole sequence is one; no words, no shingle."""
    parts = [np.fromiter(map(words.__getitem__, p), np.uint64, len(p)) for p in _pieces(text) if p]
    w = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    n = len(w)
    if not n:
        return w
    if n < SHINGLE:
        return _mixed((w * _ODD[:n]).sum(keepdims=True, dtype=np.uint64) + np.full(1, n, np.uint64) * _ODD[SHINGLE])
    total = np.zeros(n - SHINGLE + 1, np.uint64)
    for j in range(SHINGLE):
        total += w[j : n - SHINGLE + 1 + j] * _ODD[j]
    return np.unique(_mixed(total))


def signature(held: np.ndarray) -> np.ndarray:
    """The least hash of the set under each permutation, as 32 bits."""
    least = np.full(PERMS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(held), _CHUNK):
        np.minimum(least, (held[at : at + _CHUNK, None] * _PERM[0] + _PERM[1]).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(held: np.ndarray) -> np.ndarray:
    """Parities of how many shingles fall on each bit; as many bits as shingles, rounded up to a
    power of two. Halves of a sketch, put over one another, are the sketch of half as many bits."""
    size = max(512, 1 << (len(held) - 1).bit_length())
    odd = np.bincount((held & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _digest(held: np.ndarray) -> bytes:
    return hashlib.sha256(held.tobytes()).digest()[:16]


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, sig, sketch`` for every row; NULL text is empty."""

    def made(batches):
        words = Words()
        for part in slices(batches):
            sets = [shingles(t, words) for t in part["text"]]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(part["doc_id"], pa.int64()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([_digest(s) for s in sets], pa.binary()),
                    "sig": pa.array([signature(s).view(np.int32) if len(s) else None for s in sets], pa.list_(pa.int32())),
                    "sketch": pa.array([sketch(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                }
            )

    return _bytes(docs).mapInArrow(made, "doc_id long, n_shingles long, digest binary, sig array<int>, sketch binary")


def posted(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``tok, cls, posts``: the lists under which a class may meet its partners, and a bit for the
    coordinate of each of them."""
    pairs = classes.select("cls", F.posexplode("sig").alias("at", "value"))
    pairs = pairs.select("cls", F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit((1 << 32) - 1))).alias("tok"))
    shared = pairs.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = F.sort_array(F.collect_list(F.struct("df", "tok")))
    rare = pairs.join(shared, "tok").groupBy("cls").agg(order.alias("toks")).where(F.size("toks") >= matches)
    rare = rare.select("cls", F.slice("toks.tok", F.lit(1), F.size("toks") - matches + 1).alias("toks"))
    bit = F.expr("transform(toks, t -> shiftleft(1L, cast(shiftright(t, 32) AS int)))")
    posts = F.aggregate(bit, F.lit(0).cast("long"), lambda held, b: held.bitwiseOR(b))
    return rare.select("cls", posts.alias("posts"), F.explode("toks").alias("tok")).select("tok", "cls", "posts")


class Tile:
    """Members of one list, or of a part of it, in order of size."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("n", "ascending"), ("cls", "ascending")])
        self.cls, self.n = table.column("cls").to_numpy(), table.column("n").to_numpy()
        self.sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, PERMS)
        self.comp, self.side = table.column("comp").to_numpy().copy(), table.column("side").to_numpy()
        self.at = table.column("tok")[0].as_py() >> 32
        self.posts = (table.column("posts").to_numpy()[:, None] >> np.arange(PERMS)) & 1 > 0
        held = [np.frombuffer(s, np.uint64) for s in table.column("sketch").to_pylist()]
        self.words = np.array([len(s) for s in held])
        self.place = np.zeros(len(held), np.int64)
        self.sketch = {}
        for size in np.unique(self.words):
            rows = np.flatnonzero(self.words == size)
            self.place[rows] = np.arange(len(rows))
            self.sketch[size] = np.stack([held[r] for r in rows])

    def odd(self, i: int, js: np.ndarray) -> np.ndarray:
        """Differing bits of the sketches of ``i`` and of ``js``, none of which is smaller."""
        size = self.words[i]
        mine, out = self.sketch[size][self.place[i]], np.zeros(len(js), np.int64)
        for other in np.unique(self.words[js]):
            at = np.flatnonzero(self.words[js] == other)
            theirs = self.sketch[other][self.place[js[at]]].reshape(len(at), -1, size)
            out[at] = np.bitwise_count(np.bitwise_xor.reduce(theirs, axis=1) ^ mine).sum(axis=1)
        return out

    def pairs(self, whole: bool, likely: bool, matches: int, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members apart that reach ``matches`` and the bound of the sketches. ``whole``:
        of all members, else of different sides. ``likely``: only a forest of them, first those
        that are surely near; else all for which this is the first list that holds both."""
        found, rest = [], []
        n = len(self.n)
        last = np.searchsorted(self.n, self.n * 100 // percent, "right")
        for i in range(n - 1):
            js = np.arange(i + 1, last[i])
            apart = self.comp[js] != self.comp[i]
            js = js[apart if whole else apart & (self.side[js] != self.side[i])]
            if not len(js):
                continue
            same = self.sig[js] == self.sig[i]
            enough = same.sum(axis=1) >= matches
            js, same = js[enough], same[enough]
            if not likely:
                js = js[(same & self.posts[i] & self.posts[js]).argmax(axis=1) == self.at]
            if not len(js):
                continue
            most = (100 - percent) * (self.n[i] + self.n[js]) // (100 + percent)
            odd = self.odd(i, js)
            if likely:
                bits = 64 * self.words[i]
                differ = -bits / 2 * np.log1p(-np.minimum(2 * odd / bits, 0.999)) / np.maximum(most, 1)
                near = differ <= 0.9
                found.append(self.joined(i, js[near], differ[near]))
                unsure = ~near & (odd <= most)
                if unsure.any():
                    rest.append((i, js[unsure], differ[unsure]))
            else:
                js = js[odd <= most]
                found.append((np.full(len(js), i), js))
        # what is unsure is tried only where nothing surer joins it
        found += [self.joined(i, js, differ) for i, js, differ in rest]
        return [f for f in found if len(f[0])]

    def joined(self, i: int, js: np.ndarray, differ: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each component among ``js`` that ``i`` is not in, the member that differs least;
        all of them are one component from then on."""
        js = js[np.argsort(differ, kind="stable")]
        js = js[self.comp[js] != self.comp[i]]
        comps, first = np.unique(self.comp[js], return_index=True)
        if len(comps):
            self.comp[np.isin(self.comp, comps)] = self.comp[i]
        return np.full(len(first), i), js[first]


def _tile_task(likely: bool, matches: int, percent: int):
    """Reads rows sorted by tile; one tile is held at a time."""

    def tiled(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            fields = [table.column(c).to_numpy() for c in ("tok", "kind", "i", "j")]
            new = np.zeros(table.num_rows, bool)
            for f in fields:
                new[1:] |= f[1:] != f[:-1]
            starts = np.r_[0, np.flatnonzero(new)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                yield from _pairs_of(table.slice(a, b - a), likely, matches, percent)
            rest = table.slice(starts[-1])
        if rest is not None:
            yield from _pairs_of(rest, likely, matches, percent)

    return tiled


def _pairs_of(table: pa.Table, likely: bool, matches: int, percent: int):
    if table.num_rows < 2:
        return
    kind, i, j = (table.column(c)[0].as_py() for c in ("kind", "i", "j"))
    tile = Tile(table)
    found = tile.pairs(kind == 0 and i == j, likely, matches, percent)
    if found:
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        yield pa.RecordBatch.from_pydict({"a": pa.array(tile.cls[a]), "b": pa.array(tile.cls[b])})


def _tiles(rows: DataFrame, likely: bool, matches: int, percent: int) -> DataFrame:
    key = ["tok", "kind", "i", "j"]
    rows = rows.select(*key, "side", "cls", "n", "sig", "sketch", "posts", "comp")
    dealt = rows.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(_tile_task(likely, matches, percent), "a long, b long").distinct()


def _forest(lists: DataFrame, matches: int, percent: int) -> DataFrame:
    """Likely links that join most of what can be joined: each list is dealt twice into blocks,
    by different hashes, so that the blocks of one dealing tie those of the other together."""
    size = lists.groupBy("tok").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("long")
    ways = F.array(F.pmod(F.xxhash64("cls"), blocks), F.when(blocks > 1, blocks + F.pmod(F.xxhash64(F.lit(1), "cls"), blocks)))
    rows = lists.join(size, "tok").withColumn("i", F.explode(ways)).where("i IS NOT NULL")
    zero = F.lit(0).cast("long")
    return _tiles(rows.withColumns({"kind": zero, "j": F.col("i"), "side": zero, "comp": F.col("cls")}), True, matches, percent)


def _apart(lists: DataFrame, matches: int, percent: int) -> DataFrame:
    """All pairs above the threshold of members with different ``comp``. Of a list, the members
    of its largest component meet the others, but not one another."""
    sizes = lists.groupBy("tok", "comp").agg(F.count(F.lit(1)).alias("members"))
    stats = sizes.groupBy("tok").agg(F.max_by("comp", F.struct("members", "comp")).alias("top"), F.max("members").alias("large"), F.sum("members").alias("all"))
    stats = stats.where("all > large")
    small, large = (F.ceil(c / BLOCK).cast("long") for c in (F.col("all") - F.col("large"), F.col("large")))
    is_top = F.col("comp") == F.col("top")
    block = F.pmod(F.xxhash64("cls"), F.when(is_top, large).otherwise(small))
    zero = F.lit(0).cast("long")

    def tile(kind, i, j, side):
        return F.struct(F.lit(kind).cast("long").alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    def upto(n):
        return F.sequence(zero, n - 1)

    of_top = F.transform(upto(small), lambda x: tile(1, x, F.col("block"), F.lit(-1).cast("long")))
    of_rest = F.concat(
        F.transform(upto(small), lambda o: tile(0, F.least("block", o), F.greatest("block", o), F.col("block"))),
        F.transform(upto(large), lambda y: tile(1, F.col("block"), y, zero)),
    )
    rows = lists.join(stats, "tok").withColumn("block", block).withColumn("tile", F.explode(F.when(is_top, of_top).otherwise(of_rest)))
    return _tiles(rows.select("tok", "tile.*", "cls", "n", "sig", "sketch", "posts", "comp"), False, matches, percent)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, shingles`` of the classes in ``wanted`` (``cls, digest, rep``), from whole texts.
    A bitmap of fixed size keeps most other documents from being hashed again."""
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.where("rep IS NOT NULL"), "rep", BITS))

    def fetched(batches):
        words = Words()
        for part in slices(batches):
            held = [shingles(t, words) for d, p, t in zip(part["doc_id"], part["place"], part["text"], strict=True) if d is None or marks.value[p >> 3] >> (p & 7) & 1]
            if held:
                yield pa.RecordBatch.from_pydict({"digest": pa.array([_digest(s) for s in held], pa.binary()), "shingles": pa.array([s.tobytes() for s in held], pa.binary())})

    made = _bytes(docs).select("doc_id", place("doc_id", BITS).alias("place"), "text").mapInArrow(fetched, "digest binary, shingles binary")
    return made.join(wanted.select("cls", "digest"), "digest").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _confirm_task(percent: int):
    """Reads units, sorted: a class's set and then those of its partners, one at a time."""

    def confirmed(batches):
        mine, unit = None, None
        for part in slices(batches, "shingles"):
            a, b = [], []
            for left, chunk, right, raw in zip(part["a"], part["chunk"], part["b"], part["shingles"], strict=True):
                held = np.frombuffer(raw, np.uint64)
                if right is None:
                    mine, unit = held, (left, chunk)
                elif unit == (left, chunk):
                    both = len(np.intersect1d(mine, held, assume_unique=True))
                    if 100 * both >= percent * (len(mine) + len(held) - both):
                        a.append(left)
                        b.append(right)
            if a:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return confirmed


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the ``pairs`` whose whole sets are linked."""
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / UNIT).cast("long"))
    units = checkpointed(pairs.join(degree, "a").select("a", "b", chunk.alias("chunk")))
    ends = units.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = written(_sets(docs, checkpointed(classes.join(ends, "cls").select("cls", "digest", "rep"))), "sets")
    own = units.select("a", "chunk").distinct().join(sets.withColumnRenamed("cls", "a"), "a").select("a", "chunk", F.lit(None).cast("long").alias("b"), "shingles")
    theirs = units.join(sets.withColumnRenamed("cls", "b"), "b").select("a", "chunk", "b", "shingles")
    rows = own.unionByName(theirs).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.asc_nulls_first("b"))
    return checkpointed(rows.mapInArrow(_confirm_task(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, matches: int = MATCHES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row: the number of distinct shingles,
    the smallest ``doc_id`` that links reach, and whether it is the row's own.

    Rows link where ``100 * intersection >= percent * union`` of their shingle sets; words are
    runs without ASCII white space, A-Z lower-cased. Texts without words, NULL included, link
    with nothing. Rows without ``doc_id`` take part in links; ``component_id`` is NULL where no
    row of a component has an id. Rows that repeat a ``doc_id`` are judged one by one. A chance
    of about 1e-9 of losing a link at exactly ``percent`` is that of the signatures; ``matches``
    must be lowered with ``percent``.
    """
    made = written(signatures(docs), "signatures")
    grouped = made.where("n_shingles > 0").groupBy("digest", F.col("n_shingles").alias("n"), "sig", "sketch").agg(F.min("doc_id").alias("rep"))
    classes = written(grouped.withColumn("cls", F.monotonically_increasing_id()), "classes")
    lists = written(posted(classes, matches).join(classes.select("cls", "n", "sig", "sketch"), "cls"), "lists")

    first = confirmed(docs, classes, checkpointed(_forest(lists, matches, percent)), percent)
    # whole components: members of one that had different labels would be compared pair by pair
    hung = checkpointed(components(first))
    apart = lists.join(hung.select(F.col("node").alias("cls"), F.col("component").alias("comp")), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    more = confirmed(docs, classes, checkpointed(_apart(apart, matches, percent)), percent)
    joined = components(hung.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    whole = classes.join(joined, classes["cls"] == joined["node"], "left").select("digest", "rep", F.coalesce("component", "cls").alias("component"))
    least = whole.groupBy("component").agg(F.min("rep").alias("component_id"))
    answer = whole.join(least, "component").select("digest", "component_id", F.lit(True).alias("met"))
    out = made.select("doc_id", "n_shingles", "digest").join(answer, "digest", "left")
    component = F.when(F.col("met"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
