"""A trie of conversation prefixes, built as double arrays in shards that hold whole ranges.

A turn is named by 16 bytes of the SHA-256 of its role and text; a conversation's *path* is the
run of its turns' names, so the byte order of paths is the order of a trie. Equal paths become
one row for each 4,096 neighbouring conversation ids before anything else is shuffled. Paths
are then range-partitioned: a shard holds a range of them, whatever prefix they share, so a
first turn that a third of all conversations have is spread over many shards.

In a shard, the turns that occur get dense ids and the paths are packed level by level into
two arrays: the child of the node in slot ``s`` by turn ``c`` is slot ``BASE[s] + c``, and
``CHECK`` of that slot is ``s``. Paths are walked through the arrays to their last slot, and
counts flow back along ``CHECK``. Only nodes on the first and the last path of a shard can have
members elsewhere. Those *open* nodes carry partial aggregates, which are merged globally by
the digest of their prefix; sums over subtrees of open nodes take a number of rounds that is
the logarithm of their depth, each a join and a grouping of open nodes alone.

Memory: a conversation is one row (28 bytes a turn, without its text), and a shard holds
``SHARD_BYTES`` of paths or one path.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import slices, written
from seepline.session import checkpointed

#: bytes of a turn's name
NAME = 16
#: bytes of paths and conversation ids that a shard is sized for
SHARD_BYTES = 4 << 20
#: conversation ids of one path are grouped by id >> CHUNK_BITS
CHUNK_BITS = 12
#: slots that are tried for a node with several children before the arrays are made longer
TRIES = 64
_FREE = -1
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def keyed(conversations: DataFrame, near: Column | None = None) -> DataFrame:
    """``near, conv_id, turns``: one row per conversation, its turns in order as ``(name, n)``.

    Turns are ordered by ``turn``, NULL first; of equal ones, repeated rows included, by name.
    NULL role or text is empty. Rows without ``conv_id`` belong to no conversation and are left
    out; other columns take no part. Rows are dealt by ``near`` (by default the ``conv_id``),
    which must be a function of ``conv_id``.
    """
    conv = F.col("conv_id").cast("long")
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    name = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * NAME)
    rows = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.unhex(name).alias("name"), F.length(text).alias("n")
    )
    rows = rows.select((F.col("conv_id") if near is None else near).alias("near"), "*").repartition("near")
    turns = F.sort_array(F.collect_list(F.struct("turn", "name", "n")))
    return rows.groupBy("near", "conv_id").agg(F.transform(turns, lambda t: F.struct(t["name"], t["n"])).alias("turns"))


def with_shared_heads(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first one of their block.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % every`` (all if it has
    fewer, none if there is no such conversation) and then its own turns after its first ``h``,
    where ``h`` is the unsigned CRC-32 of ``c`` in decimals modulo ``most``.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    own = keyed(conversations, base)
    heads = own.where("conv_id = near").select("near", F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    built = F.concat(head, F.slice("turns", h + 1, F.size("turns")))
    return own.join(heads, "near", "left").select("conv_id", built.alias("turns"))


class DoubleArray:
    """BASE and CHECK over dense codes. Slot 0 is the root and its own parent."""

    def __init__(self):
        self.base, self.check = array("q", [0]), array("q", [0])
        self.low = self.wide = 1

    def _longer(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([_FREE] * more)

    def _place(self, codes: list[int]) -> int:
        check, size, first = self.check, len(self.check), codes[0]
        if len(codes) == 1:
            while self.low < size and check[self.low] != _FREE:
                self.low += 1
            return self.low - first
        for at in range(self.wide, min(size, self.wide + TRIES)):
            base = at - first
            if all(base + c >= size or check[base + c] == _FREE for c in codes):
                return base
        if self.wide + TRIES < size:
            self.wide = size
        return size - first

    def add(self, parent: int, codes: list[int]) -> int:
        """Give ``parent`` children by the ascending ``codes``; returns its BASE."""
        base = self.base[parent] = self._place(codes)
        self._longer(base + codes[-1] + 1)
        for c in codes:
            self.check[base + c] = parent
        return base

    def child(self, slot: int, code: int) -> int:
        """The slot of a child, or -1."""
        at = self.base[slot] + code
        return at if 0 < at < len(self.check) and self.check[at] == slot else -1


def pack(paths: list[bytes]) -> tuple[DoubleArray, dict[bytes, int], list[int], dict[int, tuple[int, int]]]:
    """The double array of distinct sorted ``paths``, the dense ids of their turns, the slots
    from the root down, and for each slot its depth and a path that runs through it."""
    trie, dense = DoubleArray(), {}
    order, seen = [0], {0: (0, 0)}
    ranges = [(0, len(paths))]
    for at, slot in enumerate(order):  # grows while it is read
        lo, hi = ranges[at]
        depth = seen[slot][0]
        start, stop = depth * NAME, (depth + 1) * NAME
        if lo < hi and len(paths[lo]) == start:
            lo += 1
        met = {}
        for i in range(lo, hi):
            name = paths[i][start:stop]
            code = dense.setdefault(name, len(dense))
            if code in met:
                met[code][1] = i + 1
            else:
                met[code] = [i, i + 1]
        if met:
            codes = sorted(met)
            base = trie.add(slot, codes)
            for c in codes:
                order.append(base + c)
                seen[base + c] = (depth + 1, met[c][0])
                ranges.append(tuple(met[c]))
    return trie, dense, order, seen


def _prefix(path: bytes, depth: int) -> bytes:
    return hashlib.sha256(path[: depth * NAME]).digest()[:NAME]


_NODES = (
    "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, n long, ends_sha256 string"
)
_FIELDS = [part.split()[0] for part in _NODES.split(",")]


class Shard:
    """Distinct paths of one range, in order, with their members."""

    def __init__(self):
        self.paths, self.lens, self.members, self.least, self.ends = [], [], [], [], []
        self._hash = None

    def add(self, path: bytes, lens: list[int], ids: list[int]) -> None:
        """Rows come by path and then by id; only the digest of the ids is held."""
        text = ",".join(map(str, ids)).encode()
        if self.paths and self.paths[-1] == path:
            self._hash.update(b"," + text)
            self.members[-1] += len(ids)
            return
        self.close()
        self._hash = hashlib.sha256(text)
        self.paths.append(path)
        self.lens.append(lens)
        self.members.append(len(ids))
        self.least.append(ids[0])

    def close(self) -> None:
        if self._hash is not None:
            self.ends.append(self._hash.hexdigest())
            self._hash = None

    def rows(self) -> Iterator[tuple]:
        """The nodes, as rows of ``_FIELDS``: open ones have a ``key``."""
        self.close()
        if not self.paths:
            return
        trie, dense, order, seen = pack(self.paths)
        size = len(trie.check)
        n, kids, leaves, saved = (array("q", bytes(8 * size)) for _ in range(4))
        least = array("q", [(1 << 63) - 1]) * size
        ends: dict[int, int] = {}
        open_keys: dict[int, bytes] = {}
        for i, path in enumerate(self.paths):
            outer = i in (0, len(self.paths) - 1)
            slot = 0
            if outer:
                open_keys[0] = _prefix(path, 0)
            for d in range(len(path) // NAME):
                slot = trie.child(slot, dense[path[d * NAME : (d + 1) * NAME]])
                if outer:
                    open_keys[slot] = _prefix(path, d + 1)
            ends[slot] = i
            n[slot] += self.members[i]
            least[slot] = min(least[slot], self.least[i])
        for slot in reversed(order):
            if slot not in open_keys:
                depth, i = seen[slot]
                saved[slot] += (n[slot] - 1) * self.lens[i][depth - 1]
                leaves[slot] += kids[slot] == 0
            if slot:
                up = trie.check[slot]
                n[up] += n[slot]
                least[up] = min(least[up], least[slot])
                if slot not in open_keys:
                    kids[up] += 1
                    leaves[up] += leaves[slot]
                    saved[up] += saved[slot]
        for slot in order:
            depth, i = seen[slot]
            up, key = trie.check[slot], open_keys.get(slot)
            above = open_keys.get(up) if slot else None
            ended = self.ends[ends[slot]] if slot in ends else None if key else _NO_ENDS
            yield (
                key, above, least[slot], depth, None if above or not slot else least[up], n[slot], kids[slot],
                leaves[slot], saved[slot], self.lens[i][depth - 1] if slot else 0, ended,
            )


def _shard_task(batches):
    shard = Shard()
    for part in slices(batches, "path"):
        for path, lens, ids in zip(part["path"], part["lens"], part["ids"], strict=True):
            shard.add(path, lens, ids)
    held = []
    for row in shard.rows():
        held.append(row)
        if len(held) == 10_000:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.binary()] + [pa.int64()] * 8 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _FIELDS)


def _merged(parts: DataFrame) -> DataFrame:
    """Open nodes with global aggregates."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    whole = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("n").alias("n"),
        F.max("ends_sha256").alias("ends_sha256"), *sums,
    )
    whole = checkpointed(whole)
    below = whole.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    met = whole.join(below, "key", "left")
    children = F.col("n_children") + F.coalesce("more", F.lit(0))
    met = met.withColumn("n_children", children)
    own = met.select(
        "key", F.col("parent_key").alias("up"), (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n")).alias("saved_tokens"),
    )
    own = checkpointed(own)
    # a round adds what lies at twice the distance: each node sends its sum to its ancestor there
    reach, deepest = 1, whole.agg(F.max("depth")).first()[0] or 0
    while reach <= deepest:
        sent = own.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("a"), F.sum("saved_tokens").alias("b"))
        higher = own.select(F.col("key").alias("up"), F.col("up").alias("above"))
        own = checkpointed(
            own.join(sent, "key", "left").join(higher, "up", "left").select(
                "key", F.col("above").alias("up"), (F.col("n_leaves") + F.coalesce("a", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("b", F.lit(0))).alias("saved_tokens"),
            )
        )
        reach *= 2
    return met.drop("n_leaves", "saved_tokens").join(own.drop("up"), "key")


_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(sequences: DataFrame, salts: int = 16) -> DataFrame:
    """One row per node of the trie of ``sequences`` (``conv_id, turns`` as ``keyed`` gives them,
    one row per ``conv_id``): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    A conversation without turns is a member of the root alone. No conversations: no nodes.
    """
    spark = sequences.sparkSession
    path = F.unhex(F.array_join(F.transform("turns.name", F.hex), ""))
    paths = sequences.select("conv_id", path.alias("path"), F.col("turns.n").alias("lens"))
    chunk = F.shiftright("conv_id", CHUNK_BITS).alias("chunk")
    rows = written(paths.groupBy("path", "lens", chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("ids")), "paths")
    total = rows.agg(F.sum(F.length("path") + 8 * F.size("ids"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    dealt = rows.repartitionByRange(shards, "path").sortWithinPartitions("path", "chunk")
    made = written(dealt.select("path", "lens", "ids").mapInArrow(_shard_task, _NODES), "nodes")

    whole = _merged(made.where("key IS NOT NULL"))
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    upper = whole.join(above, "parent_key", "left").withColumn("parent_conv_id", F.col("above"))
    # nearly all first turns hang on the root: its children are dealt over salts
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(salts)).alias("salt")
    spread = above.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    lower = made.where("key IS NULL").select("*", salt)
    hung = lower.where("parent_key IS NOT NULL").join(spread, ["parent_key", "salt"]).withColumn("parent_conv_id", F.col("above"))
    done = lower.where("parent_key IS NULL").select(_COLUMNS).unionByName(hung.select(_COLUMNS)).unionByName(upper.select(_COLUMNS))
    return done.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
