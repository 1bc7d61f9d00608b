import hashlib
import random
import zlib

import pytest

from seepline.llm import trie
from seepline.llm.queries import ORACLES, op11

SCHEMA = "conv_id long, turn long, role string, text string, name string, near long, n long, path string"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(partitions)


def rebuilt(rows):
    """The contract's conversations, turn by turn."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            name = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own.setdefault(c, []).append(((t is not None, t or 0, name), (r, x)))
    own = {c: [turn for _, turn in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    return made


def plain(convs):
    """Nodes by their sequences."""
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = {}
    for seq, cs in members.items():
        below = [s for s in members if s[: len(seq)] == seq]
        kids = [s for s in below if len(s) == len(seq) + 1]
        leaves = [s for s in below if not any(len(k) == len(s) + 1 and k[: len(s)] == s for k in below)]
        saved = sum((len(members[s]) - 1) * len(s[-1][1]) for s in below if s)
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(seq))))
        up = min(members[seq[:-1]]) if seq else None
        out[(min(cs), len(seq))] = (up, len(cs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    found = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in rows}
    assert len(found) == len(rows)
    return found


def conversations(seed, n, words, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "system", rng.choice(words)))
    return rows


@pytest.mark.parametrize("seed,words,longest,size", [(1, ["a", "bb", "ccc"], 6, 4 << 20), (2, ["a", "bb"], 9, 600), (3, ["hello", "wörld", ""], 4, 100), (4, ["a"], 12, 64)])
def test_against_plain_nodes(spark, monkeypatch, seed, words, longest, size):
    monkeypatch.setattr(trie, "SHARD_BYTES", size)
    rows = conversations(seed, 150, words, longest)
    assert got(trie.nodes(trie.with_shared_heads(table(spark, rows)))) == plain(rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (100, None, None, "first"), (100, 3, "user", None), (100, 3, "user", None), (100, 1, "user", "😀😀"), (107, 1, "user", "own"), (7, 1, "user", "gone"),
        (7, 2, "user", "gone"), (None, 1, "user", "nobody"), (-5, 0, "user", "minus"), (300, 1, "a", "bc"), (301, 1, "ab", "c"), (302, 1, "user", "z" * 100_000),
    ]
    assert got(trie.nodes(trie.with_shared_heads(table(spark, rows, 1)))) == plain(rebuilt(rows))
    none = table(spark, rows).limit(0)
    assert trie.nodes(trie.with_shared_heads(none)).count() == 0


def test_long_and_copied_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_BYTES", 2000)
    monkeypatch.setattr(trie, "CHUNK_BITS", 3)
    long = [(1, t, "user", str(t)) for t in range(500)] + [(2, t, "user", str(t)) for t in range(499)] + [(2, 499, "user", "else")]
    copies = [(c, t, "user", f"same {t}") for c in range(1000, 1150) for t in range(4)]
    convs = {}
    for c, t, r, x in long + copies:
        convs.setdefault(c, []).append((r, x))
    assert got(trie.nodes(trie.keyed(table(spark, long + copies)))) == plain(convs)


def test_double_array():
    rng = random.Random(5)
    names = [bytes([i]) * trie.NAME for i in range(40)]
    paths = sorted({b"".join(rng.choices(names, k=rng.randint(0, 5))) for _ in range(400)})
    held, dense, order, seen = trie.pack(paths)
    prefixes = {p[: trie.NAME * d] for p in paths for d in range(len(p) // trie.NAME + 1)} | {b""}
    assert len(order) == len(set(order)) == len(prefixes)
    for path in paths:
        slot = 0
        for d in range(len(path) // trie.NAME):
            slot = held.child(slot, dense[path[d * trie.NAME : (d + 1) * trie.NAME]])
            assert slot > 0 and seen[slot][0] == d + 1
    assert held.child(0, len(dense) + 1000) == -1


def test_sql(spark, tmp_path):
    import duckdb

    rows = conversations(9, 120, ["a", "bb", None], 8) + [(100, None, "user", "x"), (133, 4, None, None)]
    path = str(tmp_path / "conversations.parquet")
    table(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    want = {(r[0], r[1]): r[2:] for r in con.execute(f"SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM ({ORACLES['op11_prefix_trie']})").fetchall()}
    assert got(op11(spark, str(tmp_path))) == want
