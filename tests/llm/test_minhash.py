import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from seepline.llm import minhash
from seepline.llm.queries import ORACLES, op12


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(5)), strict=False))


def plain(docs, percent=85):
    """(doc_id, n, component) of rows with ids; ids are not repeated."""
    sets = [plain_set(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    out = set()
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if group[j] == group[i] and docs[j][0] is not None]
        c = min(ids, default=None) if sets[i] else d
        out.add((d, len(sets[i]), c, c == d))
    return out


def got(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near(prose):
    """Copies with few and with many changes, chains of changes, and a passage all share."""
    rng = random.Random(4)
    docs = [(i, prose(i, rng.randint(6, 300))) for i in range(60)]
    for k in range(5):
        base = prose(100 + k, 200 + 40 * k)
        docs += [(1000 * (k + 1) + i, edited(base, rng, rng.choice([0, 1, 2, 3, 5, 8]))) for i in range(40)]
    chain = prose(200, 250)
    for i in range(30):
        docs.append((9000 + i, chain))
        chain = edited(chain, rng, 2)
    passage = prose(300, 150)
    docs += [(9500 + i, passage + " " + prose(400 + i, rng.choice([5, 12, 30, 200]))) for i in range(40)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("block,unit", [(2048, 1024), (8, 3)])
def test_against_all_pairs(frame, monkeypatch, near, block, unit):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "UNIT", unit)
    assert got(minhash.near_duplicates(frame(near))) == plain(near)


def test_second_round_is_complete(frame, monkeypatch, near):
    """Links that the first round leaves out are all found by the second."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "_forest", lambda lists, matches, percent: lists.select("cls").limit(0).selectExpr("cls AS a", "cls AS b"))
    assert got(minhash.near_duplicates(frame(near))) == plain(near)


def test_rows_of_a_large_group():
    """Copies that all differ by just less than the bound: the first round gives a forest of
    them, and lists that share a pair give it once in the second."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    sets = [np.unique(np.r_[np.delete(base, np.s_[15 * k : 15 * k + 15]), rng.integers(0, 1 << 63, 15, dtype=np.uint64)]) for k in range(26)]
    n = len(sets)

    def rows(at, likely):
        table = pa.table(
            {c: pa.array([at << 32 if c == "tok" else 0] * n, pa.int64()) for c in ("tok", "kind", "i", "j", "side")}
            | {"cls": range(n), "comp": range(n), "n": [len(s) for s in sets], "posts": [(1 << minhash.PERMS) - 1] * n}
            | {"sig": [minhash.signature(s).view(np.int32) for s in sets], "sketch": [minhash.sketch(s).tobytes() for s in sets]}
        )
        return [p for b in minhash._pairs_of(table, likely, minhash.MATCHES, minhash.PERCENT) for p in zip(*b.to_pydict().values(), strict=True)]

    assert len(rows(0, True)) == n - 1
    met = [frozenset(p) for at in range(minhash.PERMS) for p in rows(at, False)]
    assert len(met) == len(set(met)) == n * (n - 1) // 2


def test_odd_rows(frame, prose, monkeypatch):
    monkeypatch.setattr(minhash, "PIECE", 50)
    long = prose(1, 20_000)
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE\x0btwo"), (6, "one two three"), (7, "a b c d e"), (8, "A b C d e"), (9, "é b c d e"),
        (10, "É b c d e"), (11, "x " * 500), (12, "x " * 9), (13, long), (14, long + " end"), (15, "y" * 500), (16, "y" * 500), (None, "a b c d e"), (None, "nobody else has this one text"),
    ]
    assert got(minhash.near_duplicates(frame(docs))) == plain(docs)
    assert got(minhash.near_duplicates(frame([(5, "same text of five words or more")] * 3))) == {(5, 3, 5, True)}
    assert got(minhash.near_duplicates(frame(docs).limit(0))) == set()


def test_parity_bound():
    rng = np.random.default_rng(2)
    for n in (1, 30, 600, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[n // 10 :], rng.integers(0, 1 << 63, n // 8, dtype=np.uint64)])
        x, y = sorted((minhash.sketch(a), minhash.sketch(b)), key=len)
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_sql(frame, spark, tmp_path, near):
    frame(near + [(20_000, None), (20_001, "a b")]).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = set(con.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({ORACLES['op12_minhash']})").fetchall())
    assert got(op12(spark, str(tmp_path))) == want
