import math
import random
import re
from collections import Counter

import duckdb
import pytest

from seepline.llm import search
from seepline.llm.queries import ORACLES, op13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")))


def plain(docs, items, k=10):
    held = [(d, terms(t)) for d, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in set(items):
        if i is not None:
            asked[i] = asked.get(i, Counter()) + terms(t)
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in held:
            m = 25 + 75 * c.total() * n // max(total, 1)
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, r in q.items() if t in c)
            if s > 0 and d is not None:
                scores.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, term long, doc_id string")


def got(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("block,group,salts,share", [(1024, 128, 64, [64, 16, 4, 1]), (16, 4, 64, [64, 16, 4, 1]), (16, 7, 400, [50, 3, 1])])
def test_against_plain_scores(frame, spark, monkeypatch, prose, block, group, salts, share):
    for name, value in (("BLOCK", block), ("GROUP", group), ("SALTS", salts), ("SHARES", share)):
        monkeypatch.setattr(search, name, value)
    rng = random.Random(7)
    docs = [(i, prose(i, rng.randint(0, 120))) for i in range(250)]
    docs += [(1000 + i, docs[40][1]) for i in range(30)]
    items = [(i, " ".join(docs[rng.randrange(250)][1].split()[:25]) + " Nowhere-found zz") for i in range(20)]
    assert got(search.rank(frame(docs), items_frame(spark, items))) == plain(docs, items)


def test_odd_rows(frame, spark, monkeypatch):
    monkeypatch.setattr(search, "PIECE", 64)
    docs = [(1, None), (2, ""), (3, " \t.,-"), (4, "Alpha beta"), (4, "Alpha beta"), (None, "alpha alpha"), (5, "ÄÖ äö alpha\x7fbeta_b2"), (6, "alpha " * 20_000 + "x" * 500 + " omega"), (7, "x" * 500), (8, "omega")]
    items = [(1, "ALPHA beta beta"), (1, "ALPHA beta beta"), (2, None), (3, "!!"), (None, "alpha"), (4, "ÄÖ äö B2"), (5, "x" * 500 + " omega"), (6, "absent")]
    assert got(search.rank(frame(docs), items_frame(spark, items))) == plain(docs, items)
    assert got(search.rank(frame(docs).limit(0), items_frame(spark, items))) == []
    assert got(search.rank(frame(docs), items_frame(spark, items).limit(0))) == []
    assert got(search.rank(frame([(1, "the"), (2, "the")]), items_frame(spark, [(1, "the")]))) == plain([(1, "the"), (2, "the")], [(1, "the")])


def test_terms(monkeypatch, prose):
    text = prose(3, 400) + " " + "y" * 300 + "É\x00A_b " + "z" * 70
    for piece in (7, 64, 1 << 20):
        monkeypatch.setattr(search, "PIECE", piece)
        assert search.terms_of(text.encode()) == Counter({t.encode(): c for t, c in terms(text).items()})


def test_sql(frame, spark, tmp_path, prose):
    docs = [(i, prose(i, 60)) for i in range(80)] + [(100, None), (101, prose(3, 60))]
    items = [(i, prose(i, 20) + " Extra") for i in range(0, 80, 9)]
    frame(docs).write.parquet(str(tmp_path / "documents.parquet"))
    items_frame(spark, items).select("item_id", "text").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(con.execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLES['op13_lexical_search']})").fetchall())
    assert got(op13(spark, str(tmp_path))) == want == plain(docs, items)
