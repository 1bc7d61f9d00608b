import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from seepline.llm import suffixes
from seepline.llm.queries import op3


def brute(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(x[i : i + length] for x in raws for i in range(len(x) - length + 1))
    out = []
    for (d, _), x in zip(rows, raws, strict=True):
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(x)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((d, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [16_384, 3])
def test_against_brute_force(spark, frame, prose, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffixes, "_AT_ONCE", 500)
    monkeypatch.setattr(suffixes, "BUCKET_SUFFIXES", 400)
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgé ") for _ in range(300))
    given = [(i, prose(i, 120) + (passage[i % 60 : 260 + i % 40] if i % 3 == 0 else "") + prose(100 + i % 11, 60)) for i in range(40)]
    given += [(100, None), (101, ""), (102, "a" * 900), (103, "ab" * 500), (104, passage[:230] + "#" + passage[231:]), (105, passage), (105, passage), (None, passage), (106, "é" * 120)]
    monkeypatch.setattr("seepline.llm.queries.read", lambda *_: frame(given))
    got = sorted((tuple(r) for r in op3(spark, "").collect()), key=str)
    assert got == brute(given)


def test_long_texts_in_pieces(frame, prose, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 700)
    text = prose(5, 400)
    given = [(1, text), (2, prose(6, 100) + text[500:1500])]
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.without_repeats(frame(given, 1)).collect()}
    want = brute(given)
    assert {hashlib.sha256(got[d]).hexdigest() for d in (1, 2)} == {w[4] for w in want}


def test_empty_and_unique(frame, prose):
    assert suffixes.without_repeats(frame([(1, "a")]).limit(0)).count() == 0
    assert [len(r["spans"]) for r in suffixes.without_repeats(frame([(1, prose(1, 100))])).collect()] == [0]


@pytest.mark.parametrize("seed", range(4))
def test_multikey_order(seed):
    rng = np.random.default_rng(seed)
    keys = [rng.integers(0, 5, 300), rng.integers(0, 4, 300), rng.integers(0, 1000, 300)]
    got = suffixes.multikey_order(keys)
    assert [tuple(k[i] for k in keys) for i in got] == sorted(zip(*keys, strict=True))


def test_boundaries(spark, monkeypatch):
    """One string with many places spreads over buckets; all of its places are found."""
    rows = [(5, 9, i, 100 + i, 0) for i in range(60)] + [(i, i, i, 0, 0) for i in range(60)]
    made = spark.createDataFrame(rows, "lead long, digest long, anchor long, context long, offset int")
    monkeypatch.setattr(suffixes, "BUCKET_SUFFIXES", 10)
    got = {tuple(r) for r in suffixes.repeated_strings(made, len(rows)).collect()}
    assert got == {(i, 100 + i, 0) for i in range(60)}
