import numpy as np
import pytest
import xxhash

from seepline.llm import common, simhash


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_fingerprints(frame, prose):
    given = [(i, prose(i, i)) for i in range(30)] + [(100, None), (101, "A b\x0bC D"), (102, "ÄÖ ÜX aa")]
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.fingerprints(frame(given)).collect()}
    assert got == {d: plain(t) for d, t in given}


def near_groups(values, max_bits=3):
    group = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= max_bits and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


@pytest.mark.parametrize("block", [2048, 7])
def test_links_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64).tolist()
    values = []
    for c in centres:
        for _ in range(25):
            v = c % (1 << 64)
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                v ^= 1 << int(bit)
            values.append(v)
    values = sorted(set(values)) + [0, 7, (1 << 64) - 1]
    values = list(dict.fromkeys(values))
    rows = [(v - (1 << 64) if v >= 1 << 63 else v, i) for i, v in enumerate(values)]
    links = simhash.links(spark.createDataFrame(rows, "fp long, rep long"))
    found = {r["node"]: r["component"] for r in common.components(links).collect()}
    assert [found.get(i, i) for i in range(len(values))] == near_groups(values)


def test_distance_bound():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 500, dtype=np.int64).astype(np.uint64) for _ in range(2))

    def counts(x):
        return np.array([[(int(v) >> (2 * s) & 1) + (int(v) >> (2 * s + 1) & 1) for s in range(32)] for v in x])

    manhattan = abs(counts(a) - counts(b)).sum(axis=1)
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_groups_and_odd_rows(frame, prose):
    text = prose(1, 300)
    given = [(5, text), (9, text), (2, prose(2, 300)), (20, None), (21, ""), (None, text), (9, text), (30, "x " * 100_000), (31, "one"), (32, "ONE")]
    docs = frame(given)
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(5, 5), (9, 5), (2, 2), (20, 20), (21, 20), (None, 5), (30, 30), (31, 31), (32, 31)}
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {5, 2, 20, None, 30, 31}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 999), (7, 7)] + [(5000 + i, 6000) for i in range(300)]
    found = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {found[i] for i in range(201)} == {0} and found[1000] == 999 and {found[5000 + i] for i in range(300)} == {5000} and found[6000] == 5000
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
