import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seepline.llm import packing, tokens
from seepline.llm.tokens import PieceEncoder


def layout(runs, capacity):
    """Bins as lists of (offset, size); checks ranks, gaps and the capacity."""
    bins, ranks = defaultdict(list), defaultdict(list)
    for size, first, count, each, offset, start in runs:
        ranks[size].append((first, count))
        for i in range(count):
            bins[start + i // each].append((offset + i % each * size, size))
    for spans in ranks.values():
        at = 0
        for first, count in sorted(spans):
            assert first == at
            at += count
    for items in bins.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= capacity
    return bins


@pytest.mark.parametrize("seed", range(25))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 100, 2048])
    top = rng.choice([capacity, max(2, capacity // 2), max(1, capacity // 5)])
    sizes = Counter(rng.randint(1, top) for _ in range(rng.choice([1, 5, 40, 400])))
    plan = packing.plan(sizes, capacity)
    bins = layout(plan.runs, capacity)
    assert Counter(s for items in bins.values() for _, s in items) == sizes and len(bins) == plan.bins
    least = -(-sum(s * n for s, n in sizes.items()) // capacity)
    greedy = []
    for s in sorted(sizes.elements(), reverse=True):
        fit = [i for i, r in enumerate(greedy) if r >= s]
        if fit:
            greedy[min(fit, key=greedy.__getitem__)] -= s
        else:
            greedy.append(capacity - s)
    assert least <= plan.bins <= len(greedy) + 1


def best(sizes, capacity):
    """The fewest bins, by search."""
    sizes = sorted(sizes, reverse=True)
    found = [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= found[0]:
            return
        if i == len(sizes):
            found[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= sizes[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - sizes[i]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return found[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = 20
    items = [rng.randint(rng.choice([1, 5]), rng.choice([12, 20])) for _ in range(9)]
    left, fixed = Counter(items), 0
    for size, partners, times in packing._dominating(left, capacity):
        for s in [size, *partners]:
            left[s] -= times
            if not left[s]:
                del left[s]
        fixed += times
    assert fixed + best(list(left.elements()), capacity) == best(items, capacity)


def test_many_equal_items():
    plan = packing.plan({1: 10**9, 2048: 5, 1000: 10**9, 700: 3 * 10**8}, 2048)
    assert len(plan.runs) < 50
    assert plan.bins == 5 + (10**9 + 3 * 10**8) // 2  # no bin takes three of the larger items


def test_bad_size():
    with pytest.raises(ValueError):
        packing.plan({2049: 1}, 2048)


TEXTS = [
    "", " ", "Plain words, it's what they'll say: we've 12 3½ ² things!", "über façade naïve x\x85y\x1cz", "a\n\n\n b  \t c   ", "日本語 text Ωmega", "<|endoftext|> is text", "x" * 5000,
    "é" * 3000, "tabs\tand\r\nlines   more", "😀 smile", "\x00\x01 control", "don't 'sit 'LL 's",
]


def test_ids_equal_the_tokenizer():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    encode = PieceEncoder("byte_bpe_50k.json")
    for text in [*TEXTS, *["".join(random.Random(i).choices("ab éÉ'sß.,\n\t 19²ªµ ­\x1f_-", k=80)) for i in range(300)]]:
        raw = encode(text)
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == reference.encode(text, add_special_tokens=False).ids, text


def test_ids_of_a_batch(monkeypatch):
    """Words end with their text, and frequent ones are not encoded again when the cache turns."""
    monkeypatch.setattr(tokens, "_CACHED", 8)
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    encode, rng, met = PieceEncoder("byte_bpe_50k.json"), random.Random(5), []
    texts = [*TEXTS, *["".join(rng.choices("ab é'strelvmd\n\t 19", k=rng.randrange(12))) for _ in range(500)]]
    for text, raw in zip(texts, encode.batch(texts), strict=True):
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == reference.encode(text, add_special_tokens=False).ids, text
    monkeypatch.setattr(encode, "model", type("Model", (), {"tokenize": lambda _, w, own=encode.model: met.append(w) or own.tokenize(w)})())
    for i in range(40):
        encode.batch(["often"]), encode.batch([f"word{i}"])
    assert met.count("often") == 1


@pytest.mark.parametrize("rank_rows", [100_000, 2])
def test_pack(frame, prose, monkeypatch, rank_rows):
    monkeypatch.setattr(packing, "RANK_ROWS", rank_rows)
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    given = [(i, prose(i, i * 7)) for i in range(40)] + [(100, None), (101, ""), (102, "word " * 30_000), (3, prose(3, 21)), (None, "x")] + [(200 + i, "same size") for i in range(60)]
    capacity = 256
    rows = packing.pack(frame(given), capacity=capacity).collect()
    want = Counter()
    for d, t in given:
        ids = [*reference.encode(t or "", add_special_tokens=False).ids, 0]
        at = k = 0
        while at < len(ids):
            n = capacity if at or len(ids) % capacity == 0 else len(ids) % capacity
            n = min(n, len(ids))
            want[d, k, at, n, zlib.crc32(struct.pack(f"<{n}I", *ids[at : at + n]))] += 1
            at, k = at + n, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in held.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= capacity
    assert len(held) <= -(-sum(r["length"] for r in rows) // capacity) + 1
    assert packing.pack(frame(given).limit(0)).count() == 0
    assert packing.pieces(frame([(1, "a b")]), with_ids=True).first()["ids"][-1] == 0
