import random

import numpy as np
import pytest

from seepline.llm import decontaminate as dc


def semi_global(passage, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j - 1] + (a != b), before[j] + 1, now[j - 1] + 1))
        before = now
    return min(before)


def altered(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        j, r = rng.randrange(len(out)), rng.random()
        if r < 0.4:
            out[j] = rng.choice("abcde")
        elif r < 0.7:
            del out[j]
        else:
            out.insert(j, rng.choice("abcde"))
    return "".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_against_edit_distance(seed):
    """Every place within the budget is found, with its distance, and nothing else."""
    rng = random.Random(seed)
    items = [(i, "".join(rng.choice("abc de") for _ in range(rng.choice([30, 60, 90])))) for i in range(5)]
    block = dc.Block(items, 4, 0.1)
    docs = []
    for _ in range(30):
        filler = "".join(rng.choice("abc de") for _ in range(150))
        cut = rng.randrange(150)
        docs.append(filler[:cut] + altered(rng, rng.choice(items)[1], rng.randint(0, 9)) + filler[cut:])
    got = {(d, i): n for d, i, _, _, n in dc.find(block, docs)}
    want = {}
    for d, text in enumerate(docs):
        plain = "".join(map(chr, dc.normal(text)))
        for k, (i, _) in enumerate(items):
            n = semi_global("".join(map(chr, block.points[k])), plain)
            if n <= block.edits[k]:
                want[d, i] = n
    assert got == want


def test_normal():
    assert "".join(map(chr, dc.normal("  A--b\n_c  É! "))) == "a b c é"
    assert len(dc.normal("")) == len(dc.normal(" .!_")) == 0


def test_tables(spark, frame, prose):
    passages = [(1, prose(900, 40)), (2, prose(901, 30)), (3, "tiny"), (4, None), (None, "x"), (5, ""), (1, prose(900, 40))]
    bench = spark.createDataFrame(passages, "item_id long, text string")
    given = [(i, prose(i, 80)) for i in range(20)]
    given += [(50, f"{prose(60, 20)} {passages[0][1].upper()}! {prose(61, 9)}"), (51, passages[1][1].replace(" ", " - ")), (52, None), (53, ""), (54, "a tiny thing"), (55, "tinyx"), (56, "ab " * 30_000), (50, prose(62, 5))]
    docs = frame(given)
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in dc.matches(docs, bench).collect()}
    assert got == {(50, 1, 0), (51, 2, 0), (54, 3, 0)}
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([*range(20), 50, 52, 53, 55, 56])
    assert dc.matches(docs, bench.limit(0)).count() == 0 and dc.clean(docs, bench.limit(0)).count() == len(given)
    assert dc.matches(docs.limit(0), bench).count() == 0


def test_blocks_agree(spark, frame, prose, monkeypatch):
    bench = spark.createDataFrame([(i, prose(800 + i, 30)) for i in range(6)], "item_id long, text string")
    docs = frame([(i, f"{prose(i, 10)} {prose(800 + i, 30)}") for i in range(6)])
    one = {tuple(r) for r in dc.matches(docs, bench).collect()}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 200)
    assert len(list(dc.blocks(bench))) > 2
    assert {tuple(r) for r in dc.matches(docs, bench).collect()} == one and len(one) == 6
    assert {r["doc_id"] for r in dc.clean(docs, bench).collect()} == set()


def test_qgrams_differ():
    rng = np.random.default_rng(0)
    points = rng.integers(97, 123, 5000).astype(np.uint32)
    grams = dc.qgrams(points, 8)
    pieces = [tuple(points[i : i + 8]) for i in range(len(points) - 7)]
    assert len(grams) == len(pieces) and len(set(grams.tolist())) == len(set(pieces))
    assert (dc.qgrams(points[100:200], 8) == grams[100:193]).all()


def test_parts(spark, frame, prose):
    """Half an item, an item that lost a line and one cut at a line are found; less than a window
    of an item, and short lines alone, are not."""
    lines = [prose(700 + i, 9)[:44].strip() for i in range(3)]
    texts = [prose(600, 60), "\n".join(lines), prose(601, 24), f"{prose(602, 20)}\n{prose(603, 20)}"]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    half, side = len(texts[0]) // 2, [prose(610 + i, 15) for i in range(2)]
    given = [
        (1, f"{side[0]} {texts[0][:half]} {side[1]}"),
        (2, f"{side[0]}\n{lines[0]}\n{side[1]}\n{lines[2]}"),
        (3, f"{side[0]} {texts[2][-60:]}"),
        (4, f"{side[0]} {texts[0][37:137]} {side[1]}"),
        (5, f"{prose(603, 20)}\n{side[1]}"),
        (6, f"{side[0]} {texts[0][:70]} {side[1]}"),
        (7, f"{side[0]}\n{lines[0]}\n{side[1]}"),
        (8, f"{side[0]} {texts[0]}"),
    ]
    got = {r["doc_id"]: r for r in dc.matches(frame(given), bench).collect()}
    assert {d: r["item_id"] for d, r in got.items()} == {1: 0, 2: 1, 3: 2, 4: 0, 5: 3, 8: 0}
    assert got[8]["covered"] == got[8]["item_end"] == len(dc.normal(texts[0])) and got[8]["edits"] == 0
    assert got[2]["covered"] >= len(dc.normal(lines[0])) + len(dc.normal(lines[2]))
    assert sorted(r["doc_id"] for r in dc.clean(frame(given), bench).collect()) == [6, 7]


def test_any_run(prose):
    """Every run of the stated length is found, wherever it lies, with one edit in ten."""
    rng = random.Random(1)
    for words, run in ((20, 58), (70, 94)):
        item = "".join(map(chr, dc.normal(prose(620 + words, words))))
        block = dc.Block([(1, item)], dc.Q, dc.EDIT_RATE, cut=True)
        assert len(item) > run and (len(item) >= 200) == (run == 94)
        at = range(0, len(item) - run + 1, 3)
        docs = [f"{prose(630 + s, 12)} q{altered(rng, item[s : s + run], 3)}q {prose(640 + s, 12)}" for s in at]
        assert len(dc.find(block, docs)) == len(at)


def test_many_short_items_and_documents():
    """More pairs of a document and an item than 32 bits hold."""
    items = [(i, f"q{i:08d}") for i in range(200_000)]
    block = dc.Block(items, dc.Q, dc.EDIT_RATE, cut=True)
    text = "see q00000017 and q00199999 there"
    docs = [""] * 15_990 + [text] + [""] * 9
    one = {row[1:] for row in dc.find(block, [text])}
    assert {row[0] for row in one} == {17, 199_999}
    assert {row[1:] for row in dc.find(block, docs) if row[0] == 15_990} == one and len(dc.find(block, docs)) == 2


def test_runs_are_cut_within_documents(monkeypatch, prose):
    """Cutting the votes of a document changes nothing."""
    rng = random.Random(3)
    items = [(i, prose(700 + i, 40)) for i in range(4)] + [(9, "na " * 30)]
    block = dc.Block(items, dc.Q, dc.EDIT_RATE, cut=True)
    docs = []
    for k in range(6):
        parts = [prose(720 + k, 30)]
        for _ in range(4):
            text = rng.choice(items)[1]
            parts += [altered(rng, text, rng.randint(0, 6)), text[: len(text) // 2], prose(rng.randrange(10**6), 20)]
        docs.append(" ".join(parts))
    want = dc.places(block, docs)
    assert len(want) >= 12
    for least in (1, 50, 700):
        monkeypatch.setattr(dc, "_AT_ONCE", least)
        assert dc.places(block, docs) == want


def test_repetitive_text_is_bounded():
    """A text that repeats what an item repeats: its votes are cut, and one place is enough."""
    import tracemalloc

    block = dc.Block([(1, "la " * 69 + "l"), (2, "lo " * 69 + "x")], dc.Q, dc.EDIT_RATE, cut=True)
    text = "la " * 100_000
    tracemalloc.start()
    found = dc.find(block, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [row[1] for row in found] == [1] and peak < 1 << 30
