import re
from collections import Counter

from seepline.llm import quality
from seepline.llm.queries import op5

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text)
    n = len(words)
    seen = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    covered = {j for i in range(n - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_against_brute_force(spark, frame, prose, monkeypatch):
    given = [(i, prose(i, 15 + i) + "\n" + prose(i % 5, 12) + "\n" + prose(i % 5, 12)) for i in range(30)]
    given += [(100, None), (101, ""), (102, " \t\r\n"), (103, "\x0b a b\t" + "x y z w v u t s " * 30 + "\n\n \n a\na\na "), (104, "ü" * 40_000), (105, "ha " * 5000), (None, "a b"), (7, "a b"), (7, "a b")]
    monkeypatch.setattr("seepline.llm.queries.read", lambda *_: frame(given))
    got = sorted((tuple(r)[:7] for r in op5(spark, "").collect()), key=str)
    assert got == sorted(((d, *measured(t or "")) for d, t in given), key=str)


def test_rules(frame, prose):
    good = prose(1, 200)
    rows = {1: good, 2: " ".join(w + "%%%" for w in good.split()), 3: good.upper(), 4: "zzqq " * 3 + " ".join(f"xq{i}vv" for i in range(60)), 5: " | ".join(good.split())}
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(frame(list(rows.items()))).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_one_projection(frame):
    plan = quality.judge(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 1  # the one of the fixture itself
    assert quality.judge(frame([(1, "a")]).limit(0)).count() == 0
