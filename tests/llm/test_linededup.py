import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from seepline.llm import linededup
from seepline.llm.queries import op2

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows):
    docs = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 20:
                docs[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(docs[key(x)]) < 3 or max(docs[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(prose):
    common = "A line that Many documents share ÄÖ"
    made = [(i, f"{prose(i, 12)}\n {common}\t\n{prose(i % 7, 9)}\n\n{common.lower() if i % 2 else common}") for i in range(40)]
    return made + [(50, None), (51, ""), (52, "\n\n"), (None, common), (53, f"{common}\n" * 500), (54, "short"), (3, f"{common}\nanother text of the same id"), (7, made[7][1]), (7, made[7][1])]


def test_against_brute_force(spark, frame, prose, monkeypatch):
    given = rows(prose)
    monkeypatch.setattr("seepline.llm.queries.read", lambda *_: frame(given))
    got = sorted((tuple(r) for r in op2(spark, "").collect()), key=str)
    assert got == brute(given)


def test_bitmaps_and_texts(frame, prose):
    given = rows(prose)
    docs = frame(given)
    bitmaps = linededup.keep_bitmaps(docs)
    for r in bitmaps.collect():
        assert sum(k["length"] for k in r["keep"]) == r["n_lines"] - r["n_dropped"]
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(given)
    assert out.where(F.col("n_chars") != F.char_length("text")).count() == 0
    want = {(d, h) for d, _, _, h in brute(given)}
    got = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in out.collect()}
    assert got == want


def test_only_the_first_line_of_the_kept_document(frame):
    line = "a line that stands more than once"
    docs = frame([(1, f"{line}\nown words of this document"), (2, line), (9, f"head\n{line}\n{line.upper()}\ntail\n{line}")])
    out = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs, only_first=True).collect()}
    assert out == {1: "own words of this document", 2: "", 9: f"head\n{line}\ntail"}
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}[9].count("\n") == 4


def test_smallest_and_largest_ids(frame):
    line = "a line that three documents hold"
    docs = frame([(-(2**63), line), (2**63 - 1, line), (0, line)])
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()} == {-(2**63): "", 0: "", 2**63 - 1: line}


def test_occurrences_are_streamed(frame, prose):
    """Sorted rows are aggregated in their order: no hash table of lines, no second sort."""
    lines = frame(rows(prose)).where("doc_id IS NOT NULL").selectExpr("doc_id", "text AS key", "struct(n_chars) AS at")
    _, firsts = linededup.first_occurrences(lines)
    plan = firsts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("SortAggregate") == 2 and "HashAggregate" not in plan
    assert plan.count("Sort [") == 1 and plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan and "Python" not in plan


def test_empty_table(frame):
    docs = frame([(1, "a")]).limit(0)
    assert linededup.dedup_lines(docs).count() == 0
