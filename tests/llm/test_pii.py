import hashlib
import re
from collections import Counter

from seepline.llm import pii
from seepline.llm.queries import op4

BASE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text):
            n = re.sub("[^0-9]", "", m.group())
            fits = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")), "card": 14 <= len(n) <= 19 and luhn(n), "phone": 10 <= len(n) <= 15}
            if fits[kind]:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


GIVEN = [
    (1, None),
    (2, ""),
    (3, "a@b.c_x@d.e.f 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 +1 (544) 555-8128. +12"),
    (4, "é 4012 8888 8888 1881, 4012-8888-8888-1881 \x01 x@y.z  +++9 9 9 9 9 9 9 9 9 9- \U0001f600 é@a.b.c- 12345678901234567890123"),
    (5, "1 " * 3000 + "a.b@" * 2000 + "x." * 2000 + "+1" * 1000 + "1.1." * 2000),
    (6, "12 " * 20_000),
    (7, "mail a@b.co " * 300),
    (7, "mail a@b.co " * 300),
    (None, "q@r.st"),
]


def test_base_spans(spark, frame, monkeypatch):
    monkeypatch.setattr("seepline.llm.queries.read", lambda *_: frame(GIVEN))
    got = sorted((tuple(r)[:6] for r in op4(spark, "").collect()), key=str)
    want = []
    for d, t in GIVEN:
        found = spans(t or "")
        n = Counter(k for _, _, k, _ in found)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in found).encode()).hexdigest()
        want.append((d, n["email"], n["ip"], n["card"], n["phone"], digest))
    assert got == sorted(want, key=str)


def test_added_kinds(frame):
    text = "account GB82 WEST 1234 5698 7654 32, DE89370400440532013001; my ssn 123-45-6789, part 123-45-6789"
    found = pii.find(frame([(1, text)])).first()["spans"]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in found] == [("iban", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789")]


def test_context_moves_the_score(frame):
    rows = pii.find(frame([(1, "card 4012888888881881"), (2, "invoice 4012888888881881"), (3, "4012888888881881")])).collect()
    score = {r["doc_id"]: r["spans"][0]["score"] for r in rows}
    assert score[1] > score[3] > score[2]


def test_context_decides_about_added_kinds(frame):
    """A valid account number sinks among serial numbers, a bare group of digits rises near its name."""
    iban, ssn = "DE89370400440532013000", "123-45-6789"
    given = [(1, f"iban {iban}"), (2, iban), (3, f"serial {iban}"), (4, f"serial of this account {iban}"), (5, ssn), (6, f"social {ssn}"), (7, f"{ssn} was the tax id"), (8, f"order social {ssn}")]
    found = {r["doc_id"]: [(s["kind"], round(s["score"], 2)) for s in r["spans"]] for r in pii.find(frame(given)).collect()}
    assert found == {1: [("iban", 0.95)], 2: [("iban", 0.7)], 3: [], 4: [("iban", 0.7)], 5: [], 6: [("ssn", 0.55)], 7: [("ssn", 0.55)], 8: []}


def test_scores_are_returned(spark, frame, monkeypatch):
    monkeypatch.setattr("seepline.llm.queries.read", lambda *_: frame([(1, "card 4012888888881881, order 4012888888881881 a@b.co"), (2, None)]))
    got = {r["doc_id"]: (r["spans"], r["scores"]) for r in op4(spark, "").collect()}
    assert got == {1: ("card:5:21,card:29:45,email:46:52", "0.95,0.45,0.90"), 2: ("", "")}


def test_empty_table(frame):
    assert pii.find(frame([(1, "a")]).limit(0)).count() == 0
