r"""Personal data by pattern, checksum and context (DataFrame operations only).

Patterns propose spans, validators confirm them (part ranges, digit counts, Luhn for cards,
mod 97 for account numbers), words around a span raise its score and others before it lower
it. Spans of the base kinds are kept whatever their score; those of the added kinds from
``THRESHOLD`` on.

Positions come from marks: every match is wrapped in ``\x01`` (a ``\x01`` of the text counts
as another sign first), the text is split there, and odd parts are matches. Starts are
running sums of part lengths, taken in chunks so that long texts with many matches stay
close to linear.

NULL text is empty; a text without spans gives an empty list; repeated rows are alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import texts

MARK, OTHER = "\x01", "\x02"
THRESHOLD = 0.5
BEFORE, AFTER = 48, 24
_CHUNK = 64


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: float
    near: tuple[str, ...]
    far: tuple[str, ...] = ()
    base: bool = True


#: Possessive quantifiers keep long runs iterative; each is followed by what it cannot hold.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9, ("mail", "contact", "kontakt", "correo", "courriel"),
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, ("ip", "host", "server", "address"), ("version", "release")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, ("card", "visa", "credit", "karte", "tarjeta", "carte"), ("order", "invoice", "isbn")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, ("phone", "tel", "call", "mobile", "fax", "telefon"), ("order", "version")),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        0.7, ("iban", "account", "konto", "cuenta", "compte", "bank"), ("order", "invoice", "part", "serial", "tracking"), base=False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3, ("ssn", "social", "security", "tax"), ("order", "invoice", "part"), base=False,
    ),
)


def proposals(text: Column, pattern: str) -> list[tuple[str, Column]]:
    """Steps ``(column, expression)`` that end with ``_found``: start, end (code points, end
    exclusive), value, and the text before and after, of the leftmost matches."""
    parts, starts = F.col("_parts"), F.col("_starts")
    chunks = F.transform(F.sequence(F.lit(0), F.size(parts) - 1, F.lit(_CHUNK)), lambda i: F.slice(parts, i + 1, _CHUNK))
    lengths = F.transform(F.col("_chunks"), lambda c: F.aggregate(c, F.lit(0), lambda a, p: a + F.char_length(p)))
    running = F.aggregate(F.col("_lengths"), F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    within = F.transform(
        F.col("_chunks"),
        lambda c, k: F.aggregate(c, F.array(F.get(F.col("_running"), k)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.char_length(p)))),
    )
    spans = F.transform(
        F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)),
        lambda i: F.struct(
            F.get(starts, i).alias("start"),
            (F.get(starts, i) + F.char_length(F.get(parts, i))).alias("end"),
            F.get(parts, i).alias("value"),
            F.lower(F.right(F.get(parts, i - 1), F.lit(BEFORE))).alias("before"),
            F.lower(F.left(F.get(parts, i + 1), F.lit(AFTER))).alias("after"),
        ),
    )
    empty = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    some = F.size(parts) > 1
    return [
        ("_parts", F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)),
        ("_chunks", F.when(some, chunks)),
        ("_lengths", F.when(some, lengths)),
        ("_running", F.when(some, running)),
        # each chunk's last sum is the next chunk's first
        ("_starts", F.when(some, F.flatten(F.transform(within, lambda a: F.slice(a, 1, F.size(a) - 1))))),
        ("_found", F.when(some, spans).otherwise(F.array().cast(empty))),
    ]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes: from the right, every second digit doubled, its
    digits summed, the total a multiple of ten."""
    each = F.transform(
        F.filter(F.split(F.reverse(number), ""), lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.floor(d.cast("int") * 2 / 10).cast("int") + (d.cast("int") * 2) % 10),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, its first four signs moved to the end and letters read as
    10 to 35, leaves 1 when divided by 97."""
    bare = F.regexp_replace(account, " ", "")
    signs = F.filter(F.split(F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4))), ""), lambda c: c != "")
    return (
        F.aggregate(
            signs,
            F.lit(0),
            lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
        )
        == 1
    )


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "")),
            lambda p: (F.char_length(p) <= 3) & (F.left(p, F.lit(3)).cast("int") <= 255),
        )
    if kind == "card":
        n = F.char_length(digits(value))
        return F.when((n >= 14) & (n <= 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return F.char_length(digits(value)).between(10, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike(rf"\b(?:{'|'.join(words)})") if words else F.lit(False)


def scored(kind: Kind, order: int, found: Column) -> Column:
    """The confirmed spans of one kind with their scores."""

    def span(s: Column) -> Column:
        around = F.concat(s["before"], F.lit(" "), s["after"])
        score = F.lit(kind.score) + F.when(_any(around, kind.near), 0.25).otherwise(0.0) - F.when(_any(s["before"], kind.far), 0.25).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"), F.lit(kind.base).alias("base"),
        )

    spans = F.transform(F.filter(found, lambda s: valid(kind.name, s["value"])), span)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: per row the spans by start, then kind as listed in ``KINDS``."""
    now = texts(docs).select("doc_id", F.translate("text", MARK, OTHER).alias("_text"))
    kept = ["doc_id", "_text"]
    for order, kind in enumerate(KINDS):
        for name, column in proposals(F.col("_text"), kind.pattern):
            now = now.withColumn(name, column)
        now = now.withColumn(f"_{kind.name}", scored(kind, order, F.col("_found")))
        kept.append(f"_{kind.name}")
        now = now.select(*kept)
    return now.select("doc_id", F.sort_array(F.concat(*[f"_{k.name}" for k in KINDS])).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scores(spans: Column) -> Column:
    """The scores of the spans in their order, with two decimals, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",")


def count(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))
