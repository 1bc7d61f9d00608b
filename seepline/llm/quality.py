r"""Quality rules as one projection (DataFrame operations only).

``measures`` counts words, signs, repeated lines and repeated eight-word windows of a text
inside its row: no row is exploded or shuffled. ``RULES`` is a table of ratios and their
limits, compiled into a single condition.

Words are ``[^\x20\x09-\x0D]+``. NULL or blank text has no words and fails the base rule.
Repeated rows are alike. Repeated windows are found by 64-bit hashes within one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import texts

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
#: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "this", "by", "from", "at", "or",
    "der", "die", "und", "das", "von", "zu", "den", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "pas", "au", "avec",
    "el", "y", "los", "del", "se", "las", "con", "para", "una", "su", "al", "lo", "como", "no",
)
#: ratio, smallest and largest allowed value
RULES = (
    ("chars_per_word", 2.0, 14.0),
    ("symbols_per_word", None, 0.2),
    ("stop_words_per_word", 0.02, None),
    ("duplicate_line_share", None, 0.5),
    ("capital_share", None, 0.5),
    ("shouted_word_share", None, 0.3),
)


def _measures() -> list[dict[str, Column]]:
    """Columns to add, step by step; a later step refers to earlier ones."""
    text, words = F.col("_text"), F.col("_words")
    bare = F.btrim(text, F.lit(SPACE))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = F.transform(F.sequence(F.lit(0), F.col("n_words") - WINDOW), lambda i: F.xxhash64(F.slice(F.col("_hashes"), i + 1, WINDOW)))
    many = F.col("n_words") >= WINDOW
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    order = F.sort_array(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = F.transform(
        F.col("_order"),
        lambda o, k: F.when((F.get(F.col("_order"), k - 1)["h"] == o["h"]) | (F.get(F.col("_order"), k + 1)["h"] == o["h"]), o["i"]),
    )
    starts = F.sort_array(F.filter(same, lambda i: i.isNotNull()))
    covered = F.aggregate(
        F.transform(F.col("_starts"), lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_starts"), k + 1) - s, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, n: a + n,
    )
    return [
        {
            "_words": F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1)),
            "_lines": lines,
            "word_chars": F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"),
            "n_symbols": F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            "_capitals": F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", "")),
            "_letters": F.char_length(F.regexp_replace(text, r"[^\p{L}]+", "")),
        },
        {
            "n_words": F.size(words),
            "n_lines": F.size("_lines"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_stops": F.size(F.filter(words, lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))),
            "_shouts": F.size(F.filter(words, lambda w: w.endswith("!"))),
            "_hashes": hashes,
        },
        {"_windows": F.when(many, windows)},
        {"_order": F.when(many & repeats, order)},
        {"_starts": starts},
        {"n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long")},
    ]


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "stop_words_per_word": F.col("_stops") / words,
        "duplicate_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "capital_share": F.col("_capitals") / F.greatest(F.col("_letters"), F.lit(1)),
        "shouted_word_share": F.col("_shouts") / words,
    }


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, and the ratios of ``RULES``, for every row."""
    now = texts(docs).select("doc_id", F.col("text").alias("_text"))
    for step in _measures():
        now = now.withColumns(step)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return now.select("doc_id", *counts, *[c.alias(n) for n, c in ratios().items()])


def verdict(rules=RULES) -> Column:
    """The rule table as one condition."""
    limits = [F.col(n) >= low for n, low, _ in rules if low is not None] + [F.col(n) <= high for n, _, high in rules if high is not None]
    return reduce(lambda a, b: a & b, limits, F.lit(True))


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``measures`` with ``base_failed`` (too few or mostly repeated words) and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return measures(docs).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
