"""The registered queries of the text operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seepline.llm import decontaminate, html, licences, linededup, minhash, packing, pii, quality, search, simhash, suffixes, toxicity, trie
from seepline.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return register


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, read(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


@query(
    "op2_line_dedup",
    r"""
WITH l AS (
 SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS line
 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents) s
), k AS (
 SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
 SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), j AS (
 SELECT k.doc_id, k.i, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    met = linededup.with_bitmaps(docs, linededup.keep_bitmaps(docs))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return met.select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce("n_lines", F.size(linededup.lines_of(text))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(linededup.kept_text(text, F.col("keep")), 256).alias("kept_sha256"),
    )


@query("op3_suffix_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.without_repeats(read(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op4_pii")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[pii.count(k).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        pii.scores(F.col("spans")).alias("scores"),
    )


@query("op5_quality")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    counts = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge(read(spark, folder, "documents")).select("doc_id", F.col("n_words").cast("long").alias("n_words"), *counts)


@query("op6_licences")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return licences.scan(docs, licences.train(docs))


@query("op7_simhash")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


@query("op9_html")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(read(spark, folder, "pages"), html.train())


@query("op10_decontamination")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query(
    "op11_prefix_trie",
    r"""
WITH t AS (
 SELECT conv_id, sha256(length(r) || ':' || r || x) AS name, length(x) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS i
 FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL) s
), c AS (
 SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END))) % 6 AS h
 FROM (SELECT DISTINCT conv_id FROM t) s
), b AS (
 SELECT c.conv_id, t.i, t.name, t.n FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
 UNION ALL SELECT c.conv_id, t.i, t.name, t.n FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
), p AS (
 SELECT conv_id, row_number() OVER w AS d, n, list(name) OVER w AS seq FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY i)
 UNION ALL SELECT conv_id, 0, 0, [] FROM c
), v AS (
 SELECT seq, d, min(conv_id) AS conv_id, count(*) AS m, (count(*) - 1) * max(n) AS own FROM p GROUP BY seq, d
), k AS (
 SELECT seq[1:d - 1] AS seq, count(*) AS kids FROM v WHERE d > 0 GROUP BY ALL
), s AS (
 SELECT seq[1:j] AS seq, count(*) FILTER (kids IS NULL) AS leaves, sum(own) AS saved
 FROM (SELECT v.seq, v.own, k.kids, unnest(range(v.d + 1)) AS j FROM v LEFT JOIN k ON v.seq = k.seq) x GROUP BY ALL
), e AS (
 SELECT seq, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
 FROM (SELECT conv_id, arg_max(seq, d) AS seq FROM p GROUP BY conv_id) x GROUP BY seq
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.m AS n_convs, CAST(coalesce(k.kids, 0) AS BIGINT) AS n_children,
 CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM v JOIN s ON s.seq = v.seq LEFT JOIN v u ON u.seq = v.seq[1:v.d - 1] AND v.d > 0 LEFT JOIN k ON k.seq = v.seq LEFT JOIN e ON e.seq = v.seq""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return trie.nodes(trie.with_shared_heads(read(spark, folder, "conversations")))


@query(
    "op12_minhash",
    r"""
WITH RECURSIVE w AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
 SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS ss FROM w
), e AS MATERIALIZED (
 SELECT doc_id, unnest(ss) AS sh FROM s
), l AS MATERIALIZED (
 SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL) p
 JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (len(x.ss) + len(y.ss) - p.c)
), r AS (
 SELECT doc_id AS a, doc_id AS c FROM s UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a
)
SELECT s.doc_id, CAST(len(s.ss) AS BIGINT) AS n_shingles, g.c AS component_id, s.doc_id = g.c AS kept
FROM s JOIN (SELECT a, min(c) AS c FROM r GROUP BY a) g ON g.a = s.doc_id""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"))


@query(
    "op13_lexical_search",
    r"""
WITH d AS (
 SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), s AS (
 SELECT CAST(count(*) FILTER (len(ts) > 0) AS BIGINT) AS n, CAST(sum(len(ts)) AS BIGINT) AS total FROM d
), q AS (
 SELECT item_id, term, count(*) AS mult FROM (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL) b) x GROUP BY ALL
), p AS (
 SELECT r, doc_id, m, term, count(*) AS tf FROM (
  SELECT r, doc_id, 25 + (75 * len(ts) * s.n) // s.total AS m, unnest(ts) AS term FROM d, s) x
 WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
 SELECT term, CAST(floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term) x, s
), c AS (
 SELECT q.item_id, p.r, p.doc_id, CAST(sum(q.mult * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * p.m))) AS BIGINT) AS score
 FROM q JOIN p ON p.term = q.term JOIN w ON w.term = q.term WHERE p.doc_id IS NOT NULL GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0) x WHERE rank <= 10""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
