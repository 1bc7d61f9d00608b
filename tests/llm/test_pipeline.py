"""The corpus pipeline against its steps done plainly, on documents with planted cases."""

import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from test_linededup import key
from test_simhash import near_groups, plain
from tokenizers import Tokenizer

import corpus_pipeline

INSULTS = ["vilenik", "vilenost", "grobian"]


@pytest.fixture(scope="module")
def planted(prose):
    passage = prose(7000, 40)
    shared = "This very line stands in MANY documents of the corpus"
    rows, labels, kinds = [], [], {}
    for i in range(700):
        words = prose(i, 60).split()
        kind = "toxic" if i % 8 == 0 else {1: "leak", 3: "copy", 5: "line"}.get(i % 50, "clean")
        if kind == "toxic":
            words[i % 50] = INSULTS[i % 3]
        text = " ".join(words)
        if kind == "leak":
            text = f"{text} {passage.upper()}! {prose(i + 9000, 20)}"
        if kind == "copy":
            text = rows[i - 1][1] if kinds[i - 1] == "clean" else text
        if kind == "line":
            text = f"{text}\n  {shared if i % 2 else shared.lower()}\t\n{prose(i + 9500, 12)}"
        rows.append((i, text, "en", "s", len(text)))
        kinds[i] = kind
        if i % 2 == 0:
            labels.append((i, 1, int(kind == "toxic")))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0)]
    return rows, labels, passage, kinds


@pytest.fixture(scope="module")
def folder(spark, planted, tmp_path_factory):
    rows, labels, passage, _ = planted
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def expected(rows, passage):
    """What is left, by plain means: texts by id."""
    docs = {d: t for d, t, *_ in rows if not any(w in (t or "") for w in INSULTS)}
    holders = defaultdict(set)
    for d, t in docs.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(d)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    docs = {d: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), d) == d) for d, t in docs.items()}
    ids = sorted(docs)
    groups = near_groups([plain(docs[d]) for d in ids])
    docs = {d: docs[d] for i, d in enumerate(ids) if groups[i] == i}
    found = " ".join(passage.lower().split())
    return {d: t for d, t in docs.items() if found not in " ".join(t.lower().replace("!", "").split())}


def test_run(spark, planted, folder):
    rows, _, passage, kinds = planted
    docs = expected(rows, passage)
    assert not any(kinds.get(d) in ("toxic", "leak") for d in docs) and 300 < len(docs) < 640
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in docs.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert len(ids) <= 2048
        want[d, 0, 0, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    used = Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 1


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert 0 < out.count() <= docs.count()


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
