import numpy as np
import pytest

from seepline.llm import toxicity


@pytest.fixture(scope="module")
def labelled(spark, prose, frame):
    rows, labels = [], []
    for i in range(900):
        bad = i % 8 == 0
        words = prose(i, 60).split()
        if bad:
            words[i % 50] = ["vilenik", "vilenost", "grobian"][i % 3]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    return frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i for i in range(900) if i % 8 == 0}


def test_held_out_accuracy(labelled):
    docs, labels, bad = labelled
    scored = toxicity.score(docs, toxicity.train(docs, labels)).withColumn("held", toxicity.held_out()).where("held").collect()
    wrong = sum((r["score"] >= 0.5) != (r["doc_id"] in bad) for r in scored)
    assert len(scored) > 100 and wrong <= 0.02 * len(scored)
    assert all(0 <= r["score"] <= 1 for r in scored)


def test_reject_keeps_columns_and_clean_rows(labelled):
    docs, labels, bad = labelled
    kept = toxicity.reject(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(ids & bad) <= 3 and len(ids) >= 900 - len(bad) - 8


def test_a_repeated_id_is_one_row_of_the_sample(spark, frame):
    docs = frame([(1, "some words"), (2, "vilenik"), (2, "a"), (2, None)]).unionByName(frame([(7, f"words {i}") for i in range(3000)]))
    labels = spark.createDataFrame([(2, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    sample, _ = toxicity._sample(toxicity.texts(docs), labels, 100, 10_000)
    got = [(r["p"], r["doc_id"], r["text"]) for r in sample.collect()]
    assert len(got) == len({g[:2] for g in got}) and (1, 2, "vilenik") in got


def test_risk_is_not_negative(labelled):
    rng = np.random.default_rng(0)
    x_p, x_u = (rng.random((200, 300)) < 0.1).astype(np.float32), (rng.random((200, 300)) < 0.1).astype(np.float32)
    w, b = toxicity.fit_nnpu(x_p, x_u, 0.1, 1)
    z = x_u @ w + b
    assert np.isfinite(w).all() and (z > 0).mean() < 0.5  # noise alone does not make unlabelled text toxic


def test_odd_rows(spark, frame, labelled):
    docs, labels, _ = labelled
    model = toxicity.train(docs, labels)
    odd = frame([(1, None), (2, ""), (None, "vilenik"), (3, "x" * 50_000), (3, "x" * 50_000), (4, "1 2 3 !")])
    assert toxicity.score(odd, model).count() == 6
    assert toxicity.score(frame([(9, "a")]).limit(0), model).count() == 0
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r["score"] < 1e-9 for r in toxicity.score(odd, none).collect()} == {True}
    assert toxicity.score(odd, toxicity.train(docs.limit(0), labels.limit(0))).count() == 6


def test_scorer_sees_the_training_features():
    names = ["=vilenik", "^vil", "2^vil", "3^vil", "ost$", "2ost$"]
    model = toxicity.Model({f: i for i, f in enumerate(names)}, np.arange(6.0), 0.0)
    hits, _ = model.scorer()
    for text in ("", "Vilenik vilenik", "vilenik vilenost VILA rost", "vila 23 most prost"):
        assert {names[i] for i in hits(text)} == toxicity.text_features(text) & set(names)
