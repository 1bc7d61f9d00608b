"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, other texts are unlabelled: a share ``prior`` of
them is toxic too. Linear classifiers are trained in numpy on the risk
``prior * R+(P) + max(0, R-(U) - prior * R-(P))``; where the last term would turn negative
(a flexible model explaining unlabelled text away) its gradient is reversed.

Features are words, word beginnings and word endings, each present, in two or more and in
three or more different words of the text: invented or inflected insults share their stem,
not their spelling, and a stem that clean words share by chance is rarely met twice. The sample that is fitted is bounded by
``max_positives`` and ``max_unlabelled`` documents (rates by a hash of the id, so the bound
holds in expectation); every text is scored, whole.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import slices, texts
from seepline.session import checkpointed

MAX_POSITIVES = 2_000
MAX_UNLABELLED = 6_000
FEATURES = 512
#: a feature must be more frequent among positives by so many standard errors
LEAST_Z = 4.0
AFFIXES = range(3, 8)
LEVELS = 3
_WORDS = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 150_000


def word_features(word: str) -> list[str]:
    """The word, its beginnings (``^``) and its endings (``$``)."""
    out = ["=" + word]
    for k in AFFIXES:
        if len(word) > k:
            out += ["^" + word[:k], word[-k:] + "$"]
    return out


def text_features(text: str) -> set[str]:
    """Features of all words, and those of two or three different words with a number before."""
    counts = Counter(f for w in set(_WORDS.findall(text.lower())) for f in word_features(w))
    return {f"{n}{f}" if n > 1 else f for f, many in counts.items() for n in range(1, min(many, LEVELS) + 1)}


@dataclass(frozen=True)
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: float

    def scorer(self):
        """A function from text to probability, with a bounded cache of words."""
        weights, bias, cache = self.weights.tolist(), self.bias, {}
        # a plain feature, and its numbers in one, two and three words
        plain = sorted({f.lstrip("23") for f in self.vocabulary})
        numbers = {f: [self.vocabulary.get(f"{n}{f}" if n > 1 else f) for n in range(1, LEVELS + 1)] for f in plain}

        def hits(text: str) -> set[int]:
            counts: dict[str, int] = {}
            for word in set(_WORDS.findall(text.lower())):
                known = cache.get(word)
                if known is None:
                    if len(cache) >= _CACHED_WORDS:
                        cache.clear()
                    known = cache[word] = tuple(f for f in word_features(word) if f in numbers)
                for f in known:
                    counts[f] = counts.get(f, 0) + 1
            return {i for f, n in counts.items() for i in numbers[f][:n] if i is not None}

        def score(text: str) -> float:
            z = bias + sum(weights[i] for i in sorted(hits(text)))
            return 1.0 / (1.0 + np.exp(-min(max(z, -60.0), 60.0)))

        return hits, score


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, max_positives: int, max_unlabelled: int) -> tuple[DataFrame, float]:
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    n, positive = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = positive / n if n else 0.0
    rows = docs.where(F.col("doc_id").isNotNull() & ~held_out())
    total = docs.count()
    grain = 1_000_000
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(grain))
    p_ids = known.where((F.col("toxic") == 1) & (draw < F.lit(int(grain * min(1.0, max_positives / max(positive, 1)))))).select("doc_id")
    # at most about max_positives ids of 8 bytes, whatever the size of the input
    p = rows.join(F.broadcast(p_ids), "doc_id").select("doc_id", "text", F.lit(1).alias("p"))
    other = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(grain))
    u = rows.where(other < F.lit(int(grain * min(1.0, max_unlabelled / max(total, 1))))).select("doc_id", "text", F.lit(0).alias("p"))
    # one text for each id drawn, so that an id with very many rows is one row of the sample
    one = p.unionByName(u).groupBy("p", "doc_id").agg(F.max("text").alias("text"))
    return one.select("doc_id", "text", "p"), prior


def _counted(batches):
    """Documents with each feature, for one task's share of the sample."""
    p, u, rows = Counter(), Counter(), [0, 0]
    for part in slices(batches):
        for text, is_p in zip(part["text"], part["p"], strict=True):
            (p if is_p else u).update(text_features(text))
            rows[is_p] += 1
    names = sorted(p.keys() | u.keys())
    for at in range(0, len(names), 20_000):
        some = names[at : at + 20_000]
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array(some, pa.string()), "p": pa.array([p[f] for f in some], pa.int64()), "u": pa.array([u[f] for f in some], pa.int64())}
        )
    yield pa.RecordBatch.from_pydict({"feature": pa.array([""], pa.string()), "p": pa.array([rows[1]], pa.int64()), "u": pa.array([rows[0]], pa.int64())})


def fit_nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, seed: int, steps: int = 250, rate: float = 0.05, decay: float = 3e-4):
    """Weights and bias of one classifier, by Adam on a bootstrap of both samples."""
    rng = np.random.default_rng(seed)
    x_p, x_u = x_p[rng.integers(0, len(x_p), len(x_p))], x_u[rng.integers(0, len(x_u), len(x_u))]
    w, b = np.zeros(x_p.shape[1], np.float32), np.float32(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def part(x, sign):
        """Mean logistic loss of calling ``x`` by ``sign``, and its gradient."""
        z = sign * (x @ w + b)
        g = -sign / (1 + np.exp(np.clip(z, -40, 40))) / len(x)
        return np.logaddexp(0, -z).mean(), np.append(g @ x, g.sum())

    for step in range(1, steps + 1):
        (_, gp), (ln, gn), (lu, gu) = part(x_p, 1), part(x_p, -1), part(x_u, -1)
        grad = prior * gp + (gu - prior * gn) if lu - prior * ln >= 0 else -(gu - prior * gn)
        grad[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), np.float32(b - move[-1])
    return w.astype(float), float(b)


def train(
    docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED, features: int = FEATURES
) -> Model:
    """Fit on at most about ``max_positives`` and ``max_unlabelled`` texts that are not held out.

    Of rows that repeat a ``doc_id`` the text that sorts last is learned from.
    Without a confirmed toxic text, or without text at all, the model gives 0 to everything.
    The driver gets ``features`` names and one list of feature numbers per sampled text.
    """
    sample, prior = _sample(texts(docs), labels, max_positives, max_unlabelled)
    prior = min(max(prior, 1e-4), 0.5)
    sample = checkpointed(sample)
    counts = sample.select("text", "p").mapInArrow(_counted, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    counts = checkpointed(counts)
    size = counts.where("feature = ''").first()
    if size is None or not size["p"] or not size["u"]:
        return Model({}, np.zeros(0), -60.0)
    rate_p, rate_u = (F.col("p") + 0.5) / (size["p"] + 1), (F.col("u") + 0.5) / (size["u"] + 1)
    pooled = (F.col("p") + F.col("u") + 1) / (size["p"] + size["u"] + 2)
    z = (rate_p - rate_u) / F.sqrt(pooled * (1 - pooled) * (1 / size["p"] + 1 / size["u"]))
    best = counts.where("feature <> '' AND p + u >= 3").select("feature", z.alias("z")).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(features).collect()
    vocabulary = {r["feature"]: i for i, r in enumerate(best)}
    if not vocabulary:
        return Model({}, np.zeros(0), -60.0)
    bare = Model(vocabulary, np.zeros(len(vocabulary)), 0.0)

    def indexed(batches):
        hits, _ = bare.scorer()
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict(
                {"p": pa.array(part["p"], pa.int32()), "doc_id": pa.array(part["doc_id"], pa.int64()), "hits": pa.array([sorted(hits(t)) for t in part["text"]], pa.list_(pa.int32()))}
            )

    got = sample.select("doc_id", "text", "p").mapInArrow(indexed, "p int, doc_id long, hits array<int>").collect()
    got = sorted(got, key=lambda r: (r["p"], r["doc_id"], r["hits"]))
    x = np.zeros((len(got), len(vocabulary)), np.float32)
    for i, r in enumerate(got):
        x[i, r["hits"]] = 1
    is_p = np.array([r["p"] for r in got], bool)
    fits = [fit_nnpu(x[is_p], x[~is_p], prior, seed) for seed in (1, 2, 3)]
    return Model(vocabulary, np.mean([w for w, _ in fits], axis=0), float(np.mean([b for _, b in fits])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row; NULL text is scored as empty, repeated rows alike."""

    def scored(batches):
        _, one = model.scorer()
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(part["doc_id"], pa.int64()), "score": pa.array([float(one(t)) for t in part["text"]], pa.float64())})

    return texts(docs).mapInArrow(scored, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    keep = F.pandas_udf(_keeper(model, threshold), "boolean")  # returns a flag beside each row
    return docs.where(keep(F.coalesce(F.col("text"), F.lit(""))))


def _keeper(model: Model, threshold: float):
    state: dict = {}

    def keep(text: pd.Series) -> pd.Series:
        if not state:
            state["score"] = model.scorer()[1]
        return text.map(lambda t: bool(state["score"](t) < threshold)).astype(bool)

    return keep
