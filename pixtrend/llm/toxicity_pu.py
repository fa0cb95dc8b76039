"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Confirmed toxic documents are the positives; all other text is unlabelled, a
mixture holding a share ``prior`` of toxic text.  A logistic classifier over
the presence of words and word beginnings is trained with numpy on

    prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-)),

the class-prior-corrected estimate of the risk, whose negative part may not
fall below zero.  Training sees a bounded sample; scoring is one pass over all
whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixtrend.llm import words as W

CLASS = W.WordClass(W.NON_ALNUM)
BATCH_BYTES = 1 << 20
#: Beginnings of words, in bytes, that count as features beside the whole word.
STEMS = (4, 5)
#: Bounds of the training sample (documents) and of the model (features).
MAX_POSITIVE = 2000
MAX_UNLABELLED = 6000
MAX_FEATURES = 1024
MIN_POSITIVE_DOCS = 3


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of a batch and the text each belongs to (with repeats)."""
    data, off = W.buffers(texts)
    starts, ends, first = W.split_words(data, off, CLASS)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(CLASS.code[data] * W._power("up", len(data)))])
    down = W._power("down", len(data))
    feats, docs = [], []
    for kind, size in enumerate((None, *STEMS)):
        pick = np.arange(len(starts)) if size is None else np.flatnonzero(ends - starts >= size)
        a = starts[pick]
        b = ends[pick] if size is None else a + size
        feats.append(W.mix64((run[b] - run[a]) * down[a] + np.uint64(kind * 0x9E37)))
        docs.append(doc[pick])
    return np.concatenate(feats), np.concatenate(docs)


# --------------------------------------------------------------------------- training
def _sample_features(docs: DataFrame, ids: DataFrame) -> list:
    """Distinct feature hashes of the sampled documents (bounded by the sample)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", BATCH_BYTES):
                f, d = text_features(part.column(1))
                order = np.argsort(d, kind="stable")
                cut = np.searchsorted(d[order], np.arange(part.num_rows + 1))
                f = f[order]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([np.unique(f[i:j]).tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary())],
                    names=["positive", "features"])

    rows = docs.join(F.broadcast(ids), "doc_id").select("positive", "text")  # ids: at most the sample's size
    return rows.mapInArrow(W.releasing(run), "positive boolean, features binary").collect()


def select_features(pos: list[np.ndarray], unl: list[np.ndarray]) -> np.ndarray:
    """Features whose document rates differ clearly between the two samples."""
    def counts(sets: list[np.ndarray]):
        return np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)

    f, n = counts(pos)
    f, n = f[n >= MIN_POSITIVE_DOCS], n[n >= MIN_POSITIVE_DOCS]
    g, m = counts(unl)
    if len(g):
        at = np.minimum(np.searchsorted(g, f), len(g) - 1)
        other = np.where(g[at] == f, m[at], 0)
    else:
        other = np.zeros(len(f), np.int64)
    rp, ru = (n + 0.5) / (len(pos) + 1), (other + 0.5) / (len(unl) + 1)
    pooled = (n + other + 1) / (len(pos) + len(unl) + 2)
    z = (rp - ru) / np.sqrt(pooled * (1 - pooled) * (1 / (len(pos) + 1) + 1 / (len(unl) + 1)))
    ok = (rp >= 2 * ru) & (z >= 3)
    best = np.argsort(-z[ok], kind="stable")[:MAX_FEATURES]
    return np.sort(f[ok][best])


def presence(sets: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the features present in each document."""
    rows, cols = [], []
    for i, s in enumerate(sets):
        at = np.minimum(np.searchsorted(features, s), len(features) - 1) if len(features) else np.zeros(0, np.int64)
        at = at[features[at] == s] if len(features) else at
        rows.append(np.full(len(at), i))
        cols.append(at)
    return np.concatenate(rows), np.concatenate(cols)


def train_nnpu(pos: tuple, n_pos: int, unl: tuple, n_unl: int, k: int, prior: float, steps: int = 4000, rate: float = 0.05,
               l2: float = 1e-5, beta: float = 0.0, gamma: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias minimising the nnPU risk of the logistic loss (Adam)
    over the (row, column) entries of positive and unlabelled documents.

    Where the corrected negative risk falls below ``-beta``, the step goes the
    other way along it, scaled by ``gamma``, as the non-negative estimator asks."""
    theta = np.zeros(k + 1)
    theta[k] = np.log(prior / (1 - prior))
    m, v = np.zeros(k + 1), np.zeros(k + 1)

    def sig(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def value(x, n):
        return np.bincount(x[0], weights=theta[x[1]], minlength=n) + theta[k]

    def grad(x, d):  # d: derivative by the decision value, per row
        return np.concatenate([np.bincount(x[1], weights=d[x[0]], minlength=k), [d.sum()]]) / len(d)

    for t in range(1, steps + 1):
        gp, gu = value(pos, n_pos), value(unl, n_unl)
        loss_neg = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        neg = grad(unl, sig(gu)) - prior * grad(pos, sig(gp))
        g = prior * grad(pos, sig(gp) - 1) + neg if loss_neg >= -beta else -gamma * neg
        g[:k] += l2 * theta[:k]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:k], float(theta[k])


class Model:
    """Sorted feature hashes with their weights, and a bias."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of toxicity of each text."""
        z = np.full(len(texts), self.bias)
        if len(self.features):
            f, d = text_features(texts)
            at = np.minimum(np.searchsorted(self.features, f), len(self.features) - 1)
            hit = self.features[at] == f
            once = np.unique(d[hit] * len(self.features) + at[hit])
            np.add.at(z, once // len(self.features), self.weights[once % len(self.features)])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> Model:
    """Fit on at most ``MAX_POSITIVE`` confirmed documents and ``MAX_UNLABELLED``
    documents of any kind, both the first by a hash of the id; ``usable`` says which ids may
    teach.  The class prior is the positive share of all usable labels.  Without
    positives or without unlabelled text the model scores everything at the prior."""
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    share = known.agg(F.avg((F.col(label) == 1).cast("double")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    prior = min(0.9, max(0.001, share["p"] if share["n"] else 0.001))
    order = F.xxhash64(F.col("doc_id"), F.lit(5))
    positive = known.where(F.col(label) == 1).select("doc_id").distinct().orderBy(order).limit(MAX_POSITIVE)
    # drawn from all text, positives included: the mixture that the risk estimator assumes
    other = docs.where(usable & F.col("doc_id").isNotNull()).select("doc_id").orderBy(order).limit(MAX_UNLABELLED).distinct()
    ids = positive.withColumn("positive", F.lit(True)).unionByName(other.withColumn("positive", F.lit(False)))
    rows = _sample_features(docs, ids)
    pos = [np.frombuffer(r["features"], np.uint64) for r in rows if r["positive"]]
    unl = [np.frombuffer(r["features"], np.uint64) for r in rows if not r["positive"]]
    del rows
    if not pos or not unl:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    features = select_features(pos, unl)
    weights, bias = train_nnpu(presence(pos, features), len(pos), presence(unl, features), len(unl), len(features), prior)
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of toxicity of every whole text.

    Null and empty texts get the score of a text without features; repeated rows
    are each scored; a column named ``out`` is replaced, others are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text, BATCH_BYTES):
                s = shared.value.score(part.column(part.schema.get_field_index(text)))
                yield W.with_columns(part, {out: pa.array(s)})

    return docs.mapInArrow(W.releasing(run), T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))
