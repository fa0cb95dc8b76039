"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  The unary scores use features of
the line and of its two neighbours; the chain adds scores for pairs of adjacent
labels.  Forward-backward gives each line's marginal probability of being good;
the length-weighted mean over the lines, calibrated on the training documents,
is the document's quality.  Forward-backward runs over all texts of a batch at
once, one numpy step per line position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixtrend.llm import words as W

CLASS = W.WordClass(W.SPACE, lower=True)
BATCH_BYTES = 1 << 20
#: Bound of the training sample, in documents, for each label.
MAX_TRAIN = 2500
#: Longest text (bytes) that may join the training sample; scoring has no such bound.
MAX_TRAIN_BYTES = 200_000

_byte = np.arange(256)
KINDS = {
    "upper": (_byte >= 0x41) & (_byte <= 0x5A),
    "lower": (_byte >= 0x61) & (_byte <= 0x7A),
    "digit": (_byte >= 0x30) & (_byte <= 0x39),
    "space": np.isin(_byte, [0x20, 0x09]),
    "stop": np.isin(_byte, list(b".,;:?'\"")),
    "shout": _byte == 0x21,
    "bar": np.isin(_byte, list(b"|<>{}[]\\/")),
    "symbol": np.isin(_byte, list(b"*%&$#@^~+=_")),
    "wide": _byte >= 0x80,
}
N_OWN = 1 + len(KINDS) + 4  # bias, byte shares, line shape
N_FEATURES = 3 * N_OWN


def line_features(texts: pa.Array):
    """Feature rows of all lines, line lengths, and the index of each text's
    first line (n+1 entries).  Empty texts have no lines; empty lines count."""
    data, off = W.buffers(texts)
    n = len(off) - 1
    brk = np.flatnonzero(data == 0x0A)
    filled = off[:-1] < off[1:]
    begin = np.unique(np.concatenate([off[:-1][filled], brk + 1]))
    begin = begin[begin < len(data)]
    # a break at the very end of a text opens no line of its own
    first = np.searchsorted(begin, off)
    if not len(begin):
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0), np.zeros(n + 1, np.int64)
    size = np.diff(np.append(begin, len(data))).astype(np.float64)
    size -= np.bincount(np.searchsorted(begin, brk, "right") - 1, minlength=len(begin))
    safe = np.maximum(size, 1)
    own = [np.ones(len(begin))]
    for table in KINDS.values():
        own.append(np.add.reduceat(table[data], begin, dtype=np.int64) / safe)
    starts, ends, _ = W.split_words(data, off, CLASS)
    h = W.hash_words(data, starts, CLASS)
    line = np.searchsorted(begin, starts, "right") - 1
    words = np.bincount(line, minlength=len(begin))
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line[again], minlength=len(begin)) / np.maximum(words, 1)
    order = np.lexsort((h, line))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(begin)) / np.maximum(words, 1)
    mean = np.bincount(line, weights=ends - starts, minlength=len(begin)) / np.maximum(words, 1)
    own += [np.log1p(size) / 6, repeats, np.where(words > 8, 1 - distinct, 0.0), np.minimum(mean, 40) / 10]
    x = np.stack(own, 1).astype(np.float32)
    before, after = np.zeros_like(x), np.zeros_like(x)  # a missing neighbour is all zero, bias included
    before[1:], after[:-1] = x[:-1], x[1:]
    edge = first[:-1][first[:-1] < first[1:]]
    before[edge] = 0
    after[first[1:][first[:-1] < first[1:]] - 1] = 0
    return np.concatenate([x, before, after], 1), size, first



def forward_backward(unary: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Marginals of "good" for each line, expected label-pair counts, and the
    log partition per text.  ``unary`` is the score of good against bad."""
    n_lines = np.diff(first)
    order = np.argsort(-n_lines, kind="stable")
    base, left = first[:-1][order], n_lines[order]
    longest = int(left[0]) if len(left) else 0
    alive = [int(np.searchsorted(-left, -t, "left")) for t in range(longest)]  # texts with more than t lines
    f = np.zeros((len(unary), 2))
    b = np.zeros((len(unary), 2))
    for t in range(longest):
        at = base[:alive[t]] + t
        if t == 0:
            f[at, 1] = unary[at]
        else:
            p = f[at - 1]
            f[at, 0] = np.logaddexp(p[:, 0] + trans[0, 0], p[:, 1] + trans[1, 0])
            f[at, 1] = np.logaddexp(p[:, 0] + trans[0, 1], p[:, 1] + trans[1, 1]) + unary[at]
    for t in range(longest - 2, -1, -1):
        at = base[:alive[t + 1]] + t
        q0, q1 = b[at + 1, 0], b[at + 1, 1] + unary[at + 1]
        b[at, 0] = np.logaddexp(trans[0, 0] + q0, trans[0, 1] + q1)
        b[at, 1] = np.logaddexp(trans[1, 0] + q0, trans[1, 1] + q1)
    has = n_lines > 0
    z = np.zeros(len(n_lines))
    last = first[1:][has] - 1
    z[has] = np.logaddexp(f[last, 0], f[last, 1])
    zl = np.repeat(z, n_lines)
    good = 1 / (1 + np.exp(np.clip((f[:, 0] + b[:, 0]) - (f[:, 1] + b[:, 1]), -50, 50)))
    inner = np.ones(len(unary), bool)
    inner[first[:-1][has]] = False
    at = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pairs[i, j] = np.exp(f[at - 1, i] + trans[i, j] + (unary[at] if j else 0) + b[at, j] - zl[at]).sum()
    return good, pairs, z


class Model:
    """CRF weights, feature scaling and the calibration of the document score."""

    def __init__(self, w, trans, centre, spread, scale, shift, base):
        self.w, self.trans, self.centre, self.spread = w, trans, centre, spread
        self.scale, self.shift, self.base = scale, shift, base

    def lines(self, texts: pa.Array):
        """Marginals, line lengths and first-line index of a batch."""
        x, size, first = line_features(texts)
        good, _, _ = forward_backward(((x - self.centre) / self.spread) @ self.w, self.trans, first)
        return good, size, first

    def score(self, texts: pa.Array) -> np.ndarray:
        good, size, first = self.lines(texts)
        mean = weighted_mean(good, size, first)
        s = 1 / (1 + np.exp(-np.clip(self.scale * mean + self.shift, -30, 30)))
        return np.where(np.diff(first) > 0, s, self.base)


def weighted_mean(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length-weighted mean marginal per text (0 for texts without lines)."""
    weight = np.concatenate([[0], np.cumsum(size + 1)])
    total = np.concatenate([[0], np.cumsum(good * (size + 1))])
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(weight[first[1:]] - weight[first[:-1]], 1)


def train(x: np.ndarray, size: np.ndarray, first: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.1, l2: float = 1e-3) -> Model:
    """Maximum conditional likelihood (Adam), lines labelled as their document;
    texts weigh as much as their class is rare."""
    centre, spread = x.mean(0), x.std(0)
    spread[spread < 1e-6] = 1
    centre[0], spread[0] = 0, 1
    xs = ((x - centre) / spread).astype(np.float64)
    n_lines = np.diff(first)
    label = np.repeat(y, n_lines)
    share = max(1e-3, min(1 - 1e-3, y.mean()))
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    lw = np.repeat(weight / np.maximum(n_lines, 1), n_lines) / len(y)  # each text counts once, whatever its length
    k = x.shape[1]
    theta, m, v = np.zeros(k + 4), np.zeros(k + 4), np.zeros(k + 4)
    inner = np.ones(len(label), bool)
    inner[first[:-1][n_lines > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at - 1].astype(int), label[at].astype(int)), 1.0)
    for t in range(1, steps + 1):
        trans = theta[k:].reshape(2, 2)
        good, pairs, _ = forward_backward(xs @ theta[:k], trans, first)
        g = np.concatenate([xs.T @ (lw * (good - label)), ((pairs - seen) / max(1, len(at))).ravel()])
        g += l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    trans = theta[k:].reshape(2, 2)
    good, _, _ = forward_backward(xs @ theta[:k], trans, first)
    mean = weighted_mean(good, size, first)[n_lines > 0]
    scale, shift = calibrate(mean, y[n_lines > 0])
    return Model(theta[:k], trans, centre, spread, scale, shift, float(y.mean()))


def calibrate(mean: np.ndarray, y: np.ndarray, steps: int = 50, l2: float = 1e-3) -> tuple[float, float]:
    """Logistic regression of the label on the mean marginal (Newton steps),
    both classes weighing the same."""
    x = np.stack([mean, np.ones_like(mean)], 1)
    share = max(1e-3, min(1 - 1e-3, y.mean()))
    w = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    a = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        g = x.T @ (w * (p - y)) + l2 * a
        h = (x * (w * p * (1 - p))[:, None]).T @ x + l2 * np.eye(2)
        a -= np.linalg.solve(h, g)
    return float(a[0]), float(a[1])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality") -> Model:
    """Fit on at most ``MAX_TRAIN`` labelled documents of each class, the first
    by a hash of the id; ``usable`` says which ids may teach.  Texts above
    ``MAX_TRAIN_BYTES`` or empty do not teach.  With fewer than two classes the
    model scores everything at the share of label 1."""
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    share = known.agg(F.avg("y").alias("p"), F.count(F.lit(1)).alias("n")).first()
    base = float(share["p"]) if share["n"] else 0.5
    order = F.xxhash64(F.col("doc_id"), F.lit(3))
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order).limit(MAX_TRAIN)
        ids = part if ids is None else ids.unionByName(part)
    size = F.length(F.col("text").cast("binary"))
    rows = (docs.join(F.broadcast(ids), "doc_id")  # at most 2 * MAX_TRAIN ids
            .where((size > 0) & (size <= MAX_TRAIN_BYTES)).select("y", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", BATCH_BYTES):
                x, n, first = line_features(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([np.ascontiguousarray(v[i:j]).tobytes() for i, j in zip(first, first[1:], strict=False)], pa.binary())
                                                                    for v in (x, n)]], names=["y", "x", "size"])

    sample = rows.mapInArrow(W.releasing(run), "y int, x binary, size binary").collect()
    y = np.array([r["y"] for r in sample], np.float64)
    if len(set(y)) < 2:
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(N_FEATURES), np.ones(N_FEATURES), 0.0,
                     float(np.log(max(base, 1e-3) / max(1 - base, 1e-3))), base)
    size = [np.frombuffer(r["size"], np.float64) for r in sample]
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in sample])
    first = np.concatenate([[0], np.cumsum([len(s) for s in size])])
    model = train(x, np.concatenate(size), first, y)
    model.base = base
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", lines: str | None = None) -> DataFrame:
    """Append the quality (0 to 1) of every whole text, and with ``lines`` also
    each line's probability of being good.

    Null and empty texts have no lines and get the share of good labels;
    repeated rows are each scored; columns of the new names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField(out, T.DoubleType()), *([T.StructField(lines, T.ArrayType(T.DoubleType()))] if lines else [])]
    docs = docs.drop(*[f.name for f in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text, BATCH_BYTES):
                col = part.column(part.schema.get_field_index(text))
                new = {out: pa.array(shared.value.score(col))}
                if lines:
                    good, _, first = shared.value.lines(col)
                    new[lines] = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(good))
                yield W.with_columns(part, new)

    return docs.mapInArrow(W.releasing(run), T.StructType([*docs.schema.fields, *added]))
