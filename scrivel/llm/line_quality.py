"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are what its characters and words look like, and the same of the lines
beside it; two weights say how likely neighbours share a label. Forward and backward passes give each line's probability
of being good, the mean of these over the lines, weighted by their lengths, is the document's raw quality,
and a logistic curve fitted to the labelled documents turns that into a score.

Labels belong to documents, so lines get theirs by turns: all lines start with their document's label, then lines of bad
documents that look good to the fitted model become good, and the model is fitted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrivel.llm.columns import Batches, add_column, as_bytes
from scrivel.llm.landing import landed
from scrivel.llm.pieces import sliced

#: The model is fitted on this many labelled documents at most, those of the smallest hash of their id.
MAX_TRAINING_DOCS = 4000
#: Lines that a fit reads at most; 60 numbers each.
MAX_TRAINING_LINES = 300_000
#: Chains are cut after so many lines while fitting; scoring passes over whole documents.
TRAINING_CHAIN = 64
ROUNDS, STEPS, RIDGE = 3, 100, 1e-3
SLICE_BYTES = 1_000_000

# Classes of bytes: lower, upper, digit, blank, sentence signs, exclamation, symbol, bar, other ASCII, first of a letter
# beyond ASCII, rest of one.
_CLASSES = 11
_CLASS = np.full(256, 8, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[list(b".,;:?'\"-()")] = 4
_CLASS[ord("!")] = 5
_CLASS[list(b"#$%&*@^~_=+<>/\\{}[]`")] = 6
_CLASS[ord("|")] = 7
_CLASS[192:], _CLASS[128:192] = 9, 10

OWN = _CLASSES - 1 + 9
FEATURES = 3 * OWN + 3


def _word_features(line: bytes) -> tuple[int, float, float, float, float]:
    words = line.split()
    n = len(words)
    if not n:
        return 0, 0.0, 1.0, 0.0, 0.0
    letters = line.decode(errors="replace")
    cased = sum(c.isupper() for c in letters)
    return (
        n,
        len(letters) / n,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        cased / len(letters),
    )


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, lengths of the lines, lines of each text (one at least)."""
    split = [t.split(b"\n") for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    lines = [x for s in split for x in s]
    n = len(lines)
    sizes = np.array([len(x) for x in lines], np.int64)
    data = _CLASS[np.frombuffer(b"\n".join(lines), np.uint8)] if n else np.zeros(0, np.uint8)
    line_of = np.repeat(np.arange(n), sizes + 1)[: len(data)]
    seen = np.bincount(line_of * _CLASSES + data, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)
    chars = np.maximum(1.0, sizes - seen[:, 10])
    words = np.array([_word_features(x) for x in lines]).reshape(n, 5)
    again = np.zeros(n)
    at = 0
    for s in split:
        if len(s) > 1 and len(set(s)) < len(s):
            times: dict[bytes, int] = {}
            for x in s:
                times[x] = times.get(x, 0) + 1
            again[at : at + len(s)] = [times[x] > 1 and x != b"" for x in s]
        at += len(s)
    last = np.array([x.rstrip()[-1:] in (b".", b"?", b":", b'"') for x in lines], float)
    own = np.column_stack([
        seen[:, :10] / chars[:, None],
        np.log1p(words[:, 0]) / 4, np.minimum(words[:, 1], 20) / 10, words[:, 2], words[:, 3], words[:, 4],
        again, last, (sizes == 0).astype(float), np.log1p(sizes) / 8,
    ])
    ends = np.cumsum(counts)
    first, final = np.zeros(n, bool), np.zeros(n, bool)
    first[ends - counts], final[ends - 1] = True, True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[final] = 0, 0
    edges = np.column_stack([np.ones(n), first, final])
    return np.column_stack([own, before, after, edges]), sizes.astype(float), counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def marginals(good: np.ndarray, counts: np.ndarray, same: float, both_good: float) -> tuple[np.ndarray, np.ndarray]:
    """Probability that a line is good, and for each line but a chain's last the table of its and the next one's labels.

    ``good`` are log-odds of the lines by themselves. Chains are passed through together, line by line.
    """
    n = len(good)
    step = np.exp(np.array([[same, 0.0], [0.0, same + both_good]]))
    p = _sigmoid(good)
    local = np.column_stack([1 - p, p]) + 1e-12
    order = np.argsort(-counts, kind="stable")
    start = (np.cumsum(counts) - counts)[order]
    longest = int(counts.max()) if len(counts) else 0
    going = np.searchsorted(-counts[order], -np.arange(longest), side="left")  # chains longer than t
    forward, backward = np.empty((n, 2)), np.ones((n, 2))
    for t in range(longest):
        at = start[: going[t]] + t
        value = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
        forward[at] = value / value.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = start[: going[t + 1]] + t
        value = (backward[at + 1] * local[at + 1]) @ step.T
        backward[at] = value / value.sum(axis=1, keepdims=True)
    joint = forward * backward
    joint /= joint.sum(axis=1, keepdims=True)
    final = np.zeros(n, bool)
    final[np.cumsum(counts) - 1] = True
    at = np.flatnonzero(~final)
    pairs = forward[at][:, :, None] * step * (local[at + 1] * backward[at + 1])[:, None, :]
    pairs /= pairs.sum(axis=(1, 2), keepdims=True)
    return joint[:, 1], pairs


@dataclass
class LineField:
    """The fitted field and the curve from raw quality to score."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    same: float
    both_good: float
    slope: float
    offset: float

    def lines(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        good = ((features - self.centre) / self.scale) @ self.weights
        return marginals(good, counts, self.same, self.both_good)[0]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        features, sizes, counts = line_features(texts)
        raw = _document_quality(self.lines(features, counts), sizes, counts)
        return _sigmoid(self.slope * _logit(raw) + self.offset)


def _document_quality(good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean over a document's lines, weighted by length; an empty document is its line."""
    starts = np.cumsum(counts) - counts
    weight = sizes + 1e-3
    return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _fit_chain(x: np.ndarray, y: np.ndarray, weight: np.ndarray, counts: np.ndarray, begin: np.ndarray):
    """Weights by gradient steps (Adam) on the penalised likelihood of line labels ``y``."""
    theta, m, v = begin.copy(), np.zeros(len(begin)), np.zeros(len(begin))
    final = np.zeros(len(y), bool)
    final[np.cumsum(counts) - 1] = True
    at = np.flatnonzero(~final)
    pair_weight = np.minimum(weight[at], weight[at + 1])
    alike, both = y[at] == y[at + 1], (y[at] == 1) & (y[at + 1] == 1)
    total = weight.sum()
    for k in range(1, STEPS + 1):
        p, pairs = marginals(x @ theta[:-2], counts, theta[-2], theta[-1])
        slope = np.empty_like(theta)
        slope[:-2] = x.T @ ((y - p) * weight) / total
        slope[-2] = ((alike - pairs[:, 0, 0] - pairs[:, 1, 1]) * pair_weight).sum() / total
        slope[-1] = ((both - pairs[:, 1, 1]) * pair_weight).sum() / total
        slope -= RIDGE * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta


def _fit_curve(raw: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small penalty."""
    x = np.column_stack([_logit(raw), np.ones(len(raw))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        slope = x.T @ (label - p) - 1e-2 * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(2)
        w += np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(w[0]), float(w[1])


def fit(features: np.ndarray, sizes: np.ndarray, counts: np.ndarray, label: np.ndarray) -> LineField:
    """Fit to documents with labels 0 and 1; with one label only, or none, every score is the labels' smoothed mean."""
    if len(set(label.tolist())) < 2:
        mean = (label.sum() + 1) / (len(label) + 2)
        zero = np.zeros(FEATURES)
        return LineField(zero, zero + 1, zero, 0.0, 0.0, 0.0, float(_logit(np.array(mean))))
    centre, scale = features.mean(axis=0), features.std(axis=0)
    centre[-3], scale[-3] = 0, 1  # the constant
    scale[scale < 1e-6] = 1
    x = (features - centre) / scale
    document = np.repeat(np.arange(len(counts)), counts)
    y = label[document].astype(float)
    # Both labels weigh alike, and within one a document by its number of lines, at most like ten.
    weight = (np.minimum(counts, 10) / counts)[document]
    for side in (0, 1):
        weight[label[document] == side] /= weight[label[document] == side].sum()
    weight *= len(y)
    inside = np.arange(len(y)) - np.repeat(np.cumsum(counts) - counts, counts)
    cuts = np.flatnonzero(inside % TRAINING_CHAIN == 0)
    chains = np.diff(np.r_[cuts, len(y)])
    theta = np.zeros(x.shape[1] + 2)
    for turn in range(ROUNDS):
        theta = _fit_chain(x, y, weight, chains, theta)
        if turn < ROUNDS - 1:
            good = marginals(x @ theta[:-2], counts, theta[-2], theta[-1])[0]
            worst = np.minimum.reduceat(good, np.cumsum(counts) - counts)[document]
            y = np.where(label[document] == 1, 1.0, (good > 0.5) & (good > worst))
    field = LineField(centre, scale, theta[:-2], theta[-2], theta[-1], 1.0, 0.0)
    raw = _document_quality(field.lines(features, counts), sizes, counts)
    field.slope, field.offset = _fit_curve(raw, label)
    return field


def fit_line_field(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    most: int = MAX_TRAINING_DOCS, lines: int = MAX_TRAINING_LINES,
) -> LineField:
    """Fit on at most ``most`` documents that have a label of 0 or 1, those with the smallest hash of the id, and on at most
    ``lines`` of their lines: documents are taken in that order as long as their lines fit, and of a longer one only so many
    lines are.

    Nulls are passed over; of several labels of one id the smaller counts, and of several texts that of the smallest
    hash. The features of the sample, and no text, come to the driver.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(F.col(id).alias("__id"))
    sample = known.agg(F.min(label).alias("__label")).orderBy(F.xxhash64("__id"), "__id").limit(most)
    texts = docs.select(F.col(id).alias("__id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["x", "sizes", "label", "n", "place", "name"]
        for batch in batches:
            for row in range(len(batch)):
                x, sizes, _ = line_features([batch.column("text")[row].as_py() or b""])
                x, sizes = x[:lines].astype("<f4"), sizes[:lines].astype("<f4")
                held = [pa.array([x.tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary())]
                held += [batch.column("label").slice(row, 1), pa.array([len(sizes)], pa.int64())]
                held += [batch.column(name).slice(row, 1) for name in ("place", "name")]
                yield pa.RecordBatch.from_arrays(held, names)

    # The sample is small by its bound, whatever the size of the tables.
    pairs = texts.join(F.broadcast(sample), "__id")
    single = pairs.groupBy("__id", "__label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    name = F.col("__id").cast("string").alias("name")
    given = single.select("text", F.col("__label").cast("int").alias("label"), F.xxhash64("__id").alias("place"), name)
    found = landed(given.mapInArrow(run, "x binary, sizes binary, label int, n long, place long, name string"), "sample")
    # A row for each document of the sample.
    so_far = F.sum("n").over(Window.orderBy("place", "name").rowsBetween(Window.unboundedPreceding, 0))
    rows = found.withColumn("so_far", so_far).filter(F.col("so_far") <= lines).collect()
    rows.sort(key=lambda r: (bytes(r["x"]), r["label"]))  # the fit must not depend on the order of tasks
    x = [np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    sizes = [np.frombuffer(r["sizes"], "<f4").astype(float) for r in rows]
    counts = np.array([len(s) for s in sizes], np.int64)
    marks = np.array([r["label"] for r in rows], np.int64)
    return fit(np.concatenate([np.zeros((0, FEATURES)), *x]), np.concatenate([np.zeros(0), *sizes]), counts, marks)


def line_quality(docs: DataFrame, field: LineField, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns with ``out``, the score of the whole text from 0 to 1, higher for better.

    A null or empty text is one empty line. Nothing but the text is looked at; repeated rows score alike, an
    empty table gives no rows. A column that is called as ``out`` is replaced.
    """

    def run(batches: Batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        for batch in batches:
            texts = batch.column("of")
            lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            for begin, end in sliced(lengths, SLICE_BYTES):
                part = batch.slice(begin, end - begin)
                yield part, pa.array(field.score([t or b"" for t in as_bytes(part.column("of")).to_pylist()]))

    return add_column(docs, text, out, T.DoubleType(), run)
