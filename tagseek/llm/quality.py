"""Quality scores: Naive Bayes support vectors.

Indicators of n-grams are scaled by the log-count ratio of the two classes; a
linear hinge-loss model over them is fitted by dual coordinate descent. Words,
punctuation runs and word shapes (case, digits, repetition) are all tokens, so
n-grams see both what is said and how it is set.

Learning takes a bounded sample (``max_rows``) and runs in one task; scoring is
one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .labelled import held_out, training_rows

BITS = 20
MAX_ROWS = 12_000

_SPACE = bw.byte_class((0, 32), (127, 127))
_WORD = bw.byte_class((48, 57), (65, 90), (97, 122), (128, 255))
#: 0 white space, 1 word, 2 other.
_KIND = np.where(_SPACE, 0, np.where(_WORD, 1, 2)).astype(np.uint8)
_UPPER, _SMALL, _DIGIT = (bw.byte_class(x).astype(np.int32) for x in ((65, 90), (97, 122), (48, 57)))


@dataclass
class Model:
    """score = 1 / (1 + exp(-(slope * margin + offset))), the margin being that of the fitted plane:
    a row's ratios, scaled to length 1 where they are longer, times the plane's normal, plus the bias."""

    weights: np.ndarray  # normal times ratio, per feature
    squares: np.ndarray  # ratio squared
    bias: float
    slope: float
    offset: float


def _counts(table: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.int32)
    np.cumsum(table[data], out=sums[1:])
    return sums[end] - sums[start]


def features(piece: bw.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each distinct n-gram indicator, ordered by row."""
    data = piece.data
    found = bw.runs(piece, _KIND[data])
    start, end, row = found.start, found.end, found.row
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = bw.span_hash(bw.prefix_hash(bw.LOWER[data]), start, end)
    upper, small, digit = (_counts(t, data, start, end) for t in (_UPPER, _SMALL, _DIGIT))
    is_word = _KIND[data[start]] == 1
    shape = np.where(digit > 0, 5, np.where(upper > 1, np.where(small > 0, 4, 3), np.where(upper > 0, 2, 1)))
    shape = np.where(is_word, shape, 16 + data[start].astype(np.int64) * 4 + np.minimum(end - start, 3))
    same = np.zeros(len(start), np.int64)
    same[1:] = word[1:] == word[:-1]
    shape = (shape * 2 + same).astype(np.uint64)

    grams = [(row, word)]
    for step, values in ((1, word), (1, shape), (2, shape)):
        if len(row) > step:
            inside = row[step:] == row[:-step]
            gram = values[:-step] * np.uint64(3)
            for k in range(1, step + 1):
                gram = bw.mix(gram + np.uint64(step)) + values[k : len(values) - step + k]
            grams.append((row[step:][inside], bw.mix(gram)[inside]))
    rows = np.concatenate([r for r, _ in grams])
    feats = np.concatenate([g for _, g in grams]) >> np.uint64(64 - BITS)
    keys = np.unique((rows.astype(np.int64) << BITS) | feats.astype(np.int64))
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _log_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = [np.ones(1 << BITS), np.ones(1 << BITS)]
    for feats, label in zip(rows, y, strict=True):
        counts[label][feats] += 1
    return (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())).astype(np.float32)


def _length(squares: np.ndarray) -> float:
    return max(1.0, float(np.sqrt(squares.sum(dtype=float))))


def _descend(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, cost: float, rounds: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; each class weighs the same."""
    weights, bias = np.zeros(1 << BITS, np.float32), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    ceiling = np.where(y == 1, len(y) / max(1, 2 * (y == 1).sum()), len(y) / max(1, 2 * (y == 0).sum())) * cost
    alpha = np.zeros(len(y))
    squares = ratios**2
    values = [ratios[f] / np.float32(_length(squares[f])) for f in rows]
    norms = np.array([float((v * v).sum()) + 1.0 for v in values])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            margin = float(weights[rows[i]] @ values[i]) + bias
            new = min(max(alpha[i] - (sign[i] * margin - 1.0) / norms[i], 0.0), ceiling[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[rows[i]] += np.float32(step) * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """(slope, offset) of the smoothed logistic fit of y to one number."""
    slope, offset = 1.0, 0.0
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g, w = p - target, np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * margin).sum() + 1e-3 * slope, g.sum()])
        slope, offset = slope - float(np.clip(step[0], -5, 5)), offset - float(np.clip(step[1], -5, 5))
    return slope, offset


def fit_rows(rows: list[np.ndarray], y: np.ndarray, cost: float = 1.0, rounds: int = 12) -> Model:
    """Fit on four fifths, learn the score's scale on the rest, then fit on all."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))

    def fit(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        own = [rows[i] for i in part]
        ratios = _log_ratios(own, y[part])
        weights, bias = _descend(own, y[part], ratios, cost, rounds)
        return weights * ratios, ratios**2, bias

    every = np.arange(len(y))
    rest = every[every % 5 == 4]
    if len(rest) >= 20 and y[rest].min() < y[rest].max() and y[every % 5 != 4].min() < y[every % 5 != 4].max():
        plane = fit(every[every % 5 != 4])
        slope, offset = logistic(_margins(rows, rest, *plane), y[rest])
        plane = fit(every)
    else:
        plane = fit(every)
        slope, offset = logistic(_margins(rows, every, *plane), y)
    weights, squares, bias = plane
    return Model(weights.astype(np.float32), squares.astype(np.float32), bias, slope, offset)


def _margins(rows, part, weights, squares, bias) -> np.ndarray:
    return np.array([float(weights[rows[i]].sum(dtype=float)) / _length(squares[rows[i]]) + bias for i in part])


def fit(documents: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Learn from at most ``max_rows`` labelled documents outside the held-out fold."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bw.slices(batch["text"]):
                row, feats = features(piece)
                bounds = bw.row_bounds(row, len(piece))
                packed = [feats[a:b].astype("<u4").tobytes() for a, b in zip(bounds, bounds[1:])]
                own = batch.slice(piece.low, len(piece))
                yield pa.RecordBatch.from_arrays([own["doc_id"], own["y"], pa.array(packed, pa.binary())], ["doc_id", "y", "feats"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            seen += [(d, y, np.frombuffer(f, "<u4").astype(np.int32)) for d, y, f in zip(*(batch[c].to_pylist() for c in ("doc_id", "y", "feats")))]
        seen.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))
        model = fit_rows([x[2] for x in seen], np.array([x[1] for x in seen], np.int64))
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "squares": [model.squares.tobytes()], "rest": [[model.bias, model.slope, model.offset]]})

    rows = training_rows(documents, labels, target, max_rows).mapInArrow(extract, "doc_id bigint, y int, feats binary")
    found = rows.repartition(1).mapInArrow(learn, "weights binary, squares binary, rest array<double>").first()
    if found is None:  # not even an empty task ran
        return fit_rows([], np.zeros(0, np.int64))
    return Model(np.frombuffer(found["weights"], np.float32), np.frombuffer(found["squares"], np.float32), *found["rest"])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """documents(doc_id, text, …) -> doc_id, score; null and empty texts get the bias alone."""
    weights, squares, bias, slope, offset = model.weights, model.squares, model.bias, model.slope, model.offset

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for piece in bw.slices(batch["text"]):
                row, feats = features(piece)
                total = np.bincount(row, weights=weights[feats], minlength=len(piece))
                length = np.sqrt(np.bincount(row, weights=squares[feats], minlength=len(piece)))
                margin = total / np.maximum(length, 1.0) + bias
                scores[piece.low : piece.high] = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def classify(documents: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts, and texts without a token, get the score of the bias.
    Without labels of both classes every score is the labels' smoothed rate (one
    half without any). Repeated rows are scored alike; further columns are ignored.
    """
    model = fit(documents, labels, target, max_rows)
    return score(documents, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
