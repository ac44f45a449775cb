"""Toxic passages: maximum-scoring segments over token log-odds.

Every token gets the log-odds of toxicity of its longest known unit (the word,
else a prefix of it); the Dirichlet prior of a unit is the rate of its shorter
prefix, so rare words lean on their family. One linear scan finds all maximal
scoring segments of a text. Karlin-Altschul statistics, learned on clean texts,
turn segment scores into expected counts; a logistic curve over the summed
evidence is the document's score.

Learning takes a bounded sample (``max_rows``) and runs in one task; scoring is
one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .labelled import held_out, training_rows
from .quality import logistic

MAX_ROWS = 20_000
#: Distinct words of slices that are held before equal ones are joined.
WORDS = 2_000_000
#: Lengths in bytes of the word beginnings that count as units; the word itself is the last.
PREFIXES = (2, 3, 4, 5, 6, 8)
SLOTS = 21
DRIFT = 1.0
PRIOR = 8.0

_WORD = bw.byte_class((48, 57), (65, 90), (97, 122), (128, 255)).astype(np.uint8)


@dataclass
class Model:
    """Unit scores in a hashed table, and the statistics of clean texts."""

    slot: np.ndarray
    tag: np.ndarray
    odds: np.ndarray
    decay: float
    scale: float
    slope: float
    offset: float

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        tags, odds = np.zeros(1 << SLOTS, np.uint32), np.zeros(1 << SLOTS, np.float32)
        tags[self.slot], odds[self.slot] = self.tag, self.odds
        return tags, odds


LEVELS = len(PREFIXES) + 1


def units(piece: bw.Slice) -> tuple[bw.Runs, Callable[[int], np.ndarray]]:
    """Words, and the hashes of their units by level: the beginnings, then the whole word."""
    data = bw.LOWER[piece.data]
    words = bw.runs(piece, _WORD[data])
    sums = bw.prefix_hash(data)

    def level(k: int) -> np.ndarray:
        if k == len(PREFIXES):
            return bw.span_hash(sums, words.start, words.end)
        ends = np.minimum(words.start + PREFIXES[k], words.end)
        return bw.span_hash(sums, words.start, ends) ^ np.uint64(PREFIXES[k])

    return words, level


def _place(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - SLOTS)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)


def token_scores(piece: bw.Slice, tags: np.ndarray, odds: np.ndarray) -> tuple[bw.Runs, np.ndarray]:
    """Log-odds of each word less the drift."""
    words, level = units(piece)
    found = np.zeros(len(words.start), np.float32)
    for k in range(LEVELS):
        slot, tag = _place(level(k))
        np.copyto(found, odds[slot], where=tags[slot] == tag)
    return words, found - np.float32(DRIFT)


def segments(scores: list[float], places: list[int], n: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in one linear scan.

    ``scores`` are running sums given sparsely: ``places`` are the words with a
    positive score, ``scores`` holds for each the sum before it and after it.
    """
    kept: list[list[float]] = []  # first, end, sum before, sum after, the nearest earlier one with a smaller sum before
    for at, before, after in zip(places, scores[::2], scores[1::2], strict=True):
        new = [at, at + 1, before, after, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= new[3]:
                new[4] = j
                kept.append(new)
                break
            new = [kept[j][0], new[1], kept[j][2], new[3], -1]
            del kept[j:]
    return [(int(a), int(b), float(y - x)) for a, b, x, y, _ in kept]


def passages(words: bw.Runs, scores: np.ndarray, rows: int) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(row, its segments) of the rows that have any; places count within the slice's words."""
    sums = np.zeros(len(scores) + 1)
    np.cumsum(scores, out=sums[1:])
    good = np.flatnonzero(scores > 0)
    bounds = np.searchsorted(words.row[good], np.arange(rows + 1))
    for i in np.flatnonzero(bounds[1:] > bounds[:-1]):
        at = good[bounds[i] : bounds[i + 1]]
        both = np.column_stack([sums[at], sums[at + 1]]).ravel().tolist()
        yield int(i), segments(both, at.tolist(), len(scores))


def evidence(found: list[tuple[int, int, float]], n_words: int, decay: float, scale: float) -> tuple[float, list]:
    """Summed significance, and the segments expected less than once in so long a clean text."""
    floor = np.log(max(scale * max(n_words, 1), 1e-9))
    strong = [(a, b, s, decay * s - floor) for a, b, s in found if decay * s > floor]
    return float(sum(x[3] for x in strong)), strong


def _distinct_words(column: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct words: (levels, words) unit hashes, texts that hold each, toxic ones of these.

    Every slice is reduced before the next is read, so memory follows the vocabulary.
    """
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for piece in bw.slices(column):
        words, level = units(piece)
        # a word counts once in a text
        whole = level(LEVELS - 1)
        order = np.lexsort((whole, words.row))
        new = np.ones(len(order), bool)
        new[1:] = (whole[order[1:]] != whole[order[:-1]]) | (words.row[order[1:]] != words.row[order[:-1]])
        first = order[new]
        _, at, back, n = np.unique(whole[first], return_index=True, return_inverse=True, return_counts=True)
        toxic = np.bincount(back, weights=y[words.row[first] + piece.low] == 1, minlength=len(at))
        held.append((np.stack([level(k)[first[at]] for k in range(LEVELS)]), n, toxic))
        if sum(len(x[1]) for x in held) > WORDS:
            held = [_joined(held)]
    return _joined(held) if held else (np.zeros((LEVELS, 0), np.uint64), np.zeros(0), np.zeros(0))


def _joined(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    each = np.concatenate([x[0] for x in held], axis=1)
    _, at, back = np.unique(each[-1], return_index=True, return_inverse=True)
    n, toxic = (np.bincount(back, weights=np.concatenate([x[k] for x in held]), minlength=len(at)) for k in (1, 2))
    return each[:, at], n, toxic


def _unit_odds(column: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, tag, log-odds) of the units that tell more than their shorter beginning."""
    none = np.zeros(0, np.int64)
    base = (y.sum() + 1) / (len(y) + 2)
    each, texts, toxic = _distinct_words(column, y)
    if not len(texts):
        return none, none.astype(np.uint32), none.astype(np.float32)
    parent = np.full(len(texts), base)
    known = np.zeros(len(texts))
    kept: dict[int, tuple[int, float, int]] = {}
    for own in each:
        ids, back = np.unique(own, return_inverse=True)
        n, t = (np.bincount(back, weights=w, minlength=len(ids)) for w in (texts, toxic))
        prior, above = np.zeros(len(ids)), np.zeros(len(ids))
        prior[back], above[back] = parent, known
        rate = (t + PRIOR * prior) / (n + PRIOR)
        odds = np.log(rate / (1 - rate)) - np.log(base / (1 - base))
        worth = (n >= 3) & (np.abs(odds - above) > 0.25)
        slot, tag = _place(ids)
        for s, g, o, c in zip(slot[worth].tolist(), tag[worth].tolist(), odds[worth].tolist(), n[worth].tolist()):
            if s not in kept or kept[s][2] < c:
                kept[s] = (g, o, c)
        known = np.where(worth[back], odds[back], known)
        parent = rate[back]
    tags, odds = (np.array([v[k] for v in kept.values()], t) for k, t in ((0, np.uint32), (1, np.float32)))
    return np.fromiter(kept, np.int64, len(kept)), tags, np.clip(odds, -2.0, 6.0)


def _calibrate(model: Model, column: pa.Array, y: np.ndarray) -> None:
    """Statistics of clean texts, and the curve from evidence to score."""
    tags, odds = model.tables()
    best, n_words, clean, found = np.zeros(len(y)), np.zeros(len(y)), [], {}
    for piece in bw.slices(column):
        words, scores = token_scores(piece, tags, odds)
        n_words[piece.low : piece.high] = np.bincount(words.row, minlength=len(piece))
        clean.append(scores[y[words.row + piece.low] == 0])
        for i, own in passages(words, scores, len(piece)):
            found[i + piece.low] = own
            best[i + piece.low] = max(s for _, _, s in own)
    low, high = 1e-3, 20.0  # the decay solves E[exp(decay * score)] = 1 over clean words
    scores = np.concatenate(clean).astype(np.float64) if clean else np.zeros(0)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if len(scores) and np.exp(np.clip(mid * scores, -50, 50)).mean() < 1 else (low, mid)
    model.decay = min(max(low, 0.2), 3.0)
    ok = (y == 0) & (n_words > 0)
    if ok.any():
        model.scale = float(np.clip(np.exp((model.decay * best[ok] - np.log(n_words[ok])).mean() + 0.5772), 1e-3, 1e3))
    total = np.array([evidence(found.get(i, []), int(n_words[i]), model.decay, model.scale)[0] for i in range(len(y))])
    model.slope, model.offset = logistic(np.log1p(total), y)


def fit_texts(texts: list[str], y: np.ndarray) -> Model:
    """Unit odds from four fifths calibrate on the rest; then all texts give the odds."""
    none = np.zeros(0, np.int64)
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Model(none, none.astype(np.uint32), none.astype(np.float32), 1.0, 1.0, 0.0, float(np.log(p / (1 - p))))
    column = pa.array(texts, pa.large_string())
    rest = np.arange(len(y)) % 5 == 4
    if rest.sum() < 20 or y[rest].min() == y[rest].max() or y[~rest].min() == y[~rest].max():
        model = Model(*_unit_odds(column, y), 1.0, 1.0, 1.0, 0.0)
        _calibrate(model, column, y)
        return model
    model = Model(*_unit_odds(column.filter(pa.array(~rest)), y[~rest]), 1.0, 1.0, 1.0, 0.0)
    _calibrate(model, column.filter(pa.array(rest)), y[rest])
    return Model(*_unit_odds(column, y), model.decay, model.scale, model.slope, model.offset)


def fit(documents: DataFrame, labels: DataFrame, target: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """Learn from at most ``max_rows`` labelled documents outside the held-out fold."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((d, t, y) for b in batches for d, t, y in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "y"))))
        m = fit_texts([r[1] for r in rows], np.array([r[2] for r in rows], np.int64))
        packed = [m.slot.astype(np.int64).tobytes(), m.tag.tobytes(), m.odds.tobytes()]
        yield pa.RecordBatch.from_pydict({"packed": [packed], "rest": [[m.decay, m.scale, m.slope, m.offset]]})

    rows = training_rows(documents, labels, target, max_rows).repartition(1)
    found = rows.mapInArrow(learn, "packed array<binary>, rest array<double>").first()
    if found is None:  # not even an empty task ran
        return fit_texts([], np.zeros(0, np.int64))
    slot, tag, odds = (np.frombuffer(p, t) for p, t in zip(found["packed"], (np.int64, np.uint32, np.float32)))
    return Model(slot, tag, odds, *found["rest"])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """documents(doc_id, text, …) -> doc_id, score, passages(start, end, score).

    ``start`` and ``end`` count UTF-8 bytes of the text.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags, odds = model.tables()
        for batch in batches:
            total, spans = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for piece in bw.slices(batch["text"]):
                words, scores = token_scores(piece, tags, odds)
                n_words = np.bincount(words.row, minlength=len(piece))
                for i, own in passages(words, scores, len(piece)):
                    total[piece.low + i], strong = evidence(own, int(n_words[i]), model.decay, model.scale)
                    left = piece.offsets[i]
                    spans[piece.low + i] = [
                        {"start": int(words.start[a] - left), "end": int(words.end[b - 1] - left), "score": e} for a, b, _, e in strong
                    ]
            p = 1 / (1 + np.exp(-np.clip(model.slope * np.log1p(total) + model.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(p), pa.array(spans, kind)], ["doc_id", "score", "passages"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, score double, passages array<struct<start: bigint, end: bigint, score: double>>"
    )


def keep_clean(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score is below ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags, odds = model.tables()
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for piece in bw.slices(batch["text"]):
                words, scores = token_scores(piece, tags, odds)
                n_words = np.bincount(words.row, minlength=len(piece))
                for i, own in passages(words, scores, len(piece)):
                    total[piece.low + i] = evidence(own, int(n_words[i]), model.decay, model.scale)[0]
            p = 1 / (1 + np.exp(-np.clip(model.slope * np.log1p(total) + model.offset, -30, 30)))
            yield batch.filter(pa.array(p < threshold))

    return documents.mapInArrow(run, documents.schema)


def classify(documents: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = 0.5, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, passages.

    Null and empty texts have no passage and get the lowest score. Without labels
    of both classes every score is the labels' smoothed rate, or one half.
    Repeated rows are scored alike; further columns are ignored.
    """
    return score(documents, fit(documents, labels, target, max_rows)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages"
    )
