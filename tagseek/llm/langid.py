"""Language of whole texts: scripts, per-word scores, Viterbi spans.

A text's letters are cut into words of one script. The scripts that a language
was seen in narrow a word's candidates; its letter trigrams score them. Viterbi
with a penalty for each change of language labels spans of mixed texts, and the
language with the most letters names the text.

Learning counts trigrams over all training rows (partial sums per task, then a
shuffle of bucket counts, never of texts). Prediction is one pass, no shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .labelled import held_out

BUCKETS = 1 << 15
SWITCH = 12.0
UNKNOWN = "und"

#: First and last code point of the scripts told apart; other letters are script 1.
SCRIPTS = [
    (0x41, 0x24F), (0x1E00, 0x1EFF), (0x370, 0x3FF), (0x400, 0x52F), (0x530, 0x58F), (0x590, 0x5FF), (0x600, 0x77F),
    (0x900, 0x97F), (0x980, 0x9FF), (0xA00, 0xA7F), (0xA80, 0xAFF), (0xB80, 0xBFF), (0xC00, 0xC7F), (0xC80, 0xCFF),
    (0xD00, 0xD7F), (0xE00, 0xE7F), (0xE80, 0xEFF), (0x1000, 0x109F), (0x10A0, 0x10FF), (0x1200, 0x137F),
    (0x1780, 0x17FF), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF),
]


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: script number (0: no letter), and the small letter."""
    size = 0x110000
    script = np.zeros(size, np.uint8)
    small = np.arange(size, dtype=np.uint32)
    every = [c for c in range(size) if unicodedata.category(chr(c))[0] == "L"]
    script[every] = 1
    for number, (low, high) in enumerate(SCRIPTS, 2):
        own = script[low : high + 1]
        own[own > 0] = 2 if low == 0x1E00 else number
    for c in every:
        lower = chr(c).lower()
        if len(lower) == 1:
            small[c] = ord(lower)
    return script, small


@dataclass
class Words:
    """Words of a slice: their text, letters, script, and trigram buckets."""

    row: np.ndarray
    length: np.ndarray
    script: np.ndarray
    gram: np.ndarray  # one for each letter
    word_of: np.ndarray  # of each gram


def words(piece: bw.Slice) -> Words:
    script, small = _letters()
    codes = np.frombuffer(piece.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    places = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum((piece.data & 0xC0) != 0x80, out=places[1:])
    own = bw.Slice(piece.low, piece.high, codes, places[piece.offsets])
    kind = script[codes]
    found = bw.runs(own, kind)
    length = found.end - found.start
    word_of = np.repeat(np.arange(len(length)), length)
    at = np.flatnonzero(kind)
    c = small[codes[at]].astype(np.uint64)
    before, after = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    if len(at):
        joined = word_of[1:] == word_of[:-1]
        before[1:] = np.where(joined, c[:-1], 0)
        after[:-1] = np.where(joined, c[1:], 0)
    gram = bw.mix((before << np.uint64(42)) | (c << np.uint64(21)) | after) >> np.uint64(49)
    return Words(found.row, length, kind[found.start], gram.astype(np.int64), word_of)


@dataclass
class Model:
    langs: list[str]
    odds: np.ndarray  # (buckets, languages), log-probabilities
    allowed: np.ndarray  # (scripts, languages)


def fit(documents: DataFrame) -> Model:
    """Count over all documents with a language outside the held-out fold."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    n_scripts = len(SCRIPTS) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, number = np.unique(np.array(batch["lang"].to_pylist(), object).astype(str), return_inverse=True)
            for piece in bw.slices(batch["text"]):
                found = words(piece)
                lang = number[found.row + piece.low]
                both = np.bincount(lang[found.word_of] * BUCKETS + found.gram, minlength=len(langs) * BUCKETS)
                seen = np.bincount(lang * n_scripts + found.script, weights=found.length, minlength=len(langs) * n_scripts)
                for i, name in enumerate(langs):
                    own = sums.setdefault(str(name), np.zeros(BUCKETS + n_scripts, np.int64))
                    own[:BUCKETS] += both[i * BUCKETS : (i + 1) * BUCKETS]
                    own[BUCKETS:] += seen[i * n_scripts : (i + 1) * n_scripts].astype(np.int64)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bucket", "n"])

    counted = rows.select("lang", "text").mapInArrow(count, "lang string, bucket int, n bigint")
    # languages times buckets: a bounded table
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    langs = sorted(set(names))
    sums = np.zeros((BUCKETS + n_scripts, len(langs)))
    sums[table["bucket"].to_numpy(), np.searchsorted(np.array(langs, object), names) if langs else []] = table["n"].to_numpy()
    grams, seen = sums[:BUCKETS] + 0.1, sums[BUCKETS:]
    allowed = seen > 0.001 * seen.sum(axis=0, keepdims=True) if langs else seen > 0
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word of one text, given (words, languages) scores."""
    total = scores.sum(axis=0)
    best = int(total.argmax())
    # If no stretch of words gains more elsewhere than one change costs, there is none.
    others = np.delete(scores, best, axis=1)
    if not others.shape[1]:
        return np.zeros(len(scores), np.int64)
    gain = np.zeros(len(scores) + 1)
    np.cumsum(others.max(axis=1) - scores[:, best], out=gain[1:])
    if (gain - np.minimum.accumulate(gain)).max() <= switch:
        return np.full(len(scores), best)
    value, back = scores[0].astype(float), np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1])
    for t in range(1, len(scores)):
        top = int(value.argmax())
        floor = value[top] - switch
        stay = value >= floor
        back[t] = np.where(stay, own, top)
        value = np.where(stay, value, floor) + scores[t]
    path = np.empty(len(scores), np.int64)
    path[-1] = int(value.argmax())
    for t in range(len(scores) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def label(documents: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """documents(doc_id, text, …) -> doc_id, lang_pred, score, spans.

    ``spans``: (lang, words) in order. ``score``: the share of the letters in
    spans of the predicted language.
    """
    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, spans = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for piece in bw.slices(batch["text"]) if model.langs else ():
                found = words(piece)
                firsts = bw.row_bounds(found.word_of, len(found.row))[:-1]
                if not len(firsts):
                    continue
                own = np.add.reduceat(model.odds[found.gram], firsts, axis=0)
                own = np.where(model.allowed[found.script], own, own.min(axis=1, keepdims=True) - 1.0)
                bounds = bw.row_bounds(found.row, len(piece))
                for i in np.flatnonzero(bounds[1:] > bounds[:-1]):
                    a, b = bounds[i], bounds[i + 1]
                    path = viterbi(own[a:b], switch)
                    letters = np.bincount(path, weights=found.length[a:b], minlength=len(model.langs))
                    top = int(letters.argmax())
                    names[piece.low + i], scores[piece.low + i] = model.langs[top], letters[top] / letters.sum()
                    cut = np.flatnonzero(np.diff(path, prepend=-1, append=-1))
                    spans[piece.low + i] = [{"lang": model.langs[path[x]], "words": int(y - x)} for x, y in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(scores), pa.array(spans, kind)], ["doc_id", "lang_pred", "score", "spans"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, spans array<struct<lang: string, words: bigint>>"
    )


def identify(documents: DataFrame, switch: float = SWITCH) -> DataFrame:
    """Learn and predict in one: doc_id, held_out, lang_pred, score, spans.

    Null and empty texts, and texts without a letter, are ``und`` with score 0, as
    is every text when no row has a language to learn. Equal scores go to the
    name that sorts first. Repeated rows are labelled alike; further columns are
    ignored.
    """
    return label(documents, fit(documents), switch).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")
