"""Removing repeated byte strings by longest previous factors.

A byte goes if a string of ``LENGTH`` bytes over it also starts earlier. In
suffix order, suffixes that share ``LENGTH`` bytes are neighbours; one of them
has a longest previous factor that long if, and only if, a previous or next
neighbour of that stretch has a smaller position. So the first copy stays.

Nobody sorts all suffixes of a corpus. Every window of ``LENGTH`` bytes names
its anchor, the place of the smallest hash of ``GRAM`` bytes in it; equal windows
have equal anchors. Neighbouring windows of one anchor are a run, and runs take
the place of suffixes:

1. Equal runs: all but the first go. Each task settles its own copies before the
   shuffle, so a passage in a third of all texts costs a row per task.
2. Different runs of one anchor may share windows. Their bytes are fetched, their
   windows sorted in suffix order, and longest previous factors decide. Anchors
   with more than ``HOT`` different runs are split by the windows' own bytes, so
   bytes decide either way.
3. What the windows cover is cut out of each text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from . import bytewords as bw

LENGTH = 100
GRAM = 32
#: Different runs of one anchor that are sorted in one task.
HOT = 5_000
#: Runs that a task settles among themselves, and windows it sorts, at a time.
LOCAL = 1_500_000
SORT_WINDOWS = 120_000

_RUN = "kind tinyint, anchor bigint, mark bigint, doc_id bigint, row int, start int, off int, n int"
_NAMES = [c.split()[0] for c in _RUN.split(", ")]
_TYPES = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
COPY, FIRST = 0, 1


def longest_previous_factors(data: bytes) -> list[int]:
    """For each position, the longest string there that also starts earlier.

    A plain form for one small text: previous and next smaller positions in
    suffix order give the only candidates.
    """
    order = sorted(range(len(data)), key=lambda i: data[i:])
    nearest: list[list[int]] = [[] for _ in data]
    for sequence in (order, order[::-1]):
        smaller: list[int] = []
        for i in sequence:
            while smaller and smaller[-1] > i:
                smaller.pop()
            if smaller:
                nearest[i].append(smaller[-1])
            smaller.append(i)

    def common(i: int, j: int) -> int:
        n = 0
        while i + n < len(data) and data[i + n] == data[j + n]:
            n += 1
        return n

    return [max((common(i, j) for j in nearest[i]), default=0) for i in range(len(data))]


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def anchored_runs(piece: bw.Slice, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, anchor, mark, start, off, n) of the window runs of each text of a slice.

    ``start``: the first window's place in its text; ``off``: the anchor's place
    after it; ``n``: windows in the run; ``mark``: a hash of all the run's bytes.
    """
    data = piece.data
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    sums = bw.prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    hashes = bw.span_hash(sums, at, at + gram)
    width = length - gram + 1
    least = _window_min(hashes, width)  # of the windows that start at 0, 1, ...
    size = np.diff(piece.offsets)
    last = piece.offsets[1:] - length  # each text's last window
    inside = np.zeros(len(least) + 1, np.int32)
    full = size >= length
    np.add.at(inside, piece.offsets[:-1][full], 1)
    np.add.at(inside, last[full] + 1, -1)
    inside = np.cumsum(inside)[:-1] > 0
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    change[piece.offsets[:-1][full]] = True
    edges = np.flatnonzero(change)
    ends = np.append(edges[1:], len(least))
    # an anchor that repeats inside a window: a run goes on while it can have one place
    place = _first_place(hashes, least, edges, width)
    while (late := np.flatnonzero((place < ends - 1) & inside[edges])).size:
        cut = place[late] + 1
        edges = np.concatenate([edges, cut])
        ends_late = ends[late].copy()
        ends[late] = cut
        ends = np.concatenate([ends, ends_late])
        place = np.concatenate([place, _first_place(hashes, least, cut, width)])
    good = inside[edges]
    edges, ends, place = edges[good], ends[good], place[good]
    row = np.searchsorted(piece.offsets, edges, "right") - 1
    mark = bw.span_hash(sums, edges, ends - 1 + length)
    return row, least[edges], mark, edges - piece.offsets[row], place - edges, ends - edges


def _first_place(hashes: np.ndarray, least: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Where each window that starts at ``starts`` first holds its least hash."""
    out = np.full(len(starts), -1)
    left = np.arange(len(starts))
    for k in range(width):
        if not len(left):
            break
        met = hashes[starts[left] + k] == least[starts[left]]
        out[left[met]] = starts[left[met]] + k
        left = left[~met]
    return out


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, _TYPES)], _NAMES)


def _first_of_each(columns: list[np.ndarray]) -> np.ndarray:
    """Sort runs by content and position; say which is the first of its content."""
    order = np.lexsort([columns[i] for i in (5, 4, 3, 2, 1)])
    for i, c in enumerate(columns):
        columns[i] = c[order]
    new = np.ones(len(order), bool)
    new[1:] = (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1])
    return new


def _copies(columns: list[np.ndarray], copy: np.ndarray) -> list[np.ndarray]:
    """The copies among runs, joined where they follow each other in a text."""
    doc, row, start, n = (columns[i][copy] for i in (3, 4, 5, 7))
    order = np.lexsort([start, row, doc])
    doc, row, start, n = doc[order], row[order], start[order], n[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(n, first) if len(first) else n
    zero = np.zeros(len(first), np.int64)
    # any key will do: copies are settled, they only travel along
    return [zero, bw.mix(doc[first].astype(np.uint64)).view(np.int64), zero, doc[first], row[first], start[first], zero, total]


def runs(documents: DataFrame) -> DataFrame:
    """documents(doc_id, row, text) -> first runs of each task, and its settled copies."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate([h[i] for h in held]) for i in range(len(_NAMES))]
            held.clear()
            new = _first_of_each(columns)
            yield _batch(_copies(columns, ~new))
            for a in range(0, len(new), 1 << 17):
                keep = new[a : a + (1 << 17)]
                yield _batch([c[a : a + (1 << 17)][keep] for c in columns])

        for batch in batches:
            doc, number = batch["doc_id"].to_numpy(), batch["row"].to_numpy()
            for piece in bw.slices(batch["text"]):
                row, anchor, mark, start, off, n = anchored_runs(piece)
                at = row + piece.low
                held.append([np.full(len(row), FIRST), anchor.view(np.int64), mark.view(np.int64), doc[at], number[at], start, off, n])
                count += len(row)
                if count > LOCAL:
                    yield from flush()
                    count = 0
        if held:
            yield from flush()

    return documents.mapInArrow(find, _RUN)


def settle_equal(found: DataFrame) -> DataFrame:
    """Copies of equal runs (kind 0), and the first runs of anchors that have several (kind 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple | None = None  # (anchor, mark) of the last run
        pending: list | None = None  # the last first run, and whether its anchor had one before
        for batch in batches:
            columns = [batch[c].to_numpy() for c in _NAMES]
            old = columns[0] == COPY
            if old.any():
                yield _batch([c[old] for c in columns])
                columns = [c[~old] for c in columns]
            if not len(columns[0]):
                continue
            anchor, mark = columns[1], columns[2]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (mark[1:] != mark[:-1])
            new[0] = seen != (anchor[0], mark[0])
            seen = (anchor[-1], mark[-1])
            if not new.all():
                yield _batch(_copies(columns, ~new))
            first = [c[new] for c in columns]
            if pending is not None:
                first = [np.concatenate([[p], c]) for p, c in zip(pending[0], first)]
            if len(first[0]):
                same = first[1][1:] == first[1][:-1]
                several = np.zeros(len(first[0]), bool)
                several[1:] |= same
                several[:-1] |= same
                several[0] |= pending is not None and pending[1]
                yield _batch([c[:-1][several[:-1]] for c in first])
                pending = [[c[-1] for c in first], bool(several[-1])]
        if pending is not None and pending[1]:
            yield _batch([np.array([c]) for c in pending[0]])

    keys = ["kind", "anchor", "mark", "doc_id", "row", "start"]
    return found.repartition("anchor").sortWithinPartitions(*keys).mapInArrow(work, _RUN)


_SLICES = "hot boolean, anchor bigint, doc_id bigint, row int, start int, bytes binary"
#: Slices handed on at a time.
_ROWS = 50_000


def _fetch(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """Bytes of the wanted runs; of hot ones a row per window."""
    asked = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("anchor", "start", "n", "hot")).alias("asked"))
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in _SLICES.split(", ")]

    def slices(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc, row, text, asks in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), batch["text"], batch["asked"].to_pylist()):
            data = text.as_py().encode()
            for x in asks:
                a, n = x["start"], x["n"]
                if x["hot"]:
                    yield from ((True, x["anchor"], doc, row, k, data[k : k + LENGTH]) for k in range(a, a + n))
                else:
                    yield False, x["anchor"], doc, row, a, data[a : a + n + LENGTH - 1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = slices(batch)
            while part := list(islice(found, _ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)

    return documents.join(asked, ["doc_id", "row"]).mapInArrow(cut, _SLICES)


def previous_factors(slices: DataFrame) -> DataFrame:
    """(doc_id, row, start, n): windows whose longest previous factor covers them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        windows = 0
        for batch in batches:
            for x in zip(*(batch[c].to_pylist() for c in ("anchor", "doc_id", "row", "start", "bytes"))):
                if windows > SORT_WINDOWS and held[-1][0] != x[0]:
                    yield _factors(held)
                    held, windows = [], 0
                held.append(x)
                windows += len(x[4]) - LENGTH + 1
        if held:
            yield _factors(held)

    rows = slices.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "row", "start")
    return rows.mapInArrow(work, "doc_id bigint, row int, start int, n int")


def _factors(held: list[tuple]) -> pa.RecordBatch:
    """Suffix order of the held runs' windows; rows come in order of position within an anchor."""
    size = np.array([len(h[4]) for h in held])
    data = np.frombuffer(b"".join(h[4] for h in held), np.uint8)
    n = size - LENGTH + 1
    owner = np.repeat(np.arange(len(held)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(np.cumsum(size) - size, n) + place
    group = np.array([h[0] for h in held], np.int64)[owner]
    # anchor, then bytes: one fixed-width key; a stable sort keeps positions in order
    key = np.empty((len(begin), 8 + LENGTH), np.uint8)
    key[:, :8] = group.astype(">i8").view(np.uint8).reshape(-1, 8)
    key[:, 8:] = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begin]
    order = np.argsort(key.view(f"S{8 + LENGTH}").ravel(), kind="stable")
    ranked = key[order]
    alike = (ranked[1:] == ranked[:-1]).all(axis=1)  # the common prefix reaches LENGTH
    # within such a stretch of suffix order, all but the smallest position have an earlier match
    stretch = np.concatenate([[0], np.cumsum(~alike)])
    smallest = np.minimum.reduceat(order, np.flatnonzero(np.concatenate([[True], ~alike])))
    again = np.sort(order[order != smallest[stretch]])
    doc, row, start = (np.array([h[i] for h in held], np.int64)[owner[again]] for i in (1, 2, 3))
    start = start + place[again]
    new = np.ones(len(again), bool)
    new[1:] = (again[1:] != again[:-1] + 1) | (owner[again[1:]] != owner[again[:-1]])
    first = np.flatnonzero(new)
    total = np.diff(np.append(first, len(again)))
    return pa.RecordBatch.from_arrays([pa.array(doc[first], pa.int64()), pa.array(row[first], pa.int32()), pa.array(start[first], pa.int32()), pa.array(total, pa.int32())], ["doc_id", "row", "start", "n"])


def _spans(windows: list[dict]) -> list[tuple[int, int]]:
    """Maximal removed byte runs from (start, n) windows."""
    out: list[list[int]] = []
    for a, b in sorted((w["start"], w["start"] + w["n"] - 1 + LENGTH) for w in windows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_windows(documents: DataFrame) -> DataFrame:
    """documents(doc_id, row, text) -> (doc_id, row, start, n): windows that also start earlier."""
    found = settle(settle_equal(runs(documents)), "runs")
    first = found.where(F.col("kind") == FIRST).select("anchor", "doc_id", "row", "start", "n")
    hot = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("several")).where(F.col("several") > HOT).select("anchor", F.lit(True).alias("hot"))
    wanted = first.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    slices = settle(_fetch(wanted, documents), "slices")
    by_order = previous_factors(slices.where(~F.col("hot")).drop("hot"))
    windows = slices.where("hot").select("bytes", "doc_id", "row", "start")
    least = windows.groupBy("bytes").agg(F.min(F.struct("doc_id", "row", "start")).alias("least"), F.count(F.lit(1)).alias("several")).where("several > 1")
    later = windows.join(least, "bytes").where(F.struct("doc_id", "row", "start") != F.col("least"))
    split = later.select("doc_id", "row", "start", F.lit(1).alias("n"))
    return found.where(F.col("kind") == COPY).select("doc_id", "row", "start", "n").unionByName(by_order).unionByName(split)


def numbered(documents: DataFrame) -> DataFrame:
    """(doc_id, key, row, text): ``key`` orders texts, ``row`` tells rows of one key apart by their texts."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63)).cast("bigint")))
    if rows.groupBy("key").count().where("count > 1").isEmpty():
        return rows.select("doc_id", "key", F.lit(0).alias("row"), "text")
    order = Window.partitionBy("key").orderBy("text")
    return settle(rows.select("doc_id", "key", (F.row_number().over(order) - 1).cast("int").alias("row"), "text"), "numbered")


def deduplicate(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Null and empty texts lose nothing and keep the empty string. Copies within one
    text count too. Rows that repeat a doc_id are ordered by their texts, and of
    equal rows one is the first; null ids come before all others. ``kept_text``
    replaces bytes that no longer form a character. Further columns are ignored.
    """
    texts = numbered(documents)
    found = repeated_windows(texts.select(F.col("key").alias("doc_id"), "row", "text"))
    gone = found.groupBy(F.col("doc_id").alias("key"), "row").agg(F.collect_list(F.struct("start", "n")).alias("windows"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, windows in zip(batch["text"], batch["windows"].to_pylist()):
                data = text.as_py().encode()
                spans = _spans(windows or [])
                parts, at = [], 0
                for a, b in spans:
                    parts.append(data[at:a])
                    at = b
                kept = b"".join([*parts, data[at:]]) if spans else data
                out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return texts.join(gone, ["key", "row"], "left").select("doc_id", "text", "windows").mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    )
