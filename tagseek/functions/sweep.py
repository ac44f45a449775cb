"""Sloppy phrase windows inside one record."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOWS = T.StructType([T.StructField("freq", T.DoubleType()), T.StructField("width", T.IntegerType())])


def sloppy_widths(slots: list[list[int]], slop: int, apart: bool = True) -> list[int]:
    """Widths, at most ``slop``, of the windows holding one place per slot.

    ``slots[s]`` lists, in order, each place of word ``s`` minus ``s``: a window
    of width 0 is the exact phrase. The slot that lies furthest back always
    moves on; a window is closed once that slot would overtake the next one.
    With ``apart``, two slots never share a place in the text; different words
    cannot, so this only keeps slots asking for the same word from each other.
    """
    n = len(slots)
    at = [0] * n

    def clash(s: int, among) -> int | None:
        if not apart:
            return None
        place = slots[s][at[s]] + s
        return next((o for o in among if o != s and slots[o][at[o]] + o == place), None)

    for s in range(n):
        if not slots[s]:
            return []
        while clash(s, range(s)) is not None:
            at[s] += 1
            if at[s] == len(slots[s]):
                return []

    queue = [(slots[s][at[s]], s) for s in range(n)]
    heapify(queue)
    end = max(queue)[0]
    widths: list[int] = []
    while True:
        start, s = heappop(queue)
        width = end - start
        limit = queue[0][0] if queue else end
        while True:
            moving, over = s, False
            moved_others = False
            while True:
                at[moving] += 1
                if at[moving] == len(slots[moving]):
                    over = True
                    break
                end = max(end, slots[moving][at[moving]])
                other = clash(moving, range(n))
                if other is None:
                    break
                moving = min((slots[moving][at[moving]], moving), (slots[other][at[other]], other))[1]
                moved_others = moved_others or moving != s
            if over:
                if width <= slop:
                    widths.append(width)
                return widths
            if moved_others:
                queue = [(slots[o][at[o]], o) for o in range(n) if o != s]
                heapify(queue)
            place = slots[s][at[s]]
            if place > limit:
                if width <= slop:
                    widths.append(width)
                heappush(queue, (place, s))
                break
            width = min(width, end - place)


_ARROW_FIELDS = [pa.field("freq", pa.float64()), pa.field("width", pa.int32())]


@F.arrow_udf(WINDOWS)
def sloppy_windows(slots: pa.Array, slop: pa.Array) -> pa.Array:
    """Slot arrays to (frequency, tightest width); rows without slots give 0."""
    freqs, tightest = [], []
    for row, reach in zip(slots.to_pylist(), slop.to_pylist()):
        widths = sloppy_widths(row, reach) if row else []
        freqs.append(sum(1.0 / (1 + w) for w in widths))
        tightest.append(min(widths, default=None))
    columns = [pa.array(freqs, pa.float64()), pa.array(tightest, pa.int32())]
    return pa.StructArray.from_arrays(columns, fields=_ARROW_FIELDS)


def apart(slots: Column) -> Column:
    """Whether two slots never name the same place of the text, so none can clash."""
    second = F.transform(F.get(slots, 1), lambda p: p + 1)
    return (F.size(slots) == 2) & ~F.arrays_overlap(F.get(slots, 0), second)


def _marked(places: Column, a: bool, b: bool) -> Column:
    return F.transform(places, lambda p: F.struct(p.alias("p"), F.lit(a).alias("a"), F.lit(b).alias("b")))


def pair_windows(slots: Column, slop: Column) -> Column:
    """(frequency, tightest width) of two slots that are ``apart``, without Python.

    Going through all places in order, a window lies between neighbours of
    different slots. Where both slots have a place, the slot at hand comes first.
    """
    first, second = F.get(slots, 0), F.get(slots, 1)
    shared = F.array_intersect(first, second)
    parts = ((F.array_except(first, shared), True, False), (F.array_except(second, shared), False, True), (shared, True, True))
    marked = F.array_sort(F.concat(*[_marked(places, a, b) for places, a, b in parts]))
    start = F.struct(
        F.lit(None).cast("boolean").alias("at_first"), F.lit(0).alias("last"), F.lit(0.0).alias("freq"), F.lit(None).cast("int").alias("width")
    )

    def step(state: Column, x: Column) -> Column:
        both = x["a"] & x["b"]
        turned = state["at_first"].isNotNull() & (state["at_first"] != x["a"])
        width = F.when(both, 0).when(turned, x["p"] - state["last"])
        counts = width <= slop
        return F.struct(
            F.when(both, ~F.coalesce(state["at_first"], F.lit(True))).otherwise(x["a"]).alias("at_first"),
            x["p"].alias("last"),
            (state["freq"] + F.when(counts, 1.0 / (1 + width)).otherwise(0.0)).alias("freq"),
            F.when(counts, F.least(state["width"], width)).otherwise(state["width"]).alias("width"),
        )

    empty = (F.size(first) == 0) | (F.size(second) == 0)
    swept = F.aggregate(marked, start, step, lambda s: F.struct(s["freq"].alias("freq"), s["width"].alias("width")))
    return F.when(~empty, swept).otherwise(F.struct(F.lit(0.0).alias("freq"), F.lit(None).cast("int").alias("width")))
