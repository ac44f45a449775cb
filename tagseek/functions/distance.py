"""Edit distance in which swapping two neighbouring letters is one edit."""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def swap_distance(a: str, b: str) -> int:
    """Optimal string alignment distance."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, older[j - 2] + 1)
            row.append(best)
    return row[-1]


@F.arrow_udf(T.IntegerType())
def swap_distances(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = zip(a.to_pylist(), b.to_pylist())
    return pa.array([swap_distance(x, y) for x, y in pairs], pa.int32())


def deletion_keys(word: Column, edits: int, prefix: int = 7) -> Column:
    """Join keys for words at most ``edits`` apart: what is left of the first
    ``prefix`` characters after dropping up to ``edits`` of them.

    Two words within ``edits`` insertions, deletions, replacements or
    neighbour swaps always share a key, since every such edit is undone by
    dropping at most one character on each side.
    """
    def without(places: tuple[int, ...]) -> Column:
        # the runs between the places dropped; places behind a short word's end drop nothing
        runs = zip((0, *places), (*places, prefix + 1))
        return F.concat(*[F.substring(word, a + 1, b - a - 1) for a, b in runs if b - a > 1] or [F.lit("")])

    return F.array_distinct(F.array(*[without(places) for n in range(edits + 1) for places in combinations(range(1, prefix + 1), n)]))
