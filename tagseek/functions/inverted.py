"""Arrays of words to entries per distinct term, in Arrow batches.

Words are numbers here, so a record is cut into runs of equal terms by one sort of
numbers. About ``STEP`` words are worked on together, which bounds memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words sorted together; a longer record is sorted whole.
STEP = 1 << 20

_PLACES = T.ArrayType(T.IntegerType())
ENTRIES = T.ArrayType(T.StructType().add("field", T.StringType()).add("term", T.StringType()).add("positions", _PLACES).add("hyphens", _PLACES))


def _portions(batch: pa.Array) -> Iterator[pa.Array]:
    """The arrays in turn, about ``STEP`` words at a time; at least one portion."""
    ends = np.cumsum(_sizes(batch))
    at, words = 0, 0
    while True:
        stop = max(at + 1, int(np.searchsorted(ends, words + STEP, side="right")))
        yield batch.slice(at, stop - at)
        if stop >= len(batch):
            return
        at, words = stop, ends[stop - 1]


def _sizes(batch: pa.Array) -> np.ndarray:
    return batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _inverted(batch: pa.Array, field: str, named: Callable[[pa.Array], pa.Array], marked: bool) -> pa.Array:
    distinct = batch.flatten().dictionary_encode()
    words = distinct.indices.to_numpy(zero_copy_only=False)
    terms = named(distinct.dictionary).dictionary_encode()
    ids = terms.indices.to_numpy(zero_copy_only=False)[words].astype(np.int64)
    sizes = _sizes(batch)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = owner * max(1, len(terms.dictionary)) + ids
    order = np.argsort(key, kind="stable")  # places of one term go on ascending
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    ends, place = np.append(first, len(order)), place[order]
    glued = pc.ends_with(distinct.dictionary, "-").to_numpy(zero_copy_only=False)[words][order] if marked else np.zeros(len(order), bool)
    parts = {
        "field": pa.repeat(pa.scalar(field), len(first)),
        "term": terms.dictionary.take(pa.array(ids[order][first])),
        "positions": _lists(ends, pa.array(place, pa.int32())),
        "hyphens": _lists(np.append(0, np.cumsum(glued))[ends], pa.array(place[glued], pa.int32())),
    }
    cuts = pa.array(np.searchsorted(owner[order][first], np.arange(len(sizes) + 1)), pa.int32())
    entries = pa.StructArray.from_arrays(list(parts.values()), list(parts))
    return pa.ListArray.from_arrays(cuts, entries, mask=batch.is_null() if batch.null_count else None)


def invert(batch: pa.Array, field: str, named: Callable[[pa.Array], pa.Array], marked: bool = False) -> pa.Array:
    """Per array an entry (field, term, positions, hyphens) for each distinct term; NULL for NULL.

    ``named``: words to their terms. ``marked``: a word's final hyphen is a mark.
    """
    return pa.concat_arrays([_inverted(part, field, named, marked) for part in _portions(batch)])


#: Postings handed on together.
ROWS = 1 << 16


def stable_order(ids: np.ndarray) -> np.ndarray:
    """As a stable argsort of numbers from 0, by 16 bits at a time: numpy counts those and needs no comparisons."""
    order, most = np.argsort((ids & 0xFFFF).astype(np.uint16), kind="stable"), int(ids.max(initial=0)) >> 16
    while most:
        ids = ids >> 16
        order = order[np.argsort((ids[order] & 0xFFFF).astype(np.uint16), kind="stable")]
        most >>= 16
    return order


def listed(spelled: pa.Array) -> list[str]:
    """The words, as ``to_pylist`` gives them, at a fraction of its time."""
    return spelled.to_numpy(zero_copy_only=False).tolist()


def bare(spelled: pa.Array) -> pa.Array:
    """Words without the hyphen that marks them."""
    return pc.utf8_rtrim(spelled, "-")


def postings(docs: pa.Array, words: pa.Array, fields: Sequence[tuple[str, Callable[[pa.Array], pa.Array], bool]]) -> Iterator[pa.RecordBatch]:
    """Arrays of words, one per record, to postings of each (field, words to terms, are its words marked).

    A portion's postings go by field, then term in byte order, then record: whoever
    sorts them so finds long runs in order.
    """
    at = 0
    for part in _portions(words) if len(words) else ():
        own, at = docs.slice(at, len(part)), at + len(part)
        distinct = part.flatten().dictionary_encode()
        spelled = distinct.indices.to_numpy(zero_copy_only=False)
        sizes = _sizes(part)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for field, named, marked in fields:
            terms = named(distinct.dictionary).dictionary_encode()
            ranked = pc.array_sort_indices(terms.dictionary)
            rank = np.empty(len(ranked), np.int64)
            rank[ranked.to_numpy(zero_copy_only=False)] = np.arange(len(ranked))
            ids = rank[terms.indices.to_numpy(zero_copy_only=False)][spelled]
            order = stable_order(ids)  # records of one term, and places in them, go on ascending
            term, record = ids[order], owner[order]
            first = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(record, prepend=-1) != 0))
            ends = np.append(first, len(order))
            term, record = term[first], record[first]
            glued = pc.ends_with(distinct.dictionary, "-").to_numpy(zero_copy_only=False)[spelled][order] if marked else np.zeros(len(order), bool)
            columns = {
                "field": pa.repeat(pa.scalar(field), len(first)),
                "term": terms.dictionary.take(ranked).take(pa.array(term)),
                "doc_id": own.take(pa.array(record)),
                "dl": pa.array(sizes[record], pa.int32()),
                "freq": pa.array(np.diff(ends), pa.int32()),
                "positions": _lists(ends, pa.array(place[order], pa.int32())),
                "hyphens": _lists(np.append(0, np.cumsum(glued))[ends], pa.array(place[order][glued], pa.int32())),
            }
            made = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            for a in range(0, made.num_rows, ROWS):
                yield made.slice(a, ROWS)


@F.arrow_udf(ENTRIES)
def word_entries(words: pa.Array) -> pa.Array:
    """Arrays of ``words_and_hyphens`` inverted."""
    return invert(words, "exact", lambda spelled: pc.utf8_rtrim(spelled, "-"), marked=True)
