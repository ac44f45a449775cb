"""Best-two-fit packing of tokenized documents into sequences.

Documents are tokenized once, in parallel; only their lengths travel further.
Longer ones are cut into full pieces, and what remains is packed per shard: a
sequence is filled greedily with the longest pieces that fit, then its smallest
piece gives way to the two unpacked pieces that fill the widened gap best.
A shard holds about ``shard_rows`` pieces whatever the corpus, so each task is
bounded and the loss at its end is a few sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle

LENGTH = 2048
SHARD_ROWS = 200_000
TOKENIZER = "byte_bpe_50k.tiktoken"
#: Chunks whose ids a worker keeps.
CACHE = 400_000

#: White space other than spaces and line ends.
_OTHER_SPACE = re.compile(r"[^\S \n]")


class ChunkIds(dict):
    """Token ids of texts as bytes, from ids of their chunks.

    The splitting pattern lets a single space open a piece, so a text may be cut
    before every space that touches no other white space. Chunks come back again
    and again; a worker keeps the ids of what follows a space.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        self[chunk] = ids = self.encode(" " + chunk)
        return ids

    def of(self, text: str) -> bytes:
        if text[-1:] == " " or "  " in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
            return self.encode(text)
        first, *rest = text.split(" ")
        return self.encode(first) + b"".join(map(self.__getitem__, rest))


@cache
def _shared_ids(path: str) -> ChunkIds:
    """One per Python worker: its tasks share what is known."""
    return ChunkIds(path)


def tokenize(documents: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32): pieces of each document.

    ``row`` tells repeated ids apart. ``tokenizer``: path of a vocabulary of
    ranks that every executor has; unset, the public byte-level one, whose ids are
    those of ``byte_bpe_50k.json``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        ids = _shared_ids(tokenizer or public_tokenizers.path(TOKENIZER))
        for batch in batches:
            out: list[tuple] = []
            for doc, row, text in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), batch["text"]):
                own = ids.of(text.as_py() or "") + b"\0\0\0\0"
                n = len(own) // 4
                first = n % length or length
                starts = [0, *range(first, n, length)] if n > length else [0]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    out.append((doc, row, k, a, b - a, zlib.crc32(own[4 * a : 4 * b])))
            cols = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(cut, "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_two_fit(counts: np.ndarray, length: int) -> list[list[int]]:
    """Sequences (lists of lengths) for ``counts[l]`` pieces of each length l."""
    counts = counts.copy()
    counts[0] = 0
    sizes = np.flatnonzero(counts)
    out = []

    def longest(room: int) -> int:
        """The longest piece left that fits, 0 if none does."""
        nonlocal sizes
        while True:
            i = int(np.searchsorted(sizes, room, "right")) - 1
            if i < 0:
                return 0
            if counts[sizes[i]]:
                return int(sizes[i])
            sizes = sizes[counts[sizes] > 0]

    def best_pair(room: int) -> tuple[int, int]:
        """Two pieces left that fill most of the room; the sum closest to it."""
        nonlocal sizes
        sizes = sizes[counts[sizes] > 0]
        a = sizes[sizes < room]
        if not len(a):
            return 0, 0
        i = np.searchsorted(sizes, room - a, "right") - 1
        fits = i >= 0
        a, b = a[fits], sizes[i[fits]]
        alone = (a == b) & (counts[a] < 2)
        if alone.any():  # the next smaller length stands in for a missing twin
            below = np.searchsorted(sizes, b[alone], "left") - 1
            b[alone] = np.where(below >= 0, sizes[below], -length)
        if not len(a):
            return 0, 0
        k = int((a + b).argmax())
        return (int(a[k]), int(b[k])) if b[k] > 0 else (0, 0)

    while True:
        held: list[int] = []
        room = length
        while (piece := longest(room)) > 0:
            held.append(piece)
            counts[piece] -= 1
            room -= piece
        if not held:
            return out
        while room > 0:
            gap = room + held[-1]
            a, b = best_pair(gap)
            if a + b <= held[-1]:
                break
            counts[held.pop()] += 1
            sizes = np.union1d(sizes, [gap - room])
            for piece in (a, b):
                counts[piece] -= 1
            held += sorted((a, b), reverse=True)
            room = gap - a - b
            held.sort(reverse=True)
        out.append(held)


def pack(pieces: DataFrame, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; full pieces are sequences of their own."""
    short = pieces.where(F.col("length") < length).select("row", "piece", "length")
    shards = max(1, -(-short.count() // shard_rows))
    keyed = short.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row", "piece"], kind="stable").reset_index(drop=True)
        sizes = frame["length"].to_numpy()
        counts = np.bincount(sizes, minlength=length + 1)
        next_of = np.searchsorted(sizes, np.arange(length + 1))
        sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
        for number, held in enumerate(best_two_fit(counts, length)):
            at = 0
            for size in held:
                i = next_of[size]
                next_of[size] += 1
                sequence[i], offset[i] = number, at
                at += size
        shard = int(frame["shard"].iloc[0]) if len(frame) else 0
        return pd.DataFrame({"row": frame["row"], "piece": frame["piece"], "sequence_id": sequence * shards + shard, "offset": offset})

    packed = keyed.groupBy("shard").applyInPandas(place, "row bigint, piece int, sequence_id bigint, offset bigint")
    rest = pieces.where(F.col("length") < length).join(packed, ["row", "piece"])
    full = pieces.where(F.col("length") >= length).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )
    return full.unionByName(rest)


def pack_documents(documents: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the closing token alone, one piece of length 1.
    Repeated rows are packed each; an empty table gives no row; further columns
    are ignored. A document longer than 2048 tokens has a shorter first piece.
    """
    pieces = settle(tokenize(documents, tokenizer, length), "pieces")
    return pack(pieces, length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
