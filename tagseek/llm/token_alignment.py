"""Alignment of two tokenizers by galloping intersection of their token ends.

A document's tokens of either side end at byte offsets. The shorter list of ends
drives: each of its entries starts at its proportional place in the longer list,
widens by doubling steps until it is enclosed, and is then found by halving. Ends
that both lists hold cut the document into groups; differences of ranks give the
tokens of a group, and the range of tokens that a single one overlaps.

Linked ids are counted over the whole corpus without moving a document's links.
A task joins its documents to chunks of about ``CHUNK_BYTES`` of text. Only the
distinct id pairs of a chunk travel: once to be summed, once to fetch their sums.
A document stays a row of its own: no row, batch or row group holds whole chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .packing import TOKENIZER, ChunkIds

PIECES = "piece_bpe_32k.model"
#: Text whose links are worked out, and looked up, together; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Chunks whose sums one task works out, one after another.
CHUNKS_PER_TASK = 8
#: Text aligned in one go.
STEP_BYTES = 512 << 10
#: Bits of a token id in the key of an id pair.
ID_BITS = 20
#: Links of one group above which equal ids are joined before pairs are formed.
WIDE = 4096

GROUPS = (
    "doc_id bigint, a_ids array<int>, b_ids array<int>, "
    "groups array<struct<a_first:int,a_last:int,b_first:int,b_last:int>>, overlaps array<struct<b_first:int,b_last:int>>"
)
_CHUNKS = (
    "chunk bigint, pairs array<bigint>, holders array<int>, doc_id bigint, n_a bigint, n_b bigint, "
    "n_groups bigint, n_links bigint, groups_sha256 string, at array<int>, times array<bigint>"
)
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class Sides:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, ranks: str, pieces: str):
        import sentencepiece

        self.a = ChunkIds(ranks).encoding
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # what a token adds to the written groups, inside its side and at the end of it
        plain = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        a, b = plain[: len(self.a_bytes)], plain[: len(self.b_bytes)]
        self.written = [x + b"," for x in a] + [x + b"|" for x in a] + [x + b"," for x in b] + [x + b";" for x in b]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of either side; none where the tokens' bytes are not the text's."""
        if text:
            a, b, whole = self.a.encode_ordinary(" " + text), self.b.encode(text), (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b)):
                return a, b
        return [], []


@cache
def _sides(ranks: str | None, pieces: str | None) -> Sides:
    """One per Python worker: its tasks share what is known."""
    import public_tokenizers

    return Sides(ranks or public_tokenizers.path(TOKENIZER), pieces or public_tokenizers.path(PIECES))


def gallop(wanted: np.ndarray, ends: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many of the sorted ``ends`` lie below each entry wanted.

    Every search starts at its own guess, doubles its step to either side until it
    is enclosed, and then halves; all advance in step, so the work follows the
    distance from the guess, not the length of the list.
    """
    n = len(ends)
    low, high = np.clip(start, 0, n), np.clip(start, 0, n)
    if not n:
        return low
    for bound, side in ((low, -1), (high, 1)):
        step, open_ = 1, np.arange(len(wanted))
        while len(open_):
            at = bound[open_]
            if side < 0:
                beyond = (at > 0) & (ends[np.maximum(at - 1, 0)] >= wanted[open_])
            else:
                beyond = (at < n) & (ends[np.minimum(at, n - 1)] < wanted[open_])
            open_ = open_[beyond]
            bound[open_] = np.clip(at[beyond] + side * step, 0, n)
            step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = ends[middle] < wanted[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these sizes one after another: each entry's list, and its place there."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Aligned:
    """Groups of several documents, one after another.

    ``a_first``, ``b_first``: where a group's tokens begin; ``a_n``, ``b_n``: how many
    they are; ``doc``: the group's document. Offsets run on from document to document.
    """

    def __init__(self, sides: Sides, texts: Iterable[str | None]):
        ids = [[np.array(side, np.int64) for side in sides.encode(text)] for text in texts]
        self.sides = sides
        self.a, self.b = (np.concatenate([x[k] for x in ids] or [np.empty(0, np.int64)]) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        self.a_ends, self.b_ends = np.cumsum(sides.a_sizes[self.a]), np.cumsum(sides.b_sizes[self.b])
        self._intersect()

    def _intersect(self) -> None:
        """Ends that both sides have, by driving each document's shorter list into its longer one."""
        swap = self.n_b < self.n_a
        a_base, b_base = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        found = []
        for driven, own, other, own_n, other_n, own_base, other_base in (
            (~swap, self.a_ends, self.b_ends, self.n_a, self.n_b, a_base, b_base),
            (swap, self.b_ends, self.a_ends, self.n_b, self.n_a, b_base, a_base),
        ):
            docs = np.flatnonzero(driven & (own_n > 0))
            doc, place = _ranges(own_n[docs])
            doc = docs[doc]
            mine = own_base[doc] + place
            at = gallop(own[mine], other, other_base[doc] + place * other_n[doc] // own_n[doc])
            same = other[at] == own[mine]  # the last ends are equal, so no search runs off the list
            found.append((doc[same], mine[same], at[same]))
        (d0, a0, b0), (d1, b1, a1) = found
        doc, a_last, b_last = np.concatenate([d0, d1]), np.concatenate([a0, a1]), np.concatenate([b0, b1])
        order = np.argsort(a_last, kind="stable")
        self.doc, a_last, b_last = doc[order], a_last[order], b_last[order]
        self.a_n, self.b_n = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        self.a_first, self.b_first = a_last + 1 - self.a_n, b_last + 1 - self.b_n

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last token of b that each token of a shares bytes with."""
        begins = self.a_ends - self.sides.a_sizes[self.a]
        group = np.repeat(np.arange(len(self.a_n)), self.a_n)
        guess = self.b_first[group]
        return gallop(begins + 1, self.b_ends, guess), gallop(self.a_ends, self.b_ends, guess)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, id pair, times): each document's distinct linked id pairs, in this order."""
        sizes = self.a_n * self.b_n
        slim = np.flatnonzero(sizes <= WIDE)
        owner, place = _ranges(sizes[slim])
        owner = slim[owner]
        a = self.a[self.a_first[owner] + place // self.b_n[owner]]
        b = self.b[self.b_first[owner] + place % self.b_n[owner]]
        docs, pairs, times = [self.doc[owner]], [a << ID_BITS | b], [np.ones(len(a), np.int64)]
        for g in np.flatnonzero(sizes > WIDE):
            (a, a_times), (b, b_times) = (
                np.unique(ids[first[g] : first[g] + n[g]], return_counts=True)
                for ids, first, n in ((self.a, self.a_first, self.a_n), (self.b, self.b_first, self.b_n))
            )
            pairs.append((a[:, None] << ID_BITS | b).ravel())
            times.append((a_times[:, None] * b_times).ravel())
            docs.append(np.full(len(pairs[-1]), self.doc[g]))
        doc, pair, n = np.concatenate(docs), np.concatenate(pairs), np.concatenate(times)
        order = np.lexsort((pair, doc))
        doc, pair, n = doc[order], pair[order], n[order]
        new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
        return doc[new], pair[new], np.add.reduceat(n, new) if len(new) else n

    def digests(self) -> list[str]:
        """Per document the digest of its groups written out, '' without tokens."""
        group, place = _ranges(self.a_n)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(group)) + self.b_first[group]] = self.a + len(self.sides.a_bytes) * (place == self.a_n[group] - 1)
        group, place = _ranges(self.b_n)
        behind = 2 * len(self.sides.a_bytes) + len(self.sides.b_bytes) * (place == self.b_n[group] - 1)
        codes[np.arange(len(group)) + (self.a_first + self.a_n)[group]] = self.b + behind
        ends = np.cumsum(self.n_a + self.n_b)
        return [
            hashlib.sha256(b"".join(map(self.sides.written.__getitem__, codes[end - n : end].tolist()))[:-1]).hexdigest() if n else ""
            for end, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist())
        ]


def _portions(rows: Iterable[tuple], most: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) of about so much text each; a longer text is one of its own or ends one."""
    ids, texts, size = [], [], 0
    for doc, text in rows:
        ids.append(doc)
        texts.append(text)
        size += 64 + len(text or "")
        if size >= most:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"]):
            yield doc.as_py(), text.as_py()


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def groups(documents: DataFrame, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """The alignment itself, one row per document: doc_id, a_ids, b_ids, groups, overlaps.

    A group names its first and last token on either side; ``overlaps`` has for each
    token of a the first and last token of b that share bytes with it. All places count
    from 0. ``ranks``, ``pieces``: vocabulary files that every executor has; unset, the
    public ones. Texts as in ``align``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(ranks, pieces)
        ints = pa.int32()
        for ids, texts in _portions(_rows(batches), STEP_BYTES):
            x = Aligned(sides, texts)
            n = np.bincount(x.doc, minlength=len(ids))
            a_base, b_base = np.cumsum(x.n_a) - x.n_a, np.cumsum(x.n_b) - x.n_b
            a, b = x.a_first - a_base[x.doc], x.b_first - b_base[x.doc]
            parts = dict(a_first=a, a_last=a + x.a_n - 1, b_first=b, b_last=b + x.b_n - 1)
            cuts = pa.array(np.concatenate([[0], np.cumsum(n)]), ints)
            own = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays([pa.array(v, ints) for v in parts.values()], list(parts)))
            base = np.repeat(b_base, x.n_a)
            met = pa.StructArray.from_arrays([pa.array(v - base, ints) for v in x.overlaps()], ["b_first", "b_last"])
            met = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(x.n_a)]), ints), met)
            columns = [pa.array(ids, pa.int64()), _lists(x.a, x.n_a, ints), _lists(x.b, x.n_b, ints), own, met]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_ids", "b_ids", "groups", "overlaps"])

    return _documents(documents).mapInArrow(work, GROUPS)


def _chunks(documents: DataFrame, ranks: str | None, pieces: str | None, chunk_bytes: int) -> DataFrame:
    """One row per document: its chunk, its numbers, and where its own pairs stand among the
    chunk's. A chunk's first row has its distinct id pairs with the documents that hold each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(ranks, pieces)
        first = TaskContext.get().partitionId() << 33
        for chunk, (ids, texts) in enumerate(_portions(_rows(batches), chunk_bytes), first):
            parts, done = [], 0
            for _, some in _portions(enumerate(texts), STEP_BYTES):
                x = Aligned(sides, some)
                doc, pair, times = x.links()
                n_groups = np.bincount(x.doc, minlength=len(some))
                n_links = np.bincount(x.doc, x.a_n * x.b_n, len(some)).astype(np.int64)
                parts.append((doc + done, pair, times, x.n_a, x.n_b, n_groups, n_links, x.digests()))
                done += len(some)
            doc, pair, times, n_a, n_b, n_groups, n_links, digests = map(np.concatenate, zip(*parts))
            distinct, at, holders = np.unique(pair, return_inverse=True, return_counts=True)
            own = np.bincount(doc, minlength=len(ids))
            head = np.where(np.arange(len(ids)) == 0, len(distinct), 0)
            columns: dict[str, pa.Array] = {
                "chunk": pa.repeat(pa.scalar(chunk, pa.int64()), len(ids)),
                "pairs": _lists(distinct, head, pa.int64()), "holders": _lists(holders, head, pa.int32()),
                "doc_id": pa.array(ids, pa.int64()), "n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()),
                "n_groups": pa.array(n_groups, pa.int64()), "n_links": pa.array(n_links, pa.int64()),
                "groups_sha256": pa.array(digests.tolist(), pa.string()),
                "at": _lists(at, own, pa.int32()), "times": _lists(times, own, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return _documents(documents).mapInArrow(work, _CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold each linked id pair, and whether no other pair of its a has more."""
    rows = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select("p.*")
    counts = rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").cast("bigint").alias("count"))
    # one id meets at most as many others as the other vocabulary has
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", ID_BITS)))
    return counts.withColumn("best", F.col("count") == most)


def _summed(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Results of a chunk's documents, from the sums found for its pairs."""
    own = docs["at"].combine_chunks()
    owner = np.repeat(np.arange(docs.num_rows), own.value_lengths().to_numpy(zero_copy_only=False))
    at = own.flatten().to_numpy(zero_copy_only=False)
    times = docs["times"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    result = {name: docs[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    for name, source in (("n_best", "best"), ("count_sum", "count")):
        value, total = np.zeros(found.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        value[found["place"].to_numpy()] = found[source].to_numpy()
        np.add.at(total, owner, times * value[at])
        result[name] = pa.array(total)
    return pa.table(result | {"groups_sha256": docs["groups_sha256"]})


def align(documents: DataFrame, ranks: str | None = None, pieces: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts whose tokens do not give back their bytes, have no
    tokens: zeros and an empty digest. Repeated rows and rows without a doc_id are each
    a document of their own and count as such. Ties for an id's commonest partner are all
    best. A text of any length is aligned whole, in one task. An empty table gives no
    row; further columns are ignored.
    """
    chunks = settle(_chunks(documents, ranks, pieces, chunk_bytes), "chunks")
    counts = settle(pair_counts(chunks), "pair-counts")
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    found = asked.join(counts, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    # a chunk's rows are bounded by its text
    tasks = max(1, -(-chunks.select("chunk").distinct().count() // CHUNKS_PER_TASK))
    kept = chunks.drop("pairs", "holders").repartition(tasks, "chunk")
    return kept.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(_summed, _RESULT)
