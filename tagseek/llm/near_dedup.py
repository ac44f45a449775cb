"""Near duplicates by SetSketch registers, verified on full shingle sets.

* A text's set: its distinct runs of five words. Texts of one set are one class.
* Every class gets a SetSketch: per register the minimum of exponentially
  distributed hashes, truncated to a level of an exponential scale. Sketches of
  parts merge by taking maxima; equal levels tell of similar sets.
* Bands of registers make buckets. Every bucket member meets the bucket's first
  member; pairs whose joint likelihood puts the similarity far below the limit
  are left out, the others are verified on full sets.
* Members of one bucket that are still in different components are then compared
  in blocks until no link between different components is unknown. So a bucket
  costs its size, plus what does not hang together, and loses no link.

Leaders with many members are salted, and buckets are cut into blocks, so no
group has to fit a task. Only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from . import bytewords as bw
from .components import connected_components, former_ids, own_ids

SHINGLE = 5
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE = 1.001
RATE = 20.0
LEVELS = 65_534
#: Percent of the union that a link's intersection has at least.
PERCENT = 75
#: Pairs whose likeliest similarity is this much below the limit are not linked:
#: six standard errors of 128 registers.
MARGIN = 0.24
#: Members of one leader, and of a bucket's block, that a task reads together.
GROUP = 4096
BLOCK = 512

_GAP = bw.byte_class((9, 13), (32, 32))
_KIND = (~_GAP).astype(np.uint8)
_seeds = np.random.default_rng(20_240_601)
_XOR = _seeds.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_TIMES = _seeds.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def shingles(piece: bw.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): shingles of text i are hashes[bounds[i]:bounds[i + 1]], repeats included."""
    data = bw.LOWER[piece.data]
    found = bw.runs(piece, _KIND[data])
    word = bw.span_hash(bw.prefix_hash(data), found.start, found.end)
    bounds = bw.row_bounds(found.row, len(piece))
    n = np.diff(bounds)
    made = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    first = np.repeat(bounds[:-1], made) + (np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made))
    size = np.repeat(np.minimum(n, SHINGLE), made)
    out = size.astype(np.uint64)
    for k in range(SHINGLE):
        inside = size > k
        at = np.minimum(first + k, max(len(word) - 1, 0))
        out = np.where(inside, bw.mix(out * np.uint64(31) + (word[at] if len(word) else 0)), out)
    return out, np.concatenate([[0], np.cumsum(made)])


def sets(piece: bw.Slice) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found, bounds = shingles(piece)
    for a, b in zip(bounds, bounds[1:]):
        yield np.unique(found[a:b])


def levels(least: np.ndarray) -> np.ndarray:
    """Register levels of the least 32-bit hashes: an exponential scale of their exponentials."""
    u = (least.astype(np.float64) + 0.5) / 2.0**32
    x = -np.log1p(-u) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LEVELS + 1).astype(np.uint16)


def registers(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, registers) levels; texts without shingles keep level 0."""
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        x = (found >> np.uint64(32)).astype(np.uint32)
        least = np.empty((len(full), REGISTERS), np.uint32)
        buffer = np.empty_like(x)
        for j in range(REGISTERS):
            np.bitwise_xor(x, _XOR[j], out=buffer)
            np.multiply(buffer, _TIMES[j], out=buffer)
            least[:, j] = np.minimum.reduceat(buffer, bounds[:-1][full])
        out[full] = levels(least)
    return out


def likeliest(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """The similarity of each pair of sketches that makes their register order likeliest."""
    more, less = (left > right).sum(axis=1), (left < right).sum(axis=1)
    same = left.shape[1] - more - less
    u, v = n_left / (n_left + n_right), n_right / (n_left + n_right)
    grid = np.linspace(0, 1, 51)[None, :] * (np.minimum(u / v, v / u) * (1 - 1e-9))[:, None]

    def ahead(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = ahead(u[:, None] - v[:, None] * grid), ahead(v[:, None] - u[:, None] * grid)
    likelihood = more[:, None] * np.log(p) + less[:, None] * np.log(q) + same[:, None] * np.log(np.maximum(1 - p - q, 1e-12))
    return grid[np.arange(len(grid)), likelihood.argmax(axis=1)]


def sketch(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sum, xor, bands, registers); the sums identify the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bw.slices(batch["text"]):
                found, bounds = shingles(piece)
                made = registers(found, bounds)
                n, total, odd = np.zeros(len(piece), np.int64), np.zeros(len(piece), np.uint64), np.zeros(len(piece), np.uint64)
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own = np.unique(found[a:b])
                    n[i] = len(own)
                    if len(own):
                        total[i] = own.sum()
                        odd[i] = np.bitwise_xor.reduce(bw.mix(own ^ np.uint64(0x5851F42D4C957F2D)))
                keys = made[:, 0::ROWS].astype(np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(1 << 20)
                for k in range(1, ROWS):
                    keys = bw.mix(keys) + made[:, k::ROWS]
                keys = bw.mix(keys).view(np.int64)
                bands = pa.ListArray.from_arrays(np.arange(len(piece) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
                own = [batch["doc_id"].slice(piece.low, len(piece)), pa.array(n), pa.array(total.view(np.int64)), pa.array(odd.view(np.int64)), bands, pa.array([r.tobytes() for r in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(own, ["doc_id", "n_shingles", "sum", "xor", "bands", "registers"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, sum bigint, xor bigint, bands array<bigint>, registers binary"
    )


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (leader, member) whose likeliest similarity is not far below the limit."""
    left = sketches.select(F.col("rep").alias("leader"), F.col("registers").alias("left"), F.col("n_shingles").alias("n_left"))
    right = sketches.select(F.col("rep").alias("member"), F.col("registers").alias("right"), F.col("n_shingles").alias("n_right"))
    joined = pairs.join(right, "member").join(left, "leader")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("left", "right"))
                n = [batch[c].to_numpy().astype(float) for c in ("n_left", "n_right")]
                batch = batch.filter(pa.array(likeliest(a, b, *n) >= PERCENT / 100 - MARGIN))
            yield batch.select(["leader", "member"])

    return joined.mapInArrow(keep, "leader bigint, member bigint")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough; exact."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    common = int((a[at] == b).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _grouped(rows: DataFrame, keys: list[str], order: list[str], work, schema: str) -> DataFrame:
    """Bring rows of a key together, and stream them through ``work`` in order."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(work, schema)


def _stars(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links (a, b) among (leader, member) pairs."""
    salts = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("salts"))
    members = pairs.join(salts, "leader").withColumn("salt", F.pmod(F.xxhash64("member"), F.col("salts")).cast("int"))
    members = members.select("leader", "salt", F.col("member").alias("rep"))
    heads = salts.select("leader", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("leader").alias("rep"))
    rows = members.unionByName(heads).join(texts, "rep").select("leader", "salt", "rep", (F.col("rep") != F.col("leader")).alias("later"), "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, leader = np.zeros(0, np.uint64), None
        for batch in batches:
            leaders, reps = batch["leader"].to_pylist(), batch["rep"].to_pylist()
            found = []
            for piece in bw.slices(batch["text"]):
                for i, own in enumerate(sets(piece), piece.low):
                    if reps[i] == leaders[i]:
                        head, leader = own, leaders[i]
                    elif leader == leaders[i] and linked(head, own):
                        found.append((leader, reps[i]))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return _grouped(rows, ["leader", "salt"], ["later"], verify, "a bigint, b bigint")


def _unsettled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(bucket, rep, component, main) of buckets that hold several components.

    A bucket of two was settled by its one pair; buckets of equal members count once.
    """
    named = members.join(parts.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sized = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("mark"))
    mixed = sized.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.sum("mark").alias("mark"), F.max(F.struct("n", "component")).alias("largest")
    )
    mixed = mixed.where((F.col("parts") > 1) & (F.col("n") > 2))
    once = mixed.groupBy("n", "mark").agg(F.min_by(F.struct("bucket", "largest", "n"), "bucket").alias("one"))
    chosen = once.select("one.bucket", F.col("one.largest.component").alias("main"), F.col("one.n").alias("size"), F.col("one.largest.n").alias("held"))
    return named.join(chosen, "bucket")


def _rest_links(unsettled: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components of a bucket, one per text and component at least."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rest_blocks = F.ceil((F.col("size") - F.col("held")) / BLOCK).cast("int")
    is_rest = F.col("component") != F.col("main")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    own_rest = F.pmod(F.xxhash64("rep", F.lit(1)), rest_blocks).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    members = unsettled.select("bucket", "rep", "component", F.lit(False).alias("asks"), own.alias("block"), F.explode(every(rest_blocks)).alias("part"))
    asking = unsettled.where(is_rest).select("bucket", "rep", "component", F.lit(True).alias("asks"), F.explode(every(blocks)).alias("block"), own_rest.alias("part"))
    rows = members.unionByName(asking).join(texts, "rep").select("bucket", "block", "part", "asks", "rep", "component", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            links = _compare_block(held)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch[c].to_pylist() for c in ("bucket", "block", "part"))))
            asks, reps, parts = (batch[c].to_pylist() for c in ("asks", "rep", "component"))
            for piece in bw.slices(batch["text"]):
                for i, own in enumerate(sets(piece), piece.low):
                    if keys[i] != key:
                        if held:
                            yield done()
                        key, held = keys[i], []
                    held.append((asks[i], reps[i], parts[i], own))
        if held:
            yield done()

    return _grouped(rows, ["bucket", "block", "part"], ["asks"], compare, "a bigint, b bigint")


def _compare_block(held: list[tuple[bool, int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """One link per asking text and other component, from common counts over an inverted list."""
    members = [h for h in held if not h[0]]
    if not members:
        return []
    size = np.array([len(h[3]) for h in members])
    part = np.array([h[2] for h in members])
    shingle = np.concatenate([h[3] for h in members])
    owner = np.repeat(np.arange(len(members)), size)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    links = []
    for _, rep, own_part, own in (h for h in held if h[0]):
        low, high = np.searchsorted(shingle, own, "left"), np.searchsorted(shingle, own, "right")
        n = high - low
        at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        common = np.bincount(owner[at], minlength=len(members))
        near = np.flatnonzero((100 * common >= PERCENT * (size + len(own) - common)) & (part != own_part) & (common > 0))
        _, first = np.unique(part[near], return_index=True)
        links += [(rep, members[j][1]) for j in near[first]]
    return links


def groups(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null and empty texts, and texts without a word, have no shingle and are linked
    with nothing; texts of fewer than five words have one, the whole sequence.
    Rows that repeat a doc_id are documents of their own. A null doc_id names a
    component (as null) only where no other does, and is never kept. An empty table
    gives no row; further columns are ignored.
    """
    rows, names = own_ids(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id")
    found = former_ids(_components(rows), names, "doc_id")
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents with distinct ids."""
    sketches = settle(sketch(documents), "sketches")
    full = sketches.where("n_shingles > 0")
    classes = settle(
        full.groupBy("n_shingles", "sum", "xor").agg(F.min_by(F.struct("doc_id", "bands", "registers"), "doc_id").alias("one"))
        .select("n_shingles", "sum", "xor", F.col("one.doc_id").alias("rep"), "one.bands", "one.registers"),
        "classes",
    )
    spread = classes.select("rep", F.explode("bands").alias("bucket"))
    sized = spread.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = settle(spread.join(sized.select("bucket", "leader"), "bucket"), "members")
    pairs = members.where("rep <> leader").select("leader", F.col("rep").alias("member")).distinct()
    likely = settle(_likely(pairs, classes), "likely")
    wanted = members.select("rep").distinct()
    texts = documents.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(wanted, "rep", "left_semi")
    stars = settle(_stars(likely, texts), "links")
    unsettled = settle(_unsettled(members.select("bucket", "rep"), connected_components(stars)), "unsettled")
    links = stars.unionByName(_rest_links(unsettled, texts))
    parts = connected_components(links)
    named = classes.select("n_shingles", "sum", "xor", "rep").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("n_shingles", "sum", "xor", F.coalesce("component", "rep").alias("component_id"))
    found = sketches.select("doc_id", "n_shingles", "sum", "xor").join(named, ["n_shingles", "sum", "xor"], "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
