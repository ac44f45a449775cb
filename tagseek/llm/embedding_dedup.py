"""Near-duplicate embeddings: a navigable small-world graph per shard.

* Equal vectors are one class. Classes are dealt to shards of bounded size, and
  each shard's task builds a hierarchical navigable small-world graph.
* An audit in every shard compares beam searches with brute force and widens the
  beam until the recall is met; past ``WIDEST`` that shard is scanned instead.
* Every vector queries every shard. A graph travels in small rows to a few tasks,
  whatever the number of vectors, and their queries stream by it. A beam full of links is doubled,
  and past ``WIDEST`` its vector scans the shard, so no number of links is a limit. Cosines of hits are verified in
  double precision, and so are those of the graph's own edges. A task hands on
  a spanning forest of its links, not all of them.
* Links are joined to components; within a component, blocks of vectors are
  compared so that every member gets its exact number of links there. Blocks
  stay in their task: no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .components import connected_components, former_ids, own_ids

COSINE = 0.95
#: Vectors of a shard, fewest queries that a copy of a graph is made for, and vectors of a compared block.
SHARD = 65_536
QUERIES = 8_192
BLOCK = 2_048
#: Points of a graph in one row.
PIECE = 1_024
#: Copies of graphs for each core of the session.
COPIES = 4
DEGREE = 16
BUILD_BEAM = 48
BEAM = 32
WIDEST = 512
RECALL = 0.97
AUDIT = 200
_SLACK = 1e-4
_STEP = 512
#: Queries scanned at once.
_SCAN = 128


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _table_vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """(n, dimensions) doubles of an array column of equal lengths."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


class Graph:
    """Unit vectors, and the neighbours of each one on each level (-1: none)."""

    def __init__(self, points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.points = points
        #: from the base up: members, and their neighbours by place in ``points``
        self.levels = levels or []

    @classmethod
    def build(cls, points: np.ndarray, seed: int = 7) -> Graph:
        """Insert in random order, in batches that at most double the graph."""
        graph = cls(points)
        n = len(points)
        random = np.random.default_rng(seed)
        height = np.minimum(np.floor(-np.log(1 - random.random(n)) / np.log(DEGREE)).astype(int), 6)
        members = np.arange(n)
        above: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(int(height.max(initial=0)), -1, -1):
            members = np.flatnonzero(height >= level)
            width = 2 * DEGREE if level == 0 else DEGREE
            above = [(members, graph._layer(random.permutation(members), width, above)), *above]
        graph.levels = above
        return graph

    def _layer(self, order: np.ndarray, width: int, above: list) -> np.ndarray:
        """Neighbours of every point on one level; rows of points not on it stay -1."""
        near = np.full((len(self.points), width), -1, np.int32)
        done = 0
        while done < len(order):
            size = min(len(order) - done, max(256, done), 2048)
            batch = order[done : done + size]
            found = [np.stack([self._top(self.points[batch] @ self.points[batch].T, batch, 32)], 0)[0]]
            if done:
                starts = self.descend(self.points[batch], above) if above else None
                if starts is None or done <= 256:
                    starts = np.repeat(order[: min(done, 4)][None], size, axis=0)
                else:
                    starts = np.concatenate([starts, np.repeat(order[:1][None], size, axis=0)], axis=1)
                    starts = np.where((near[starts] >= 0).any(axis=2), starts, order[0])
                found.append(self.search(self.points[batch], near, starts, BUILD_BEAM)[0])
            pool = np.concatenate(found, axis=1)
            pool = np.where(pool == batch[:, None], -1, pool)
            near[batch] = self._diverse(batch, pool, width)
            self._link_back(near, batch, width)
            done += size
        return near

    @staticmethod
    def _top(sims: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        np.fill_diagonal(sims, -2)
        k = min(k, sims.shape[1])
        return ids[np.argpartition(-sims, k - 1, axis=1)[:, :k]]

    def _diverse(self, owners: np.ndarray, pool: np.ndarray, width: int) -> np.ndarray:
        """Of each owner's pool, nearest first, those nearer to it than to any chosen one.

        Free places go to the nearest of the others.
        """
        out = np.full((len(owners), width), -1, np.int32)
        for a in range(0, len(owners), _STEP):
            own, ids = owners[a : a + _STEP], pool[a : a + _STEP]
            sims = np.where(ids >= 0, np.einsum("bd,bcd->bc", self.points[own], self.points[ids]), -3)
            order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * width]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            repeat = (ids[:, :, None] == ids[:, None, :]) & np.tri(ids.shape[1], k=-1, dtype=bool)
            good = (ids >= 0) & ~repeat.any(axis=2)
            vectors = self.points[ids]
            cross = np.matmul(vectors, vectors.transpose(0, 2, 1))
            chosen = np.zeros(ids.shape, bool)
            for c in range(ids.shape[1]):
                blocked = (chosen & (cross[:, c] > sims[:, c : c + 1])).any(axis=1)
                chosen[:, c] = good[:, c] & ~blocked & (chosen.sum(axis=1) < width)
            rank = np.where(chosen, 0, np.where(good, 1, 2))
            best = np.argsort(rank, axis=1, kind="stable")[:, :width]
            keep = np.take_along_axis(np.where(good, ids, -1), best, 1)
            out[a : a + len(own), : keep.shape[1]] = keep
        return out

    def _link_back(self, near: np.ndarray, batch: np.ndarray, width: int) -> None:
        source, target = np.repeat(batch, near.shape[1]), near[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        owners, first, n = np.unique(target, return_index=True, return_counts=True)
        limit = 4 * width
        pool = np.full((len(owners), near.shape[1] + limit), -1, np.int64)
        pool[:, : near.shape[1]] = near[owners]
        place = np.arange(len(source)) - np.repeat(first, n)
        row = np.repeat(np.arange(len(owners)), n)
        fits = place < limit
        pool[row[fits], near.shape[1] + place[fits]] = source[fits]
        near[owners] = self._diverse(owners, pool, width)

    def descend(self, queries: np.ndarray, levels: list | None = None) -> np.ndarray:
        """Entry points from the upper levels: (queries, 1)."""
        upper = self.levels[1:] if levels is None else levels
        if not upper:
            first = self.levels[0][0][:1]
            return np.repeat(first[None], len(queries), axis=0)
        top = upper[-1][0]
        at = top[(queries @ self.points[top].T).argmax(axis=1)][:, None] if len(top) <= 4096 else np.repeat(top[:1][None], len(queries), axis=0)
        for _, near in reversed(upper):
            at = self.search(queries, near, at, 4)[0][:, :1]
        return at

    def search(self, queries: np.ndarray, near: np.ndarray, starts: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the beam's nearest points, for all queries in step."""
        ids = np.full((len(queries), beam), -1, np.int64)
        sims = np.full((len(queries), beam), -2, self.points.dtype)
        for a in range(0, len(queries), _STEP):
            ids[a : a + _STEP], sims[a : a + _STEP] = self._beam(queries[a : a + _STEP], near, starts[a : a + _STEP], beam)
        return ids, sims

    def _beam(self, queries, near, starts, beam):
        rows = np.arange(len(queries))
        seen = np.zeros((len(queries), len(self.points)), bool)
        ids = np.full((len(queries), beam), -1, np.int64)
        sims = np.full((len(queries), beam), -2, self.points.dtype)
        opened = np.ones((len(queries), beam), bool)
        fresh = starts.astype(np.int64)
        fresh = np.where((np.sort(fresh, 1)[:, 1:] == np.sort(fresh, 1)[:, :-1]).any(1, keepdims=True) if fresh.shape[1] > 1 else False, np.where(np.arange(fresh.shape[1]) == 0, fresh, -1), fresh)
        active = rows
        while len(active):
            new = fresh >= 0
            new &= ~seen[active[:, None], np.maximum(fresh, 0)]
            seen[np.broadcast_to(active[:, None], fresh.shape)[new], fresh[new]] = True
            got = np.full(fresh.shape, -2, self.points.dtype)
            r, c = np.nonzero(new)
            got[r, c] = np.einsum("nd,nd->n", queries[active[r]], self.points[fresh[r, c]])
            all_ids = np.concatenate([ids[active], np.where(new, fresh, -1)], axis=1)
            all_sims = np.concatenate([sims[active], got], axis=1)
            all_open = np.concatenate([opened[active], ~new], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            opened[active] = np.take_along_axis(all_open, best, 1)
            active = active[(~opened[active]).any(axis=1)]
            if not len(active):
                break
            steps = []
            for _ in range(2):  # the two best that were not opened yet
                shut = ~opened[active]
                first = shut.argmax(axis=1)
                some = shut[np.arange(len(active)), first]
                node = np.where(some, ids[active, first], -1)
                opened[active, first] = True
                steps.append(np.where(node[:, None] >= 0, near[np.maximum(node, 0)], -1))
            fresh = np.concatenate(steps, axis=1)
            order = np.argsort(fresh, axis=1)
            ranked = np.take_along_axis(fresh, order, 1)
            ranked[:, 1:][ranked[:, 1:] == ranked[:, :-1]] = -1
            fresh = ranked
        return ids, sims

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return self.search(queries, self.levels[0][1], self.descend(queries), beam)

    def pack(self) -> Iterator[tuple[bytes, bytes, bytes]]:
        """Rows of (points, their neighbours on the base, upper levels), ``PIECE`` points each; the first has the upper levels."""
        upper = [np.column_stack([m, near[m]]).astype(np.int32).tobytes() for m, near in self.levels[1:]]
        ends = np.cumsum([len(x) for x in upper], dtype=np.int32)
        packed = np.int32(len(upper)).tobytes() + ends.tobytes() + b"".join(upper)
        base = self.levels[0][1].astype(np.int32)
        for a in range(0, len(base), PIECE):
            yield self.points[a : a + PIECE].tobytes(), base[a : a + PIECE].tobytes(), packed if a == 0 else b""

    @classmethod
    def unpack(cls, points: np.ndarray, base: bytes, packed: bytes) -> Graph:
        n = int(np.frombuffer(packed, np.int32, 1)[0])
        ends = np.frombuffer(packed, np.int32, n, 4)
        body = packed[4 + 4 * n :]
        levels = [(np.arange(len(points)), np.frombuffer(base, np.int32).reshape(len(points), -1))]
        for low, high in zip([0, *ends[:-1].tolist()], ends.tolist()):
            rows = np.frombuffer(body[low:high], np.int32).reshape(-1, DEGREE + 1)
            near = np.full((len(points), DEGREE), -1, np.int32)
            near[rows[:, 0]] = rows[:, 1:]
            levels.append((rows[:, 0].astype(np.int64), near))
        return cls(points, levels)


def linked(graph: Graph, queries: np.ndarray, exact: np.ndarray, beam: int, cosine: float, widest: int = WIDEST) -> Iterator[tuple[int, np.ndarray]]:
    """(place of a query, places of the points linked with it), for all queries.

    A beam whose last entry still is linked may have left out others, and one
    that could not be filled met a part of the graph that leads nowhere else: it
    is doubled for that query, and past ``widest`` the query scans all points.
    Beam 0 scans for all. Links are verified in double precision.
    """
    for a in range(0, len(queries), _STEP):
        part = queries[a : a + _STEP]
        left, width = np.arange(len(part)), beam
        while len(left) and 0 < width <= widest and width < len(exact):
            near, sims = graph.nearest(part[left].astype(np.float32), width)
            full = (sims[:, -1] >= cosine - _SLACK) | (near[:, -1] < 0)
            row, col = np.nonzero((sims >= cosine - _SLACK) & ~full[:, None])
            at = near[row, col]
            good = np.einsum("nd,nd->n", part[left[row]], exact[at]) >= cosine
            row, at = row[good], at[good]
            ends = np.searchsorted(row, np.arange(len(left) + 1))
            for k in np.flatnonzero(~full):
                yield a + int(left[k]), at[ends[k] : ends[k + 1]]
            left, width = left[full], 2 * width
        for b in range(0, len(left), _SCAN):
            for k, row in zip(left[b : b + _SCAN], part[left[b : b + _SCAN]] @ exact.T >= cosine):
                yield a + int(k), np.flatnonzero(row)


def _recall(found: list[np.ndarray], wanted: list[np.ndarray]) -> float:
    """Share of the wanted links that were found: of all, or the mean of the queries, whichever is lower."""
    hits = np.array([len(np.intersect1d(f, w)) for f, w in zip(found, wanted)])
    sizes = np.array([len(w) for w in wanted])
    return float(min(hits.sum() / sizes.sum(), (hits / sizes).mean())) if len(sizes) else 1.0


def audit(graph: Graph, cosine: float, recall: float = RECALL, widest: int = WIDEST) -> tuple[int, float]:
    """(beam, recall): the first beam that finds enough links, by brute force, of a sample.

    Asked are points that are linked with others, sought by brute force in random
    order until there are ``AUDIT`` or no more; that a point finds itself does not
    count. Points turned as far away as a link reaches have a recall of their own.
    Both must be met. Beam 0 means that no beam up to ``widest`` does: scan.
    """
    random = np.random.default_rng(3)
    order = random.permutation(len(graph.points))
    chosen = graph.points[order[:AUDIT]].astype(np.float64)
    aside = random.normal(size=chosen.shape)
    aside -= (aside * chosen).sum(axis=1, keepdims=True) * chosen
    aside /= np.maximum(np.sqrt((aside * aside).sum(axis=1, keepdims=True)), 1e-12)
    reach = min(cosine + 1e-5, 1.0)
    turned = _unit(reach * chosen + np.sqrt(1 - reach * reach) * aside)
    exact = graph.points.astype(np.float64)
    own: list[int] = []
    partners: list[np.ndarray] = []
    for a in range(0, len(order), _SCAN):
        block = order[a : a + _SCAN]
        near = graph.points[block] @ graph.points.T >= cosine - _SLACK
        near[np.arange(len(block)), block] = False
        for k in np.flatnonzero(near.any(axis=1)):
            at = np.flatnonzero(near[k])
            at = at[exact[at] @ exact[block[k]] >= cosine]
            if len(at) and len(own) < AUDIT:
                own.append(int(block[k]))
                partners.append(at)
        if len(own) >= AUDIT:
            break
    sources = [np.flatnonzero(row >= cosine) for row in turned @ exact.T]
    asked = np.concatenate([exact[own], turned])
    beam = BEAM
    while beam <= widest:
        found = [at for _, at in sorted(linked(graph, asked, exact, beam, cosine, widest), key=lambda x: x[0])]
        got = min(_recall(found[: len(own)], partners), _recall(found[len(own) :], sources))
        if got >= recall:
            return beam, got
        beam *= 2
    return 0, 1.0


class Joined:
    """What a task's links join, as labels of its points; hands on the links that join something.

    A query hands on one link to each label that its links reach, so a dense group
    costs its members one link each.
    """

    def __init__(self, n: int):
        self.label = np.arange(n)

    def links(self, at: np.ndarray) -> np.ndarray:
        """Those of a query's linked points that it hands on."""
        label = self.label[at]
        if not len(at) or (label == label[0]).all():
            return at[:1]
        labels, first = np.unique(label, return_index=True)
        self.label[np.isin(self.label, labels)] = labels[0]
        return at[first]


class Forest:
    """Of all links added, those that join what all of them join."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.a: list[int] = []
        self.b: list[int] = []

    def _root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self._root(x), self._root(y)
            if p != q:
                self.up[max(p, q)] = min(p, q)
                self.a.append(x)
                self.b.append(y)

    def edges(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.a, pa.int64()), pa.array(self.b, pa.int64())], ["a", "b"])


_GRAPH = "shard int, beam int, piece int, ids binary, points binary, base binary, upper binary"


def build_graphs(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """classes(shard, rep, vector) -> the rows of one graph per shard, with its audited beam."""
    schema = pa.schema([("shard", pa.int32()), ("beam", pa.int32()), ("piece", pa.int32()), *((c, pa.binary()) for c in ("ids", "points", "base", "upper"))])

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        points = _unit(_table_vectors(table["vector"], table.num_rows))
        graph = Graph.build(points.astype(np.float32))
        beam, _ = audit(graph, cosine)
        graph.points = points  # handed on in double precision
        ids, shard = table["rep"].to_numpy().astype(np.int64), table["shard"][0].as_py()
        rows = [(shard, beam, k, ids[k * PIECE : (k + 1) * PIECE].tobytes(), *parts) for k, parts in enumerate(graph.pack())]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return classes.select("shard", "rep", "vector").groupBy("shard").applyInArrow(build, _GRAPH)


class Searched:
    """One copy of a graph, put together from its rows, and what its queries found."""

    def __init__(self, part: int, rows: list[dict], cosine: float):
        ids, points, base, upper = (b"".join(r[c] for r in rows) for c in ("ids", "points", "base", "upper"))
        self.part, self.beam, self.cosine = part, rows[0]["beam"], cosine
        self.ids = np.frombuffer(ids, np.int64)
        self.exact = np.frombuffer(points, np.float64).reshape(len(self.ids), -1)
        self.graph = Graph.unpack(self.exact.astype(np.float32), base, upper)
        self.joined, self.forest = Joined(len(self.ids)), Forest()

    def ask(self, reps: np.ndarray, queries: np.ndarray) -> None:
        for k, at in linked(self.graph, queries, self.exact, self.beam, self.cosine):
            at = self.joined.links(at)
            self.forest.add(np.repeat(reps[k], len(at)), self.ids[at])

    def edges(self) -> pa.RecordBatch:
        if self.part == 0:  # the graph's own edges, once for each shard
            base = self.graph.levels[0][1]
            row, col = np.nonzero(base >= 0)
            at = base[row, col]
            for a in range(0, len(row), 1 << 16):
                r, t = row[a : a + (1 << 16)], at[a : a + (1 << 16)]
                near = np.einsum("nd,nd->n", self.exact[r], self.exact[t]) >= self.cosine
                self.forest.add(self.ids[r[near]], self.ids[t[near]])
        return self.forest.edges()


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """((shard, part), rows of a graph?, rows) in turn."""
    for batch in batches:
        shard, part = batch["shard"].to_numpy(), batch["part"].to_numpy()
        of_graph = batch["piece"].is_valid().to_numpy(zero_copy_only=False)
        new = (np.diff(shard) != 0) | (np.diff(part) != 0) | (np.diff(of_graph.astype(int)) != 0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield (int(shard[a]), int(part[a])), bool(of_graph[a]), batch.slice(a, b - a)


def find_links(classes: DataFrame, graphs: DataFrame, shards: dict[int, tuple[int, int]], parts: int, cosine: float = COSINE) -> DataFrame:
    """A forest (a, b) of the links that queries and graph edges find, per copy of a graph.

    ``shards``: for each dimension, the first of its shards and their number. ``parts``:
    copies of each graph, which share the queries.
    """
    own = F.pmod(F.xxhash64("rep", F.lit(5)), F.lit(parts)).cast("int").alias("part")
    first = F.create_map(*[F.lit(x) for d, (a, _) in shards.items() for x in (d, a)])[F.size("vector")]
    count = F.create_map(*[F.lit(x) for d, (_, n) in shards.items() for x in (d, n)])[F.size("vector")]
    asked = classes.select("rep", "vector", own, F.explode(F.sequence(first, first + count - 1)).alias("shard"))
    copies = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    rows = copies.unionByName(asked, allowMissingColumns=True)
    total = sum(n for _, n in shards.values()) * parts
    placed = rows.repartitionById(total, (F.col("shard") * parts + F.col("part")).cast("int"))
    placed = placed.sortWithinPartitions("shard", "part", F.col("piece").asc_nulls_last())

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, at_hand = None, [], None
        for now, of_graph, rows in _runs(batches):
            if now != key:
                if at_hand or pieces:
                    yield (at_hand or Searched(key[1], pieces, cosine)).edges()
                key, pieces, at_hand = now, [], None
            if of_graph:
                pieces += rows.select(["beam", "ids", "points", "base", "upper"]).to_pylist()
            else:
                at_hand = at_hand or Searched(key[1], pieces, cosine)
                pieces = []
                vectors = _unit(_table_vectors(pa.chunked_array([rows["vector"]]), rows.num_rows))
                at_hand.ask(rows["rep"].to_numpy().astype(np.int64), vectors)
        if at_hand or pieces:
            yield (at_hand or Searched(key[1], pieces, cosine)).edges()

    return placed.mapInArrow(query, "a bigint, b bigint")


def count_links(members: DataFrame, cosine: float = COSINE) -> DataFrame:
    """members(component, rep, vector, copies) -> (rep, n): vectors linked with rep, copies counted.

    Large components are cut into blocks, and each block meets every block.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asks = placed.select("component", F.col("own").alias("left"), every.alias("right"), F.lit(True).alias("asks"), "rep", "vector", "copies")
    answers = placed.select("component", every.alias("left"), F.col("own").alias("right"), F.lit(False).alias("asks"), "rep", "vector", "copies")
    rows = asks.unionByName(answers).repartition("component", "left", "right").sortWithinPartitions("component", "left", "right")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            asks, answers = [h for h in held if h[0]], [h for h in held if not h[0]]
            n = np.zeros(len(asks), np.int64)
            if asks and answers:
                left, right = (_unit(np.array([h[2] for h in part], np.float64)) for part in (asks, answers))
                n = ((left @ right.T) >= cosine) @ np.array([h[3] for h in answers], np.int64)
            return pa.RecordBatch.from_arrays([pa.array([h[1] for h in asks], pa.int64()), pa.array(n, pa.int64())], ["rep", "n"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("component", "left", "right", "asks", "rep", "vector", "copies"))):
                if row[:3] != key:
                    if held:
                        yield done()
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            yield done()

    return rows.mapInArrow(count, "rep bigint, n bigint").groupBy("rep").agg(F.sum("n").alias("n"))


def groups(embeddings: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD, query_rows: int = QUERIES) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing; so do vectors of different lengths. Equal vectors are linked,
    whatever their ids and labels. Rows that repeat a vec_id are vectors of their
    own; a null one names a component (as null) only where no other does. An empty table gives no row; further columns are ignored.
    """
    rows, names = own_ids(embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"), "vec_id")
    found = former_ids(_components(rows, cosine, shard_rows, query_rows), names, "vec_id")
    return found.select("vec_id", "n_links", "component_id", "kept")


def _components(embeddings: DataFrame, cosine: float, shard_rows: int, query_rows: int) -> DataFrame:
    """(vec_id, n_links, component_id) of vectors with distinct ids."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("vector", F.when(~F.coalesce(bad, F.lit(True)) & ~F.coalesce(zero, F.lit(True)), F.col("vector")))
    classes = rows.where(F.col("vector").isNotNull()).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = settle(classes, "classes")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each length of vector
    lone = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not sizes:
        return lone
    shards, total = {}, 0
    for dim, n in sorted(sizes.items()):
        shards[dim] = (total, -(-n // shard_rows))
        total += shards[dim][1]
    first = F.create_map(*[F.lit(x) for d, (a, _) in shards.items() for x in (d, a)])[F.size("vector")]
    count = F.create_map(*[F.lit(x) for d, (_, n) in shards.items() for x in (d, n)])[F.size("vector")]
    sharded = classes.withColumn("shard", (first + F.pmod(F.xxhash64("rep"), count)).cast("int"))
    graphs = settle(build_graphs(sharded, cosine), "graphs")
    # enough copies to keep all cores busy, however many vectors ask
    wanted = -(-COPIES * rows.sparkSession.sparkContext.defaultParallelism // total)
    copies = max(1, min(wanted, -(-sum(sizes.values()) // query_rows)))
    parts = settle(connected_components(find_links(classes, graphs, shards, copies, cosine)), "components")
    members = parts.withColumnRenamed("id", "rep").join(classes, "rep")
    counted = count_links(members, cosine)
    known = classes.join(parts.withColumnRenamed("id", "rep"), "rep", "left").join(counted, "rep", "left")
    known = known.select("vector", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("n", F.col("copies")) - 1).alias("n_links"))
    found = rows.join(known, "vector", "left")
    component = F.coalesce("component_id", "vec_id").alias("component_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component)
