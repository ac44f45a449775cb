"""A Merkle manifest of a dataset, with inclusion proofs by pointer jumping.

Rows are leaves. The leaves of a source, in the order of their ids, form a tree of
16-fold nodes; the sources' roots form another, whose top commits to the whole
dataset. Rows are numbered inside their source from range partitions and the
counts of each, so that neither a large source nor all sources meet in a task.

Every node but the top holds a pointer to an ancestor and the segment of siblings
on the way there. Joining the table with itself doubles the distance of all
pointers and puts the segments together, until each points at the top. Leaves take
part 16 at a time: the run they belong to fetches one segment for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle

FANOUT = 16
#: The tree that stands above the sources' trees; those are numbered from 0.
TOP = -1

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def record_hash(fields: dict[str, Column]) -> Column:
    """The digest of a row: each field as its UTF-8 byte count, a colon and its value, or ``-``."""

    def part(column: Column) -> Column:
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in fields.values()]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _SMALL)


def numbered(rows: DataFrame, group: str | None, order: list[str], label: str) -> DataFrame:
    """Add ``i``, each row's place in its group from 0, and ``n``, the group's rows.

    Range partitions put the rows in order; a row's place is its place in its
    partition, less where its group begins there, plus the group's rows in earlier
    partitions. Only those counts are put side by side. ``group`` null is a group.
    """
    keys = [*([group] if group else []), *order]
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # numbers of the sorted rows, partition by partition; written, so they stay
    placed = settle(spread.withColumn("_at", F.monotonically_increasing_id()), label)
    part, at = F.shiftright("_at", 33).alias("_part"), F.col("_at")
    mine = F.col(group) if group else F.lit(0)
    begun = placed.groupBy(mine.alias("_group"), part).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # one row per partition that a group reaches into
    group_rows = Window.partitionBy("_group")
    before = F.sum("_rows").over(group_rows.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    starts = begun.select("_group", "_part", "_first", before.alias("_before"), F.sum("_rows").over(group_rows).alias("n"))
    starts = settle(starts, f"{label}-starts")
    rows = placed.withColumns({"_group_": mine, "_part_": F.shiftright("_at", 33)})
    found = rows.join(starts, (F.col("_part_") == F.col("_part")) & F.col("_group_").eqNullSafe(F.col("_group")))
    return found.withColumn("i", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_group", "_group_", "_part", "_part_", "_first", "_before")


def _nodes(children: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Parents of a level's nodes, and its edges with the siblings left and right of each child.

    children(tree, i, n, hash) of trees that have several nodes on this level.
    """
    runs = children.groupBy("tree", F.floor(F.col("i") / FANOUT).alias("up"), "n").agg(F.sort_array(F.collect_list(F.struct("i", "hash"))).alias("kids"))
    runs = settle(runs, f"level-{level}")
    parents = runs.select(
        "tree", F.col("up").alias("i"), F.ceil(F.col("n") / FANOUT).alias("n"), F.sha2(F.array_join("kids.hash", ""), 256).alias("hash")
    )
    edges = runs.select("tree", "up", "n", "kids", F.posexplode("kids.i").alias("k", "i")).select(
        node(F.col("tree"), F.lit(level), F.col("i")).alias("node"),
        parent(F.col("tree"), F.lit(level + 1), F.col("up"), F.col("n") <= FANOUT).alias("up"),
        F.array(siblings(F.col("kids.hash"), F.col("k"))).alias("segment"),
    )
    return parents, edges


def siblings(hashes: Column, k: Column) -> Column:
    """The others of a run, left and right of its member ``k``."""
    return F.struct(
        F.array_join(F.slice(hashes, 1, k), "").alias("left"),
        F.array_join(F.slice(hashes, k + 2, F.lit(FANOUT)), "").alias("right"),
    )


def node(tree: Column, level: Column, i: Column) -> Column:
    return F.struct(tree.cast("bigint").alias("tree"), level.cast("int").alias("level"), i.cast("bigint").alias("i"))


def parent(tree: Column, level: Column, i: Column, last: Column) -> Column:
    """A source's root is a leaf of the top tree; ``last``: the parent is the root."""
    return F.when(last & (tree != TOP), node(F.lit(TOP), F.lit(0), tree)).otherwise(node(tree, level, i))


def _grow(nodes: DataFrame, level: int, most: int) -> tuple[DataFrame | None, list[DataFrame]]:
    """Roots (tree, hash) of all trees, and the edges below them, from ``level`` up."""
    roots, edges = [], []
    while True:
        roots.append(nodes.where(F.col("n") == 1).select("tree", "hash"))
        if most <= 1:
            return reduce(DataFrame.unionByName, roots), edges
        parents, found = _nodes(nodes.where(F.col("n") > 1), level)
        edges.append(found)
        nodes, level, most = parents, level + 1, -(-most // FANOUT)


def fold(segment: Column, leaf: Column) -> Column:
    """The top that a leaf and its siblings, level by level, give."""
    return F.aggregate(segment, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def jumped(edges: DataFrame, height: int) -> DataFrame:
    """(node, segment) with every segment reaching the top, by doubling.

    After k rounds a pointer spans 2^k levels or ends at the top. Only nodes that are
    ancestors 2^k levels up are looked up in a round, so the looked-up side shrinks
    16-fold with every level that the pointers gain, while many more ask for each.
    """
    pointers, spans = settle(edges, "pointers"), 1
    while spans < height:
        above = pointers.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("segment").alias("more"))
        asked = pointers.select("up").distinct()
        above = settle(above.join(asked, "up", "left_semi"), "above")
        met = pointers.join(above, "up", "left")
        nearer = met.select(
            "node",
            F.coalesce("next", "up").alias("up"),
            F.concat("segment", F.coalesce("more", F.expr("cast(array() as array<struct<left:string,right:string>>)"))).alias("segment"),
        )
        pointers, spans = settle(nearer, "pointers"), spans * 2
    return pointers.select("node", "segment")


@dataclass
class Manifest:
    """A dataset's commitment: tables written to the shared folder, and the top."""

    spark: SparkSession
    leaves: DataFrame  # the given columns, leaf, tree, i, n (rows of the tree)
    subroots: DataFrame  # source, tree, subroot
    segments: DataFrame  # node, segment (array of left and right), nodes above the leaves only
    root: str | None

    def proofs(self) -> DataFrame:
        """``leaves`` with subroot and ``segment``: the siblings, level by level, up to the top."""
        runs = self.leaves.groupBy("tree", F.floor(F.col("i") / FANOUT).alias("up"), "n").agg(
            F.sort_array(F.collect_list(F.struct("i", *[c for c in self.leaves.columns if c not in ("tree", "i", "n")]))).alias("kids")
        )
        lone = F.col("n") == 1
        asks = F.when(lone, node(F.lit(TOP), F.lit(0), F.col("tree"))).otherwise(parent(F.col("tree"), F.lit(1), F.col("up"), F.col("n") <= FANOUT))
        met = runs.withColumn("node", asks).join(self.segments, "node", "left").join(self.subroots.drop("source"), "tree")
        above = F.coalesce("segment", F.expr("cast(array() as array<struct<left:string,right:string>>)"))
        # only here does a run's segment meet each of its leaves; nothing is moved after
        each = met.select("kids", "subroot", lone.alias("lone"), above.alias("above"), F.posexplode("kids").alias("k", "own"))
        own = F.when(F.col("lone"), F.col("above")).otherwise(F.concat(F.array(siblings(F.col("kids.leaf"), F.col("k"))), F.col("above")))
        return each.select("own.*", "subroot", own.alias("segment")).drop("i")


def build(leaves: DataFrame, source: str = "source", order: str = "doc_id") -> Manifest:
    """The manifest of leaves(source, order, leaf, …); further columns are kept.

    Leaves of one source stand in the order of their ids, nulls first; equal ids in the
    order of their digests. A null source is one of its own, before all others.
    """
    spark = leaves.sparkSession
    # written first: range partitions read their input twice
    placed = settle(numbered(settle(leaves, "digests"), source, [order, "leaf"], "leaves"), "numbered")
    # a row per source, whichever row of it comes first
    names = placed.where(F.col("i") == 0).select(F.col(source).alias("source"), "n")
    trees = settle(numbered(names.withColumnRenamed("n", "rows"), None, ["source"], "sources").select("source", F.col("i").alias("tree"), "rows", F.col("n").alias("trees")), "trees")
    size = trees.agg(F.max("rows"), F.max("trees")).first()
    if size[0] is None:
        none = spark.createDataFrame([], "node struct<tree:bigint,level:int,i:bigint>, segment array<struct<left:string,right:string>>")
        return Manifest(spark, placed.withColumn("tree", F.lit(0)), trees.select("source", "tree", F.lit("").alias("subroot")), none, None)
    named = trees.select(F.col("source").alias("_source"), "tree")
    placed = placed.join(named, F.col(source).eqNullSafe(F.col("_source"))).drop("_source")
    # the tree's number takes the source's place in all that follows; sources come back with the result
    placed = settle(placed, "placed")
    lowest = placed.select("tree", "i", "n", F.col("leaf").alias("hash"))
    first = lowest.where(F.col("n") > 1).groupBy("tree", F.floor(F.col("i") / FANOUT).alias("up"), "n").agg(F.sort_array(F.collect_list(F.struct("i", "hash"))).alias("kids"))
    parents = first.select(
        "tree", F.col("up").alias("i"), F.ceil(F.col("n") / FANOUT).alias("n"), F.sha2(F.array_join("kids.hash", ""), 256).alias("hash")
    )
    roots, edges = _grow(settle(parents, "level-1-nodes"), 1, -(-size[0] // FANOUT))
    lone = lowest.where(F.col("n") == 1).select("tree", "hash")
    subroots = settle(trees.join(roots.unionByName(lone), "tree").select("source", "tree", F.col("hash").alias("subroot"), "trees"), "subroots")
    top = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("i"), F.col("trees").alias("n"), F.col("subroot").alias("hash"))
    found, more = _grow(top, 0, size[1])
    edges += more
    if edges:
        height = len(edges)
        segments = jumped(reduce(DataFrame.unionByName, edges), height)
    else:
        segments = spark.createDataFrame([], "node struct<tree:bigint,level:int,i:bigint>, segment array<struct<left:string,right:string>>")
    return Manifest(spark, placed, subroots.drop("trees"), segments, found.first()["hash"])


def document_leaves(documents: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): a row's digest, and that of the row with its text
    in small letters where 5 divides the crc32 of the decimal doc_id (else null)."""
    columns = {c: F.col(c) for c in FIELDS}
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = record_hash(columns | {"text": lower_ascii(F.col("text"))})
    return documents.select("doc_id", "source", record_hash(columns).alias("leaf"), F.when(touched, changed).alias("tampered"))


def verify(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Null fields count as such; rows without a doc_id come first in their source and are
    never tampered with; repeated rows are leaves of their own, all of whose proofs
    hold. Texts are hashed whole, whatever their length. An empty table gives no row;
    further columns are ignored.
    """
    manifest = build(document_leaves(documents))
    proofs = manifest.proofs()
    shown = F.array_join(F.transform("segment", lambda s: F.concat(s["left"], s["right"])), "")
    folded = fold(F.col("segment"), F.coalesce("tampered", "leaf"))
    out = proofs.select("doc_id", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"), F.sha2(shown, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: ``verify`` over the table ``documents``; crc32 is worked out bit by bit (-1 stands for one shift).
ORACLE = """
WITH RECURSIVE rows AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END
    )) AS crc,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents
),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM rows
),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM hashed
),
nodes AS (
  SELECT tree, 0 AS level, i, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 16, n
),
subroots AS (SELECT tree, hash AS subroot FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, tree AS i, (SELECT count(*) FROM subroots) AS n, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 16, n
),
runs AS (
  SELECT tree, level, i // 16 AS up, n, list(hash ORDER BY i) AS kids FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, i // 16, n, list(hash ORDER BY i) FROM top WHERE n > 1 GROUP BY ALL
),
walk AS (
  SELECT l.doc_id, l.tree AS own, l.i AS own_i, l.leaf, CASE WHEN l.n > 1 THEN l.tree ELSE -1 END AS tree, 0 AS level,
    CASE WHEN l.n > 1 THEN l.i ELSE l.tree END AS i, coalesce(l.tampered, l.leaf) AS hash, '' AS proof
  FROM leaves l
  UNION ALL
  SELECT w.doc_id, w.own, w.own_i, w.leaf, CASE WHEN r.n <= 16 THEN -1 ELSE w.tree END,
    CASE WHEN r.n <= 16 AND w.tree >= 0 THEN 0 ELSE w.level + 1 END, CASE WHEN r.n <= 16 AND w.tree >= 0 THEN w.tree ELSE w.i // 16 END,
    sha256(array_to_string(r.kids[: w.i % 16], '') || w.hash || array_to_string(r.kids[w.i % 16 + 2 :], '')),
    w.proof || array_to_string(r.kids[: w.i % 16], '') || array_to_string(r.kids[w.i % 16 + 2 :], '')
  FROM walk w JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.up = w.i // 16
)
SELECT w.doc_id, w.leaf, s.subroot, t.hash AS root, sha256(w.proof) AS proof_sha256, w.hash AS folded_root, w.hash = t.hash AS verified
FROM walk w JOIN subroots s ON s.tree = w.own, (SELECT hash FROM top WHERE n = 1) t
WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.tree = w.tree AND r.level = w.level AND r.up = w.i // 16)
"""
