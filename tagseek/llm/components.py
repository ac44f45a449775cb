"""Connected components of an edge table, by star contraction in Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (id, component): the smallest id reachable, for every id in an edge.

    Large and small stars alternate until no edge changes; every round is written
    to the shared folder, so a lost executor costs one round at most, and only a
    count reaches the driver. Stars shrink a path's length by half each round.
    """
    stars = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour of a node meets the node's smallest neighbour
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: the node and its smaller neighbours meet the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        stars = settle(small.unionByName(own).where("a <> b").distinct(), "stars")
        # equal sums of equal many edges: nothing changed
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = stars.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def own_ids(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows with an id of their own each, and (key, own), its former value.

    Rows whose ids are distinct keep them, and the second is None. Otherwise new
    ids follow the order of the old ones, null ids last.
    """
    repeated = rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
    if repeated.isEmpty():
        return rows, None
    others = [c for c in rows.columns if c != key]
    ordered = rows.orderBy(F.col(key).asc_nulls_last(), *others).withColumnRenamed(key, "own")
    kept = settle(ordered.select(F.monotonically_increasing_id().alias(key), "own", *others), "rows")
    return kept.drop("own"), kept.select(key, "own")


def former_ids(found: DataFrame, names: DataFrame | None, key: str) -> DataFrame:
    """``found`` with its ids and component ids back in their former values; adds ``kept``."""
    if names is not None:
        heads = names.select(F.col(key).alias("component_id"), F.col("own").alias("head"))
        found = found.join(names, key).join(heads, "component_id").drop(key, "component_id")
        found = found.withColumnsRenamed({"own": key, "head": "component_id"})
    return found.withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(False)))
