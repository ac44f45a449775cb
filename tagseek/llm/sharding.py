"""Shards on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Every shard stands at many places of a ring, and a row belongs to the next place
clockwise of its own. A shard takes no more than its bound: rows that find it full
go on clockwise to the next place of a shard with room, in rounds, so that a
row's own shard is served before any overflow. Bounds that add up to the number
of rows make counts differ by one at most; slack moves fewer rows instead.

Rows between two places (an arc) share their way, so the rounds run on counts: a
table of as many rows as the ring has places. Rows are only numbered along the
ring. Its cells grow in number with the rows, a cell that many rows share (one
key may be very frequent) is split by row, and a row's number inside its cell says
which part of the cell's way is its own. Texts are read once, and only numbers
are shuffled, once.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle

SHARDS = 24
#: Places of each shard on the ring.
PLACES = 128
#: Places stand at the ends of 2 ** RING_BITS equal cells.
RING_BITS = 16
#: Rows numbered together; cells are made, and crowded ones split, to stay below.
CELL_ROWS = 20_000

_EARLIER = (Window.unboundedPreceding, Window.currentRow)


def ring_place(*parts: Column) -> Column:
    """A place on the ring: a whole number below 2^63."""
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 63) - 1))


def cell_of(place: Column, bits: int) -> Column:
    return F.shiftright(place, 63 - bits)


def ring(spark: SparkSession, shards: int = SHARDS, places: int = PLACES) -> DataFrame:
    """(arc, shard): each place of the ring, named by its cell, and who stands there.

    Of several shards at one place the smallest has it. At most shards * places rows.
    """
    nodes = spark.range(shards * places).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("copy"))
    at = nodes.select(cell_of(ring_place(F.lit("shard"), "shard", "copy"), RING_BITS).alias("arc"), "shard")
    return at.groupBy("arc").agg(F.min("shard").alias("shard"))


def arcs_of_cells(places: DataFrame) -> DataFrame:
    """(coarse, arc, shard): for each of the ring's 2 ** RING_BITS cells the next place at or after it."""
    cells = places.sparkSession.range(1 << RING_BITS).select(F.col("id").alias("coarse"))
    here = F.when(F.col("arc").isNotNull(), F.struct("arc", "shard"))
    line = cells.join(places, cells["coarse"] == places["arc"], "left").select("coarse", here.alias("here")).coalesce(1)
    after = F.last("here", ignorenulls=True).over(Window.orderBy(F.col("coarse").desc()).rowsBetween(*_EARLIER))
    first = F.min("here").over(Window.partitionBy())
    return line.select("coarse", F.coalesce(after, first).alias("own")).select("coarse", "own.*")


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    """The most rows that each shard takes; without slack they add up to ``rows``."""
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def overflow(loads: DataFrame, most: list[int]) -> DataFrame:
    """loads(arc, shard, load) → (arc, shard, rows, round): who takes how many rows of each arc.

    In a round the rows left of each arc ask at the next place whose shard has room,
    and are taken in the order of the ring. Whoever turns rows away is full, so there are
    at most as many rounds as shards, whatever the number of rows.
    """
    room = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in most]), F.col("shard") + 1)
    state = loads.select("arc", "shard", F.col("load").alias("left"), room.alias("room"))
    rounds: list[DataFrame] = []
    for number in range(len(most) + 1):
        here = F.when(F.col("room") > 0, F.struct("arc", "shard", "room"))
        after = F.last(here, ignorenulls=True).over(Window.orderBy(F.col("arc").desc()).rowsBetween(*_EARLIER))
        line = state.coalesce(1).withColumn("to", F.coalesce(after, F.min(here).over(Window.partitionBy())))
        asked = F.sum("left").over(Window.partitionBy("to.shard").orderBy("arc").rowsBetween(*_EARLIER)) - F.col("left")
        taken = F.greatest(F.lit(0), F.least("left", F.col("to.room") - asked))
        took = settle(line.withColumn("taken", F.coalesce(taken, F.lit(0))), "ring").coalesce(1)
        rounds.append(took.where("taken > 0").select("arc", F.col("to.shard").alias("shard"), F.col("taken").alias("rows"), F.lit(number).alias("round")))
        if not took.agg(F.sum(F.col("left") - F.col("taken"))).first()[0]:
            return reduce(DataFrame.unionByName, rounds)
        used = took.groupBy(F.col("to.shard").alias("shard")).agg(F.sum("taken").alias("used"))
        room = (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")
        state = took.join(used, "shard", "left").select("arc", "shard", (F.col("left") - F.col("taken")).alias("left"), room)
    raise ValueError("the bounds are below the number of rows")


def place(documents: DataFrame, shards: int = SHARDS, places: int = PLACES, slack: float = 0.0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, home_shard, shard, slot.

    ``size``: UTF-8 bytes of the text and 8 more. ``home_shard`` is the ring's own choice, which
    the doc_id alone decides; ``shard`` differs where that one is full. ``slot`` counts
    from 0 in each shard. ``slack``: share by which a shard may exceed its part.

    Null texts are empty. Rows without a doc_id, or that share one, stand at one place and
    overflow from there. An empty table gives no row; further columns are ignored.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(
        documents.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            ring_place(F.lit("row"), "doc_id").alias("place"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    count = rows.count()
    most = bounds(count, shards, slack)
    bits = RING_BITS + max(0, math.ceil(math.log2(max(1, 4 * count / cell_rows / (1 << RING_BITS)))))
    celled = rows.withColumn("cell", cell_of(F.col("place"), bits))
    parts = F.ceil(F.col("count") / cell_rows).cast("int")
    crowded = settle(celled.groupBy("cell").count().where(F.col("count") > cell_rows).select("cell", parts.alias("parts")), "crowded")
    split = celled.join(crowded, "cell", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), "parts"), F.lit(0)).cast("int")).drop("parts")

    owners = settle(arcs_of_cells(ring(spark, shards, places)), "owners")
    coarse = F.shiftright("cell", bits - RING_BITS).alias("coarse")
    cells = settle(split.groupBy("cell", "part").count().select("*", coarse).join(owners, "coarse"), "cells")
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("home_shard"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    loads = owners.select("arc", "shard").distinct().join(cells.groupBy("arc").agg(F.sum("count").alias("load")), "arc", "left").fillna(0, ["load"])
    taken = overflow(loads, most)
    # parts of an arc in the order of the rounds, and where each begins in its shard
    begin = F.sum("rows").over(Window.partitionBy("arc").orderBy("round").rowsBetween(*_EARLIER)) - F.col("rows")
    slot = F.sum("rows").over(Window.partitionBy("shard").orderBy("round", "arc").rowsBetween(*_EARLIER)) - F.col("rows")
    pieces = settle(taken.coalesce(1).select("arc", F.col("shard").alias("to"), "rows", begin.alias("begin"), slot.alias("slot")), "pieces")

    # the cells behind the last place come first on the arc that ends at the first one
    along = Window.partitionBy("arc").orderBy((F.col("coarse") > F.col("arc")).desc(), "cell", "part").rowsBetween(*_EARLIER)
    ranked = cells.withColumn("low", F.sum("count").over(along) - F.col("count")).withColumn("high", F.col("low") + F.col("count"))
    met = ranked.join(pieces, "arc").where((F.col("begin") < F.col("high")) & (F.col("low") < F.col("begin") + F.col("rows")))
    own = F.struct(
        F.greatest(F.col("begin") - F.col("low"), F.lit(0)).alias("first"), "to", (F.col("slot") + F.greatest(F.col("low") - F.col("begin"), F.lit(0))).alias("slot")
    )
    # a cell's way has at most one part per round
    ways = settle(met.groupBy("cell", "part").agg(F.first("shard").alias("home_shard"), F.sort_array(F.collect_list(own)).alias("way")), "ways")
    number = F.row_number().over(Window.partitionBy("cell", "part").orderBy("place", "doc_id", "row")) - 1
    found = split.withColumn("number", number.cast("bigint")).join(ways, ["cell", "part"])
    found = found.withColumn("own", F.element_at(F.filter("way", lambda w: w["first"] <= F.col("number")), -1))
    return found.select("doc_id", "size", "text_crc32", "home_shard", F.col("own.to").alias("shard"), (F.col("own.slot") + F.col("number") - F.col("own.first")).alias("slot"))


def shard_rows(documents: DataFrame) -> DataFrame:
    """``place`` under the law that shards' counts are at most one apart."""
    return place(documents).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard"
    )
