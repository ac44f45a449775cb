"""Benchmark decontamination by winnowing, in DataFrame operations only.

The smallest k-gram hash of every sliding window is a fingerprint, so any shared
span of a whole window shares one. Fingerprints of documents meet those of the
benchmark; the windows around a met fingerprint are then compared word by word,
and every document word inside an occurring window is a hit.

Only fingerprints are spread out, and only those that the benchmark has leave
the task that made them: the benchmark side is broadcast, in blocks of at most
``BLOCK`` rows. Hot passages are pre-aggregated per document before a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle, worked_out

WINDOW = 10
GRAM = 5
#: Rows of the benchmark that are broadcast at once.
BLOCK = 500_000

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(text: Column, gap: str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), gap)


def word_list(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    parts = _split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _SMALL), _GAP)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words; only the ends of a split can be empty."""
    parts = _split(text, _ANY_GAP)
    ends = (F.element_at(parts, 1) == "").cast("int") + F.when(F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("int")).otherwise(0)
    return (F.size(parts) - ends).cast("bigint")


def _grams(each: Column, n: int) -> Column:
    """Hashes of n neighbours; ``each`` is a column of single hashes."""
    starts = F.sequence(F.lit(0), F.size(each) - n)
    grams = F.transform(starts, lambda i: F.xxhash64(*[F.get(each, i + k) for k in range(n)]))
    return F.when(F.size(each) >= n, grams).otherwise(F.array().cast("array<bigint>"))


def with_grams(df: DataFrame, n: int) -> DataFrame:
    """Add ``grams``, the hashes of every n neighbours of ``words``."""
    # two steps: a lambda would work its argument's expression out again for each element
    each = worked_out(df, each=F.transform("words", lambda w: F.xxhash64(w)))
    return worked_out(each, grams=_grams(F.col("each"), n)).drop("each")


def fingerprints(grams: Column, window: int) -> Column:
    """The smallest of every ``window`` neighbouring hashes, each once.

    A list shorter than a window is one window.
    """
    last = F.greatest(F.size(grams) - window, F.lit(0))
    least = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_min(F.slice(grams, i + 1, window)))
    return F.when(F.size(grams) > 0, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, words, n): every window of every item."""
    listed = items.select(F.col("item_id"), word_list(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last)).alias("at")
    return listed.select("item_id", "words", starts).select(
        "item_id", F.array_join(F.slice("words", F.col("at") + 1, window), " ").alias("words"), F.least(F.size("words"), F.lit(window)).alias("n")
    )


def _blocks(df: DataFrame, key: str, block: int) -> list[DataFrame]:
    """``df`` cut by a hash of its key into parts of about ``block`` rows."""
    parts = -(-df.count() // block) or 1
    return [df] if parts == 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)]


def own_rows(documents: DataFrame) -> DataFrame:
    """Add ``row``, which tells the rows apart: the doc_id, or a number where ids repeat or are null."""
    unclear = documents.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    if unclear.isEmpty():
        return documents.withColumn("row", F.col("doc_id"))
    # written, so that every later reading finds the same numbers
    return settle(documents.withColumn("row", F.monotonically_increasing_id()), "rows")


def decontaminate(documents: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``items_sha256`` digests the ids of the items with an occurring window, as
    sorted strings joined by commas. Null texts have no words; texts and items
    without words neither hit nor are hit; items shorter than a window are one
    window. Rows without a doc_id, or that share one, are documents of their own.
    Further columns are ignored.
    """
    documents = own_rows(documents.select("doc_id", "text"))
    windows = settle(_windows(items.select(F.col("item_id").cast("string").alias("item_id"), "text"), window).distinct(), "windows")
    sizes = [r["n"] for r in windows.select("n").distinct().collect()]  # at most as many as a window has words
    occurring = settle(reduce(DataFrame.unionByName, [_occurring(documents, windows.where(F.col("n") == n), n, min(gram, n), block) for n in sorted(sizes)]), "hits") if sizes else None
    counted = documents.select("doc_id", "row", word_count(F.col("text")).alias("n_words"))
    if occurring is None:
        none = {"n_hit": F.lit(0).cast("bigint"), "n_items": F.lit(0).cast("bigint"), "items_sha256": F.sha2(F.lit(""), 256), "contaminated": F.lit(False)}
        return counted.drop("row").withColumns(none)

    # each document's windows are few and bounded by its own length
    spans = occurring.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("spans"))
    ends = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(acc["end"], s["at"]))).alias("hit"),
            F.greatest(acc["end"], s["at"] + s["n"]).alias("end"),
        ),
    )
    hit_words = spans.select("row", ends["hit"].alias("n_hit"))
    hit_items = (
        occurring.select("row", "words").distinct()
        .join(windows.select("words", "item_id"), "words")
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
        .select("row", F.size("ids").cast("bigint").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    )
    return counted.join(hit_words.join(hit_items, "row"), "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def _occurring(documents: DataFrame, windows: DataFrame, n: int, gram: int, block: int) -> DataFrame:
    """(row, at, words, n): where windows of n words occur in documents."""
    span = n - gram + 1
    each = windows.select("words").distinct()
    marks = with_grams(each.select(F.split("words", " ").alias("words")), gram)
    prints = settle(marks.select(F.array_min("grams").alias("print")).distinct(), "prints")
    lists = worked_out(documents.where(F.col("text").isNotNull()), words=word_list(F.col("text"))).drop("text")
    hashed = with_grams(lists.where(F.size("words") >= n), gram)
    keyed = hashed.select("row", "words", "grams", F.explode(fingerprints(F.col("grams"), span)).alias("print"))
    found = []
    for part in _blocks(prints, "print", block):
        met = keyed.join(F.broadcast(part), "print")
        places = F.filter(F.sequence(F.lit(0), F.size("grams") - 1), lambda i: F.get(F.col("grams"), i) == F.col("print"))
        met = met.select("row", "words", F.explode(places).alias("place"))
        low, high = F.greatest(F.col("place") - span + 1, F.lit(0)), F.least(F.col("place"), F.size("words") - n)
        around = met.select("row", "words", F.explode(F.sequence(low, high)).alias("at"))
        found.append(around.select("row", "at", F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("words")))
    spread, parts = reduce(DataFrame.unionByName, found), _blocks(each, "words", block)
    if len(parts) > 1:  # texts are read once, however many blocks meet their windows
        spread = settle(spread, "spread")
    kept = [spread.join(F.broadcast(part), "words", "left_semi") for part in parts]
    return reduce(DataFrame.unionByName, kept).distinct().withColumn("n", F.lit(n))
