"""Query rows of the registered searches, and tables derived from the inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagseek.operators.postings import EXACT, SOUND, tokenize_queries
from tagseek.session import fresh_path
from tagseek.sources.store import Index, load_index, save_index, total_bytes

PHRASES = {
    "term_match": ["double", "nicht", "the"],
    "phrase_exact": ["of the", "in die", "double"],
    "phrase_sloppy": ["of the", "in die"],
    "phonetic_phrase": ["double", "worthless", "nicht", "of the"],
    "prefix_match": ["thou*"],
    "wildcard_match": ["t?e*", "*hou*", "*keit"],
    "wildcard_phrase": ["of th*", "t?e und", "thou*"],
    "fuzzy_match": ["whcih", "nichts~", "thta", "ther"],
    "glued_match": ["th at", "nicht"],
    "hyphen_match": ["by nc", "of the"],
    "clauses": [
        "hyper space", "hyper", "hyper*", "hy*er", "hy?er*", "hyper* space", "hyper~", "hyper~ space", "*", "~", "", "!?",
    ],
    "exact": ["of the", "th at", "by nc", "nicht", "thou*", "of th*", "whcih~", "nichts~ the"],
    "phonetic": ["double", "of the", "public domain", "nicht"],
    "full": ["of the", "public domain", "nicht", "commons", "creative jump", "worthles domian"],
    "spelling": ["whcih of becuase", "th eou", "of the", "publc domian", "commons", "hyper space"],
    "details": ["nicht", "le"],
}


def query_table(spark: SparkSession, name: str) -> DataFrame:
    rows = list(enumerate(PHRASES[name], 1))
    return spark.createDataFrame(rows, "query_id bigint, phrase string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, with the source as bookmark tag."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("bookmark_tag"), "text")


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations``, with turns as times; replies have no end."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("doc_id"),
        F.col("conv_id").cast("string").alias("bookmark_tag"),
        F.col("turn").cast("double").alias("start"),
        F.when(F.col("role") == "user", F.col("turn") + 1).cast("double").alias("end"),
        "text",
        "role",
    )


#: Query ids: a benchmark text's id times this, plus the place of a word in it.
PLACES = 1 << 32


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query for every word of every benchmark text: query_id, phrase."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("phrase"))
    return tokenize_queries(asked).select((F.col("query_id") * PLACES + F.col("slot")).alias("query_id"), F.col("term").alias("phrase"))


def benchmark_runs(spark: SparkSession, sf_dir: str, n: int = 2) -> DataFrame:
    """A query for every run of n neighbouring words of every benchmark text."""
    words = benchmark_words(spark, sf_dir)
    # a text's words stand next to each other, and are as many as it has
    later = Window.partitionBy(F.floor(F.col("query_id") / PLACES)).orderBy("query_id")
    runs = words.select("query_id", "phrase", *[F.lead("phrase", k).over(later).alias(f"next_{k}") for k in range(1, n)])
    followers = [f"next_{k}" for k in range(1, n)]
    return runs.where(F.col(followers[-1]).isNotNull()).select("query_id", F.concat_ws(" ", "phrase", *followers).alias("phrase"))


def benchmark_patterns(spark: SparkSession, sf_dir: str, letters: int = 5) -> DataFrame:
    """A prefix query for the first letters of every longer word of every benchmark text."""
    longer = benchmark_words(spark, sf_dir).where(F.length("phrase") > letters)
    return longer.select("query_id", F.concat(F.left("phrase", F.lit(letters)), F.lit("*")).alias("phrase"))


_saved: dict[tuple[str, str, str], str] = {}


def corpus_index(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = (EXACT, SOUND)) -> Index:
    """Built once per session and input folder, then only opened.

    A search that asks for words only takes an index of words, unless one of both fields is there.
    """
    key, whole = [(spark.sparkContext.applicationId, sf_dir, " ".join(["corpus", *held])) for held in (fields, (EXACT, SOUND))]
    if key not in _saved and whole not in _saved:
        path = fresh_path(spark, "corpus")
        save_index(corpus(spark, sf_dir), path, input_bytes=total_bytes(spark, f"{sf_dir}/documents.parquet"), fields=fields)
        _saved[key] = path
    return load_index(spark, _saved.get(whole) or _saved[key])


def transcript_index(spark: SparkSession, sf_dir: str) -> Index:
    """Built in two parts: one side of the talk first, the other appended."""
    key = (spark.sparkContext.applicationId, sf_dir, "transcript")
    if key not in _saved:
        path = fresh_path(spark, "transcript")
        rows = transcript(spark, sf_dir)
        size = total_bytes(spark, f"{sf_dir}/conversations.parquet")
        save_index(rows.where(F.col("role") == "user"), path, input_bytes=size)
        save_index(rows.where(F.col("role") != "user"), path, mode="append")
        _saved[key] = path
    return load_index(spark, _saved[key])


def transcript_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filename, filepath, value): each turn as a nested JSON text."""
    turns = table(spark, sf_dir, "conversations")
    place = F.concat_ws("/", "conv_id", "turn")
    said = F.struct(
        "text", F.col("turn").alias("start"), (F.col("turn") + 0.5).alias("end"), F.struct("role").alias("speaker")
    )
    tag = F.struct(F.concat(F.lit("tag-"), "conv_id").alias("bookmark_tag"))
    tree = F.struct(F.struct(tag.alias("inner")).alias("meta"), F.array(said).alias("results"))
    return turns.select(place.alias("filename"), place.alias("filepath"), F.to_json(tree).alias("value"))


#: About how many turns a file holds; a turn is dealt to file (conv_id + turn) mod the number of files.
TURNS_PER_FILE = 200


def transcript_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of JSON files made from ``conversations``, a few hundred turns
    each whatever the length of any one conversation."""
    turns = table(spark, sf_dir, "conversations")
    n = max(1, turns.count() // TURNS_PER_FILE)
    entry = F.struct(F.col("conv_id"), "turn", "role", "text")
    grouped = turns.groupBy(((F.col("conv_id") + F.col("turn")) % n).alias("part")).agg(
        F.sort_array(F.collect_list(entry)).alias("results")
    )
    folder = fresh_path(spark, "json")
    named = grouped.select(F.concat(F.lit("part "), F.col("part")).alias("bookmark_tag"), "results")
    named.write.option("maxRecordsPerFile", 1).json(folder)
    return folder

