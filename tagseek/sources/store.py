"""Saved indexes: parquet tables laid out so that searches need no shuffle.

* ``documents``: a folder per batch, bucketed and sorted by ``doc_id``;
* ``postings``: a folder per (batch, field, term bucket), bucketed by ``doc_id`` and
  sorted by term. A search opens only its terms' folders, and all rows of one
  record share a bucket, so phrases and clause sums are worked out without an
  exchange. A term found everywhere is spread over all buckets alike;
* ``vocabulary``: one folder per (field, term bucket), sorted by term;
* ``dictionary``: n-grams for spelling, made when first asked for;
* ``manifest``: a row per published state of the index, which names its batches.

A batch is written in full before one small write publishes it. Whoever opened the
index earlier goes on reading the batches and the vocabulary of that state; what a
failed writer left is named by no state, so it is never read and a retry starts anew.
"""

from __future__ import annotations

import uuid
from dataclasses import astuple, dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


from ..operators.postings import EXACT, SOUND, build_postings, corpus_stats, term_bucket, vocabulary
from ..session import kept_types, settings

#: A bucket's postings are sorted in one task, which takes some 60 times its input (0.1 GB in 8 buckets: 671 MB a task).
BYTES_PER_BUCKET = 8 << 20
BYTES_PER_TERM_BUCKET = 16 << 30

#: Words whose keys one task makes, sorts and writes: some 30 keys a word.
WORDS_PER_TASK = 50_000

#: Bounds of the layout: beyond them buckets and folders grow larger, not more.
MOST_DOC_BUCKETS = 8192
MOST_TERM_BUCKETS = 256

#: The folder column of a batch, and the columns of a posting in the order of its table.
BATCH = "_batch"
POSTING = ("term", "doc_id", "dl", "freq", "positions", "hyphens")
VOCABULARY = "field string, term_bucket int, term string, df bigint, cf bigint"
MANIFEST = (
    "version int, writer string, build_id string, batches string, words string, doc_buckets int, term_buckets int, "
    "columns string, fields string, n_docs bigint, n_tokens bigint"
)


def total_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files at ``paths``; lists them without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def planned_bytes(documents: DataFrame) -> int:
    """The planner's size of ``documents``: its files' sizes, carried through its steps.

    Where it does not know (it then names a size no cluster holds), 0.
    """
    known = int(str(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < 1 << 60 else 0


def layout(input_bytes: int, least: int) -> tuple[int, int]:
    """(document buckets, term buckets) for so much input."""
    sized = input_bytes // BYTES_PER_BUCKET
    return min(max(least, sized), MOST_DOC_BUCKETS), max(1, min(MOST_TERM_BUCKETS, input_bytes // BYTES_PER_TERM_BUCKET))


@dataclass
class Index:
    """Opened tables of one index, and the corpus numbers ranking needs."""

    spark: SparkSession
    path: str
    build_id: str
    doc_buckets: int
    term_buckets: int
    documents: DataFrame
    postings: DataFrame
    vocabulary: DataFrame
    n_docs: int
    n_tokens: int
    version: int = 0
    batches: tuple[str, ...] = ()
    words: str = ""
    opened: dict = field(default_factory=dict)

    @property
    def avg_length(self) -> float:
        return self.n_tokens / self.n_docs if self.n_docs else 0.0


def with_document_columns(documents: DataFrame) -> DataFrame:
    """Add the optional columns a document may lack."""
    for name, kind in (("bookmark_tag", "string"), ("start", "double"), ("end", "double")):
        if name not in documents.columns:
            documents = documents.withColumn(name, F.lit(None).cast(kind))
    first = ["doc_id", "bookmark_tag", "start", "end", "text"]
    return documents.select(*first, *[c for c in documents.columns if c not in first])


def save_index(
    documents: DataFrame,
    path: str,
    mode: str = "overwrite",
    doc_buckets: int | None = None,
    term_buckets: int | None = None,
    input_bytes: int | None = None,
    fields: tuple[str, ...] = (EXACT, SOUND),
) -> Index:
    """Index documents(doc_id, text, …) at ``path`` and open the result.

    ``overwrite`` starts a new build beside the old one, which readers may go on
    using; ``append`` adds a batch to the current build. Bucket counts follow
    ``input_bytes`` (see ``total_bytes``; unset, the planner's figure) unless given.
    ``fields``: words, sounds or both; an append keeps the index's own.
    """
    spark = documents.sparkSession
    documents = with_document_columns(documents)
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be overwrite or append, got {mode!r}")
    last = _published(spark, path, must=mode == "append")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    if mode == "append":
        state = last
        fields = tuple(state.fields.split(","))
    else:
        least = spark.sparkContext.defaultParallelism
        sized = layout(planned_bytes(documents) if input_bytes is None else input_bytes, least)
        state = State(0, "", uuid.uuid4().hex[:12], "", "", doc_buckets or sized[0], term_buckets or sized[1], columns, ",".join(fields), 0, 0)
    batch, before = uuid.uuid4().hex[:12], state.names
    docs, postings = _tables(spark, path, state)
    if before:
        _check_ids(spark.table(docs).where(F.col(BATCH).isin(before)).select("doc_id").unionAll(documents.select("doc_id")))
    with kept_types(spark):
        documents.withColumn(BATCH, F.lit(batch)).repartition(state.doc_buckets, "doc_id").write.insertInto(docs)
    written = spark.table(docs).where(F.col(BATCH) == batch).drop(BATCH)
    if not before:
        _check_ids(written.select("doc_id"))

    # The batch is laid out by doc_id already, so inverting it moves no row between tasks.
    with settings(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        inverted = build_postings(written.repartition(state.doc_buckets, "doc_id"), fields)
        inverted = inverted.withColumns({BATCH: F.lit(batch), "term_bucket": term_bucket(F.col("term"), state.term_buckets)})
        inverted.select(*POSTING, BATCH, "field", "term_bucket").write.insertInto(postings)
    own = spark.table(postings).where(F.col(BATCH) == batch)
    words = vocabulary(own)
    if before:
        known = spark.read.schema(VOCABULARY).parquet(f"{path}/{state.build_id}/{state.words}")
        united = known.select("field", "term", "df", "cf").unionByName(words)
        words = united.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    folder = f"vocabulary-{batch}"
    _write_words(words, f"{path}/{state.build_id}/{folder}", state.term_buckets)
    lengths = own.where(F.col("field") == fields[0]).groupBy("doc_id", "dl").agg(F.lit(1))
    n_docs, n_tokens, _ = corpus_stats(lengths).first()
    version = (last.version if last else 0) + 1
    _publish(
        spark, path,
        state.but(version=version, writer=batch, batches=",".join([*before, batch]), words=folder, n_docs=state.n_docs + n_docs, n_tokens=state.n_tokens + n_tokens),
    )
    return load_index(spark, path)


def compact_index(spark: SparkSession, path: str) -> Index:
    """Put an index's batches together into one, beside them; results stay the same.

    Rows stay in their buckets: each is read, merged by key and written by one task.
    """
    state = _published(spark, path)
    if len(state.names) < 2:
        return load_index(spark, path)
    batch = uuid.uuid4().hex[:12]
    docs, postings = _tables(spark, path, state)
    with kept_types(spark), settings(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        for table, order in ((docs, []), (postings, ["field", "term_bucket"])):
            rows = spark.table(table).where(F.col(BATCH).isin(state.names))
            kept = [c for c in rows.columns if c not in (BATCH, *order)]
            rows.select(*kept, F.lit(batch).alias(BATCH), *order).repartition(state.doc_buckets, "doc_id").write.insertInto(table)
    _publish(spark, path, state.but(version=state.version + 1, writer=batch, batches=batch))
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> Index:
    """Open the last published state of a saved index; nothing is rebuilt."""
    state = _published(spark, path)
    docs, postings = _tables(spark, path, state)
    mine = F.col(BATCH).isin(state.names)
    return Index(
        spark,
        path,
        state.build_id,
        state.doc_buckets,
        state.term_buckets,
        spark.table(docs).where(mine).drop(BATCH),
        spark.table(postings).where(mine).drop(BATCH),
        spark.read.schema(VOCABULARY).parquet(f"{path}/{state.build_id}/{state.words}"),
        state.n_docs,
        state.n_tokens,
        state.version,
        tuple(state.names),
        state.words,
    )


@dataclass(frozen=True)
class State:
    """A row of the manifest."""

    version: int
    writer: str
    build_id: str
    batches: str
    words: str
    doc_buckets: int
    term_buckets: int
    columns: str
    fields: str
    n_docs: int
    n_tokens: int

    @property
    def names(self) -> list[str]:
        return self.batches.split(",") if self.batches else []

    def but(self, **changes) -> State:
        return replace(self, **changes)


def _write_words(words: DataFrame, path: str, term_buckets: int) -> None:
    (
        words.withColumn("term_bucket", term_bucket(F.col("term"), term_buckets))
        .hint("rebalance", "field", "term_bucket")
        .sortWithinPartitions("field", "term_bucket", "term")
        .write.partitionBy("field", "term_bucket")
        .parquet(path)
    )


def dealt(words: DataFrame) -> DataFrame:
    """words(term, …) in as many tasks as their keys take; a vocabulary's few files are as few tasks."""
    return words.repartition(max(1, -(-words.count() // WORDS_PER_TASK)), "term")


def write_keys(keys: DataFrame, path: str, folder: str, key: str, buckets: int) -> None:
    """Write the keys of ``dealt`` words in folders by ``folder``, the bucket of a key, sorted by key.

    Each task writes what it made: keys outnumber their words by far and need not
    travel, unless that gave each of many key buckets a file of every task. A sort compares
    the beginnings of its first column cheaply and whole rows otherwise, so that column is
    the key wherever there is one folder only.
    """
    if buckets == 1:
        keys.drop(folder).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/{folder}=0")
        return
    keys.hint("rebalance", folder).sortWithinPartitions(folder, key).write.mode("overwrite").partitionBy(folder).parquet(path)


def _published(spark: SparkSession, path: str, must: bool = True) -> State | None:
    """The newest state; of several under one version the first writer's by name."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy(F.col("version").desc(), "writer").take(1)
    except AnalysisException:
        rows = []
    if not rows and must:
        raise FileNotFoundError(f"no index at {path}")
    return State(*rows[0]) if rows else None


def _publish(spark: SparkSession, path: str, state: State) -> None:
    """One small file makes a state known; nothing is taken away or changed."""
    spark.createDataFrame([astuple(state)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    if _published(spark, path).writer != state.writer:
        raise RuntimeError(f"another writer published version {state.version} of {path} first; write again")


def _check_ids(ids: DataFrame) -> None:
    """Two records under one id would be searched as one; refuse them."""
    twice = ids.groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id").limit(3).collect()
    if twice:
        raise ValueError(f"doc_id must be unique, these are not: {[r[0] for r in twice]}")


_known: dict[tuple[str, str], set[str]] = {}


def _tables(spark: SparkSession, path: str, state: State) -> tuple[str, str]:
    """Register the bucketed tables of one build with this session's catalog."""
    docs, postings = f"tagseek_documents_{state.build_id}", f"tagseek_postings_{state.build_id}"
    if not spark.catalog.tableExists(docs):
        spark.sql(
            f"CREATE TABLE {docs} ({state.columns}, {BATCH} string) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {state.doc_buckets} BUCKETS "
            f"LOCATION '{path}/{state.build_id}/documents'"
        )
    if not spark.catalog.tableExists(postings):
        spark.sql(
            f"CREATE TABLE {postings} (term string, doc_id bigint, dl int, freq int, positions array<int>, "
            f"hyphens array<int>, {BATCH} string, field string, term_bucket int) USING parquet "
            f"PARTITIONED BY ({BATCH}, field, term_bucket) "
            f"CLUSTERED BY (doc_id) SORTED BY (term, doc_id) INTO {state.doc_buckets} BUCKETS "
            f"LOCATION '{path}/{state.build_id}/postings'"
        )
    # batches that other sessions wrote are folders this catalog has not seen
    known = _known.setdefault((spark.sparkContext.applicationId, docs), set())
    if not known.issuperset(state.names):
        for table in (docs, postings):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        known.update(state.names)
    return docs, postings


def index_stats(index: Index) -> DataFrame:
    """One row (docs, tokens, terms): records, words and distinct words held."""
    words = index.vocabulary.where(F.col("field") == EXACT)
    held = words.agg(F.coalesce(F.sum("cf"), F.lit(0)).cast("bigint").alias("tokens"), F.count(F.lit(1)).alias("terms"))
    docs = index.documents.agg(F.count(F.lit(1)).alias("docs"))
    # two one-row tables side by side
    return docs.withColumn("row", F.lit(1)).join(held.withColumn("row", F.lit(1)), "row").select("docs", "tokens", "terms")


#: Keys that one scan filter names; more are told to it as ranges only.
LISTED = {"doc_id": 20_000}
LISTED_TERMS = 1_000
#: Ranges that one scan filter holds: about as many as a bucket has pages. The JVM leaves a scan of 64 uncompiled.
SPANS = 16


def _within(key: str, spans: list[tuple]) -> Column:
    """Is a key in one of these ranges, which ascend? Found by halving: a scan asks this of every row."""
    if len(spans) == 1:
        return F.col(key).between(*spans[0])
    low, high = spans[: len(spans) // 2], spans[len(spans) // 2 :]
    return (F.col(key) <= low[-1][1]) & _within(key, low) | (F.col(key) >= high[0][0]) & _within(key, high)


def key_filter(wanted: DataFrame, key: str) -> Column:
    """A scan filter that all wanted keys pass, however many they are.

    Files are sorted by key, so ranges leave out the row groups between them; named
    ids also leave out whole buckets. The join that follows is exact either way.
    """
    most = LISTED.get(key, LISTED_TERMS)
    keys = wanted.where(F.col(key).isNotNull()).select(key).distinct()
    few = sorted(row[0] for row in keys.limit(most + 1).collect())
    if len(few) > most:
        # as many rows as there are ranges, whatever the number of keys
        parts = keys.repartitionByRange(SPANS, key).groupBy(F.spark_partition_id()).agg(F.min(key), F.max(key))
        return _within(key, sorted((low, high) for _, low, high in parts.collect()))
    step = -(-len(few) // SPANS) or 1
    spans = [(few[i], few[min(i + step, len(few)) - 1]) for i in range(0, len(few), step)]
    named = F.expr(f"{key} IN ({', '.join(map(str, few))})") if few and isinstance(few[0], int) else F.col(key).isin(few)
    return reduce(Column.__and__, [named, *([_within(key, spans)] if len(few) > 10 else [])])


def probe(table: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of a large saved ``table`` with ``wanted`` rows.

    Scans are told the keys, or their ranges. The planner broadcasts ``wanted`` only if
    its size allows.
    """
    return reduce(DataFrame.where, [key_filter(wanted, key) for key in keys], table).join(wanted, keys)


def lookup(records: DataFrame, wanted: DataFrame, buckets: int | None = None) -> DataFrame:
    """Records of an index by ``doc_id``; any number of them.

    Wanted rows beyond the broadcast limit are dealt to the buckets that the records
    lie in, so that records do not move.
    """
    found = records.where(key_filter(wanted, "doc_id"))
    if buckets is None or _join_bytes(wanted, wanted.columns) <= _broadcast_limit(records.sparkSession):
        return found.join(wanted, "doc_id")
    return found.join(wanted.repartition(buckets, "doc_id"), "doc_id")


def _broadcast_limit(spark: SparkSession) -> int:
    """Bytes that may be broadcast; 0 or less: none."""
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")))


def row_bytes(columns: list[tuple[str, str]]) -> Column:
    """About what a row takes in a broadcast table."""
    text = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in columns if kind == "string"]
    return reduce(Column.__add__, text, F.lit(32 + 16 * len(columns)))


def _join_bytes(rows: DataFrame, columns: list[str]) -> int:
    return rows.agg(F.sum(row_bytes(rows.select(*columns).dtypes))).first()[0] or 0


def term_blocks(terms: DataFrame, limit: int) -> list[tuple[Column, Column]]:
    """(filter of postings, filter of terms) for parts of ``terms`` of at most ``limit`` bytes.

    Parts are term folders, or ranges of terms within one folder, so that all parts
    together read the postings once. Only the rows of one single term that exceed the
    limit are split by query, and read that term's postings again.
    """
    size = row_bytes(terms.dtypes).alias("size")
    folders = terms.groupBy("term_bucket").agg(F.sum(size).alias("size")).orderBy("term_bucket").collect()
    blocks, packed, room = [], [], 0
    for bucket, total in folders:
        mine = F.col("term_bucket") == bucket
        if total > limit:
            inside = terms.where(mine).repartitionByRange(-(-total // limit), "term")
            for _, low, high, own in inside.groupBy(F.spark_partition_id()).agg(F.min("term"), F.max("term"), F.sum(size)).collect():
                span, parts = mine & F.col("term").between(low, high), -(-own // (2 * limit))
                blocks += [(span, span & (F.pmod(F.xxhash64("query_id"), F.lit(parts)) == k)) for k in range(parts)]
        elif packed and total <= room:
            packed[-1].append(bucket)
            room -= total
        else:
            packed.append([bucket])
            room = limit - total
    return blocks + [(F.col("term_bucket").isin(b), F.col("term_bucket").isin(b)) for b in packed]


#: What names the postings of a term.
TERM_KEYS = ["field", "term_bucket", "term"]
#: Blocks that terms go in at most, about; more terms make them larger. Each opens all buckets and costs the
#: driver some jobs, so if both grew with the input, tasks would with its square.
BLOCKS = 8


def probe_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the wanted terms(field, term_bucket, term, query_id, …); no posting moves.

    Terms beyond the broadcast limit go in blocks below it, or in ``BLOCKS`` larger ones,
    each over its own part of the postings; of those, only rows found travel on.
    """
    limit, size = _broadcast_limit(postings.sparkSession), _join_bytes(terms, terms.columns)
    if limit <= 0 or size <= limit:
        return probe(postings, terms, TERM_KEYS)
    parts = [
        probe(postings.where(of_postings), F.broadcast(terms.where(of_terms)), TERM_KEYS)
        for of_postings, of_terms in term_blocks(terms, max(limit, -(-size // BLOCKS)))
    ]
    return reduce(DataFrame.unionByName, parts)
