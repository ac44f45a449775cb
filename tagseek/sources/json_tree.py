"""Folders of nested JSON files to flat records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settings, settle

TEXT, TAG, START, END = "text", "bookmark_tag", "start", "end"


def read_json_files(spark: SparkSession, folder: str, pattern: str = "*.[jJ][sS][oO][nN]", underscored: str = "fail") -> DataFrame:
    """(filename, filepath, value): one row per file that lies directly in the
    folder and whose name fits ``pattern``, by default ``.json`` in any case. Hidden files are skipped.

    Spark's readers never open a file whose name starts with ``_``. Such files are
    not left out unseen: they are an error, unless ``underscored="skip"``.
    """
    if underscored not in ("fail", "skip"):
        raise ValueError(f"underscored must be 'fail' or 'skip', got {underscored!r}")
    if underscored == "fail" and (unread := _underscored(spark, folder, pattern)):
        raise ValueError(f"{len(unread)} files start with '_' and cannot be read, such as {unread[0]}; rename them or pass underscored='skip'")
    return (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
        .select(
            F.col("_metadata.file_name").alias("filename"),
            F.col("_metadata.file_path").alias("filepath"),
            "value",
        )
    )


def _underscored(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names of the folder's files that fit ``pattern`` and start with ``_``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    # the pattern itself must fit too, as in a_*.json
    fits = hadoop.GlobFilter(pattern)
    found = files.globStatus(hadoop.Path(folder, "_*")) or []
    return [f.getPath().getName() for f in found if f.isFile() and fits.accept(f.getPath())]


# path: the node's position at each level, which sorts parents first.
# shape: first word of the node's type. direct: the object's own tag, if a string.
# sealed: an object above the node has a tag of its own, which ends the search
# for the file's tag there. root_tag: what the file's root has as direct.
_TREE = """
WITH RECURSIVE tree (filename, filepath, path, node, shape, direct, sealed, root_tag) MAX RECURSION LEVEL {levels} AS (
  SELECT filename, filepath, CAST(array() AS array<int>), node, shape, {direct}, false, {direct}
  FROM (SELECT *, substring_index(substring_index(schema_of_variant(node), '<', 1), '(', 1) AS shape FROM {{roots}})
  WHERE shape IN ('OBJECT', 'ARRAY')
  UNION ALL
  SELECT filename, filepath, path, node, shape, {direct}, sealed, root_tag
  FROM (
    SELECT t.filename, t.filepath, array_append(t.path, c.pos) AS path, c.value AS node,
           t.sealed OR t.direct IS NOT NULL AS sealed, t.root_tag,
           substring_index(substring_index(schema_of_variant(c.value), '<', 1), '(', 1) AS shape
    FROM tree AS t, LATERAL variant_explode(t.node) AS c
  )
  WHERE shape IN ('OBJECT', 'ARRAY')
)
SELECT filename, filepath, path, size(path) AS depth, direct, sealed, root_tag, {own} AS fields FROM tree WHERE shape = 'OBJECT'
"""
_DIRECT = (
    "CASE WHEN shape = 'OBJECT' AND schema_of_variant(try_variant_get(node, '$.bookmark_tag', 'variant')) = 'STRING' "
    "THEN try_variant_get(node, '$.bookmark_tag', 'string') END"
)
# An object without its object and array members, which are rows of their own.
_OWN = (
    "to_variant_object(map_filter(CAST(node AS map<string, variant>), "
    "(k, v) -> NOT coalesce(startswith(schema_of_variant(v), 'OBJECT') OR startswith(schema_of_variant(v), 'ARRAY'), false)))"
)


def flatten_json(files: DataFrame, max_levels: int = 500, on_error: str = "fail") -> DataFrame:
    """Every object at any depth → (filename, filepath, path, depth, direct,
    sealed, root_tag, fields), ``fields`` being the object's own scalar members.

    A malformed file fails the job, or is left out with ``on_error="skip"``.
    Levels are worked off one after the other, each over all files at once, and the
    result is written down: the session's limit on recursive rows is lifted for it alone.
    """
    spark = files.sparkSession
    parse = {"fail": F.parse_json, "skip": F.try_parse_json}[on_error]
    roots = files.select("filename", "filepath", parse("value").alias("node"))
    with settings(spark, spark__sql__cteRecursionRowLimit="-1"):
        return settle(spark.sql(_TREE.format(levels=max_levels, direct=_DIRECT, own=_OWN), roots=roots), "nodes")


def tag_files(nodes: DataFrame, strict: bool = False) -> DataFrame:
    """Give every record its file's tag, as ``bookmark_tag``.

    The root's own string tag counts, even an empty one; else the first
    non-empty one in reading order (members by name, parents first). A file
    without any gets the empty string, or fails with ``strict``.
    """
    named = nodes.where(F.col("root_tag").isNotNull()).withColumn("bookmark_tag", F.col("root_tag"))
    rest = nodes.where(F.col("root_tag").isNull())
    candidate = (F.col("direct") != "") & ~F.col("sealed")
    # One partial result per task and file, so one huge file does no harm.
    tags = rest.groupBy("filepath").agg(
        F.min_by(F.when(candidate, F.col("direct")), F.when(candidate, F.col("path"))).alias("bookmark_tag")
    )
    missing = F.raise_error(F.concat(F.lit("no bookmark_tag in "), F.col("filepath"))) if strict else F.lit("")
    tags = tags.select("filepath", F.coalesce("bookmark_tag", missing).alias("bookmark_tag"))
    return named.unionByName(rest.join(settle(tags, "tags"), "filepath"))


def typed_fields(nodes: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Fields by the type of their value.

    With ``types`` ({name: type}) one column each, NULL where the value is of
    another kind. Without, the long form (…, field, type, value): strings,
    whole numbers (bigint), reals (double) and booleans (as text); nulls,
    objects and arrays of scalars are no fields.
    """
    others = [c for c in nodes.columns if c != "fields"]
    if types is not None:
        picked = []
        for name, kind in types.items():
            path = "$['" + name.replace("'", "\\'") + "']"
            value = F.try_variant_get("fields", path, "variant")
            found = _kind(F.schema_of_variant(value))
            wanted = {"string": ["string", "boolean"], "bigint": ["bigint"], "double": ["double", "bigint"]}[kind]
            picked.append(F.when(found.isin(wanted), F.try_variant_get("fields", path, kind)).alias(name))
        return nodes.select(*others, *picked)
    spark = nodes.sparkSession
    listed = spark.sql(
        f"SELECT {', '.join('n.`' + c + '`' for c in others)}, c.key AS field, schema_of_variant(c.value) AS shape, "
        "c.value AS value FROM {nodes} AS n, LATERAL variant_explode(n.fields) AS c",
        nodes=nodes,
    )
    kind = _kind(F.col("shape"))
    text = F.try_variant_get("value", "$", "string")
    shown = F.when(kind == "double", F.try_variant_get("value", "$", "double").cast("string")).otherwise(text)
    return listed.select(*others, "field", kind.alias("type"), shown.alias("value")).where(F.col("type").isNotNull())


def _kind(shape):
    return (
        F.when(shape == "STRING", "string")
        .when(shape == "BIGINT", "bigint")
        .when((shape == "DOUBLE") | (shape == "FLOAT") | shape.startswith("DECIMAL"), "double")
        .when(shape == "BOOLEAN", "boolean")
    )


def records(tagged: DataFrame) -> DataFrame:
    """Tagged objects → documents(doc_id, bookmark_tag, start, end, text,
    filename, filepath, fields). Only a string ``text`` is searched."""
    columns = [*tagged.columns]
    typed = tagged.select(
        *columns,
        F.when(
            F.schema_of_variant(F.try_variant_get("fields", "$.text", "variant")) == "STRING",
            F.try_variant_get("fields", "$.text", "string"),
        ).alias(TEXT),
        _number("start"),
        _number("end"),
    )
    return typed.select(
        F.xxhash64("filepath", F.to_json("path")).alias("doc_id"),
        TAG,
        START,
        END,
        TEXT,
        "filename",
        "filepath",
        "fields",
    )


def _number(name: str):
    kind = _kind(F.schema_of_variant(F.try_variant_get("fields", f"$.{name}", "variant")))
    return F.when(kind.isin("bigint", "double"), F.try_variant_get("fields", f"$.{name}", "double")).alias(name)


def read_records(
    spark: SparkSession,
    folder: str,
    strict: bool = False,
    on_error: str = "fail",
    pattern: str = "*.[jJ][sS][oO][nN]",
    max_levels: int = 500,
    underscored: str = "fail",
) -> DataFrame:
    """A folder of JSON files → documents, ready for ``save_index``.

    The tree of each file is walked once and written down; tags and records
    are both taken from that table.
    """
    nodes = flatten_json(read_json_files(spark, folder, pattern, underscored), max_levels, on_error)
    return records(tag_files(nodes, strict))
