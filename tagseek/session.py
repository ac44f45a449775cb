"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}


def local_session(cores: str = "*", name: str = "tagseek", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a session of one machine may leave it unset; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tagseek-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/tagseek/{label}-{uuid.uuid4().hex[:16]}"


def settle(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lost executors do not lose it, later readers do not recompute it, and the
    planner knows its true size: it is broadcast if, and only if, it is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with kept_types(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Set session options for one block (double underscores stand for dots)."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def kept_types(spark: SparkSession):
    """Writes of variants keep every value's own type. Split into typed columns, a
    whole number beside a real one of the same name would come back as a real one."""
    return settings(spark, spark__sql__variant__writeShredding__enabled="false", spark__sql__variant__inferShreddingSchema="false")


def worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters must not recompute.

    A filter is pushed below a projection by repeating its expressions; it is
    not pushed below a generator, and this one yields exactly one row per row.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*df.columns, F.inline_outer(F.array(row)))
