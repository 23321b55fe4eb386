"""Session settings, the shared working folder and size-checked lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only when it was measured and has at most this many rows and bytes.
LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 32 * 2**20
SLOT_BYTES = 16


def build_session(app: str = "wanewatch", cores: int = 8, **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="wanewatch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/wanewatch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def at_once(spark: SparkSession, tasks: list[Callable[[], object]], parallel: int) -> list:
    """Results of the tasks in their order, so many of them started from threads of the driver at a time."""
    if min(parallel, len(tasks)) < 2:
        return [task() for task in tasks]
    shared_dir(spark)  # set by one thread, not by several
    with ThreadPool(min(parallel, len(tasks))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(spark)(task) for task in tasks], 1)


def value_bytes(value: Column, kind: T.DataType) -> Column | int:
    """Bytes a value takes; a plain number where the type alone tells."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint") + SLOT_BYTES
    if isinstance(kind, T.StructType):
        return sum((value_bytes(value[f.name], f.dataType) for f in kind.fields), SLOT_BYTES)
    if isinstance(kind, T.ArrayType):
        return _list_bytes(value, kind.elementType)
    if isinstance(kind, T.MapType):
        keys = _list_bytes(F.map_keys(value), kind.keyType)
        return keys + _list_bytes(F.map_values(value), kind.valueType)
    return SLOT_BYTES


def _list_bytes(value: Column, kind: T.DataType) -> Column:
    probe = value_bytes(F.lit(None).cast(kind), kind)
    if isinstance(probe, int):
        inner = F.size(value).cast("bigint") * probe
    else:
        inner = F.aggregate(
            value,
            F.lit(0).cast("bigint"),
            lambda total, x: total + F.lit(value_bytes(x, kind)).cast("bigint"),
        )
    return F.greatest(F.coalesce(inner, F.lit(0)), F.lit(0)).cast("bigint") + SLOT_BYTES


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_rows: int = LOOKUP_ROWS,
    max_bytes: int = LOOKUP_BYTES,
) -> DataFrame:
    """Join a table to a lookup side, broadcasting the lookup only if it is small.

    Rows of fixed width are fetched up to the bound and broadcast from there. Rows with texts
    or lists are written once and their bytes summed before anything is fetched. Beyond either
    bound the plain join runs and adaptive execution splits skewed partitions.
    """
    width = sum(
        (value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in right.schema.fields), SLOT_BYTES
    )
    if isinstance(width, int):
        bound = min(max_rows, max_bytes // width)
        rows = right.take(bound + 1)
        if len(rows) <= bound:
            right = F.broadcast(right.sparkSession.createDataFrame(rows, right.schema))
    else:
        right = cut_lineage(right)
        n, size = right.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
        if n <= max_rows and size <= max_bytes:
            right = F.broadcast(right)
    return left.join(right, on, how)
