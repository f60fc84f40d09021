"""Shared storage for intermediate tables, and stable row ids."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_ID = "_row_id"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="contractframe-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/contractframe-{label}-{uuid.uuid4().hex}"


#: Spark then deletes the shuffle files of a query when it ends, and not only when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_discarded(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; what they give must be stored or collected."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str, path: str | None = None, rows_at_once: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Cuts the lineage: the result survives lost executors, and later stages read
    only the columns they need, with real size statistics.  Tasks hold a row group
    of all rows they write, and of those they read, up to 4,096 rows; ``rows_at_once``
    makes the groups smaller, for rows of megabytes.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    if rows_at_once:
        writer = writer.option("parquet.block.row.count.limit", rows_at_once)
    with shuffles_discarded(spark):
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that nothing will read again; frames that are not stored are left alone."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            context = df.sparkSession.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of a table that ``materialize`` has stored; endless for any other."""
    path = getattr(df, "_stored_at", None)
    if not path:
        return 1 << 62
    context = df.sparkSession.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def _number_partitions(stored: DataFrame, position: str, name: str) -> tuple[DataFrame, int]:
    """Turn (partition, position in partition) into consecutive global numbers.

    Only one count per partition comes to the driver.
    """
    spark = stored.sparkSession
    part = F.shiftright(F.col(position), 33)
    counts = sorted(stored.groupBy(part.alias("p")).count().collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    if len(offsets) <= 1:
        return stored.withColumn(name, F.col(position).bitwiseAND((1 << 33) - 1)).drop(position), total
    small = spark.createDataFrame(offsets, "_p bigint, _offset bigint")
    out = (
        stored.withColumn("_p", part)
        .join(F.broadcast(small), "_p")  # one row per partition
        .withColumn(name, F.col("_offset") + F.col(position).bitwiseAND((1 << 33) - 1))
        .drop("_p", "_offset", position)
    )
    return out, total


def with_rank(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Add the 0-based global rank of each row under ``order`` and return the row count.

    Range-partitions and sorts inside partitions, so no task sees more than its
    range.  ``order`` should end in a unique column: it fixes ties, and it lets
    the ranges split a value that fills a large share of the table.  The sorted
    table is written once because range bounds are sampled anew in every run.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    return _number_partitions(materialize(placed, "rank"), "_position", name)


def with_row_id(df: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Add consecutive ``_row_id`` values: by ``order``, else in scan order."""
    if order:
        return with_rank(df, order, ROW_ID)[0]
    placed = df.withColumn("_position", F.monotonically_increasing_id())
    return _number_partitions(materialize(placed, "rows"), "_position", ROW_ID)[0]


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def evaluated_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters read instead of computing again.

    Exploding a one-element array changes nothing, but no filter moves below it,
    neither a written one nor the one Spark infers from exploding ``name``.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="contractframe-py-"), "contractframe.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
