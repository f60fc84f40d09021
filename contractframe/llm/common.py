"""What the operators share: tables, row keys, Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractframe import storage
from contractframe.storage import discard, materialize, scratch_path

__all__ = ["batches", "discard", "ground", "materialize", "row_key", "scratch_path", "ship_package", "slices", "table"]


#: Arrow batches of texts, unless the session sets its own: rows and bytes that a Python worker gets at once.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864", "8388608")}


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers, and texts in batches that fit beside each other."""
    storage.ship_package(spark)
    for name, (default, small) in _BATCHES.items():
        if spark.conf.get(name, default) in (default, "64MB", "9223372036854775807"):
            spark.conf.set(name, small)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(text: Column) -> Column:
    """With the id of a row, tells texts of one id apart; rows of equal id and text share their results."""
    return F.xxhash64(text)


def ground(df: DataFrame, **columns: Column) -> DataFrame:
    """Only these columns, so that extra columns of the input can't clash with an operator's own."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose ``column`` holds about ``most_bytes``, at least a row each."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size, dtype="int64") // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def batches(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in columns.values()], names=list(columns)
    )
