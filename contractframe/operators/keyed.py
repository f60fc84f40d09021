"""Attach one-row-per-key values to a large table without skewed tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.storage import ROW_ID, materialize

HEAVY_KEYS = 1000  # broadcast digests; any key outside holds at most 1/1000 of the table
CHUNK_ROWS = 128  # rows of a heavy key that share one copy of its values


def _token(key: Column, key_type: T.DataType) -> Column:
    """What stands for a key in joins: long keys cost no more than short ones."""
    if isinstance(key_type, (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(key, 256))
    return key


def attach_by_key(df: DataFrame, per_key: DataFrame, key: str, weight: str) -> DataFrame:
    """Left-join ``per_key`` (unique on ``key``) to ``df``, whatever the key distribution.

    ``weight`` is the row count of a key.  The HEAVY_KEYS heaviest keys are dealt
    into chunks of CHUNK_ROWS rows, and their values are copied once per chunk,
    which adds one row for each 128; rows without a key are dealt by row and
    match nothing.  Only digests and chunk counts are broadcast, never values.
    Rows are dealt by ``_row_id``; without one by their place in a stored copy,
    so that equal rows part and a task that runs again deals its rows as before.
    """
    values = [c for c in per_key.columns if c not in (key, weight)]
    columns, spread = df.columns, ROW_ID
    if ROW_ID not in columns:
        spread = "_spread"
        df = materialize(df.withColumn(spread, F.monotonically_increasing_id()), "dealt")
    key_type = df.schema[key].dataType
    stored = materialize(
        per_key.where(F.col(key).isNotNull()).select(
            _token(F.col(key), key_type).alias("_key"), F.col(weight).alias("_weight"), *[F.col(v).alias(f"_of_{v}") for v in values]
        ),
        "per-key",
    )
    heavy = (
        stored.where(F.col("_weight") > CHUNK_ROWS)
        .select("_key", "_weight")
        .orderBy(F.desc("_weight"), "_key")
        .limit(HEAVY_KEYS)
        .select(F.col("_key").alias("_heavy"), F.ceil(F.col("_weight") / CHUNK_ROWS).cast("bigint").alias("_chunks"))
    )
    own = [f"_of_{v}" for v in values]
    copies = stored.join(F.broadcast(heavy), F.col("_key") == F.col("_heavy")).select(
        "_key", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_chunks"))).alias("_part"), *own
    )
    right = stored.select("_key", F.lit(0).cast("bigint").alias("_part"), *own).unionByName(copies)
    dealt = (
        df.withColumn("_token", _token(F.col(key), key_type))
        .join(F.broadcast(heavy), F.col("_token") == F.col("_heavy"), "left")
        .withColumn(
            "_salt",
            F.when(F.col("_chunks").isNotNull(), 1 + F.pmod(F.xxhash64(spread), F.col("_chunks")))
            .when(F.col("_token").isNull(), -1 - F.pmod(F.xxhash64(spread), F.lit(1 << 40)))
            .otherwise(0),
        )
    )
    joined = dealt.join(right, (F.col("_token") == F.col("_key")) & (F.col("_salt") == F.col("_part")), "left")
    return joined.select(*columns, *[F.col(f"_of_{v}").alias(v) for v in values])
