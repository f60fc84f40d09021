"""Rule-based cleaning: strip, map values, drop exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.contract import Contract
from contractframe.functions.text import strip_control, strip_text
from contractframe.operators.keyed import attach_by_key
from contractframe.storage import ROW_ID, materialize, named


def _string_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def strip_whitespace(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: strip_text(F.col(c)) for c in _string_columns(df, columns)})


def strip_control_chars(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: strip_control(F.col(c)) for c in _string_columns(df, columns)})


def strip_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many cells of each column stripping changes: one pass over the table."""
    columns = _string_columns(df, columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, changed bigint")
    one = df.agg(*[F.count_if(~F.col(c).eqNullSafe(strip_text(F.col(c)))).alias(c) for c in columns])
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("changed")) for c in columns]))
    )


def _lossless(value: Column, kind: T.DataType) -> Column:
    """Text that is equal exactly where values are equal to a grouping; null stays null."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # One zero and one NaN, and the shortest text that reads back as the same number.
        return F.when(F.isnan(value), "NaN").otherwise((value + F.lit(0.0).cast(kind)).cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.ArrayType):
        return _joined(F.transform(value, lambda x: _marked(_lossless(x, kind.elementType))), value)
    if isinstance(kind, T.StructType):
        return _joined(F.array(*[_marked(_lossless(value.getField(f.name), f.dataType)) for f in kind.fields]), value)
    return value.cast("string")  # whole numbers, decimals, dates, naive times (to the microsecond), text, booleans


def _marked(text: Column) -> Column:
    """Length and text, so that neighbours can't run into each other; null is a mark of its own."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _joined(parts: Column, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.size(parts).cast("string"), F.lit("["), F.array_join(parts, "")))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """256 bits that are equal for rows equal in these columns (nulls equal)."""
    parts = [_marked(_lossless(named(c), df.schema[c].dataType)) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def exact_dedupe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows equal in ``columns`` (all, nulls equal), keeping the first whole row by row id.

    Rows are grouped by digest, with a partial minimum per task, so neither
    texts nor copies are shuffled; kept rows are then fetched by row id.
    """
    columns = columns or [c for c in df.columns if c != ROW_ID]
    if ROW_ID not in df.columns:
        return df.dropDuplicates(columns)
    kept = df.groupBy(row_digest(df, columns).alias("_digest")).agg(F.min(ROW_ID).alias("_kept"))
    return df.join(kept.select("_kept"), F.col(ROW_ID) == F.col("_kept"), "left_semi")


def dedupe_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows before, after and dropped. Groups by a 256-bit row digest, so text is not shuffled."""
    columns = columns or [c for c in df.columns if c != ROW_ID]
    return (
        df.select(row_digest(df, columns).alias("d"))
        .groupBy("d")
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n").alias("rows_before"), F.count("*").alias("rows_after"))
        .select(
            F.coalesce("rows_before", F.lit(0)).cast("bigint").alias("rows_before"),
            F.col("rows_after"),
            (F.coalesce("rows_before", F.lit(0)) - F.col("rows_after")).cast("bigint").alias("dropped"),
        )
    )


def apply_value_map(df: DataFrame, column: str, mapping: dict | DataFrame) -> DataFrame:
    """Replace the values of one column that the map names; others pass unchanged.

    The map, a dict or a DataFrame with columns ``original`` and ``canonical``,
    is joined to the distinct values, its size not assumed.  Equal entries count
    once; entries that map one value to two are refused.
    """
    out_type = df.schema[column].dataType
    if isinstance(mapping, dict):
        mapping = df.sparkSession.createDataFrame(
            [(str(k), None if v is None else str(v)) for k, v in mapping.items()], "original string, canonical string"
        )
    # Values meet as the type of the column: as texts, 1 and 1.0 would differ.
    entries = mapping.select(F.col("original").cast(out_type).alias("_original"), F.col("canonical").cast(out_type).alias("_canonical"))
    entries = materialize(
        entries.where("_original IS NOT NULL").groupBy("_original").agg(F.min("_canonical").alias("_canonical"), F.max("_canonical").alias("_other")), "value-map"
    )
    doubled = entries.where("_canonical <> _other").select(F.col("_original").cast("string")).limit(5).collect()
    if doubled:
        raise ValueError(f"the value map maps to more than one value: {[r[0] for r in doubled]}")
    # Attach per distinct value, weighted by its rows, so that a value that
    # fills a third of the column does not make one slow task.
    weights = df.groupBy(named(column).alias("_value")).agg(F.count("*").alias("_n"))
    known = weights.join(entries, F.col("_value") == F.col("_original")).select(F.col("_value").alias(column), "_n", "_canonical")
    joined = attach_by_key(df, known, column, "_n")
    return joined.withColumn(column, F.coalesce(F.col("_canonical"), named(column))).drop("_canonical").select(*[named(c) for c in df.columns])


def clean(df: DataFrame, contract: Contract) -> DataFrame:
    """The cleaning stage: strip text-like columns, then drop exact duplicates."""
    return exact_dedupe(strip_whitespace(df, contract.text_columns(df.columns)))
