"""Column profiles: nulls, distinct counts, top values, ranges, lengths, freshness.

Two passes whatever the number and types of columns: one aggregate for everything
that is one number per column, ages included, and one frequency count for distinct
and top values.  A third reads only the rows that hold a long text among the top values.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.functions import pii
from contractframe.functions.coercion import is_float, is_integer, is_number, is_time, missing
from contractframe.storage import ROW_ID, named

TOP = 5
LONG_TEXT = 64  # bytes; longer texts are grouped by digest and looked up afterwards

# How a timestamp is written in a profile.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def profiled_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ID]


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.BooleanType):
        return "boolean"
    if is_integer(t):
        return "integer"
    if is_float(t):
        return "float"
    if isinstance(t, T.DecimalType):
        return "decimal"
    if is_time(t):
        return "time"
    return "text"


def _tall(one: DataFrame, rows: list[Column], schema_of_none: str) -> DataFrame:
    if not rows:
        return one.sparkSession.createDataFrame([], schema_of_none)
    return one.select(F.inline(F.array(*rows)))


def profile_table(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "column_count", F.lit(len(profiled_columns(df))).cast("bigint")
    )


def _as_double(c: Column, t: T.DataType) -> Column:
    c = c.cast("int") if isinstance(t, T.BooleanType) else c
    d = c.cast("double")
    return F.when(~F.isnan(d), d) if is_float(t) else d


def _time_text(c: Column) -> Column:
    return F.date_format(c, TIMESTAMP_TEXT)


def profile_stats(df: DataFrame, as_of: Column | None = None, threshold_days: float | None = None) -> DataFrame:
    """Nulls, numeric and time ranges and text lengths of every column, in one aggregate.

    With ``threshold_days`` also span, age at ``as_of`` and staleness of time columns.
    """
    columns = profiled_columns(df)
    aggs: list[Column] = [F.count("*").alias("rows")]
    rows: list[Column] = []
    none_d, none_i, none_s = (F.lit(None).cast(t) for t in ("double", "bigint", "string"))
    for i, c in enumerate(columns):
        t = df.schema[c].dataType
        v, kind = named(c), _kind(t)
        aggs.append(F.count_if(missing(v, t)).alias(f"nulls_{i}"))
        out = dict(min=none_d, max=none_d, mean=none_d, std=none_d, first=none_s, last=none_s, lo=none_i, hi=none_i)
        ages = [none_d.alias("span_days"), none_d.alias("staleness_days"), F.lit(None).cast("boolean").alias("is_stale")]
        if kind in ("integer", "float", "decimal", "boolean"):
            d = _as_double(v, t)
            aggs += [F.min(d).alias(f"min_{i}"), F.max(d).alias(f"max_{i}"),
                     F.avg(d).alias(f"mean_{i}"), F.stddev_samp(d).alias(f"std_{i}")]
            some = F.col(f"min_{i}").isNotNull()
            out.update(min=F.col(f"min_{i}"), max=F.col(f"max_{i}"), mean=F.round(f"mean_{i}", 4),
                       # one value has no spread
                       std=F.when(some, F.round(F.coalesce(F.col(f"std_{i}"), F.lit(0.0)), 4)))
        elif kind == "time":
            aggs += [F.min(v).alias(f"first_{i}"), F.max(v).alias(f"last_{i}")]
            out.update(first=_time_text(F.col(f"first_{i}")), last=_time_text(F.col(f"last_{i}")))
            if threshold_days is not None:
                ages = _ages(F.col(f"last_{i}"), F.col(f"first_{i}"), t, as_of, threshold_days)
        elif isinstance(t, T.StringType):
            aggs += [F.min(F.length(v)).alias(f"lo_{i}"), F.max(F.length(v)).alias(f"hi_{i}")]
            out.update(lo=F.col(f"lo_{i}").cast("bigint"), hi=F.col(f"hi_{i}").cast("bigint"))
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(t.simpleString()).alias("dtype"),
                F.col(f"nulls_{i}").alias("null_count"),
                F.when(F.col("rows") > 0, F.round(F.lit(100.0) * F.col(f"nulls_{i}") / F.col("rows"), 3))
                .otherwise(F.lit(0.0)).alias("null_pct"),
                out["min"].alias("min_value"), out["max"].alias("max_value"),
                out["mean"].alias("mean_value"), out["std"].alias("std_value"),
                out["first"].alias("min_time"), out["last"].alias("max_time"),
                out["lo"].alias("min_length"), out["hi"].alias("max_length"),
                *(ages if threshold_days is not None else []),
            )
        )
    return _tall(df.agg(*aggs), rows, "position int, column string")


def profile_nulls(df: DataFrame) -> DataFrame:
    return profile_stats(df).select("column", "null_count", "null_pct")


def profile_numeric(df: DataFrame) -> DataFrame:
    return profile_stats(df).where("min_value is not null").select(
        "column", "min_value", "max_value", "mean_value", "std_value"
    )


def profile_datetime(df: DataFrame) -> DataFrame:
    return profile_stats(df).where("min_time is not null").select("column", "min_time", "max_time")


def profile_lengths(df: DataFrame) -> DataFrame:
    return profile_stats(df).where("min_length is not null").select("column", "min_length", "max_length")


# -- frequencies ---------------------------------------------------------------


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table of one column; nulls are a value of their own."""
    return df.groupBy(named(column).alias("value")).agg(F.count("*").alias("n"))


def _value_text(c: Column, kind: str, t: T.DataType) -> Column:
    if kind == "time" and not isinstance(t, T.DateType):
        return _time_text(c)
    return c.cast("string")


def value_frequencies(df: DataFrame) -> DataFrame:
    """(column, value, digest, n, first_row) for every distinct non-null value of every column.

    All columns are unpivoted in one scan, each into the slot of its native type; a
    long text is keyed by its 256-bit digest with ``value`` left null.  Hot values
    collapse before the one shuffle.  Without ``_row_id``, ``first_row`` is null and
    texts are keyed whole.
    """
    columns = profiled_columns(df)
    has_id = ROW_ID in df.columns
    slot_of, slots = [], {}
    for c in columns:
        t = df.schema[c].dataType
        kind = _kind(t)
        native = {"boolean": "boolean", "integer": "bigint", "float": "double", "text": "string"}.get(kind, t.simpleString())
        slots.setdefault(native, (f"v{len(slots)}", kind, t))
        slot_of.append(native)
    none = {native: F.lit(None).cast(native) for native in slots}
    cells = []
    for i, c in enumerate(columns):
        t = df.schema[c].dataType
        value = F.when(~missing(named(c), t), named(c).cast(slot_of[i]))
        cells += [F.lit(i), *[value if native == slot_of[i] else none[native] for native in slots]]
    names = [name for name, _, _ in slots.values()]
    row = (F.col(ROW_ID) if has_id else F.lit(None).cast("bigint")).alias("row")
    tall = df.select(row, F.stack(F.lit(len(columns)), *cells).alias("k", *names))
    tall = tall.where(reduce(or_, [F.col(n).isNotNull() for n in names]))
    text = slots.get("string", (None,))[0]
    keys = ["k", *names]
    digest = F.lit(None).cast("binary")
    if text and has_id:  # without a row id there is no way back from the digest
        long = F.octet_length(text) > LONG_TEXT
        tall = tall.withColumn("digest", F.when(long, F.unhex(F.sha2(text, 256)))).withColumn(text, F.when(~long, F.col(text)))
        keys, digest = [*keys, "digest"], F.col("digest")
    counted = tall.groupBy(*keys).agg(F.count("*").alias("n"), F.min("row").alias("first_row"))
    column = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("k") + 1)
    value = F.coalesce(*[_value_text(F.col(name), kind, t) for name, kind, t in slots.values()])
    return counted.select(column.alias("column"), value.alias("value"), digest.alias("digest"), "n", "first_row")


def distinct_of(freq: DataFrame) -> DataFrame:
    # The condition always holds. It names both aggregates, so this branch keeps
    # the same shuffle as the top values and Spark runs that shuffle once.
    return freq.groupBy("column").agg(F.count_if(F.greatest("n", "first_row") >= 1).alias("distinct_count"))


def top_of(freq: DataFrame, df: DataFrame, k: int = TOP) -> DataFrame:
    """The k most frequent values per column; ties go to the value seen first.

    Spark cuts each task to k rows per column before the shuffle (window group limit).
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("first_row"), F.asc("value"), F.asc("digest"))
    top = freq.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    texts = [c for c in profiled_columns(df) if isinstance(df.schema[c].dataType, T.StringType)]
    if ROW_ID in df.columns and texts:
        top = _fill_long(top, df, texts)
    return top.select("column", F.col("rank").cast("int").alias("rank"), "value", "n")


def _fill_long(top: DataFrame, df: DataFrame, texts: list[str]) -> DataFrame:
    """Fetch the long texts among the top values by their first row."""
    # At most k rows per column.
    wanted = F.broadcast(
        top.where("digest is not null").select(F.col("first_row").alias("_first"), F.col("column").alias("_column"))
    )
    found = (
        df.select(F.col(ROW_ID).alias("_row"), *[named(c).alias(f"t{i}") for i, c in enumerate(texts)])
        .join(wanted, F.col("_row") == F.col("_first"))
        .select(
            "_first", "_column",
            F.coalesce(*[F.when(F.col("_column") == c, F.col(f"t{i}")) for i, c in enumerate(texts)]).alias("_text"),
        )
    )
    return (
        top.join(
            F.broadcast(found),  # again at most k rows per column
            (F.col("column") == F.col("_column")) & (F.col("first_row") == F.col("_first")) & F.col("digest").isNotNull(),
            "left",
        )
        .withColumn("value", F.coalesce("value", "_text"))
    )


def profile_distinct(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; ``approximate`` uses sketches in one pass without shuffling values."""
    columns = profiled_columns(df)
    if approximate:
        one = df.agg(*[F.approx_count_distinct(
            F.when(~missing(named(c), df.schema[c].dataType), named(c))).alias(f"d{i}") for i, c in enumerate(columns)])
        return one.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("distinct_count")) for i, c in enumerate(columns)])))
    counts = distinct_of(value_frequencies(df))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(counts, "column", "left").select("column", F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias("distinct_count"))


def profile_top_values(df: DataFrame, k: int = TOP) -> DataFrame:
    return top_of(value_frequencies(df), df, k)


def freshness(df: DataFrame, as_of: Column | None = None, threshold_days: float = 90) -> DataFrame:
    """Newest and oldest value, span and age of every time column that has values.

    Naive timestamps are taken as UTC, as is ``as_of`` when naive.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    columns = [c for c in profiled_columns(df) if is_time(df.schema[c].dataType)]
    aggs, rows = [], []
    for i, c in enumerate(columns):
        aggs += [F.min(named(c)).alias(f"o{i}"), F.max(named(c)).alias(f"n{i}")]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                _time_text(F.col(f"n{i}")).alias("newest"),
                _time_text(F.col(f"o{i}")).alias("oldest"),
                *_ages(F.col(f"n{i}"), F.col(f"o{i}"), df.schema[c].dataType, as_of, threshold_days),
            )
        )
    schema = "column string, newest string, oldest string, span_days double, staleness_days double, is_stale boolean"
    if not columns:
        return df.sparkSession.createDataFrame([], schema)
    return _tall(df.agg(*aggs), rows, schema).where("newest is not null")


def _ages(newest: Column, oldest: Column, t: T.DataType, as_of: Column, threshold_days: float) -> list[Column]:
    newest, oldest, day = _micros(newest, t), _micros(oldest, t), F.lit(86_400_000_000.0)
    age = (F.unix_micros(as_of.cast("timestamp")) - newest) / day
    return [
        F.round((newest - oldest) / day, 3).alias("span_days"),
        F.round(age, 3).alias("staleness_days"),
        (age > threshold_days).alias("is_stale"),
    ]


def _micros(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.TimestampNTZType):  # one value per column: going through text is cheap here
        c = F.concat(c.cast("string"), F.lit("Z"))
    return F.unix_micros(c.cast("timestamp"))


def profile_full(df: DataFrame, as_of: Column | None = None, threshold_days: float = 90) -> DataFrame:
    """One row per column with everything; ``top_values`` as an ordered array of (value, count)."""
    freq = value_frequencies(df)
    tops = top_of(freq, df).groupBy("column").agg(  # at most five rows per column
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "value", F.col("n").alias("count")))),
            lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count")),
        ).alias("top_values")
    )
    return (
        profile_stats(df, F.current_timestamp() if as_of is None else as_of, threshold_days)
        .join(distinct_of(freq), "column", "left")
        .join(tops, "column", "left")
        .withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)).cast("bigint"))
    )


# -- personal data in profiles ---------------------------------------------------


def redact_top_values(top: DataFrame) -> DataFrame:
    """Replace personal values of a top-value table by numbered tags, counted per column by rank."""
    kind = pii.classify_or_name(F.col("value"))
    order = Window.partitionBy("column").orderBy("rank")  # at most five rows per column
    return (
        top.withColumn("_kind", kind)
        .withColumn("_i", F.sum(F.col("_kind").isNotNull().cast("int")).over(order))
        .withColumn(
            "value",
            F.when(F.col("_kind").isNotNull(),
                   F.concat(F.lit("[REDACTED_"), F.upper("_kind"), F.lit("_"), F.col("_i").cast("string"), F.lit("]")))
            .otherwise(F.col("value")),
        )
        .drop("_kind", "_i")
    )


def scan_top_values(top: DataFrame) -> DataFrame:
    """Personal data among top values: location, class, value."""
    kind = pii.classify_or_name(F.col("value"))
    return top.withColumn("pii_type", kind).where("pii_type is not null").select(
        F.concat(F.lit("profile.columns."), F.col("column"), F.lit(".top_values")).alias("location"), "pii_type", "value"
    )
