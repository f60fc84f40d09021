"""Comparison with the original, quality checks and cross-column checks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.contract import Contract, Field
from contractframe.functions.coercion import coerce, is_float, is_time, missing
from contractframe.operators.checks import rename_to_contract, revalidate, violation_counts
from contractframe.storage import ROW_ID, materialize, named

SAMPLES = 5
CROSS = "check string, columns string, violations bigint, sample_rows array<bigint>"

# Name prefixes of column pairs that must be in order.
DATE_PREFIXES = (("start", "end"), ("open", "close"))
DATE_EXACT = (("created_at", "updated_at"),)
RANGE_PREFIXES = (("min", "max"), ("low", "high"))


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ID]


# -- original against final -------------------------------------------------------


def _typed_original(original: DataFrame, contract: Contract) -> DataFrame:
    """The raw table renamed and cast, so that '1.0' against 1 is no drift."""
    renamed = rename_to_contract(original, contract)
    out = [F.col(ROW_ID)]
    for f in contract.fields:
        if f.name in renamed.columns:
            source = renamed.schema[f.name].dataType
            value = coerce(named(f.name), source, f)
            out.append(value.alias(f"o_{f.name}"))
            # A source value that does not fit the type is present all the same.
            out.append((~missing(named(f.name), source) & value.isNull()).alias(f"x_{f.name}"))
    return renamed.select(*out)


def row_count_drift(original: DataFrame, final: DataFrame) -> DataFrame:
    """Row counts of both sides and how many original rows are gone."""
    sides = original.select(F.col(ROW_ID), F.lit(1).alias("o"), F.lit(0).alias("f")).unionByName(
        final.select(F.col(ROW_ID), F.lit(0).alias("o"), F.lit(1).alias("f"))
    )
    per_row = sides.groupBy(ROW_ID).agg(F.max("o").alias("o"), F.max("f").alias("f"))
    return per_row.agg(
        F.coalesce(F.sum("o"), F.lit(0)).cast("bigint").alias("original_rows"),
        F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("final_rows"),
        F.count_if((F.col("o") == 1) & (F.col("f") == 0)).alias("dropped_rows"),
    )


def dropped_rows(original: DataFrame, final: DataFrame) -> DataFrame:
    return original.join(final.select(ROW_ID), ROW_ID, "left_anti").select(ROW_ID)


def original_vs_final_diff(original: DataFrame, final: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns whose values differ from the original; one row-id join, one aggregate.

    When the row counts differ, every column reports that instead, and nothing is joined.
    """
    raw = _typed_original(original, contract)
    shared = [f for f in contract.fields if f"o_{f.name}" in raw.columns and f.name in final.columns]
    schema = "column string, row_count_changed boolean, original_rows bigint, final_rows bigint, mismatches bigint"
    if not shared:
        return final.sparkSession.createDataFrame([], schema)
    before, after = original.count(), final.count()
    if before != after:
        return final.sparkSession.createDataFrame([(f.name, True, before, after, None) for f in shared], schema)
    new = final.select(F.col(ROW_ID).alias("_final_id"), *[named(f.name).alias(f"f_{f.name}") for f in shared])
    both = raw.join(new, F.col(ROW_ID) == F.col("_final_id"), "full_outer")
    matched = F.col(ROW_ID).isNotNull() & F.col("_final_id").isNotNull()
    aggs = [F.count(ROW_ID).alias("original_rows"), F.count("_final_id").alias("final_rows")]
    for f in shared:
        same = F.col(f"o_{f.name}").eqNullSafe(F.col(f"f_{f.name}")) & ~F.col(f"x_{f.name}")
        aggs.append(F.count_if(~(matched & same)).alias(f"m_{f.name}"))
    one = both.agg(*aggs)
    changed = F.col("original_rows") != F.col("final_rows")
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            changed.alias("row_count_changed"),
            F.col("original_rows"),
            F.col("final_rows"),
            F.when(~changed, F.col(f"m_{f.name}")).alias("mismatches"),
        )
        for f in shared
    ]
    return one.select(F.inline(F.array(*rows))).where("row_count_changed or mismatches > 0")


# -- cross-column checks ----------------------------------------------------------


def _partners(columns: list[str], heads: dict[str, str], whole: dict[str, str]) -> list[tuple[str, str]]:
    """Columns and their partners: the same rest behind the partner's head, or the partner's whole name."""
    present, found = set(columns), []
    for name in sorted(present):
        head, rest = name.split("_", 1) if "_" in name else (name, None)
        candidates = [whole.get(name)]
        if head in heads:
            candidates.append(heads[head] if rest is None else f"{heads[head]}_{rest}")
        found += [(name, other) for other in candidates if other in present]
    return found


def date_pairs(columns: list[str]) -> list[tuple[str, str]]:
    return _partners(columns, dict(DATE_PREFIXES), dict(DATE_EXACT))


def range_pairs(columns: list[str]) -> list[tuple[str, str]]:
    return _partners(columns, dict(RANGE_PREFIXES), {})


def reference_pairs(columns: list[str]) -> list[tuple[str, str]]:
    """(column, target): every tail of a name behind an underscore that is a column itself."""
    present, found = set(columns), []
    for name in sorted(present):
        parts = name.split("_")
        tails = ["_".join(parts[i:]) for i in range(1, len(parts))]
        found += [(name, tail) for tail in tails if tail in present]
    return found


def _as_time(df: DataFrame, c: str) -> Column:
    return coerce(named(c), df.schema[c].dataType, Field(c, dtype="datetime64[ns]"))


def _as_number(df: DataFrame, c: str) -> Column:
    return coerce(named(c), df.schema[c].dataType, Field(c, dtype="float64"))


def _ordering(df: DataFrame, check: str, pairs: list[tuple[str, str]], read) -> DataFrame:
    """Pairs with a > b: all pairs in one pass, with the first violating rows of each."""
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], CROSS)
    names = [",".join(p) for p in pairs]
    flags = [F.coalesce(read(df, a) > read(df, b), F.lit(False)) for a, b in pairs]
    counts = df.agg(*[F.count_if(v).alias(f"v{i}") for i, v in enumerate(flags)]).select(
        F.inline(F.array(*[
            F.struct(F.lit(check).alias("check"), F.lit(n).alias("columns"), F.col(f"v{i}").alias("violations"))
            for i, n in enumerate(names)
        ]))
    )
    bad = df.select(
        F.col(ROW_ID),
        F.explode(F.filter(F.array(*[F.when(v, F.lit(n)) for v, n in zip(flags, names)]), lambda x: x.isNotNull())).alias("columns"),
    )
    return counts.join(first_rows(bad, "columns"), "columns", "left").select(
        "check", "columns", "violations", F.coalesce("sample_rows", F.array().cast("array<bigint>")).alias("sample_rows")
    )


def first_rows(rows: DataFrame, by: str, n: int = SAMPLES) -> DataFrame:
    """The n smallest row ids per group; each task keeps n per group before the shuffle."""
    order = Window.partitionBy(by).orderBy(ROW_ID)
    return (
        rows.select(by, ROW_ID)
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= n)
        .groupBy(by)
        .agg(F.sort_array(F.collect_list(ROW_ID)).alias("sample_rows"))
    )


def violation_samples(df: DataFrame, violated: Column, n: int = SAMPLES) -> DataFrame:
    """The first n rows, by row id, that violate a condition."""
    return df.where(violated).select(ROW_ID).orderBy(ROW_ID).limit(n)


def date_ordering(df: DataFrame) -> DataFrame:
    return _ordering(df, "date_ordering", date_pairs(_data_columns(df)), _as_time)


def numeric_range(df: DataFrame) -> DataFrame:
    return _ordering(df, "numeric_range", range_pairs(_data_columns(df)), _as_number)


def referential_presence(df: DataFrame) -> DataFrame:
    """For columns X_t and t: non-null values of X_t, as text, that never occur in t.

    All pairs share one unpivot and one grouping by value digest, where a hot
    value is one row per task; a second reading finds the first violating rows.
    """
    pairs = reference_pairs(_data_columns(df))
    if not pairs:
        return df.sparkSession.createDataFrame([], CROSS)

    def cell(i: int, c: str, is_target: bool) -> Column:
        digest = F.unhex(F.sha2(named(c).cast("string"), 256))
        there = ~missing(named(c), df.schema[c].dataType)
        return F.when(there, F.struct(F.lit(i).alias("pair"), digest.alias("v"), F.lit(is_target).alias("is_target")))

    def unpivot(cells: list[Column]) -> DataFrame:
        return df.select(F.col(ROW_ID), F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))

    refs = [cell(i, r, False) for i, (r, _) in enumerate(pairs)]
    targets = [cell(i, t, True) for i, (_, t) in enumerate(pairs)]
    values = unpivot(refs + targets).groupBy("pair", "v").agg(
        F.bool_or("is_target").alias("known"), F.count_if(~F.col("is_target")).alias("n"), F.min(F.when(~F.col("is_target"), F.col(ROW_ID))).alias("first")
    )
    dangling = materialize(values.where("NOT known AND n > 0").drop("known"), "dangling")
    totals = dangling.groupBy("pair").agg(F.sum("n").alias("violations"))
    # The first five violating rows hold at most five values, and those are the
    # values with the smallest first rows: five digests a pair decide where to look.
    order = Window.partitionBy("pair").orderBy("first")
    earliest = dangling.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= SAMPLES)
    earliest = earliest.select(F.col("pair").alias("_pair"), F.col("v").alias("_v"))
    rows = unpivot(refs).join(F.broadcast(earliest), (F.col("pair") == F.col("_pair")) & (F.col("v") == F.col("_v")), "left_semi")
    names = df.sparkSession.createDataFrame([(i, f"{r},{t}") for i, (r, t) in enumerate(pairs)], "pair int, columns string")
    return names.join(totals, "pair", "left").join(first_rows(rows, "pair"), "pair", "left").select(
        F.lit("referential_presence").alias("check"), "columns", F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"),
        F.coalesce("sample_rows", F.array().cast("array<bigint>")).alias("sample_rows"),
    )


def mutex_nulls(df: DataFrame) -> DataFrame:
    """Pairs of partly null columns that are never both present.

    One aggregate: for each column, how often it is present and, in words of 64
    bits, which columns are ever present beside it. Pairs are read off that row.
    """
    columns = _data_columns(df)
    present = [~missing(named(c), df.schema[c].dataType) for c in columns]
    words = [
        reduce(Column.bitwiseOR, [F.when(p, F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, p in enumerate(part)])
        for part in (present[at : at + 64] for at in range(0, len(present), 64))
    ]
    table = df.select(*[p.alias(f"p{i}") for i, p in enumerate(present)], *[w.alias(f"w{j}") for j, w in enumerate(words)])
    beside = [F.bit_or(F.when(F.col(f"p{i}"), F.col(f"w{j}"))).alias(f"b{i}_{j}") for i in range(len(columns)) for j in range(len(words))]
    one = table.agg(F.count("*").alias("rows"), *[F.count_if(f"p{i}").alias(f"n{i}") for i in range(len(columns))], *beside).first()
    mixed = [i for i in range(len(columns)) if 0 < one[f"n{i}"] < one["rows"]]
    found = [
        ("mutually_exclusive_nulls", f"{columns[i]},{columns[j]}", 0, [])
        for i in mixed for j in mixed if i < j and not one[f"b{i}_{j // 64}"] >> (j % 64) & 1
    ]
    return df.sparkSession.createDataFrame(found, CROSS)


def cross_field_checks(df: DataFrame) -> DataFrame:
    """All four families in one table."""
    return (
        date_ordering(df)
        .unionByName(numeric_range(df))
        .unionByName(referential_presence(df))
        .unionByName(mutex_nulls(df))
    )


# -- quality report ---------------------------------------------------------------


def qa_report(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(check, column) for every finding: infinity, rounding, future dates, bad names. One aggregate."""
    as_of = F.current_timestamp() if as_of is None else as_of
    aggs, rows = [F.count("*").alias("rows")], []

    def finding(check: str, column: str, hit: Column) -> Column:
        return F.when(hit, F.struct(F.lit(check).alias("check"), F.lit(column).alias("column")))

    for i, c in enumerate(_data_columns(df)):
        t, v = df.schema[c].dataType, named(c)
        if is_float(t):
            present = ~missing(v, t)
            aggs.append(F.max(present & (F.abs(v) == F.lit(float("inf")))).alias(f"inf{i}"))
            aggs.append(F.avg(F.when(present, (v == F.rint(v)).cast("int"))).alias(f"round{i}"))
            rows.append(finding("infinity_columns", c, F.col(f"inf{i}")))
            rows.append(finding("suspicious_rounding_columns", c, F.col(f"round{i}") > 0.9))
        if is_time(t):
            aggs.append(F.max(v).alias(f"newest{i}"))
            limit = (as_of.cast("timestamp") + F.expr("interval 1 day")).cast(
                T.TimestampType() if isinstance(t, T.DateType) else t
            )
            rows.append(finding("future_date_columns", c, F.col(f"newest{i}") > limit))
        if bad_name(c):
            rows.append(finding("bad_column_names", c, F.lit(True)))
    if not rows:
        return df.sparkSession.createDataFrame([], "check string, column string")
    return df.agg(*aggs).select(F.inline(F.filter(F.array(*rows), lambda x: x.isNotNull())))


# White space at an end, double blanks, or anything beyond ASCII; read alike by both pattern languages.
_EDGE = "[\\t-\\r\\x1c-\\x20]"
NAME_FAULT = rf"^{_EDGE}|{_EDGE}(?![\s\S])|  |[^\x00-\x7f]"


def bad_name(name: str) -> bool:
    return re.search(NAME_FAULT, name) is not None


def qa_infinity(df: DataFrame) -> DataFrame:
    return qa_report(df).where("check = 'infinity_columns'").select("column")


def qa_rounding(df: DataFrame) -> DataFrame:
    return qa_report(df).where("check = 'suspicious_rounding_columns'").select("column")


def qa_future_dates(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    return qa_report(df, as_of).where("check = 'future_date_columns'").select("column")


def qa_column_names(schema_table: DataFrame) -> DataFrame:
    """Names with outer or double white space or non-ASCII letters, over a table of column names."""
    return schema_table.where(F.col("column").rlike(NAME_FAULT)).select("column")


# -- whole report -----------------------------------------------------------------


def validation_report(original: DataFrame, final: DataFrame, contract: Contract, as_of: Column | None = None) -> DataFrame:
    """(section, item, value) rows: contract re-check, drift, quality and cross-column findings."""
    again = violation_counts(revalidate(final, contract)).select(
        F.lit("schema_revalidation").alias("section"),
        F.concat_ws(":", "column", "check").alias("item"),
        F.col("n").alias("value"),
    )
    drift = original_vs_final_diff(original, final, contract).select(
        F.lit("original_vs_final_diff").alias("section"),
        F.concat("column", F.when(F.col("row_count_changed"), F.lit(":row_count_changed")).otherwise(F.lit(":mismatches"))).alias("item"),
        F.coalesce("mismatches", F.col("final_rows") - F.col("original_rows")).alias("value"),
    )
    qa = qa_report(final, as_of).select(
        F.lit("qa_checks").alias("section"), F.concat_ws(":", "check", "column").alias("item"), F.lit(1).cast("bigint").alias("value")
    )
    cross = cross_field_checks(final).select(
        F.lit("cross_field_checks").alias("section"), F.concat_ws(":", "check", "columns").alias("item"), F.col("violations").alias("value")
    )
    return again.unionByName(drift).unionByName(qa).unionByName(cross)
