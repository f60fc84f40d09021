"""Contract enforcement: rename, coerce, check every rule, report every failure."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.contract import Contract, Field
from contractframe.functions.coercion import coerce, is_number, is_time, missing
from contractframe.storage import ROW_ID, evaluated_once, materialize

VIOLATION = "struct<column:string,check:string,failure_case:string>"


class ContractViolation(Exception):
    """The table breaks its contract; ``path`` holds the failure table."""

    def __init__(self, message: str, path: str | None = None):
        super().__init__(message)
        self.path = path


@dataclass
class Enforced:
    accepted: DataFrame
    rejected: DataFrame
    violations: DataFrame


def rename_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Source names to field names; unmapped columns survive."""
    return df.withColumnsRenamed(contract.names().renames)


def project_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns only (with the row id), in contract order."""
    keep = [c for c in contract.names().fields if c in df.columns]
    return df.select(*_carried(df), *keep)


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    return [c for c in contract.names().fields if c not in df.columns]


def _carried(df: DataFrame) -> list[str]:
    return [ROW_ID] if ROW_ID in df.columns else []


def coerce_types(df: DataFrame, contract: Contract, truncate: bool = False) -> DataFrame:
    """Declared columns cast to their contract types; what does not fit is null."""
    return df.select(
        *_carried(df),
        *[
            coerce(F.col(f.name), df.schema[f.name].dataType, f, truncate).alias(f.name)
            for f in contract.fields
            if f.name in df.columns
        ],
    )


def _failure(name: str, check: str, case: Column) -> Column:
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(check).alias("check"),
        case.cast("string").alias("failure_case"),
    )


def _bound(value, f: Field) -> Column:
    if is_time(f.spark_type) and isinstance(value, (str, datetime.date, datetime.datetime)):
        return F.lit(str(value)).cast(f.spark_type)
    return F.lit(value)


def check_failures(typed: Column, source: Column, source_type: T.DataType, f: Field) -> list[tuple[Column, Column]]:
    """One (broken, failure) pair per rule of ``f``; ``broken`` is never null."""
    # NaN, as a number or as text in a numeric column, is a missing value, not a failed cast.
    absent = missing(source, source_type)
    if is_number(f.spark_type) and isinstance(source_type, T.StringType):
        absent = absent | (typed.isNull() & source.rlike(r"(?i)^\s*[+-]?nan\s*$"))
    out = [(typed.isNull() & ~absent, _failure(f.name, f"coerce_dtype('{f.dtype}')", source))]
    if not f.accepts_null:
        out.append((absent, _failure(f.name, "not_nullable", F.lit(None))))

    def rule(holds: Column, check: str) -> None:
        # A rule says nothing about nulls; one that cannot be evaluated is broken.
        out.append((typed.isNotNull() & ~F.coalesce(holds, F.lit(False)), _failure(f.name, check, typed)))

    if f.allowed_values is not None:
        rule(typed.isin(list(f.allowed_values)) if f.allowed_values else F.lit(False), "isin")
    # Bounds compare numbers with numbers; text under a numeric bound must read as one.
    comparable = is_number(f.spark_type) or is_time(f.spark_type)
    ordered = typed if comparable else typed.cast("string").try_cast("double")
    if f.min is not None:
        rule(ordered >= _bound(f.min, f), f"greater_than_or_equal_to({f.min})")
    if f.max is not None:
        rule(ordered <= _bound(f.max, f), f"less_than_or_equal_to({f.max})")
    if f.pattern is not None:
        rule(typed.cast("string").rlike(f"^(?:{f.pattern})"), "str_matches")  # anchored at the start only
    return out


def check_contract(df: DataFrame, contract: Contract, truncate: bool = False, keep_extra: bool = False) -> DataFrame:
    """Typed columns plus ``_violations``, the failures of each row, in one projection.

    Expects field names (see ``rename_to_contract``).  Undeclared columns are
    dropped unless ``keep_extra``.
    """
    present = [f for f in contract.fields if f.name in df.columns]
    names = {f.name for f in present}
    extra = [c for c in df.columns if c not in names and c != ROW_ID] if keep_extra else []
    # Values are cast in a projection of their own, so that the rules, which name
    # them several times, do not cast again.
    cast = df.select(
        *_carried(df),
        *[coerce(F.col(f.name), df.schema[f.name].dataType, f, truncate).alias(f.name) for f in present],
        *extra,
        *[F.col(f.name).alias(f"_source_{f.name}") for f in present],
    )
    rules: list[tuple[Column, Column]] = []
    for f in present:
        rules += check_failures(F.col(f.name), F.col(f"_source_{f.name}"), df.schema[f.name].dataType, f)
    none = F.array().cast(f"array<{VIOLATION}>")
    found = none
    if rules:
        # Failures are collected only for rows that have one.
        any_broken = reduce(or_, [broken for broken, _ in rules])
        failures = F.concat(*[F.when(broken, F.array(failure)).otherwise(none) for broken, failure in rules])
        found = F.when(any_broken, failures).otherwise(none)
    kept = [*_carried(df), *[f.name for f in present], *extra]
    return evaluated_once(cast.select(*kept, found.alias("_found")), "_violations", F.col("_found")).drop("_found")


def violations_of(checked: DataFrame, contract: Contract | None = None, absent: list[str] | None = None) -> DataFrame:
    """The failure table: column, check, failing value and row."""
    row = F.col(ROW_ID) if ROW_ID in checked.columns else F.lit(None).cast("bigint").alias(ROW_ID)
    rows = checked.select(row, F.inline("_violations"))
    if absent:
        # At most one row per declared column.
        table = checked.sparkSession.createDataFrame(
            [(None, c, "column_in_dataframe", c) for c in absent],
            f"{ROW_ID} bigint, column string, check string, failure_case string",
        )
        rows = rows.unionByName(table)
    return rows


def violation_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("column", "check").agg(F.count("*").alias("n"))


def enforce(
    df: DataFrame,
    contract: Contract,
    mode: str = "fail",
    violations_path: str | None = None,
    truncate: bool = False,
) -> Enforced:
    """Enforce the contract on a source table.

    ``fail`` writes the failure table and raises when there is any failure;
    ``split`` returns accepted and rejected rows side by side.  A missing
    declared column rejects the table as a whole.
    """
    if mode not in ("fail", "split"):
        raise ValueError(f"mode must be 'fail' or 'split', not {mode!r}")
    renamed = rename_to_contract(df, contract)
    absent = missing_columns(renamed, contract)
    # Written once: the split, the failure table and later steps all read it.
    checked = materialize(check_contract(renamed, contract, truncate), "checked")
    failures = violations_of(checked, contract, absent)
    if violations_path:
        failures.write.mode("overwrite").parquet(violations_path)
    clean = (F.size("_violations") == 0) if not absent else F.lit(False)
    if mode == "fail" and not failures.isEmpty():
        raise ContractViolation(f"table {contract.dataset_name!r} breaks its contract", violations_path)
    return Enforced(
        accepted=checked.where(clean).drop("_violations"),
        rejected=checked.where(~clean),
        violations=failures,
    )


def revalidate(df: DataFrame, contract: Contract) -> DataFrame:
    """Check an already typed table again; derived columns stay. Returns the failure table."""
    return violations_of(check_contract(df, contract, keep_extra=True), contract, missing_columns(df, contract))


def null_tolerance_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Null rate of each declared column against its declared tolerance. A report, never a failure."""
    present = [f for f in contract.fields if f.name in df.columns]
    rates = df.agg(
        *[F.avg(missing(F.col(f.name), df.schema[f.name].dataType).cast("int")).alias(f.name) for f in present]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.round(F.col(f.name), 6).alias("null_rate"),
                F.lit(float(f.null_tolerance)).alias("null_tolerance"),
                (F.col(f.name) <= F.lit(float(f.null_tolerance))).alias("within"),
            )
            for f in present
        ]
    )
    return rates.select(F.inline(rows))
