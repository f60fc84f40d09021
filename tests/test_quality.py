import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from contractframe.contract import Contract, Field
from contractframe.operators import quality

D = datetime.datetime


def checks_of(df):
    return {(r["check"], r["columns"]): (r["violations"], r["sample_rows"]) for r in quality.cross_field_checks(df).collect()}


@pytest.mark.parametrize("a, b", [("start_date", "end_date"), ("open_date", "close_date"), ("created_at", "updated_at"), ("start", "end")])
def test_date_order(spark, a, b):
    df = spark.createDataFrame(
        [(0, D(2024, 1, 2), D(2024, 1, 1)), (1, D(2024, 1, 1), D(2024, 1, 1)), (2, None, D(2024, 1, 1))],
        f"_row_id bigint, {a} timestamp_ntz, {b} timestamp_ntz")
    assert checks_of(df)["date_ordering", f"{a},{b}"] == (1, [0])


def test_dates_as_text(spark):
    df = spark.createDataFrame([(0, "2024-02-01", "01/31/2024"), (1, "soon", "2024-01-01")], "_row_id bigint, start_day string, end_day string")
    assert checks_of(df)["date_ordering", "start_day,end_day"] == (1, [0])


@pytest.mark.parametrize("a, b", [("min_price", "max_price"), ("low", "high"), ("min_val", "max_val")])
def test_ranges(spark, a, b):
    df = spark.createDataFrame([(0, 5.0, 1.0), (1, 1.0, 1.0), (2, None, 1.0)], f"_row_id bigint, {a} double, {b} double")
    assert checks_of(df)["numeric_range", f"{a},{b}"] == (1, [0])


def test_samples_stop_at_five_and_are_the_first(spark):
    df = spark.createDataFrame([(i, 9.0, 1.0) for i in reversed(range(10))], "_row_id bigint, low double, high double")
    assert checks_of(df)["numeric_range", "low,high"] == (10, [0, 1, 2, 3, 4])


def test_unpaired_names_are_not_checked(spark):
    df = spark.createDataFrame([(0, 9.0, 1.0, 1.0)], "_row_id bigint, min_price double, max_cost double, minimum double")
    assert checks_of(df) == {}


def test_referential_presence(spark):
    df = spark.createDataFrame([(0, 1, "1"), (1, 2, "7"), (2, None, "1"), (3, 3, None), (4, 4, "9"), (5, 5, "7")], "_row_id bigint, id bigint, parent_id string")
    assert checks_of(df)["referential_presence", "parent_id,id"] == (3, [1, 4, 5])


def test_referential_presence_with_a_hot_dangling_value(spark):
    df = spark.range(9000).select(
        F.col("id").alias("_row_id"), (F.col("id") % 100).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") == 1, F.lit(-2)).otherwise(F.col("id") % 100).alias("parent_id"))
    assert checks_of(df)["referential_presence", "parent_id,id"] == (3001, [0, 1, 3, 6, 9])


def test_references_are_compared_per_distinct_value(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").alias("_row_id"), "id", F.col("id").alias("parent_id")).write.parquet(path)
    plan = plan_of(quality.referential_presence(spark.read.parquet(path)))
    assert "LeftAnti" not in plan


def test_exclusive_nulls(spark):
    rows = [(0, "a", None, "x"), (1, None, "b", "y"), (2, "c", None, None)]
    df = spark.createDataFrame(rows, "_row_id bigint, person string, company string, both string")
    got = checks_of(df)
    assert got["mutually_exclusive_nulls", "person,company"] == (0, [])
    assert ("mutually_exclusive_nulls", "person,both") not in got


def test_full_and_empty_columns_are_not_exclusive(spark):
    df = spark.createDataFrame([(0, "a", None, None), (1, "b", None, "c")], "_row_id bigint, p string, q string, r string")
    assert checks_of(df) == {}


def test_many_independent_columns(spark):
    df = spark.range(3000).select(
        F.col("id").alias("_row_id"), *[F.when(F.xxhash64("id", F.lit(i)) % 3 == 0, F.lit(i)).alias(f"c{i}") for i in range(64)],
        F.when(F.col("id") % 2 == 0, 1).alias("even"), F.when(F.col("id") % 2 == 1, 1).alias("odd"),
    )
    assert {r["columns"] for r in quality.mutex_nulls(df).collect()} == {"even,odd"}


def test_references_share_their_readings(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = [f"a{i}" for i in range(6)]
    spark.range(10).select(F.col("id").alias("_row_id"), *[F.col("id").alias(c) for c in columns], *[(F.col("id") + 1).alias(f"x_{c}") for c in columns]).write.parquet(path)
    got = quality.referential_presence(spark.read.parquet(path))
    assert {(r["columns"], r["violations"], tuple(r["sample_rows"])) for r in got.collect()} == {(f"x_{c},{c}", 1, (9,)) for c in columns}
    assert plan_of(got).count("FileScan parquet") <= 8  # the table, the dangling values: whatever the number of pairs


def findings(df, as_of="2024-06-01 00:00:00"):
    return {tuple(r) for r in quality.qa_report(df, F.lit(as_of).cast("timestamp")).collect()}


def test_infinity(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf, -inf, 1.5, 1), (None, 2.5, 2.5, 2)], "a double, b double, c double, n int")
    assert findings(df) == {("infinity_columns", "a"), ("infinity_columns", "b"), ("suspicious_rounding_columns", "a")}


def test_rounding_ignores_nulls_and_integers(spark):
    df = spark.createDataFrame([(1.0, 1.5, 1, None)] * 10 + [(None, 2.0, 2, None)], "whole double, mixed double, n int, none double")
    assert findings(df) == {("suspicious_rounding_columns", "whole")}


def test_rounding_needs_more_than_nine_in_ten(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(1.5,)], "v double")
    assert findings(df) == set()


@pytest.mark.parametrize("when, flagged", [(D(2024, 6, 1, 12), False), (D(2024, 6, 2), False), (D(2024, 6, 6), True), (D(2020, 1, 1), False)])
def test_future_dates(spark, when, flagged):
    df = spark.createDataFrame([(when,), (None,)], "event_date timestamp_ntz")
    assert (("future_date_columns", "event_date") in findings(df)) is flagged


def test_column_names(spark, rows):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["ok", " lead", "two  spaces", "prénom"])
    assert {c for k, c in findings(df) if k == "bad_column_names"} == {" lead", "two  spaces", "prénom"}
    names = spark.createDataFrame([(c,) for c in df.columns], "column string")
    assert rows(quality.qa_column_names(names)) == [(" lead",), ("prénom",), ("two  spaces",)]


ITEMS = Contract(fields=[Field("id", dtype="Int64", source_column="ID"), Field("price", dtype="float64", nullable=True), Field("name", nullable=True)])


def test_diff_compares_typed_values(spark, rows):
    raw = spark.createDataFrame([(0, "1.0", "2", " a"), (1, "2", None, "b"), (2, "3", "x", None)], "_row_id bigint, ID string, price string, name string")
    final = spark.createDataFrame([(0, 1, 2.0, "a"), (1, 2, None, "b"), (2, 3, None, None)], "_row_id bigint, id bigint, price double, name string")
    # ' a' was stripped and 'x' was lost
    assert rows(quality.original_vs_final_diff(raw, final, ITEMS)) == [("name", False, 3, 3, 1), ("price", False, 3, 3, 1)]


def test_diff_without_drift(spark):
    raw = spark.createDataFrame([(0, "1", "2", None)], "_row_id bigint, ID string, price string, name string")
    final = spark.createDataFrame([(0, 1, 2.0, None)], "_row_id bigint, id bigint, price double, name string")
    assert quality.original_vs_final_diff(raw, final, ITEMS).count() == 0


def test_row_count_change_is_reported_for_every_column(spark, rows):
    raw = spark.createDataFrame([(0, "1", "2", None), (1, "1", "2", None)], "_row_id bigint, ID string, price string, name string")
    final = spark.createDataFrame([(0, 1, 2.0, None)], "_row_id bigint, id bigint, price double, name string")
    assert rows(quality.original_vs_final_diff(raw, final, ITEMS)) == [(c, True, 2, 1, None) for c in ("id", "name", "price")]
    assert tuple(quality.row_count_drift(raw, final).first()) == (2, 1, 1)
    assert rows(quality.dropped_rows(raw, final)) == [(1,)]


def test_plans_have_no_pairwise_join(spark):
    df = spark.createDataFrame([(0, 9.0, 1.0, 1, "1")], "_row_id bigint, low double, high double, id bigint, parent_id string")
    plan = plan_of(quality.cross_field_checks(df))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
