import datetime

import pytest
from pyspark.sql import functions as F

from contractframe.contract import Contract, Field
from contractframe.operators import checks

ITEMS = Contract(
    dataset_name="items",
    fields=[
        Field("order_status", source_column="Status", type="categorical", allowed_values=["Completed", "Cancelled"]),
        Field("quantity", dtype="Int64", type="integer", min=1, max=99),
        Field("price", dtype="float64", type="decimal", min=0),
        Field("code", type="identifier", pattern=r"[A-Z]{2}\d+"),
        Field("image", nullable=True),
    ],
)
COLUMNS = "_row_id bigint, Status string, quantity string, price string, code string, image string, extra string"


def test_valid_row_passes_and_is_typed(spark, rows):
    df = spark.createDataFrame([(0, "Completed", "2.0", "5", "AB12", None, "x")], COLUMNS)
    got = checks.enforce(df, ITEMS).accepted
    assert got.columns == ["_row_id", "order_status", "quantity", "price", "code", "image"]
    assert rows(got) == [(0, "Completed", 2, 5.0, "AB12", None)]


def test_every_failure_is_reported(spark, rows):
    df = spark.createDataFrame(
        [(0, "Refunded", "0", "-1", "xx", None, "x"), (1, "Completed", "1.5", "abc", None, "i", "x"),
         (2, "Completed", "3", "4", "AB1", "i", "x")], COLUMNS)
    got = checks.enforce(df, ITEMS, mode="split")
    assert rows(got.violations, "_row_id", "column", "check", "failure_case") == sorted([
        (0, "order_status", "isin", "Refunded"), (0, "quantity", "greater_than_or_equal_to(1)", "0"),
        (0, "price", "greater_than_or_equal_to(0)", "-1.0"), (0, "code", "str_matches", "xx"),
        (1, "quantity", "coerce_dtype('Int64')", "1.5"), (1, "price", "coerce_dtype('float64')", "abc"),
        (1, "code", "not_nullable", None),
    ], key=repr)
    assert rows(got.accepted, "_row_id") == [(2,)]
    assert rows(got.rejected, "_row_id") == [(0,), (1,)]


def test_fail_mode_writes_and_raises(spark, tmp_path):
    df = spark.createDataFrame([(0, "Refunded", "1", "1", "AB1", None, "x")], COLUMNS)
    path = str(tmp_path / "violations")
    with pytest.raises(checks.ContractViolation) as error:
        checks.enforce(df, ITEMS, violations_path=path)
    assert error.value.path == path
    assert spark.read.parquet(path).count() == 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        checks.enforce(spark.range(1), ITEMS, mode="maybe")


def test_missing_column_rejects_the_table(spark, rows):
    df = spark.createDataFrame([(0, "Completed", "1", "1", "AB1")], "_row_id bigint, Status string, quantity string, price string, code string")
    got = checks.enforce(df, ITEMS, mode="split")
    assert rows(got.violations, "column", "check") == [("image", "column_in_dataframe")]
    assert got.accepted.count() == 0


def test_nullable_integers_keep_one_null(spark, rows):
    c = Contract(fields=[Field("id", dtype="int64"), Field("age", dtype="Int64", nullable=True)])
    df = spark.createDataFrame([(1, 34.0), (2, float("nan")), (3, 45.0)], "id bigint, age double")
    assert rows(checks.enforce(df, c).accepted) == [(1, 34), (2, None), (3, 45)]


def test_null_tolerance_makes_a_column_nullable(spark):
    df = spark.createDataFrame([(None,), ("a",)], "v string")
    assert checks.enforce(df, Contract(fields=[Field("v", null_tolerance=0.1)])).accepted.count() == 2


@pytest.mark.parametrize(
    "dtype, text, value",
    [("Int64", "3.0", 3), ("Int64", "3.7", None), ("Int64", "1e3", 1000), ("Int64", " 7 ", 7), ("Int64", "9223372036854775807", 2**63 - 1),
     ("Int64", "9223372036854775808", None), ("Int64", "3.", 3), ("Int64", "x", None), ("Int64", "-0.0", 0),
     ("float64", "1e-2", 0.01), ("float64", "nan", None), ("float64", "inf", float("inf")), ("float64", "3d", None),
     ("boolean", "TRUE", True), ("boolean", "0", False), ("boolean", "yes", None),
     ("datetime64[ns]", "2024-01-05", datetime.datetime(2024, 1, 5)), ("datetime64[ns]", "01/05/2024", datetime.datetime(2024, 1, 5)),
     ("datetime64[ns]", "5 Jan", None), ("category", "x", "x")],
)
def test_coercion(spark, dtype, text, value):
    df = spark.createDataFrame([(text,)], "v string")
    assert checks.coerce_types(df, Contract(fields=[Field("v", dtype=dtype)])).first()["v"] == value


def test_truncation_is_an_option(spark):
    df = spark.createDataFrame([(3.7,), (-3.7,)], "v double")
    c = Contract(fields=[Field("v", dtype="int64")])
    assert [r["v"] for r in checks.coerce_types(df, c, truncate=True).collect()] == [3, -3]


def test_declared_date_format(spark):
    df = spark.createDataFrame([("05.01.2024",)], "v string")
    c = Contract(fields=[Field("v", dtype="datetime64[ns]", parse_format="%d.%m.%Y")])
    assert checks.coerce_types(df, c).first()["v"] == datetime.datetime(2024, 1, 5)


def test_nan_text_is_missing_not_malformed(spark, rows):
    df = spark.createDataFrame([(0, "nan")], "_row_id bigint, v string")
    got = checks.violations_of(checks.check_contract(df, Contract(fields=[Field("v", dtype="float64")])))
    assert rows(got, "check") == [("not_nullable",)]


def test_numeric_bound_on_text(spark, rows):
    df = spark.createDataFrame([(0, "5"), (1, "50"), (2, "many")], "_row_id bigint, v string")
    got = checks.violations_of(checks.check_contract(df, Contract(fields=[Field("v", min=10)])))
    assert rows(got, "_row_id") == [(0,), (2,)]


def test_revalidate_keeps_derived_columns_out_of_it(spark):
    df = spark.createDataFrame([(0, "Completed", 1, 2.0, "AB1", None, 9)],
                               "_row_id bigint, order_status string, quantity bigint, price double, code string, image string, derived int")
    assert checks.revalidate(df, ITEMS).count() == 0
    assert "derived" in checks.check_contract(df, ITEMS, keep_extra=True).columns


def test_rules_are_not_evaluated_again_by_filters(spark):
    from conftest import plan_of

    df = spark.createDataFrame([(0, "Completed", "1", "1", "AB1", None, "x")], COLUMNS)
    checked = checks.check_contract(checks.rename_to_contract(df, ITEMS), ITEMS)
    plan = plan_of(checked.where(F.size("_violations") == 0))
    assert "Exchange" not in plan
    assert plan.count("Filter (") <= 1 and "RLIKE" not in [l for l in plan.splitlines() if "Filter (" in l][0]


def test_row_wise_checks_run_on_a_stream(spark, tmp_path, rows):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(0, "Refunded", "1", "1", "AB1", None, "x")], COLUMNS)
    df.write.parquet(source)
    stream = checks.rename_to_contract(spark.readStream.schema(df.schema).parquet(source), ITEMS)
    found = checks.violations_of(checks.check_contract(stream, ITEMS))
    found.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(out), "column", "check") == [("order_status", "isin")]
