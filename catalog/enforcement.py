"""Queries: rename, coerce, check, enforce."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import plain, query, run_sql, table
from catalog.views import ORDERS, RAW_ORDERS, TYPED_ORDERS, orders_rule
from contractframe.contract import Contract, Field
from contractframe.operators import checks

RAW = plain(RAW_ORDERS)


def _raw(spark, sf_dir):
    return run_sql(spark, sf_dir, RAW_ORDERS)


def _stamp(df):
    return df.withColumn("placed", F.date_format("placed", "yyyy-MM-dd HH:mm:ss"))


_TYPED = "order_id, customer_id, status, total, strftime(placed, '%Y-%m-%d %H:%M:%S') AS placed, priority"
# A row of the typed view that keeps every rule of the contract.
_OK = (
    "customer_id IS NOT NULL AND status IN ('O', 'F', 'P') AND placed IS NOT NULL AND _row_id NOT IN "
    "(SELECT o_orderkey FROM orders WHERE o_custkey = 16) AND (total IS NULL OR (total >= 0 AND total <= 495000))"
)


@query("rename_to_contract", f"""
WITH raw AS ({RAW})
SELECT _row_id, order_no AS order_id, cust AS customer_id, status, total, placed, priority_text AS priority, remark FROM raw
""")
def rename_to_contract(spark, sf_dir):
    return checks.rename_to_contract(_raw(spark, sf_dir), ORDERS)


@query("project_to_contract", f"""
WITH raw AS ({RAW})
SELECT _row_id, order_no AS order_id, cust AS customer_id, status, total, placed, priority_text AS priority FROM raw
""")
def project_to_contract(spark, sf_dir):
    return checks.project_to_contract(checks.rename_to_contract(_raw(spark, sf_dir), ORDERS), ORDERS)


@query("coerce_types", f"SELECT _row_id, {_TYPED} FROM ({TYPED_ORDERS})")
def coerce_types(spark, sf_dir):
    return _stamp(checks.coerce_types(checks.rename_to_contract(_raw(spark, sf_dir), ORDERS), ORDERS))


def _check(field: str, **rules):
    def run(spark, sf_dir):
        contract = orders_rule(field, **rules)
        raw = checks.rename_to_contract(_raw(spark, sf_dir), contract)
        return checks.violations_of(checks.check_contract(raw, contract))

    return run


def _failures(column: str, check: str, case: str, where: str) -> str:
    check = check.replace("'", "''")
    return (
        f"SELECT _row_id, '{column}' AS \"column\", '{check}' AS \"check\", {case} AS failure_case "
        f"FROM ({TYPED_ORDERS}) WHERE {where}"
    )


query("check_allowed", _failures("status", "isin", "status", "status NOT IN ('O', 'F')"))(
    _check("status", allowed_values=["O", "F"]))
query("check_min", _failures("total", "greater_than_or_equal_to(250000)", "cast(total AS string)", "total < 250000")
      + f" UNION ALL SELECT _row_id, 'total', 'coerce_dtype(''float64'')', '12,5' FROM ({RAW}) WHERE total = '12,5'")(
    _check("total", min=250000))
query("check_max", _failures("total", "less_than_or_equal_to(250000)", "cast(total AS string)", "total > 250000")
      + f" UNION ALL SELECT _row_id, 'total', 'coerce_dtype(''float64'')', '12,5' FROM ({RAW}) WHERE total = '12,5'")(
    _check("total", max=250000))
query("check_pattern", _failures("priority", "str_matches", "priority", "NOT regexp_matches(priority, '^(?:\\s*[1-4]-)')"))(
    _check("priority", pattern=r"\s*[1-4]-"))
query("check_not_null", f"""
WITH raw AS ({RAW})
SELECT _row_id, 'customer_id' AS "column",
       CASE WHEN cust IS NULL THEN 'not_nullable' ELSE 'coerce_dtype(''Int64'')' END AS "check", cust AS failure_case
FROM raw WHERE cust IS NULL OR cust = 'unknown'
""")(_check("customer_id", nullable=False))
query("check_coercion", f"""
WITH raw AS ({RAW})
SELECT _row_id, 'placed' AS "column", 'coerce_dtype(''datetime64[ns]'')' AS "check", placed AS failure_case
FROM raw WHERE placed = 'not a date'
""")(_check("placed"))


@query("check_missing_column", """
SELECT cast(NULL AS bigint) AS _row_id, 'currency' AS "column", 'column_in_dataframe' AS "check", 'currency' AS failure_case
UNION ALL
SELECT o_orderkey, 'o_orderstatus', 'isin', o_orderstatus FROM orders WHERE o_orderstatus = 'P'
""")
def check_missing_column(spark, sf_dir):
    contract = Contract(fields=[
        Field("o_orderstatus", allowed_values=["O", "F"]), Field("currency", allowed_values=["USD"]),
    ])
    df = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "_row_id")
    absent = checks.missing_columns(df, contract)
    return checks.violations_of(checks.check_contract(df, contract), contract, absent)


_VIOLATIONS = f"""
WITH raw AS ({RAW}),
found AS (
  SELECT _row_id, 'customer_id' AS "column", 'coerce_dtype(''Int64'')' AS "check", cust AS failure_case FROM raw WHERE cust = 'unknown'
  UNION ALL SELECT _row_id, 'customer_id', 'not_nullable', NULL FROM raw WHERE cust IS NULL
  UNION ALL SELECT _row_id, 'status', 'isin', status FROM raw WHERE status = 'X'
  UNION ALL SELECT _row_id, 'total', 'coerce_dtype(''float64'')', total FROM raw WHERE total = '12,5'
  UNION ALL SELECT _row_id, 'total', 'less_than_or_equal_to(495000)', total FROM raw WHERE try_cast(total AS double) > 495000 AND total <> 'nan'
  UNION ALL SELECT _row_id, 'placed', 'coerce_dtype(''datetime64[ns]'')', placed FROM raw WHERE placed = 'not a date'
)
"""


@query("enforce_accepted", f"SELECT _row_id, {_TYPED} FROM ({TYPED_ORDERS}) WHERE {_OK}")
def enforce_accepted(spark, sf_dir):
    return _stamp(checks.enforce(_raw(spark, sf_dir), ORDERS, mode="split").accepted)


@query("enforce_rejected", f"""
{_VIOLATIONS}
SELECT _row_id, count(*) AS failures FROM found GROUP BY _row_id
""")
def enforce_rejected(spark, sf_dir):
    rejected = checks.enforce(_raw(spark, sf_dir), ORDERS, mode="split").rejected
    return rejected.select("_row_id", F.size("_violations").cast("bigint").alias("failures"))


@query("enforce_violations", _VIOLATIONS + "SELECT * FROM found")
def enforce_violations(spark, sf_dir):
    return checks.enforce(_raw(spark, sf_dir), ORDERS, mode="split").violations


@query("violation_counts", _VIOLATIONS + 'SELECT "column", "check", count(*) AS n FROM found GROUP BY ALL')
def violation_counts(spark, sf_dir):
    return checks.violation_counts(checks.enforce(_raw(spark, sf_dir), ORDERS, mode="split").violations)


@query("revalidate", """
SELECT l_orderkey, "column", "check", failure_case FROM (
  SELECT l_orderkey, 'l_discount' AS "column", 'less_than_or_equal_to(0.09)' AS "check", cast(l_discount AS string) AS failure_case
  FROM lineitem WHERE l_discount > 0.09
  UNION ALL
  SELECT l_orderkey, 'l_returnflag', 'isin', l_returnflag FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
)
""")
def revalidate(spark, sf_dir):
    contract = Contract(fields=[
        Field("l_discount", dtype="float64", max=0.09), Field("l_returnflag", allowed_values=["A", "N"]),
    ])
    df = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("_row_id"), "l_discount", "l_returnflag", "l_tax")
    return checks.revalidate(df, contract).withColumnRenamed("_row_id", "l_orderkey")


@query("null_tolerance_report", f"""
WITH t AS ({TYPED_ORDERS}),
r AS (
  SELECT 'customer_id' AS "column", avg((customer_id IS NULL)::int) AS rate, 0.0::double AS tolerance FROM t
  UNION ALL SELECT 'order_id', avg((order_id IS NULL)::int), 0.0 FROM t
  UNION ALL SELECT 'status', avg((status IS NULL)::int), 0.0 FROM t
  UNION ALL SELECT 'total', avg((total IS NULL)::int), 0.01 FROM t
  UNION ALL SELECT 'placed', avg((placed IS NULL)::int), 0.0 FROM t
  UNION ALL SELECT 'priority', avg((priority IS NULL)::int), 0.0 FROM t
)
SELECT "column", round(rate, 6) AS null_rate, tolerance AS null_tolerance, rate <= tolerance AS within FROM r
""")
def null_tolerance_report(spark, sf_dir):
    raw = checks.rename_to_contract(_raw(spark, sf_dir), ORDERS)
    return checks.null_tolerance_report(checks.coerce_types(raw, ORDERS), ORDERS)
