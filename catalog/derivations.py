"""Queries: derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, run_sql, table
from contractframe.contract import Contract, Derived
from contractframe.operators import derive


def _derive(df, **forms):
    return derive.apply_derivations(df, Contract(derived_fields=[Derived(n, t) for n, t in forms.items()]))


def _lines(spark, sf_dir, *columns):
    return table(spark, sf_dir, "lineitem").select(*columns)


@query("derive_add", "SELECT l_orderkey, l_discount, l_tax, l_discount + l_tax AS reduced FROM lineitem")
def derive_add(spark, sf_dir):
    return _derive(_lines(spark, sf_dir, "l_orderkey", "l_discount", "l_tax"), reduced="l_discount + l_tax")


@query("derive_subtract", "SELECT l_orderkey, l_extendedprice, l_quantity, l_extendedprice - l_quantity AS gap FROM lineitem")
def derive_subtract(spark, sf_dir):
    return _derive(_lines(spark, sf_dir, "l_orderkey", "l_extendedprice", "l_quantity"), gap="l_extendedprice - l_quantity")


@query("derive_multiply", """
SELECT l_orderkey, l_extendedprice, l_discount, l_extendedprice * l_discount AS off FROM lineitem
""")
def derive_multiply(spark, sf_dir):
    return _derive(_lines(spark, sf_dir, "l_orderkey", "l_extendedprice", "l_discount"), off="l_extendedprice * l_discount")


@query("derive_divide", """
SELECT l_orderkey, l_extendedprice, l_discount, l_tax,
       CASE WHEN l_discount = 0 THEN 'infinite' ELSE cast(round(l_extendedprice / l_discount, 3) AS string) END AS ratio,
       CASE WHEN l_discount = 0 AND l_tax = 0 THEN 'missing' WHEN l_discount = 0 THEN 'infinite'
            ELSE cast(round(l_tax / l_discount, 3) AS string) END AS tax_ratio
FROM (SELECT * REPLACE (round(l_discount * 10)::bigint::double AS l_discount, round(l_tax * 100)::double AS l_tax) FROM lineitem)
""")
def derive_divide(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice",
        F.round(F.col("l_discount") * 10).alias("l_discount"), F.round(F.col("l_tax") * 100).alias("l_tax"),
    )
    out = _derive(df, ratio="l_extendedprice / l_discount", tax_ratio="l_tax / l_discount")
    inf = float("inf")

    def shown(c):
        return (
            F.when(F.col(c).isNull(), "missing").when(F.col(c) == inf, "infinite")
            .otherwise(F.round(c, 3).cast("string")).alias(c)
        )

    return out.select("l_orderkey", "l_extendedprice", "l_discount", "l_tax", shown("ratio"), shown("tax_ratio"))


# A key with nulls, and a value that is null throughout some groups.
GROUPED = """
SELECT l_orderkey, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE l_suppkey END AS k,
       CASE WHEN l_suppkey < 10 OR l_tax = 0 THEN NULL ELSE l_extendedprice END AS v
FROM {lineitem}
"""
_G = GROUPED.format(lineitem="lineitem")


def _grouped(spark, sf_dir, form, digits=None):
    out = _derive(run_sql(spark, sf_dir, GROUPED), d=form)
    return out.withColumn("d", F.round("d", digits)) if digits else out


@query("derive_group_size", f"""
WITH g AS ({_G}) SELECT l_orderkey, k, v, CASE WHEN k IS NOT NULL THEN count(*) OVER (PARTITION BY k) END AS d FROM g
""")
def derive_group_size(spark, sf_dir):
    return _grouped(spark, sf_dir, "groupby(k).size()")


@query("derive_group_sum", f"""
WITH g AS ({_G})
SELECT l_orderkey, k, v, CASE WHEN k IS NOT NULL
       THEN round(coalesce(sum(cast(v AS decimal(18,2))) OVER (PARTITION BY k), 0)::double, 2) END AS d FROM g
""")
def derive_group_sum(spark, sf_dir):
    return _grouped(spark, sf_dir, "groupby(k).v.sum()", 2)


@query("derive_group_mean", f"""
WITH g AS ({_G})
SELECT l_orderkey, k, v, CASE WHEN k IS NOT NULL THEN round(avg(v) OVER (PARTITION BY k), 3) END AS d FROM g
""")
def derive_group_mean(spark, sf_dir):
    return _grouped(spark, sf_dir, "groupby(k).v.mean()", 3)


@query("derive_group_min", f"""
WITH g AS ({_G}) SELECT l_orderkey, k, v, CASE WHEN k IS NOT NULL THEN min(v) OVER (PARTITION BY k) END AS d FROM g
""")
def derive_group_min(spark, sf_dir):
    return _grouped(spark, sf_dir, "groupby(k).v.min()")


@query("derive_group_max", f"""
WITH g AS ({_G}) SELECT l_orderkey, k, v, CASE WHEN k IS NOT NULL THEN max(v) OVER (PARTITION BY k) END AS d FROM g
""")
def derive_group_max(spark, sf_dir):
    return _grouped(spark, sf_dir, "groupby(k).v.max()")


@query("derive_chain", """
WITH a AS (
  SELECT o_orderkey, o_custkey, o_totalprice, count(*) OVER (PARTITION BY o_custkey) AS orders,
         max(o_totalprice) OVER (PARTITION BY o_custkey) AS largest FROM orders),
b AS (SELECT *, largest - o_totalprice AS below FROM a)
SELECT o_orderkey, o_custkey, o_totalprice, orders, largest, round(below, 2) AS below,
       round(max(below) OVER (PARTITION BY o_custkey), 2) AS spread FROM b
""")
def derive_chain(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = _derive(
        df, orders="groupby(o_custkey).size()", largest="groupby(o_custkey).o_totalprice.max()",
        below="largest - o_totalprice", spread="groupby(o_custkey).below.max()",
    )
    return out.withColumns({c: F.round(c, 2) for c in ("below", "spread")})


@query("null_propagation", f"""
WITH g AS (SELECT *, CASE WHEN l_orderkey < 100 THEN NULL ELSE l_orderkey END AS w FROM ({_G})),
n AS (SELECT count(*) FILTER (v IS NULL) AS nv, count(*) FILTER (k IS NULL) AS nk, count(*) FILTER (w IS NULL) AS nw,
             count(*) FILTER (v IS NULL OR w IS NULL) AS nboth FROM g)
SELECT 'total' AS derived_field, 'v' AS source_column, nv AS source_nulls, nboth AS derived_nulls,
       nboth > greatest(nv, nw) AS amplified FROM n
UNION ALL SELECT 'total', 'w', nw, nboth, nboth > greatest(nv, nw) FROM n
UNION ALL SELECT 'size', 'k', nk, nk, false FROM n
UNION ALL SELECT 'twice', NULL, NULL, nboth, nboth > 0 FROM n
""")
def null_propagation(spark, sf_dir):
    df = run_sql(spark, sf_dir, GROUPED).withColumn("w", F.when(F.col("l_orderkey") >= 100, F.col("l_orderkey")))
    contract = Contract(derived_fields=[
        Derived("total", "v + w"), Derived("size", "groupby(k).size()"),
        Derived("double_key", "l_orderkey + l_orderkey"), Derived("twice", "total + total"),
    ])
    return derive.null_propagation(df, derive.apply_derivations(df, contract), contract)
