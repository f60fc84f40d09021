"""Queries: original against final, quality and cross-column checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import plain, query, run_sql, table
from catalog.views import ORDERS, PAIRS, RAW_ORDERS, TYPED_ORDERS
from contractframe.operators import checks, cleaning, quality
from contractframe.storage import ROW_ID, materialize

RAW = plain(RAW_ORDERS)
_P = plain(PAIRS)
_AS_OF = "2001-07-01 00:00:00"


def _samples(df):
    """Row samples as text, so that both engines print them alike."""
    return df.withColumn("sample_rows", F.array_join(F.transform("sample_rows", lambda x: x.cast("string")), ","))


def _pairs(spark, sf_dir):
    """The pairs as a stored table, as checks of a final table find it."""
    return materialize(run_sql(spark, sf_dir, PAIRS), "pairs")


def _sql_check(check: str, a: str, b: str, where: str, source: str = "p") -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{a},{b}' AS columns, (SELECT count(*) FROM {source} WHERE {where}) AS violations, "
        f"coalesce((SELECT string_agg(_row_id, ',' ORDER BY _row_id) FROM "
        f"(SELECT _row_id FROM {source} WHERE {where} ORDER BY _row_id LIMIT 5)), '') AS sample_rows"
    )


_DATES = " UNION ALL ".join(
    _sql_check("date_ordering", a, b, f"{a} > {b}")
    for a, b in (("start_date", "end_date"), ("open_ship", "close_ship"), ("created_at", "updated_at"))
)
_RANGES = " UNION ALL ".join(
    _sql_check("numeric_range", a, b, f"{a} > {b}") for a, b in (("min_price", "max_price"), ("low", "high"))
)
_REFERENCES = _sql_check(
    "referential_presence", "billed_account", "account",
    "billed_account NOT IN (SELECT account FROM p WHERE account IS NOT NULL)",
)
_MUTEX = """
SELECT 'mutually_exclusive_nulls' AS "check", columns, 0::bigint AS violations, '' AS sample_rows FROM (
  SELECT 'account,person' AS columns, count(*) FILTER (account IS NOT NULL AND person IS NOT NULL) AS n FROM p
  UNION ALL SELECT 'account,company', count(*) FILTER (account IS NOT NULL AND company IS NOT NULL) FROM p
  UNION ALL SELECT 'person,company', count(*) FILTER (person IS NOT NULL AND company IS NOT NULL) FROM p
  UNION ALL SELECT c || ',account', count(*) FILTER (k IS NOT NULL AND account IS NOT NULL) FROM ship GROUP BY c HAVING count(k) BETWEEN 1 AND count(*) - 1
  UNION ALL SELECT c || ',person', count(*) FILTER (k IS NOT NULL AND person IS NOT NULL) FROM ship GROUP BY c HAVING count(k) BETWEEN 1 AND count(*) - 1
  UNION ALL SELECT c || ',company', count(*) FILTER (k IS NOT NULL AND company IS NOT NULL) FROM ship GROUP BY c HAVING count(k) BETWEEN 1 AND count(*) - 1
  ) WHERE n = 0
"""
_SHIP = """ship AS (
  SELECT 'end_date' AS c, end_date IS NOT NULL OR NULL AS k, account, person, company FROM p
  UNION ALL SELECT 'open_ship', open_ship IS NOT NULL OR NULL, account, person, company FROM p)"""


@query("date_ordering", f"WITH p AS ({_P}) {_DATES}")
def date_ordering(spark, sf_dir):
    return _samples(quality.date_ordering(_pairs(spark, sf_dir)))


@query("numeric_range", f"WITH p AS ({_P}) {_RANGES}")
def numeric_range(spark, sf_dir):
    return _samples(quality.numeric_range(_pairs(spark, sf_dir)))


@query("referential_presence", f"WITH p AS ({_P}) {_REFERENCES}")
def referential_presence(spark, sf_dir):
    return _samples(quality.referential_presence(_pairs(spark, sf_dir)))


@query("mutex_nulls", f"WITH p AS ({_P}), {_SHIP} {_MUTEX}")
def mutex_nulls(spark, sf_dir):
    return _samples(quality.mutex_nulls(_pairs(spark, sf_dir)))


@query("cross_field_checks", f"WITH p AS ({_P}), {_SHIP} {_DATES} UNION ALL {_RANGES} UNION ALL {_REFERENCES} UNION ALL {_MUTEX}")
def cross_field_checks(spark, sf_dir):
    return _samples(quality.cross_field_checks(_pairs(spark, sf_dir)))


@query("violation_samples", f"WITH p AS ({_P}) SELECT _row_id FROM p WHERE low > high ORDER BY _row_id LIMIT 5")
def violation_samples(spark, sf_dir):
    return quality.violation_samples(_pairs(spark, sf_dir), F.col("low") > F.col("high"))


# Lines with an infinite ratio, whole numbers and odd column names.
def _odd_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_shipdate",
        F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax") / F.col("l_discount")).alias("ratio"),
        F.col("l_returnflag").alias(" flag"), F.col("l_linestatus").alias("line  status"), F.col("l_partkey").alias("pièce"),
    )


_QA = f"""
WITH l AS (SELECT l_quantity, l_extendedprice, l_shipdate, l_discount,
                  CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS finite FROM lineitem),
found AS (
  SELECT 'infinity_columns' AS "check", 'ratio' AS "column", count(*) FILTER (l_discount = 0) > 0 AS hit FROM l
  UNION ALL SELECT 'suspicious_rounding_columns', 'ratio', avg((finite IS NULL OR finite = round(finite))::int) > 0.9 FROM l
  UNION ALL SELECT 'suspicious_rounding_columns', 'l_quantity', avg((l_quantity = round(l_quantity))::int) > 0.9 FROM l
  UNION ALL SELECT 'suspicious_rounding_columns', 'l_extendedprice', avg((l_extendedprice = round(l_extendedprice))::int) > 0.9 FROM l
  UNION ALL SELECT 'future_date_columns', 'l_shipdate', max(l_shipdate) > TIMESTAMP '{_AS_OF}' + INTERVAL 1 DAY FROM l
  UNION ALL SELECT 'bad_column_names', ' flag', true UNION ALL SELECT 'bad_column_names', 'line  status', true
  UNION ALL SELECT 'bad_column_names', 'pièce', true)
"""


def _as_of():
    return F.lit(_AS_OF).cast("timestamp")


@query("qa_report", _QA + 'SELECT "check", "column" FROM found WHERE hit')
def qa_report(spark, sf_dir):
    return quality.qa_report(_odd_lines(spark, sf_dir), _as_of())


@query("qa_infinity", _QA + "SELECT \"column\" FROM found WHERE hit AND \"check\" = 'infinity_columns'")
def qa_infinity(spark, sf_dir):
    return quality.qa_infinity(_odd_lines(spark, sf_dir))


@query("qa_rounding", _QA + "SELECT \"column\" FROM found WHERE hit AND \"check\" = 'suspicious_rounding_columns'")
def qa_rounding(spark, sf_dir):
    return quality.qa_rounding(_odd_lines(spark, sf_dir))


@query("qa_future_dates", f"""
SELECT 'l_shipdate' AS "column" FROM lineitem HAVING max(l_shipdate) > TIMESTAMP '{_AS_OF}' + INTERVAL 1 DAY
""")
def qa_future_dates(spark, sf_dir):
    return quality.qa_future_dates(_odd_lines(spark, sf_dir), _as_of())


@query("qa_column_names", """
SELECT url AS "column" FROM pages WHERE regexp_matches(url, '[^\\x00-\\x7f]') OR url LIKE '%  %' OR url <> trim(url)
UNION ALL
SELECT text FROM benchmark WHERE regexp_matches(text, '[^\\x00-\\x7f]') OR text LIKE '%  %' OR regexp_matches(text, '^\\s|\\s$')
""")
def qa_column_names(spark, sf_dir):
    names = table(spark, sf_dir, "pages").select(F.col("url").alias("column")).unionByName(
        table(spark, sf_dir, "benchmark").select(F.col("text").alias("column"))
    )
    return quality.qa_column_names(names)


# -- original against final ---------------------------------------------------------


def _typed_and_cleaned(spark, sf_dir):
    raw = materialize(run_sql(spark, sf_dir, RAW_ORDERS), "raw")
    typed = checks.coerce_types(checks.rename_to_contract(raw, ORDERS), ORDERS)
    return raw, materialize(cleaning.strip_whitespace(typed, ["priority"]), "cleaned")


@query("original_vs_final_diff", f"""
WITH t AS ({TYPED_ORDERS}), raw AS ({RAW})
SELECT * FROM (
  SELECT 'priority' AS "column", false AS row_count_changed, count(*) AS original_rows, count(*) AS final_rows,
         count(*) FILTER (priority <> trim(priority)) AS mismatches FROM t
  UNION ALL SELECT 'customer_id', false, count(*), count(*), count(*) FILTER (cust = 'unknown') FROM raw
  UNION ALL SELECT 'total', false, count(*), count(*), count(*) FILTER (total IN ('12,5', 'nan')) FROM raw
  UNION ALL SELECT 'placed', false, count(*), count(*), count(*) FILTER (placed = 'not a date') FROM raw
) WHERE mismatches > 0
""")
def original_vs_final_diff(spark, sf_dir):
    raw, final = _typed_and_cleaned(spark, sf_dir)
    return quality.original_vs_final_diff(raw, final, ORDERS)


@query("row_count_changed", f"""
WITH raw AS ({RAW})
SELECT c AS "column", true AS row_count_changed, count(*) AS original_rows,
       count(*) FILTER (status <> 'F') AS final_rows, NULL::bigint AS mismatches
FROM raw, (VALUES ('order_id'), ('customer_id'), ('status'), ('total'), ('placed'), ('priority')) v(c) GROUP BY c
""")
def row_count_changed(spark, sf_dir):
    raw, final = _typed_and_cleaned(spark, sf_dir)
    return quality.original_vs_final_diff(raw, final.where("status <> 'F'"), ORDERS)


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias(ROW_ID), "text", "lang")


@query("row_count_drift", """
SELECT count(*) AS original_rows, count(DISTINCT (text, lang)) AS final_rows, count(*) - count(DISTINCT (text, lang)) AS dropped_rows
FROM documents
""")
def row_count_drift(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return quality.row_count_drift(docs, cleaning.exact_dedupe(docs))


@query("dropped_rows", """
SELECT doc_id AS _row_id FROM documents WHERE doc_id NOT IN (SELECT min(doc_id) FROM documents GROUP BY text, lang)
""")
def dropped_rows(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return quality.dropped_rows(docs, cleaning.exact_dedupe(docs))


@query("validation_report", f"""
WITH t AS ({TYPED_ORDERS}), raw AS ({RAW})
SELECT * FROM (
  SELECT 'schema_revalidation' AS section, 'customer_id:not_nullable' AS item, count(*) FILTER (customer_id IS NULL) AS value FROM t
  UNION ALL SELECT 'schema_revalidation', 'status:isin', count(*) FILTER (status = 'X') FROM t
  UNION ALL SELECT 'schema_revalidation', 'total:less_than_or_equal_to(495000)', count(*) FILTER (total > 495000) FROM t
  UNION ALL SELECT 'schema_revalidation', 'placed:not_nullable', count(*) FILTER (placed IS NULL) FROM t
  UNION ALL SELECT 'original_vs_final_diff', 'priority:mismatches', count(*) FILTER (priority <> trim(priority)) FROM t
  UNION ALL SELECT 'original_vs_final_diff', 'customer_id:mismatches', count(*) FILTER (cust = 'unknown') FROM raw
  UNION ALL SELECT 'original_vs_final_diff', 'total:mismatches', count(*) FILTER (total IN ('12,5', 'nan')) FROM raw
  UNION ALL SELECT 'original_vs_final_diff', 'placed:mismatches', count(*) FILTER (placed = 'not a date') FROM raw
  UNION ALL SELECT 'qa_checks', 'future_date_columns:placed', (max(placed) > TIMESTAMP '{_AS_OF}' + INTERVAL 1 DAY)::bigint FROM t
  UNION ALL SELECT 'cross_field_checks', 'mutually_exclusive_nulls:' || c, CASE WHEN n = 0 THEN -1 ELSE 0 END FROM (
    SELECT 'customer_id,total' AS c, count(*) FILTER (customer_id IS NOT NULL AND total IS NOT NULL) AS n FROM t)
) WHERE value > 0
""")
def validation_report(spark, sf_dir):
    raw, final = _typed_and_cleaned(spark, sf_dir)
    return quality.validation_report(raw, final, ORDERS, _as_of())
