"""Queries: strip, map values, exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import plain, query, run_sql, table
from contractframe.functions.text import WHITESPACE
from contractframe.operators import cleaning, neardup

_WS = "".join(f"chr({ord(c)})||" for c in WHITESPACE)[:-2]

# Texts with white space and control characters at the ends and inside.
DIRTY = """
SELECT c_custkey AS _row_id,
       CASE WHEN c_nationkey < 10 THEN chr(9) || ' ' || c_name || chr(160) || chr(10) ELSE c_name END AS name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment || chr(0) || chr(7) || chr(9) || chr(127)
            ELSE c_mktsegment END AS segment
FROM {customer}
"""


@query("strip_whitespace", f"SELECT _row_id, trim(name, {_WS}) AS name, segment FROM ({plain(DIRTY)})")
def strip_whitespace(spark, sf_dir):
    return cleaning.strip_whitespace(run_sql(spark, sf_dir, DIRTY), ["name"])


@query("strip_counts", f"""
WITH d AS ({plain(DIRTY)})
SELECT 'name' AS "column", count(*) FILTER (name <> trim(name, {_WS})) AS changed FROM d
UNION ALL SELECT 'segment', count(*) FILTER (segment <> trim(segment, {_WS})) FROM d
""")
def strip_counts(spark, sf_dir):
    return cleaning.strip_counts(run_sql(spark, sf_dir, DIRTY), ["name", "segment"])


@query("strip_control", f"""
SELECT _row_id, name, regexp_replace(segment, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g') AS segment FROM ({plain(DIRTY)})
""")
def strip_control(spark, sf_dir):
    return cleaning.strip_control_chars(run_sql(spark, sf_dir, DIRTY), ["segment"])


_MAP = {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"}


@query("apply_value_map", """
SELECT o_orderkey AS _row_id, o_orderstatus, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
       WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def apply_value_map(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_row_id"), "o_orderstatus", "o_orderpriority")
    return cleaning.apply_value_map(df, "o_orderpriority", _MAP)


@query("apply_value_map_table", """
SELECT l_orderkey, l_quantity, CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)
       THEN (SELECT s_name FROM supplier WHERE s_suppkey = l_suppkey) ELSE cast(l_suppkey AS string) END AS supplier
FROM lineitem
""")
def apply_value_map_table(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").where("s_nationkey < 12").select(
        F.col("s_suppkey").cast("string").alias("original"), F.col("s_name").alias("canonical")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_suppkey").cast("string").alias("supplier")
    )
    return cleaning.apply_value_map(lines, "supplier", names)


@query("exact_dedupe", """
SELECT min(doc_id) AS _row_id, text, lang FROM documents GROUP BY text, lang
""")
def exact_dedupe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_row_id"), "text", "lang")
    return cleaning.exact_dedupe(docs)


@query("dedupe_counts", """
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS rows_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS dropped
FROM documents
""")
def dedupe_counts(spark, sf_dir):
    return cleaning.dedupe_counts(table(spark, sf_dir, "documents").select("text", "lang"))


# Times to the microsecond and both zeros: digests must keep the first apart and the second together.
_FINE = """
SELECT event_id % 5000 AS _row_id, event_type, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (event_id % 1000) / 1000000.0) AS at,
       CASE WHEN event_id % 2 = 0 THEN 0.0D ELSE -0.0D END AS zero, nullif(user_id % 7, 3) AS slot
FROM {events}
"""


@query("dedupe_counts_events", """
WITH d AS (SELECT event_type, event_id % 1000 AS at, nullif(user_id % 7, 3) AS slot FROM events)
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS rows_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS dropped FROM d
""")
def dedupe_counts_events(spark, sf_dir):
    return cleaning.dedupe_counts(run_sql(spark, sf_dir, _FINE).drop("_row_id"))


@query("sorted_rank", """
SELECT l_rowid AS _row_id, l_shipmode, row_number() OVER (ORDER BY l_shipmode NULLS LAST, l_rowid) - 1 AS rank FROM (
  SELECT o_orderkey AS l_rowid, nullif(o_orderpriority, '3-MEDIUM') AS l_shipmode FROM orders)
""")
def sorted_rank(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_row_id"), F.expr("nullif(o_orderpriority, '3-MEDIUM')").alias("l_shipmode")
    )
    return neardup.sorted_rank(df, "l_shipmode")


_PART_TEXT = ["p_name", "p_brand", "p_type"]


def _part_pairs(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_row_id"), *_PART_TEXT)
    return neardup.near_duplicates(part, _PART_TEXT)


@query("near_duplicates")
def near_duplicates(spark, sf_dir):
    return _part_pairs(spark, sf_dir).drop("diffs")


@query("near_duplicate_diffs")
def near_duplicate_diffs(spark, sf_dir):
    return neardup.near_duplicate_diffs(_part_pairs(spark, sf_dir))


@query("near_duplicate_documents")
def near_duplicate_documents(spark, sf_dir):
    """Whole texts of all documents."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_row_id"), "text")
    return neardup.near_duplicates(docs, ["text"]).drop("diffs")


# Suppliers by nation, number and rating: short texts, many of them alike, some without a rating.
_SUPPLIERS = """
SELECT s_suppkey AS _row_id, n_name || ' ' || substr(s_name, 10) AS name,
       CASE s_nationkey % 4 WHEN 0 THEN 'good' WHEN 1 THEN 'fine' WHEN 2 THEN 'poor' END AS rating
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
"""

# Longest common subsequences row by row: new[j] is the running maximum of old[j] and old[j - 1] plus a match.
_SIMILAR = f"""
WITH RECURSIVE s AS ({plain(_SUPPLIERS)}),
     r AS (SELECT *, row_number() OVER (ORDER BY name NULLS LAST, _row_id) - 1 AS rank, coalesce(name, '') || ' ' || coalesce(rating, '') AS t FROM s),
     p AS (SELECT a.rank AS rank_a, b.rank AS rank_b, a._row_id AS row_a, b._row_id AS row_b, a.t AS x, b.t AS y, a.name AS name_a, b.name AS name_b,
                  a.rating AS rating_a, b.rating AS rating_b
           FROM r a JOIN r b ON b.rank > a.rank AND b.rank <= a.rank + 500 AND (a.name IS DISTINCT FROM b.name OR a.rating IS DISTINCT FROM b.rating)),
     dp AS (SELECT rank_a, rank_b, x, y, 0 AS i, list_transform(range(length(y) + 1), lambda j: 0::bigint) AS best FROM p
            UNION ALL
            SELECT rank_a, rank_b, x, y, i + 1, list_transform(range(1, length(y) + 2), lambda j: list_max(cand[1:j]))
            FROM (SELECT *, list_transform(range(1, length(y) + 2), lambda j: greatest(best[j], CASE WHEN j > 1 AND x[i + 1] = y[j - 1] THEN best[j - 1] + 1 ELSE 0 END)) AS cand
                  FROM dp WHERE i < length(x))),
     near AS (SELECT p.*, round(100.0 * 2 * best[length(dp.y) + 1] / (length(dp.x) + length(dp.y)), 6) AS similarity
              FROM dp JOIN p USING (rank_a, rank_b) WHERE i = length(dp.x))
"""


def _supplier_pairs(spark, sf_dir):
    return neardup.near_duplicates(run_sql(spark, sf_dir, _SUPPLIERS), ["name", "rating"]).withColumn("similarity", F.round("similarity", 6))


@query("near_duplicate_suppliers", f"{_SIMILAR} SELECT rank_a, rank_b, row_a, row_b, similarity FROM near WHERE similarity >= 85")
def near_duplicate_suppliers(spark, sf_dir):
    return _supplier_pairs(spark, sf_dir).drop("diffs")


@query("near_duplicate_supplier_diffs", f"""
{_SIMILAR}
SELECT row_a, row_b, similarity, 'name' AS "column", name_a AS value_a, name_b AS value_b FROM near WHERE similarity >= 85 AND name_a IS DISTINCT FROM name_b
UNION ALL SELECT row_a, row_b, similarity, 'rating', rating_a, rating_b FROM near WHERE similarity >= 85 AND rating_a IS DISTINCT FROM rating_b
""")
def near_duplicate_supplier_diffs(spark, sf_dir):
    return neardup.near_duplicate_diffs(_supplier_pairs(spark, sf_dir))
