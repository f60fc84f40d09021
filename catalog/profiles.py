"""Queries: column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import plain, query, run_sql, table
from contractframe.operators import profile

# Orders with nulls, a boolean, a not-a-number and a column without values.
ORDERS_VIEW = """
SELECT o_orderkey AS _row_id, o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority,
       CASE WHEN o_orderstatus = 'P' THEN cast('nan' AS double) ELSE o_totalprice END AS price,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS placed,
       o_totalprice > 250000 AS large, cast(NULL AS double) AS nothing
FROM {orders}
"""
_O = plain(ORDERS_VIEW).replace(
    "THEN cast('nan' AS double) ELSE", "THEN NULL ELSE"
)
_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _orders(spark, sf_dir):
    return run_sql(spark, sf_dir, ORDERS_VIEW)


def _union(template: str, columns: list[str], source: str) -> str:
    return "\nUNION ALL\n".join(template.format(c=c, src=source) for c in columns)


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "_row_id")


_ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "priority", "price", "placed", "large", "nothing"]
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("profile_table", f"SELECT count(*) AS row_count, {len(_LINE_COLUMNS)}::bigint AS column_count FROM lineitem")
def profile_table(spark, sf_dir):
    return profile.profile_table(table(spark, sf_dir, "lineitem"))


@query("profile_nulls", f"WITH o AS ({_O}) " + _union(
    "SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, "
    "round(100.0::double * count(*) FILTER ({c} IS NULL) / count(*), 3) AS null_pct FROM {src}", _ORDER_COLUMNS, "o"))
def profile_nulls(spark, sf_dir):
    return profile.profile_nulls(_orders(spark, sf_dir))


@query("profile_distinct", _union(
    "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count FROM {src}", _LINE_COLUMNS, "lineitem"))
def profile_distinct(spark, sf_dir):
    return profile.profile_distinct(table(spark, sf_dir, "lineitem"))


def _tops(columns: dict[str, str], source: str, row: str) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", rank, value, n FROM (
  SELECT {text} AS value, count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, min({row}))::int AS rank
  FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 5"""
        for c, text in columns.items()
    ]
    return "\nUNION ALL\n".join(parts)


_DOC_TOPS = _tops(
    {"text": "text", "lang": "lang", "source": "source", "n_chars": "cast(n_chars AS string)"}, "documents", "doc_id"
)
_ORDER_TOPS = _tops(
    {"o_custkey": "cast(o_custkey AS string)", "o_orderstatus": "o_orderstatus", "priority": "priority",
     "price": "cast(price AS string)", "placed": f"strftime(placed, {_TS})", "large": "cast(large AS string)"},
    "o", "_row_id",
)


@query("profile_top_values", _DOC_TOPS)
def profile_top_values(spark, sf_dir):
    return profile.profile_top_values(_documents(spark, sf_dir))


@query("profile_top_values_orders", f"WITH o AS ({_O}) {_ORDER_TOPS}")
def profile_top_values_orders(spark, sf_dir):
    return profile.profile_top_values(_orders(spark, sf_dir))


_NUMERIC = (
    "SELECT '{c}' AS \"column\", min({x})::double AS min_value, max({x})::double AS max_value, "
    "round(avg({x}), 4) AS mean_value, round(coalesce(stddev_samp({x}), 0), 4) AS std_value FROM {src}"
)


@query("profile_numeric", f"WITH o AS ({_O}) " + "\nUNION ALL\n".join(
    [_NUMERIC.format(c=c, x=c, src="lineitem") for c in _LINE_COLUMNS[:8]]
    + [_NUMERIC.format(c=c, x=x, src="o") for c, x in (("o_custkey", "o_custkey"), ("price", "price"), ("large", "large::int"))]))
def profile_numeric(spark, sf_dir):
    return profile.profile_numeric(table(spark, sf_dir, "lineitem")).unionByName(
        profile.profile_numeric(_orders(spark, sf_dir))
    )


@query("profile_datetime", f"WITH o AS ({_O}) " + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", strftime(min({c}), {_TS}) AS min_time, strftime(max({c}), {_TS}) AS max_time FROM {src}"
    for c, src in (("l_shipdate", "lineitem"), ("placed", "o"), ("ts", "events"))))
def profile_datetime(spark, sf_dir):
    out = profile.profile_datetime(table(spark, sf_dir, "lineitem"))
    for df in (_orders(spark, sf_dir), table(spark, sf_dir, "events")):
        out = out.unionByName(profile.profile_datetime(df))
    return out


@query("profile_lengths", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", min(length({c})) AS min_length, max(length({c})) AS max_length FROM {src}"
    for c, src in (("text", "documents"), ("lang", "documents"), ("source", "documents"), ("url", "pages"), ("html", "pages"))))
def profile_lengths(spark, sf_dir):
    return profile.profile_lengths(_documents(spark, sf_dir)).unionByName(
        profile.profile_lengths(table(spark, sf_dir, "pages"))
    )


_AS_OF = "2024-06-01 00:00:00"


def _as_of():
    return F.lit(_AS_OF).cast("timestamp")


@query("freshness", f"WITH o AS ({_O}) " + "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", strftime(max({c}), {_TS}) AS newest, strftime(min({c}), {_TS}) AS oldest,
       round((epoch_us(max({c})) - epoch_us(min({c}))) / 86400000000.0::double, 3) AS span_days,
       round((epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(max({c}))) / 86400000000.0::double, 3) AS staleness_days,
       (epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(max({c}))) / 86400000000.0::double > 90 AS is_stale FROM {src}"""
    for c, src in (("l_shipdate", "lineitem"), ("placed", "o"), ("ts", "events"))))
def freshness(spark, sf_dir):
    out = profile.freshness(table(spark, sf_dir, "lineitem"), _as_of())
    for df in (_orders(spark, sf_dir), table(spark, sf_dir, "events")):
        out = out.unionByName(profile.freshness(df, _as_of()))
    return out


@query("value_counts", f"WITH o AS ({_O}) SELECT priority AS value, count(*) AS n FROM o GROUP BY priority")
def value_counts(spark, sf_dir):
    return profile.value_counts(_orders(spark, sf_dir), "priority")


@query("profile_full", f"""
WITH o AS ({_O}), tops AS ({_ORDER_TOPS}),
t AS (SELECT "column", string_agg(value || '=' || n, '; ' ORDER BY rank) AS top_values FROM tops GROUP BY "column"),
s AS (
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", '{dt}' AS dtype, count(*) FILTER ({c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count,
       {f"min({num})::double" if num else "NULL::double"} AS min_value, {f"max({num})::double" if num else "NULL::double"} AS max_value,
       {f"round(avg({num}), 4)" if num else "NULL::double"} AS mean_value,
       {f"CASE WHEN count({num}) > 0 THEN round(coalesce(stddev_samp({num}), 0), 4) END" if num else "NULL::double"} AS std_value,
       {f"strftime(max({c}), {_TS})" if dt == "timestamp_ntz" else "NULL"} AS max_time,
       {f"max(length({c}))" if dt == "string" else "NULL::bigint"} AS max_length,
       {f"(epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(max({c}))) / 86400000000.0::double > 90" if dt == "timestamp_ntz" else "NULL::boolean"} AS is_stale
  FROM o"""
    for c, dt, num in (
        ("o_custkey", "bigint", "o_custkey"), ("o_orderstatus", "string", None), ("priority", "string", None),
        ("price", "double", "price"), ("placed", "timestamp_ntz", None), ("large", "boolean", "large::int"),
        ("nothing", "double", "nothing"),
    )) + """)
SELECT s.*, coalesce(top_values, '') AS top_values FROM s LEFT JOIN t USING ("column")
""")
def profile_full(spark, sf_dir):
    full = profile.profile_full(_orders(spark, sf_dir), _as_of())
    shown = F.array_join(
        F.transform("top_values", lambda x: F.concat(x["value"], F.lit("="), x["count"].cast("string"))), "; "
    )
    return full.select(
        "column", "dtype", "null_count", "distinct_count", "min_value", "max_value", "mean_value", "std_value",
        "max_time", "max_length", "is_stale", F.coalesce(shown, F.lit("")).alias("top_values"),
    )


# Contacts whose most frequent values are personal data.
CONTACTS = """
SELECT o_orderkey AS _row_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Mary Ann Lee' WHEN '2-HIGH' THEN 'jo@example.com'
            WHEN '3-MEDIUM' THEN 'no one' WHEN '5-LOW' THEN '555-010-4477' ELSE o_orderpriority END AS contact,
       'Visa ending in 4' || lpad(cast(o_custkey AS string), 3, '0') AS card, o_orderstatus
FROM {orders}
"""
_KIND = (
    "CASE WHEN value LIKE '%@%' THEN 'email' WHEN value LIKE 'Visa%' THEN 'partial_card' "
    "WHEN value LIKE '555-%' THEN 'phone' WHEN value = 'Mary Ann Lee' THEN 'person_name' END"
)
_CONTACT_TOPS = f"WITH o AS ({plain(CONTACTS)}), tops AS (" + _tops(
    {"contact": "contact", "card": "card", "o_orderstatus": "o_orderstatus"}, "o", "_row_id") + f"), k AS (SELECT *, {_KIND} AS kind FROM tops)"


@query("profile_redacted", _CONTACT_TOPS + """
SELECT "column", rank, CASE WHEN kind IS NULL THEN value ELSE
       '[REDACTED_' || upper(kind) || '_' || count(kind) OVER (PARTITION BY "column" ORDER BY rank) || ']' END AS value, n FROM k
""")
def profile_redacted(spark, sf_dir):
    return profile.redact_top_values(profile.profile_top_values(run_sql(spark, sf_dir, CONTACTS)))


@query("profile_pii_scan", _CONTACT_TOPS + """
SELECT 'profile.columns.' || "column" || '.top_values' AS location, kind AS pii_type, value FROM k WHERE kind IS NOT NULL
""")
def profile_pii_scan(spark, sf_dir):
    return profile.scan_top_values(profile.profile_top_values(run_sql(spark, sf_dir, CONTACTS)))
