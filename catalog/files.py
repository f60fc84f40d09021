"""Queries: intake of delimited files, landing, logs, delivery.

Each query writes its files from the given tables into scratch storage first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query, run_sql, table
from catalog.privacy import findings_sql
from catalog.views import ORDERS, TYPED_ORDERS
from contractframe.operators import privacy, profile
from contractframe.sources import changelog, deliver, intake
from contractframe.storage import ROW_ID, materialize, scratch_path


def _write(df: DataFrame, suffix: str, sep: str = ",", encoding: str = "utf-8") -> str:
    """A table as a folder of delimited files, each with its header."""
    path = scratch_path(df.sparkSession, "files") + suffix
    df.write.option("header", True).option("sep", sep).option("escape", '"').option("encoding", encoding).csv(path)
    return path


def _with_preamble(df: DataFrame, title: str) -> str:
    """The same with a title line and a blank line above every header."""
    spark = df.sparkSession
    path = scratch_path(spark, "files") + ".csv"
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    head = F.array(F.lit(title), F.lit(""), F.lit(",".join(df.columns)))
    df.select(line.alias("line"), first.alias("first")).select(
        F.explode(F.when(F.col("first"), F.concat(head, F.array("line"))).otherwise(F.array("line"))).alias("value")
    ).write.text(path)
    return path


_PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size::bigint AS p_size, p_retailprice FROM part"


@query("intake_csv", _PART)
def intake_csv(spark, sf_dir):
    return intake.read_delimited(spark, _write(table(spark, sf_dir, "part"), ".csv")).table.drop(ROW_ID)


@query("intake_csv_rows", "SELECT c_custkey AS _row_id, c_custkey, c_name, c_acctbal FROM customer")
def intake_csv_rows(spark, sf_dir):
    """Row ids follow the order of the file."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return intake.read_delimited(spark, _write(customers, ".csv")).table


@query("intake_tsv", "SELECT s_suppkey, s_name, s_nationkey::bigint AS s_nationkey, s_acctbal FROM supplier")
def intake_tsv(spark, sf_dir):
    return intake.read_delimited(spark, _write(table(spark, sf_dir, "supplier"), ".tsv", "\t"), sep="\t").table.drop(ROW_ID)


@query("intake_header_offset", _PART)
def intake_header_offset(spark, sf_dir):
    path = _with_preamble(table(spark, sf_dir, "part"), "Parts of the warehouse")
    return intake.read_delimited(spark, path, header_row="auto").table.drop(ROW_ID)


@query("intake_nrows", """
SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_id // 10000 ORDER BY event_id) <= 100
""")
def intake_nrows(spark, sf_dir):
    """The first rows of every file; a file holds ten thousand events."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.floor(F.col("event_id") / 10_000).alias("part"))
    path = scratch_path(spark, "files")
    events.repartition("part").sortWithinPartitions("part", "event_id").write.option("header", True).partitionBy("part").csv(path)
    parts = [r["part"] for r in events.select("part").distinct().orderBy("part").collect()]  # one per file
    return intake.read_delimited(spark, [f"{path}/part={p}" for p in parts], nrows=100, sep=",").table.drop(ROW_ID)


@query("intake_ragged", """
SELECT doc_id % 3 = 0 AS aside, count(*) AS n, sum(doc_id)::bigint AS id_sum, sum(length(text))::bigint AS characters FROM documents GROUP BY 1
""")
def intake_ragged(spark, sf_dir):
    """Documents with line breaks in their cells; every third row has a cell too many and is set aside."""
    path = scratch_path(spark, "files") + ".csv"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted, F.when(F.col("doc_id") % 3 == 0, "extra"))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    docs.select(line.alias("line"), first.alias("first")).select(
        F.explode(F.when(F.col("first"), F.array(F.lit("doc_id,text"), "line")).otherwise(F.array("line"))).alias("value")
    ).write.text(path)
    got = intake.read_delimited(spark, path, ragged="split", infer=False)
    cell = lambda c, i: intake.split_cells(F.col(c), F.lit(","))[i]
    aside = got.ragged.select(cell("row", 0).cast("bigint").alias("doc_id"), cell("row", 1).alias("text"), F.lit(True).alias("aside"))
    kept = got.table.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("aside"))
    return kept.unionByName(aside).groupBy("aside").agg(
        F.count("*").alias("n"), F.sum("doc_id").cast("bigint").alias("id_sum"), F.sum(F.length("text")).cast("bigint").alias("characters")
    )


@query("file_encoding", """
SELECT 'utf-8' AS written_as, true AS utf8, false AS bom, 'utf-8' AS encoding
UNION ALL SELECT 'iso-8859-1', NOT bool_or(latin), false, CASE WHEN bool_or(latin) THEN 'iso-8859-1' ELSE 'utf-8' END
FROM (SELECT regexp_matches(text, '[\\x{80}-\\x{ff}]') AS latin FROM documents)
""")
def file_encoding(spark, sf_dir):
    """Documents as UTF-8 and as ISO-8859-1 files; the verdict on all files of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"[^\x00-\xff]", "?").alias("text"))
    found = None
    for code in ("utf-8", "iso-8859-1"):
        path = _write(docs, ".csv", encoding=code)
        one = intake.file_encoding(spark, [path]).agg(
            F.bool_and("is_utf8").alias("utf8"), F.bool_or("has_bom").alias("bom"), F.min("encoding").alias("encoding")
        ).select(F.lit(code).alias("written_as"), "utf8", "bom", "encoding")
        found = one if found is None else found.unionByName(one)
    return found


def _many_files(spark: SparkSession, sf_dir: str) -> list[str]:
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    return [
        _write(part.where("p_size <= 25"), ".csv"),
        _write(part.where("p_size > 25"), ".csv"),
        _with_preamble(customer, "Customers of the house"),
    ]


_PART_COLUMNS = "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice"
_CUSTOMER_COLUMNS = "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment"


@query("header_row", f"""
SELECT 0 AS header_row, 0 AS header_skip, '{_PART_COLUMNS}' AS columns FROM part
UNION SELECT 2, 1, '{_CUSTOMER_COLUMNS}' FROM customer
""")
def header_row(spark, sf_dir):
    """Header places over all files; how many files there are depends on the writer's tasks."""
    heads = intake.header_rows(spark, _many_files(spark, sf_dir))
    return heads.select("header_row", "header_skip", F.array_join("columns", ",").alias("columns")).distinct()


@query("schema_groups", f"""
SELECT '{_PART_COLUMNS}' AS columns, 2 AS sources FROM part UNION SELECT '{_CUSTOMER_COLUMNS}', 1 FROM customer
""")
def schema_groups(spark, sf_dir):
    """The groups, and how many of the written folders each covers."""
    files = intake.file_groups(intake.header_rows(spark, _many_files(spark, sf_dir)))
    folders = F.count_distinct(F.regexp_replace("file", "/[^/]*$", ""))
    return files.groupBy("columns").agg(folders.cast("int").alias("sources")).select(F.array_join("columns", ",").alias("columns"), "sources")


@query("bulk_union", """
SELECT 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS columns, count(*) AS total_rows, sum(p_partkey)::bigint AS key_sum FROM part
UNION ALL SELECT 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment', count(*), sum(c_custkey)::bigint FROM customer
""")
def bulk_union(spark, sf_dir):
    report, tables = intake.bulk_intake(spark, _many_files(spark, sf_dir), sep=",")
    sums = None
    for index, got in tables.items():
        key = next(c for c in got.table.columns if c != ROW_ID)
        one = got.table.agg(F.sum(key).cast("bigint").alias("key_sum")).withColumn("group_index", F.lit(index))
        sums = one if sums is None else sums.unionByName(one)
    return report.join(sums, "group_index").select(F.array_join("columns", ",").alias("columns"), "total_rows", "key_sum")


@query("bulk_profile", """
SELECT 'part' AS source, "column", distinct_count FROM (
  SELECT count(DISTINCT p_partkey) AS p_partkey, count(DISTINCT p_name) AS p_name, count(DISTINCT p_brand) AS p_brand, count(DISTINCT p_type) AS p_type,
         count(DISTINCT p_size) AS p_size, count(DISTINCT p_retailprice) AS p_retailprice FROM part)
  UNPIVOT (distinct_count FOR "column" IN (p_partkey, p_name, p_brand, p_type, p_size, p_retailprice))
UNION ALL
SELECT 'customer', "column", distinct_count FROM (
  SELECT count(DISTINCT c_custkey) AS c_custkey, count(DISTINCT c_name) AS c_name, count(DISTINCT c_nationkey) AS c_nationkey,
         count(DISTINCT c_acctbal) AS c_acctbal, count(DISTINCT c_mktsegment) AS c_mktsegment FROM customer)
  UNPIVOT (distinct_count FOR "column" IN (c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment))
""")
def bulk_profile(spark, sf_dir):
    """One profile row per schema group and column."""
    _, tables = intake.bulk_intake(spark, _many_files(spark, sf_dir), sep=",")
    source = F.when(F.col("column").startswith("p_"), "part").otherwise("customer")
    return intake.profile_groups(tables).select(source.alias("source"), "column", "distinct_count")


@query("checkpoint_roundtrip", "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders")
def checkpoint_roundtrip(spark, sf_dir):
    return materialize(table(spark, sf_dir, "orders"), "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("raw_snapshot", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def raw_snapshot(spark, sf_dir):
    """Two landings in one folder; the first is read back unchanged."""
    path = scratch_path(spark, "raw")
    customers = table(spark, sf_dir, "customer")
    intake.land_raw(customers, path, "20240601T000000Z")
    intake.land_raw(customers.where("c_acctbal > 0"), path, "20240602T000000Z")
    return intake.read_raw(spark, path, "20240601T000000Z")


@query("intake_manifest", """
SELECT (SELECT count(*) FROM events) AS row_count, 6::bigint AS column_count, * FROM (VALUES
  (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'), (3, 'event_type', 'string'),
  (4, 'value', 'double'), (5, 'props', 'string')) v(position, "column", dtype)
""")
def intake_manifest(spark, sf_dir):
    return intake.intake_manifest(table(spark, sf_dir, "events"))


@query("head_sample", "SELECT doc_id AS _row_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 50")
def head_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias(ROW_ID), "lang", "source", "n_chars")
    return intake.first_rows_of(docs)


@query("change_log", """
SELECT 'clean' AS stage, 'value_seen' AS event, count(*) AS rows_affected, '{"status":"' || o_orderstatus || '"}' AS details
FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'intake', 'archived_and_loaded', count(*), '{"table": "orders"}' FROM orders
""")
def change_log(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    log = changelog.ChangeLog(spark, scratch_path(spark, "log"))
    log.log("intake", "archived_and_loaded", orders.count(), {"table": "orders"})
    log.append(
        orders.groupBy("o_orderstatus").agg(F.count("*").alias("rows_affected")).select(
            F.lit("clean").alias("stage"), F.lit("value_seen").alias("event"), "rows_affected",
            F.to_json(F.struct(F.col("o_orderstatus").alias("status"))).alias("details"),
        )
    )
    return log.read_all().drop("ts")


_DICTIONARY = """
SELECT * FROM (VALUES
 ('order_id', 'Order', 'identifier', 'Int64', false, '', '', '', 'order_no', false, 'reliable', 'draft', '', ''),
 ('customer_id', 'Customer', 'integer', 'Int64', false, '', '', '', 'cust', false, 'reliable', 'draft', '', ''),
 ('status', 'Status', 'categorical', 'string', false, 'O, F, P', '', '', '', false, 'reliable', 'draft', '', ''),
 ('total', 'Total price', 'decimal', 'float64', true, '', '0', '495000', '', false, 'reliable', 'draft', '', ''),
 ('placed', 'Date placed', 'date', 'datetime64[ns]', false, '', '', '', '', false, 'reliable', 'draft', '', ''),
 ('priority', 'Priority', 'text', 'string', false, '', '', '', 'priority_text', false, 'reliable', 'draft', 'ask jane@example.com', ''),
 ('customer_total', 'All orders of the customer', 'decimal', 'float64', false, '', '', '', '(derived)', false, 'reliable', 'draft', '', 'groupby(customer_id).total.sum()'),
 ('customer_orders', 'Orders of the customer', 'integer', 'Int64', false, '', '', '', '(derived)', false, 'reliable', 'draft', '', 'groupby(customer_id).size()'),
 ('share', 'Share of the customer''s total', 'decimal', 'float64', false, '', '', '', '(derived)', false, 'reliable', 'draft', '', 'total / customer_total')
) v(field_name, label, type, dtype, nullable, allowed_values, "min", "max", source_column, pii, reliability, review_status, notes, transformation)
"""


_FIELDS = ("order_id", "customer_id", "status", "total", "placed", "priority")


@query("dictionary_table", f"""
WITH t AS ({TYPED_ORDERS}), n AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS field_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count FROM t"
    for c in _FIELDS)})
SELECT d.*, row_count, null_count, distinct_count FROM ({_DICTIONARY}) d LEFT JOIN n USING (field_name)
""")
def dictionary_table(spark, sf_dir):
    """The dictionary beside figures of the columns it describes; none for derived ones."""
    typed = run_sql(spark, sf_dir, TYPED_ORDERS.replace("FROM orders", "FROM {orders}")).select(ROW_ID, *_FIELDS)
    counts = typed.agg(*[F.count("*").alias(c) for c in _FIELDS]).unpivot([], list(_FIELDS), "column", "row_count")
    figures = profile.profile_stats(typed).join(profile.profile_distinct(typed), "column").join(counts, "column")
    figures = figures.select(F.col("column").alias("field_name"), "row_count", "null_count", "distinct_count")
    return deliver.dictionary_table(spark, ORDERS).join(figures, "field_name", "left")


@query("deliver_bundle", f"""
SELECT 'data' AS dataset, o_orderstatus AS item, count(*) AS n FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'dictionary', type, count(*) FROM ({_DICTIONARY}) GROUP BY type
UNION ALL SELECT 'changes', 'archived_and_loaded', count(*) FROM orders
""")
def deliver_bundle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    log = changelog.ChangeLog(spark, scratch_path(spark, "log"))
    log.log("intake", "archived_and_loaded", orders.count())
    at = deliver.deliver(orders, ORDERS, log.read_all(), scratch_path(spark, "delivery"))
    read = {name: spark.read.parquet(path) for name, path in at.items()}
    n = F.count("*").alias("n")
    data = read["data"].groupBy(F.col("o_orderstatus").alias("item")).agg(n)
    dictionary = read["dictionary"].groupBy(F.col("type").alias("item")).agg(n)
    changes = read["changes"].select(F.col("event").alias("item"), F.col("rows_affected").alias("n"))
    out = None
    for name, part in (("data", data), ("dictionary", dictionary), ("changes", changes)):
        part = part.select(F.lit(name).alias("dataset"), "item", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("scan_text_files", f"""
WITH f AS ({findings_sql("documents", "doc_id", "text")})
SELECT pii_type, CASE WHEN length("match") > 6 THEN substr("match", 1, 3) || '...' ELSE '...' END AS preview, count(*) AS n
FROM f GROUP BY ALL
""")
def scan_text_files(spark, sf_dir):
    """Documents as text files; findings counted per class and preview."""
    path = scratch_path(spark, "texts")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return privacy.scan_text_files(spark, path, "*.txt").groupBy("pii_type", "preview").agg(F.count("*").alias("n"))
