"""Queries: personal data and unsafe cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import plain, query, run_sql, table
from catalog.views import VALUES
from contractframe.contract import contract_from_dict
from contractframe.functions import pii, text
from contractframe.operators import privacy
from contractframe.storage import evaluated_once

_V = plain(VALUES)

# The oracle engine's regular expressions know no Unicode word boundary: letters
# beyond ASCII are turned into a plain letter before digits are matched.
_PLAIN = "regexp_replace({t}, '[^\\x00-\\x7F]', 'x', 'g')"
_EMAIL = "\\b[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+(?:\\.[a-zA-Z0-9-]+)*\\.[a-zA-Z]{2,}\\b"
_CLASSES = (
    ("ssn", "\\b\\d{3}-\\d{2}-\\d{4}\\b", _PLAIN),
    ("email", _EMAIL, "{t}"),
    ("credit_card", "\\b\\d{4}[\\s-]?\\d{4}[\\s-]?\\d{4}[\\s-]?\\d{4}\\b", _PLAIN),
    ("partial_card", "(?i)(?:ending|last\\s*4|card)\\s*(?:in\\s*)?\\d{4}", "{t}"),
    ("phone", "\\b\\+?\\d{3}[\\s.-]?\\d{3}[\\s.-]?\\d{4}\\b", _PLAIN),
)


def _found(t: str) -> str:
    parts = [
        f"list_transform(regexp_extract_all({source.format(t=t)}, '{pattern}'), "
        f"lambda m: struct_pack(pii_type := '{name}', \"match\" := m))"
        for name, pattern, source in _CLASSES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


def findings_sql(table_name: str, key: str, column: str) -> str:
    return (
        f"SELECT {key}, position, f.pii_type AS pii_type, f.\"match\" AS \"match\" FROM ("
        f"SELECT {key}, unnest(fs) AS f, (generate_subscripts(fs, 1) - 1)::int AS position "
        f"FROM (SELECT {key}, {_found(column)} AS fs FROM {table_name}))"
    )


def _redacted(t: str) -> str:
    # Longest finding first, equal lengths in the order found.
    ordered = (
        f"list_sort(list_transform({_found(t)}, lambda x, i: struct_pack(k := -length(x.\"match\"), i := i, "
        f"a := x.\"match\", b := '[REDACTED_' || upper(x.pii_type) || ']')))"
    )
    start = f"struct_pack(k := 0::bigint, i := 0::bigint, a := {t}, b := '')"
    return (
        f"list_reduce(list_prepend({start}, {ordered}), "
        f"lambda s, x: struct_pack(k := 0::bigint, i := 0::bigint, a := replace(s.a, x.a, x.b), b := '')).a"
    )


# Documents with personal data of every class added to their own text.
NOTES = """
SELECT doc_id, CASE lang WHEN 'en' THEN text || ' SSN 123-45-6789, card ending 4122'
            WHEN 'fr' THEN text || ' 555 010 4477 et a.b+c@mail.example.co.uk'
            WHEN 'de' THEN text || ' 4111-1111-1111-1111 oder 123-45-6789'
            ELSE text END AS text
FROM {documents}
"""
_N = plain(NOTES)


@query("classify_pii", f"""
WITH v AS ({_V}), t AS (SELECT *, trim(value) AS s FROM v)
SELECT _row_id, value, CASE
  WHEN regexp_matches(s, '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') THEN 'ssn'
  WHEN regexp_matches(s, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z]{{2,}}$') THEN 'email'
  WHEN regexp_matches(s, '^\\d{{4}}[\\s-]?\\d{{4}}[\\s-]?\\d{{4}}[\\s-]?\\d{{4}}$') THEN 'credit_card'
  WHEN regexp_matches(s, '(?i)(?:ending|last\\s*4|card)\\s*(?:in\\s*)?\\d{{4}}') THEN 'partial_card'
  WHEN regexp_matches(s, '^[.*]{{2,}}\\d{{3,}}$') THEN 'partial_account'
  WHEN regexp_matches(s, '^[+]?[\\d\\s().-]{{10,}}$') AND length(regexp_replace(s, '\\D', '', 'g')) >= 7
       AND NOT regexp_matches(s, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN 'phone' END AS pii_type
FROM t
""")
def classify_pii(spark, sf_dir):
    return run_sql(spark, sf_dir, VALUES).withColumn("pii_type", pii.classify_pii(F.col("value")))


@query("person_name", f"""
WITH v AS ({_V})
SELECT _row_id, value, regexp_matches(value, '^\\s*\\p{{Lu}}[\\pL''-]*(\\s+\\p{{Lu}}[\\pL''-]*){{1,3}}\\s*$') AS is_name FROM v
""")
def person_name(spark, sf_dir):
    return run_sql(spark, sf_dir, VALUES).withColumn("is_name", pii.is_person_name(F.col("value")))


@query("find_pii", findings_sql(f"({_N})", "doc_id", "text"))
def find_pii(spark, sf_dir):
    return privacy.find_in_column(run_sql(spark, sf_dir, NOTES), "doc_id", "text")


@query("pii_counts_by_type", f"""
WITH f AS ({findings_sql(f"({_N})", "doc_id", "text")}) SELECT pii_type, count(*) AS n FROM f GROUP BY pii_type
""")
def pii_counts_by_type(spark, sf_dir):
    return privacy.pii_summary(find_pii(spark, sf_dir))


# Conversations whose speakers give contacts.
CHATS = """
SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 5 = 0 THEN text || ' Mail to ask.' || cast(conv_id AS string) || '@example.com'
                           WHEN (conv_id + turn) % 5 = 1 THEN 'Card ending in 41' || lpad(cast(conv_id % 100 AS string), 2, '0') || '. ' || text
                           WHEN (conv_id + turn) % 5 = 2 THEN text || ' call 555-010-' || lpad(cast(conv_id % 10000 AS string), 4, '0')
                           ELSE text END AS text
FROM {conversations}
"""


@query("find_pii_conversations", f"""
SELECT conv_id, turn, f.pii_type AS pii_type, f."match" AS "match" FROM (
  SELECT conv_id, turn, unnest({_found("text")}) AS f FROM ({plain(CHATS)}))
""")
def find_pii_conversations(spark, sf_dir):
    found = evaluated_once(run_sql(spark, sf_dir, CHATS), "found", pii.find_pii(F.col("text")))
    return found.select("conv_id", "turn", F.inline("found"))


@query("redact_value", f"""
WITH f AS ({findings_sql(f"({_N})", "doc_id", "text")})
SELECT doc_id, position, '[REDACTED_' || upper(pii_type) || ']' AS tag FROM f
""")
def redact_value(spark, sf_dir):
    return find_pii(spark, sf_dir).select("doc_id", "position", pii.redaction_tag(F.col("pii_type")).alias("tag"))


@query("redact_text", f"SELECT doc_id, {_redacted('text')} AS text FROM ({_N})")
def redact_text(spark, sf_dir):
    return run_sql(spark, sf_dir, NOTES).withColumn("text", pii.redact_text(F.col("text")))


@query("formula_injection", f"""
WITH v AS ({_V})
SELECT _row_id, 'value' AS "column", trim(value) AS value FROM v WHERE regexp_matches(trim(value), '^[=@]|^[+-]([^0-9]|$)')
""")
def formula_injection(spark, sf_dir):
    return privacy.formula_injection(run_sql(spark, sf_dir, VALUES))


@query("looks_numeric", f"""
WITH v AS ({_V}), c AS (SELECT *, trim(translate(value, ',$%', '')) AS s FROM v)
SELECT _row_id, value, regexp_matches(s, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?$') AS numeric FROM c
UNION ALL SELECT -1 - l_orderkey, cast(l_extendedprice AS string), true FROM lineitem
""")
def looks_numeric(spark, sf_dir):
    prices = table(spark, sf_dir, "lineitem").select(
        (F.lit(-1) - F.col("l_orderkey")).alias("_row_id"), F.col("l_extendedprice").cast("string").alias("value")
    )
    values = run_sql(spark, sf_dir, VALUES).unionByName(prices)
    return values.withColumn("numeric", text.looks_numeric(F.col("value")))


@query("pii_summary", f"""
WITH f AS ({findings_sql(f"({_N})", "doc_id", "text")}), c AS (SELECT pii_type, count(*) AS n FROM f GROUP BY pii_type)
SELECT coalesce(sum(n), 0) = 0 AS is_safe, coalesce(sum(n), 0)::bigint AS findings,
       CASE WHEN coalesce(sum(n), 0) = 0 THEN 'Safe (no PII detected)' ELSE
       'Unsafe (' || sum(n)::bigint || ' findings — ' || string_agg(pii_type || ':' || n, ', ' ORDER BY pii_type) || ')' END AS summary
FROM c
""")
def pii_summary(spark, sf_dir):
    return privacy.safety_summary(find_pii(spark, sf_dir))


SHARED = contract_from_dict({
    "dataset": {"name": "documents"},
    "fields": [
        {"name": "id", "source_column": "doc_id", "type": "identifier", "dtype": "Int64"},
        {"name": "body", "source_column": "text", "type": "text", "dtype": "string"},
        {"name": "lang", "type": "categorical", "dtype": "string"},
        {"name": "origin", "source_column": "source", "type": "categorical", "dtype": "string", "shareable": False},
    ],
})


@query("share_safe_table", f"SELECT doc_id AS id, {_redacted('text')} AS body, lang FROM (SELECT n.*, d.lang FROM ({_N}) n JOIN documents d USING (doc_id))")
def share_safe_table(spark, sf_dir):
    notes = run_sql(spark, sf_dir, NOTES.replace("AS text", "AS text, lang, source"))
    return privacy.share_safe_table(notes, SHARED)


def _dictionaries(spark, sf_dir):
    """One dictionary entry per document: its text as notes, its words of origin as enumerated values."""
    return run_sql(spark, sf_dir, NOTES.replace("AS text", "AS notes, lang, source")).select(
        F.lit("documents").alias("dataset"), F.col("doc_id").cast("int").alias("position"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("field_name"),
        F.col("source").alias("source_column"), "notes",
        F.when(F.col("lang") == "es", F.lit("see x@example.org")).otherwise("").alias("community_notes"),
        (F.col("source") != "src0").alias("shareable"),
        F.array(F.lit("plain"), F.when(F.col("lang") == "fr", F.lit("contact jane@example.com")).otherwise("***218")).alias("allowed_values"),
        F.lit(2).alias("value_count"),
    )


_D = f"SELECT n.doc_id, n.text, d.lang, d.source FROM ({_N}) n JOIN documents d USING (doc_id) WHERE d.source <> 'src0'"


@query("dictionary_pii_scan", f"""
WITH d AS ({_D}), f AS (SELECT doc_id, unnest({_found("text")}) AS f FROM d)
SELECT 'documents' AS dataset, 'field.doc_' || doc_id || '.notes' AS location, f.pii_type AS pii_type, f."match" AS value FROM f
UNION ALL SELECT 'documents', 'field.doc_' || doc_id || '.community_notes', 'email', 'x@example.org' FROM d WHERE lang = 'es'
UNION ALL SELECT 'documents', 'field.doc_' || doc_id || '.allowed_values', CASE lang WHEN 'fr' THEN 'email' ELSE 'partial_account' END,
       CASE lang WHEN 'fr' THEN 'jane@example.com' ELSE '***218' END FROM d
""")
def dictionary_pii_scan(spark, sf_dir):
    return privacy.dictionary_pii_scan(_dictionaries(spark, sf_dir))


@query("share_safe_dictionary", f"""
WITH d AS ({_D})
SELECT 'field.doc_' || doc_id AS field, '2 unique values (redacted for community safety). ' ||
       CASE WHEN lang = 'es' THEN 'see x@example.org' ELSE {_redacted("text")} END AS notes FROM d
""")
def share_safe_dictionary(spark, sf_dir):
    out = privacy.share_safe_dictionary(_dictionaries(spark, sf_dir))
    return out.select(F.concat(F.lit("field."), "field_name").alias("field"), "notes")
