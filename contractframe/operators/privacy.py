"""Personal data and unsafe cells in tables, dictionaries and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.contract import Contract
from contractframe.functions.pii import classify_pii, find_pii, masked, pii_in_values, redact_text
from contractframe.functions.text import is_formula, strip_text
from contractframe.sources import firstbytes, textfiles
from contractframe.storage import ROW_ID, evaluated_once, named

FINDINGS = "location string, pii_type string, value string"


def find_in_column(df: DataFrame, key: str, column: str) -> DataFrame:
    """Every personal-data substring of a text column: (key, position, pii_type, match)."""
    found = evaluated_once(df.select(key, named(column).alias("_text")), "_found", find_pii(F.col("_text")))
    return found.select(key, F.posexplode("_found").alias("position", "f")).select(
        key, "position", F.col("f.pii_type").alias("pii_type"), F.col("f.match").alias("match")
    )


def pii_summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("pii_type").agg(F.count("*").alias("n"))


def safety_summary(findings: DataFrame) -> DataFrame:
    """One row: is the table safe, how many findings, and a line naming them by type."""
    per_type = pii_summary(findings)  # one row per class
    one = per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("findings"),
        F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "pii_type", F.col("n").cast("string")))), ", ").alias("parts"),
    )
    return one.select(
        (F.col("findings") == 0).alias("is_safe"),
        "findings",
        F.when(F.col("findings") == 0, F.lit("Safe (no PII detected)"))
        .otherwise(F.concat(F.lit("Unsafe ("), F.col("findings").cast("string"), F.lit(" findings — "), F.col("parts"), F.lit(")")))
        .alias("summary"),
    )


def formula_injection(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cells a spreadsheet would run: (row, column, value). Reads the table once; only hits are expanded."""
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    hits = F.filter(
        F.array(
            *[
                F.when(is_formula(named(c)), F.struct(F.lit(c).alias("column"), strip_text(named(c)).alias("value")))
                for c in columns
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return evaluated_once(df, "_hits", hits).select(F.col(ROW_ID), F.inline("_hits"))


# -- dictionaries -------------------------------------------------------------------


def dictionary_frame(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """The fields of many dictionaries as one table, for scanning and sharing."""
    rows = [
        (
            c.dataset_name, i, f.name, f.source_column, f.notes, f.community_notes, bool(f.shareable),
            [v for v in f.allowed_values if isinstance(v, str)] if f.allowed_values else None,
            len(f.allowed_values) if f.allowed_values else 0,
        )
        for c in contracts
        for i, f in enumerate(c.fields)
    ]
    return spark.createDataFrame(
        rows,
        "dataset string, position int, field_name string, source_column string, notes string, community_notes string, "
        "shareable boolean, allowed_values array<string>, value_count int",
    )


def _in_part(part: str):
    return lambda x: F.struct(
        F.lit(part).alias("part"), x["pii_type"].alias("pii_type"), x["match"].alias("value")
    )


def _in_dictionary():
    """Findings in the notes and enumerated values of a dictionary row."""
    whole = lambda v: F.struct(classify_pii(v).alias("pii_type"), v.alias("match"))
    in_values = F.flatten(
        F.transform(
            F.coalesce("allowed_values", F.array().cast("array<string>")),
            lambda v: F.when(classify_pii(v).isNotNull(), F.array(whole(v))).otherwise(find_pii(v)),
        )
    )
    parts = (("notes", find_pii(F.col("notes"))), ("community_notes", find_pii(F.col("community_notes"))), ("allowed_values", in_values))
    return F.concat(*[F.transform(found, _in_part(part)) for part, found in parts])


def dictionary_pii_scan(fields: DataFrame) -> DataFrame:
    """Personal data in notes and enumerated values of shareable fields: (dataset, location, pii_type, value)."""
    return (
        evaluated_once(fields.where("shareable"), "_found", _in_dictionary())
        .select("dataset", "field_name", F.inline("_found"))
        .select("dataset", F.concat_ws(".", F.lit("field"), "field_name", "part").alias("location"), "pii_type", "value")
    )


def share_safe_dictionary(fields: DataFrame) -> DataFrame:
    """The dictionary as it may be shared: unshareable fields gone, notes and values scrubbed, source names cleared."""
    notes = F.when(F.coalesce(F.col("community_notes"), F.lit("")) != "", F.col("community_notes")).otherwise(
        redact_text(F.col("notes"))
    )
    unsafe = pii_in_values(F.col("allowed_values"))
    count = F.concat(F.col("value_count").cast("string"), F.lit(" unique values (redacted for community safety). "))
    return fields.where("shareable").select(
        "dataset", "position", "field_name",
        F.lit(None).cast("string").alias("source_column"),
        F.when(unsafe, strip_text(F.concat(count, F.coalesce(notes, F.lit(""))))).otherwise(notes).alias("notes"),
        F.when(~unsafe, F.col("allowed_values")).alias("allowed_values"),
    )


def share_safe_table(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows as they may be shared: shareable fields under contract names, free text redacted."""
    df = df.withColumnsRenamed(contract.names().renames)
    out = []
    for f in contract.fields:
        if not f.shareable or f.name not in df.columns:
            continue
        text = f.type == "text" and isinstance(df.schema[f.name].dataType, T.StringType)
        out.append((redact_text(named(f.name)) if text else named(f.name)).alias(f.name))
    return df.select(*out)


# -- files --------------------------------------------------------------------------


def scan_text_files(spark: SparkSession, root: str, glob: str = "*.{md,yaml,yml}") -> DataFrame:
    """Personal data in all text files under a folder: (location, pii_type, preview), values masked.

    Files are read in pieces cut where no finding can go on, so a file may have any
    length.  A YAML file that is a contract is scanned as a dictionary: its notes and
    enumerated values, without fields that may not be shared; any other as text.
    """
    if firstbytes.can_open([root]):
        rows = textfiles.text_pieces(spark, root, glob)
    else:  # a file system for Spark alone: a file is one row, and contracts are texts
        texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True)
        rows = texts.selectExpr(
            "_metadata.file_path AS file", "lower(_metadata.file_path) RLIKE '[.]ya?ml$' AS yaml", "value", "CAST(NULL AS string) AS field_name",
            "CAST(NULL AS string) AS notes", "CAST(NULL AS string) AS community_notes", "CAST(NULL AS boolean) AS shareable",
            "CAST(NULL AS array<string>) AS allowed_values", "CAST(NULL AS string) AS dataset",
        )
    field = F.col("field_name").isNotNull()
    found = F.when(field, F.when(F.col("shareable"), _in_dictionary())).otherwise(
        F.transform(find_pii(F.col("value")), _in_part("freetext"))
    )
    place = F.when(field, F.concat_ws(".", F.lit("field"), "field_name", "part")).when(F.col("yaml"), F.col("part"))
    found = evaluated_once(rows, "_found", found).select("file", "yaml", "field_name", F.inline("_found"))
    return found.select(F.concat_ws(":", "file", place).alias("location"), "pii_type", masked(F.col("value")).alias("preview"))
