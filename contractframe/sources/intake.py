"""Intake of delimited files: encoding, header rows, schema groups, raw landing, manifest.

Files of any number of schemas are read once, line by line, into one Parquet landing partitioned by schema. A line
carries its file, the block of it that its task read, and its place there; and what it does to a quote that may be open
(``quotes``), so that blocks are read by different tasks although cells may hold line breaks. Everything that decides
about rows is then a small table of blocks: which lines begin records, where a block's rows stand in their table, how
the file is encoded. Nothing about files, blocks or rows comes to the driver but one row per schema.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.functions.text import CASTABLE_INTEGER, CASTABLE_NUMBER, looks_numeric, strip_text
from contractframe.sources import firstbytes, quotes
from contractframe.storage import ROW_ID, materialize, named, scratch_path, stored_bytes

HEADER_SCAN = 10
SAMPLE_ROWS = 50
_BYTES = "iso-8859-1"
#: Stored bytes up to which tables of files and of blocks are broadcast; beyond, Spark joins them as it sees fit.
SMALL = 128 << 20

# File suffixes and their separators.
SEPARATORS = {".csv": ",", ".tsv": "\t", ".tab": "\t"}

# Cell texts that a table reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def separator_of(path: str) -> str:
    for suffix, sep in SEPARATORS.items():
        if path.lower().endswith(suffix):
            return sep
    raise ValueError(f"unsupported file {path!r}; supported: {sorted(SEPARATORS)}")


def _small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it is small."""
    return F.broadcast(df) if stored_bytes(df) <= SMALL else df


# -- what the files look like -----------------------------------------------------


def raw_lines(spark: SparkSession, paths: list[str], codec: str | None = None) -> DataFrame:
    """(file, block, pos, value): lines as their bytes, in splittable blocks; ``pos`` counts in a block without gaps.

    With a 16-bit ``codec`` lines end where that has its line feed.
    """
    reader = spark.read.option("lineSep", "\n")
    if codec:
        reader = reader.option("encoding", codec)
    return reader.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("pos"),
        "value",
    )


def file_encoding(spark: SparkSession, paths: list[str], fallback: str = "iso-8859-1") -> DataFrame:
    """(file, has_bom, is_utf8, encoding) per file that is not empty.

    A line is valid UTF-8 on its own when the file is, so validity is a plain
    aggregate over lines.  Byte-order marks are read from the first bytes, inflated
    where the file is compressed; null where its codec can't be read that way.
    """
    marks = _marks(spark, paths)
    lines = raw_lines(spark, paths).groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"))
    wide = F.coalesce(F.startswith("mark", F.lit("utf-16")), F.lit(False))
    return lines.join(marks, "file").select(
        "file",
        F.when(F.col("known"), F.col("mark").isNotNull()).alias("has_bom"),
        (F.col("is_utf8") & ~wide).alias("is_utf8"),
        F.when(wide, "utf-16").when(F.col("mark").isNotNull(), F.col("mark")).when(F.col("is_utf8"), "utf-8").otherwise(fallback).alias("encoding"),
    )


def _marks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, known, mark) of every file that has a line."""
    if firstbytes.can_open(paths):
        return firstbytes.heads(spark, paths, ",", 1, None, _BYTES).select("file", F.lit(True).alias("known"), "mark")
    first = F.upper(F.hex(F.substring(F.col("value").cast("binary"), 1, 2)))
    mark = F.when(first == "FFFE", "utf-16-le").when(first == "FEFF", "utf-16-be")
    heads = raw_lines(spark, paths).groupBy("file").agg(F.min_by(mark, F.struct("block", "pos")).alias("mark"))
    return heads.select("file", F.col("mark").isNotNull().alias("known"), "mark")  # the reader drops the mark of UTF-8


def head_lines(
    spark: SparkSession, paths: list[str], n: int = HEADER_SCAN, fallback: str = "iso-8859-1", records: bool = False, sep: str | None = None
) -> DataFrame:
    """The first n lines of every file, or all lines of its first n records that are not blank.

    (file, mark, ordinal, line, begins, blank, cells): decoded; a line that is not
    UTF-8 is read as ``fallback``.  ``begins`` tells whether a record begins with
    the line, ``cells`` are those of that record.  Only the first bytes of a file
    are read, unless its file system is open to Spark alone: then all its lines
    are, each task keeps n per file, and no cell may hold a line break.
    """
    if firstbytes.can_open(paths):
        return firstbytes.heads(spark, paths, sep, None if records else n, n if records else None, fallback)
    order = Window.partitionBy("file").orderBy("block", "pos")
    line = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), fallback))
    lines = raw_lines(spark, paths).select("file", "block", "pos", F.regexp_replace(line, r"\r$", "").alias("line"))
    lines = lines.withColumn("blank", strip_text(F.col("line")) == "")
    if records:
        lines = lines.where(~F.col("blank"))
    kept = lines.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n)
    by_suffix = F.lit(sep) if sep else F.when(F.lower("file").rlike(r"\.(tsv|tab)$"), "\t").otherwise(",")
    return kept.select(
        "file", F.lit(None).cast("string").alias("mark"), (F.col("_n") - 1).alias("ordinal"), "line",
        F.lit(True).alias("begins"), "blank", split_cells(F.col("line"), by_suffix).alias("cells"),
    )


def split_cells(line: Column, sep: Column) -> Column:
    """Cells of one delimited line; separators inside double quotes do not count."""
    quoted = F.concat(sep, F.lit('(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    return F.transform(
        F.split(line, quoted),
        lambda c: F.when(
            c.rlike('(?s)^".*"$'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )


def header_rows(
    spark: SparkSession,
    paths: list[str],
    max_scan: int = HEADER_SCAN,
    header_row: int | None = None,
    sep: str | None = None,
) -> DataFrame:
    """Where each file's header is: (file, header_row, header_skip, cells, columns, mark).

    The guess is the first of ``max_scan`` lines with more than one non-empty
    cell that is not mostly numbers; row 0 when there is none.  ``header_skip``
    counts records that are not blank, as a table reader does; a given ``header_row``
    already counts that way, and files with fewer records have no row here.
    ``cells`` is the whole header, ``columns`` its non-empty names.  Empty files
    have no line and hence no row here.
    """
    if header_row is None:
        lines = head_lines(spark, paths, max_scan, sep=sep)
    else:
        lines = head_lines(spark, paths, header_row + 1, records=True, sep=sep)
    filled = F.filter("cells", lambda c: strip_text(c) != "")
    numeric = F.size(F.filter("filled", lambda c: looks_numeric(strip_text(c))))
    n = F.size("filled")
    parsed = lines.withColumn("filled", filled).withColumn("likely", (n > 1) & ~((n > 2) & (numeric / n > 0.6)))
    # At most max_scan rows, or the lines of header_row + 1 records, per file from here on.
    before = Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    counts = F.col("begins") & ~F.col("blank")
    parsed = parsed.withColumn("skip", F.coalesce(F.sum(counts.cast("int")).over(before), F.lit(0)))
    pick = (F.col("likely") if header_row is None else (F.col("skip") == header_row)) & counts
    found = parsed.groupBy("file").agg(
        F.min(F.when(pick, F.struct("ordinal", "skip", "cells"))).alias("hit"),
        F.min(F.struct("ordinal", "skip", "cells")).alias("top"),
        F.min("mark").alias("mark"),
    )
    if header_row is not None:
        found = found.where("hit IS NOT NULL")
    best = F.coalesce("hit", "top")
    names = F.transform(
        F.filter(best["cells"], lambda c: strip_text(c) != ""), lambda c: F.btrim(strip_text(c), F.lit('"'))
    )
    return found.select(
        "file",
        best["ordinal"].cast("int").alias("header_row"),
        best["skip"].cast("int").alias("header_skip"),
        best["cells"].alias("cells"),
        names.alias("columns"),
        "mark",
    )


def file_groups(headers: DataFrame) -> DataFrame:
    """(file, group_index, columns): every file with its group; groups count by their first file."""
    groups = schema_groups(headers)
    return headers.select("file", "columns").join(groups.select("columns", "group_index"), "columns").select("file", "group_index", "columns")


def schema_groups(headers: DataFrame) -> DataFrame:
    """Groups of files by their column names in order: (group_index, columns, first_file, file_count)."""
    groups = headers.groupBy("columns").agg(F.min("file").alias("first_file"), F.count("*").alias("file_count"))
    order = Window.orderBy("first_file")  # one row per distinct schema
    return groups.select((F.row_number().over(order) - 1).alias("group_index"), "columns", "first_file", "file_count")


# -- reading ----------------------------------------------------------------------


@dataclass
class Intake:
    """A table taken in: typed rows with ``_row_id``, and how it was read."""

    table: DataFrame
    landed_path: str
    params: dict = field(default_factory=dict)
    ragged: DataFrame | None = None  # rows with more cells than the header: row id, file, text
    total_rows: int = 0


def column_names(cells: list[str]) -> list[str]:
    """Header cells as unique column names."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, cell in enumerate(cells):
        name = cell if cell.strip() else f"Unnamed: {i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


# A schema as it is landed: its files, and where their rows stand.
@dataclass
class _Schema:
    key: str
    sep: str
    cells: list[str]
    columns: list[str]
    first_file: str
    file_count: int
    group_index: int = 0


@dataclass
class Landing:
    """Files of any schemas as one stored table of lines, and the tables that say which rows they make."""

    path: str
    lines: DataFrame  # schema, file, block, pos, value, blank and what it does to an open quote
    blocks: DataFrame  # per file and block: where its rows stand
    special: DataFrame | None  # lines of blocks that are not one record per line, with their records
    schemas: list[_Schema]
    encoding: str | None


def land(
    spark: SparkSession,
    paths: list[str],
    header_row: int | str = 0,
    sep: str | None = None,
    encoding: str | None = None,
    nrows: int | None = None,
    path: str | None = None,
) -> Landing:
    """Read all lines of all files once; the number of jobs depends on neither files nor schemas."""
    path, auto = path or scratch_path(spark, "landed"), header_row == "auto"
    by_suffix = F.lit(sep) if sep else F.when(F.lower("file").rlike(r"\.(tsv|tab)$"), "\t").otherwise(",")
    heads = header_rows(spark, paths, header_row=None if auto else int(header_row), sep=sep)
    heads = heads.withColumn("sep", by_suffix)
    # The key of a schema tells its separator and width: one job can parse all rows of a separator.
    key = F.concat_ws("-", F.hex("sep"), F.size("cells").cast("string"), F.sha2(F.to_json("columns"), 256))
    heads = materialize(heads.withColumn("schema", key), "heads")
    groups = heads.groupBy("schema", "sep", "columns").agg(
        F.min("cells").alias("cells"), F.max("cells").alias("other"), F.min("file").alias("first"),
        F.max_by("file", "cells").alias("last"), F.count("*").alias("n"),
        F.max(F.startswith("mark", F.lit("utf-16"))).alias("wide"),
    )
    found = groups.orderBy("first").collect()  # one row per schema
    for g in found:
        if g["cells"] != g["other"]:
            raise ValueError(f"files differ in their header: {g['last']}")
    schemas = [
        _Schema(g["schema"], g["sep"], list(g["cells"]), list(g["columns"]), g["first"], g["n"], i) for i, g in enumerate(found)
    ]

    if not schemas:
        return Landing(path, heads, heads, None, [], encoding)
    if nrows is not None:
        if not firstbytes.can_open(paths):
            raise ValueError("a row cap needs a file system that tasks can open")
        lines = firstbytes.capped_lines(spark, paths, sep or ",", nrows + (HEADER_SCAN if auto else int(header_row)) + 1)
    else:
        lines = _decoded_lines(spark, paths, encoding, heads if any(g["wide"] for g in found) else None)
    lines = lines.join(_small(heads.select("file", "schema", "sep")), "file")
    # What separates nothing is blank; with tabs as separators a tab is no blank.
    trimmed = F.when(F.col("sep") == "\t", F.btrim("value", F.lit(" \r\x0b\x0c"))).otherwise(F.btrim("value", F.lit(" \t\r\x0b\x0c")))
    lines = quotes.with_functions(lines, "sep").select(
        "schema", "file", "block", "pos", "value", "out", "into", (trimmed == "").alias("blank"), F.is_valid_utf8("value").alias("utf8")
    )
    lines.write.mode("overwrite").partitionBy("schema").parquet(path)
    lines = spark.read.schema(lines.select("file", "block", "pos", "value", "out", "into", "blank", "utf8", "schema").schema).parquet(path)
    return _placed(spark, lines, heads, Landing(path, lines, lines, None, schemas, encoding), nrows)


def _decoded_lines(spark: SparkSession, paths: list[str], encoding: str | None, heads: DataFrame | None) -> DataFrame:
    """All lines; those of 16-bit files, and all if an encoding is given, decoded."""
    if encoding:
        codec = encoding.lower().replace("_", "-")
        wide = codec.startswith("utf-16")
        codec = "utf-16-le" if codec == "utf-16" else codec
        lines = raw_lines(spark, paths, codec.replace("16-", "16") if wide else None)
        return lines.withColumn("value", F.decode(F.col("value").cast("binary"), codec.replace("16-", "16")))
    if heads is None:
        return raw_lines(spark, paths)
    marked = heads.where("mark LIKE 'utf-16%'").groupBy("mark").agg(F.collect_list("file").alias("files")).collect()  # names of 16-bit files
    lines = raw_lines(spark, paths)
    lines = lines.where(~F.col("file").isin([f for m in marked for f in m["files"]]))
    for m in marked:
        codec = m["mark"].replace("16-", "16")
        wide = raw_lines(spark, list(m["files"]), codec)
        text = F.decode(F.col("value").cast("binary"), codec)
        lines = lines.unionByName(wide.withColumn("value", F.ltrim(text, F.lit("\ufeff"))))
    return lines


def _placed(spark: SparkSession, lines: DataFrame, heads: DataFrame, landing: Landing, nrows: int | None) -> Landing:
    """Tell where the rows of each block stand in their table."""
    in_file = Window.partitionBy("file").orderBy("block", "chunk")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    chunks = quotes.chunk_functions(lines, F.count_if("blank").alias("n_blank"), F.bool_and("utf8").alias("utf8"))
    chunks = quotes.with_states(chunks, ["file"], ["block", "chunk"])
    # A block is special if a cell goes on over a line's end in it, or if a line is blank.
    odd = F.max(F.col("inside") | F.col("opens") | (F.col("n_blank") > 0)).over(Window.partitionBy("file", "block"))
    ends = F.when(F.col("inside"), F.col("into")).otherwise(F.col("out"))
    chunks = chunks.withColumn("special", odd).withColumn("ends_inside", ends)
    plain = _block_places(chunks.withColumn("n_records", F.col("n_lines")), heads, nrows)
    landing.blocks = materialize(_blocks(plain), "blocks")
    state = landing.blocks.agg(F.min(F.when(F.col("open"), F.col("file"))).alias("open"), F.max("special").alias("special")).first()
    if state["special"] is None:
        raise ValueError("no rows to read")
    if state["open"] and nrows is None:
        raise ValueError(f"a quote stays open in {state['open']}")
    if not state["special"]:
        return landing

    # The state before each line of the special blocks, then the records that begin there.
    at = ["file", "block", "chunk"]
    chunks = materialize(chunks, "chunks")
    mine = lines.select(*lines.columns, F.expr(f"pos div {quotes.CHUNK}").alias("chunk")).join(
        _small(materialize(chunks.where("special").select(*at, F.col("inside").alias("begun")), "special-chunks")), at
    )
    mine = quotes.with_states(mine, at, ["pos"], F.col("begun")).where("inside OR NOT blank")
    running = Window.partitionBy(*at).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    mine = mine.withColumn("record", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(running))
    special = materialize(mine.select("schema", *at, "pos", "value", "record"), "special-lines")
    counted = special.groupBy(*at).agg(F.max("record").alias("n_begun"))
    n_records = F.when(F.col("special"), F.coalesce("n_begun", F.lit(0))).otherwise(F.col("n_lines"))
    chunks = chunks.join(counted, at, "left").withColumn("n_records", n_records)
    # A record that goes on in later chunks is known by the chunk it begins in.
    latest = F.last(F.when(F.col("n_records") > 0, F.struct("block", "chunk", F.col("n_records").alias("record"))), ignorenulls=True)
    where = materialize(_block_places(chunks.withColumn("carried", latest.over(before)), heads, nrows), "places")
    landing.blocks = materialize(_blocks(where), "blocks")
    places = where.where("special").select("file", "block", "chunk", "skip", "offset", "file_utf8", "last", "ordinal", "carried")
    places = materialize(places, "special-places")
    keys = special.join(_small(places).select("file", "block", "chunk", "carried"), at)
    key = F.when(F.col("record") > 0, F.struct("block", "chunk", "record")).otherwise(F.col("carried"))
    whole = keys.withColumn("key", key).groupBy("schema", "file", "key").agg(
        F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("parts")
    )
    whole = whole.select("schema", "file", "key.*", F.array_join("parts.value", "\n").alias("value"))
    landing.special = whole.join(_small(places).drop("carried"), at).withColumn("nth", F.col("ordinal") + F.col("record") - 1)
    return landing


def _block_places(chunks: DataFrame, heads: DataFrame, nrows: int | None) -> DataFrame:
    """Chunks with the number of their first record in the file, and where the file's rows begin in the table."""
    before = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("ordinal", F.coalesce(F.sum("n_records").over(before), F.lit(0)))
    rows = F.greatest(F.lit(0), F.sum("n_records") - F.first("header_skip") - 1)
    files = chunks.join(_small(heads.select("file", "header_skip", "schema")), "file").groupBy("schema", "file").agg(
        (F.least(rows, F.lit(nrows)) if nrows is not None else rows).alias("rows"),
        F.bool_and("utf8").alias("file_utf8"), F.first("header_skip").alias("skip"),
        F.max_by("ends_inside", F.struct("block", "chunk")).alias("open"),
    )
    earlier = Window.partitionBy("schema").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows", "schema")
    return chunks.join(files, "file").withColumn("last", F.lit(nrows if nrows is not None else 1 << 62))


def _blocks(places: DataFrame) -> DataFrame:
    same = ["skip", "offset", "file_utf8", "last", "open", "special"]
    firsts = [F.first(c).alias(c) for c in same]
    return places.groupBy("file", "block").agg(*firsts, F.min("first").alias("first"), F.min("ordinal").alias("ordinal"))


def _records(landing: Landing, mine: Column) -> DataFrame:
    """(_row_id, file, schema, file_utf8, value): the rows of some schemas as text."""
    columns = ["schema", "file", "nth", "skip", "offset", "last", "file_utf8", "value"]
    blocks = landing.blocks.where("NOT special") if landing.special is not None else landing.blocks
    plain = landing.lines.where(mine).select("schema", "file", "block", "pos", "value").join(_small_blocks(landing, blocks), ["file", "block"])
    rows = plain.withColumn("nth", F.col("ordinal") + F.col("pos") - F.col("first")).select(columns)
    if landing.special is not None:
        rows = rows.unionByName(landing.special.where(mine).select(columns))
    text = "CASE WHEN endswith(value, '\\r') THEN left(value, char_length(value) - 1) ELSE value END"
    if not landing.encoding:
        # Lines hold bytes; what is not UTF-8 anywhere in its file is one byte a character.
        raw = "CASE WHEN endswith(value, '\\r') THEN substring(binary(value), 1, octet_length(value) - 1) ELSE binary(value) END"
        text = f"CASE WHEN file_utf8 THEN {text} ELSE decode({raw}, '{_BYTES}') END"
    kept = rows.where("nth > skip AND nth - skip - 1 < last")
    return kept.selectExpr(f"offset + nth - skip - 1 AS {ROW_ID}", "file", "schema", "file_utf8", f"{text} AS value")


def _small_blocks(landing: Landing, blocks: DataFrame) -> DataFrame:
    return F.broadcast(blocks) if stored_bytes(landing.blocks) <= SMALL else blocks


def _cells(landing: Landing, mine: Column, sep: str, width: int) -> DataFrame:
    """(_row_id, file, schema, file_utf8, value, cells, extra): rows cut into cells, and whether there are more than the header has."""
    layout = ", ".join([*(f"c{i} STRING" for i in range(width)), "_malformed STRING"])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    records = _records(landing, mine).select("*", F.from_csv("value", layout, options).alias("cells"))
    wider = f"cells._malformed IS NOT NULL AND {quotes.count_cells('value', _literal(sep))} > int(split_part(schema, '-', 2))"
    return records.withColumn("extra", F.expr(wider))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _shown(rows: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """The cells under these names; texts that stand for a missing value are nulls."""
    missing = ", ".join(f"'{t}'" for t in MISSING_TEXTS)
    cells = [F.expr(f"CASE WHEN cells.c{i} NOT IN ({missing}) THEN cells.c{i} END").alias(n) for i, n in enumerate(names)]
    return rows.select(*keep, *cells)


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    header_row: int | str = 0,
    nrows: int | None = None,
    encoding: str | None = None,
    infer: bool = True,
    landed_path: str | None = None,
    sep: str | None = None,
    ragged: str = "fail",
) -> Intake:
    """Read delimited files of one schema as a single table, files in name order.

    ``header_row`` counts records that are not blank, or ``"auto"`` guesses it per
    file.  ``nrows`` caps each file and reads no further than that takes.  Cells may
    hold line breaks inside quotes; a quote elsewhere than at a cell's beginning is
    text.  A quote that stays open is an error.  So is a row with more cells than the
    header, unless ``ragged="split"`` sets such rows aside in ``Intake.ragged``;
    missing cells at the end of a row are nulls.  Files that are not UTF-8 are read
    as ISO-8859-1, those with a 16-bit byte-order mark by that, all by ``encoding``
    if given; bytes that do not fit a given encoding are an error.
    """
    if ragged not in ("fail", "split"):
        raise ValueError(f"ragged must be 'fail' or 'split', not {ragged!r}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if sep is None:
        found = {separator_of(p) for p in paths}
        if len(found) > 1:
            raise ValueError("files of one table must share their separator")
        sep = found.pop()
    landing = land(spark, paths, header_row, sep, encoding, nrows, landed_path)
    if not landing.schemas:
        raise ValueError("no rows to read" if header_row == "auto" else f"no file has a header row {header_row}")
    if len(landing.schemas) > 1:
        raise ValueError(f"files differ in their header: {landing.schemas[1].first_file}")
    return next(iter(_intakes(landing, landing.schemas, infer, ragged, {"header": header_row, "nrows": nrows}).values()))


def _intakes(landing: Landing, schemas: list[_Schema], infer: bool, ragged: str, params: dict) -> dict[int, Intake]:
    """The tables of these schemas; one aggregate per separator tells all their types and the first row that is too wide."""
    told = None
    for sep in {s.sep for s in schemas}:
        names = [f"c{i}" for i in range(max(len(s.cells) for s in schemas if s.sep == sep))]
        cells = _cells(landing, F.startswith("schema", F.lit(sep.encode().hex().upper() + "-")), sep, len(names))
        cells = cells if ragged == "fail" else cells.where("NOT extra")
        row = F.expr(f"CASE WHEN extra THEN struct({ROW_ID}, file, left(value, 200) AS row) END").alias("extra")
        rows = _shown(cells, names if infer else [], "schema", "file_utf8", row)
        one = rows.groupBy("schema").agg(
            F.expr(f"array({', '.join(f'to_json({_type_flags(n)})' for n in names) if infer else ''})").alias("flags"),
            F.min("extra").alias("extra"), F.count("*").alias("total"), F.collect_set("file_utf8").alias("utf8"),
        )
        told = one if told is None else told.unionByName(one)
    answers = {r["schema"]: r for r in told.collect()}  # one row per schema
    out: dict[int, Intake] = {}
    for s in schemas:
        names = column_names([c.removeprefix("\ufeff") for c in s.cells])
        answer = answers.get(s.key)
        if answer and answer["extra"] and ragged == "fail":
            e = answer["extra"]
            raise ValueError(f"row {e[ROW_ID]} of the table, in {e['file']}, has more cells than the header: {e['row']!r}")
        cells = _cells(landing, F.col("schema") == s.key, s.sep, len(s.cells))
        table = _shown(cells if ragged == "fail" else cells.where("NOT extra"), names, ROW_ID)
        if infer:
            table = _with_types(table, [json.loads(f) for f in answer["flags"]] if answer else [{"n": 0}] * len(names))
        codes = [landing.encoding] if landing.encoding else sorted("utf-8" if u else _BYTES for u in (answer["utf8"] if answer else []))
        aside = cells.where("extra").select(ROW_ID, "file", F.col("value").alias("row"))
        out[s.group_index] = Intake(table, landing.path, {"sep": s.sep, **params, "encodings": codes}, aside, answer["total"] if answer else 0)
    return out


def _type_flags(name: str) -> str:
    """SQL aggregates that tell the narrowest type of a text column: integer, double or boolean."""
    v = "`" + name.replace("`", "``") + "`"
    integer, number = (p.replace("\\", "\\\\") for p in (CASTABLE_INTEGER, CASTABLE_NUMBER))
    return f"""struct(
        bool_and({v} IS NULL OR ({v} RLIKE '{integer}' AND try_cast({v} AS bigint) IS NOT NULL)) AS i,
        bool_and({v} RLIKE '{number}') AS d,
        bool_and({v} IN ('True', 'False', 'TRUE', 'FALSE', 'true', 'false')) AS b,
        count({v}) AS n, count_if({v} IS NULL) AS z)"""


def _with_types(df: DataFrame, flags: list[dict]) -> DataFrame:
    casts = {}
    for c, got in zip([c for c in df.columns if c != ROW_ID], flags):
        if not got["n"]:
            casts[c] = named(c).cast("double")  # a column without values reads as numbers
        elif got.get("i") and not got["z"]:
            casts[c] = named(c).try_cast("bigint")
        elif got.get("i") or got.get("d"):
            casts[c] = named(c).try_cast("double")
        elif got.get("b") and not got["z"]:
            casts[c] = named(c).try_cast("boolean")
    return df.select(*[(casts[c] if c in casts else named(c)).alias(c) for c in df.columns])


def infer_types(df: DataFrame) -> DataFrame:
    """Give all-text columns the narrowest type all their values have: integer, double or boolean.

    One aggregate; five figures per column come back.
    """
    columns = [c for c in df.columns if c != ROW_ID and isinstance(df.schema[c].dataType, T.StringType)]
    if not columns:
        return df
    got = df.agg(*[F.expr(_type_flags(c)).alias(f"f{i}") for i, c in enumerate(columns)]).first()
    typed = _with_types(df.select(*[named(c) for c in columns]), [got[f"f{i}"].asDict() for i in range(len(columns))])
    types = dict(typed.dtypes)
    return df.select(*[named(c).try_cast(types[c]).alias(c) if types.get(c, "string") != "string" else named(c) for c in df.columns])


# -- after reading ----------------------------------------------------------------


def land_raw(df: DataFrame, path: str, ingested_at: str) -> None:
    """Append an immutable snapshot under its intake time."""
    df.withColumn("ingested_at", F.lit(ingested_at)).write.partitionBy("ingested_at").mode("append").parquet(path)


def read_raw(spark: SparkSession, path: str, ingested_at: str) -> DataFrame:
    """The snapshot of one intake time; other snapshots are not read."""
    return spark.read.parquet(path).where(F.col("ingested_at") == ingested_at).drop("ingested_at")


def intake_manifest(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row and column counts."""
    columns = [(n, t) for n, t in df.dtypes if n != ROW_ID]
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(columns)).cast("bigint").alias("column_count"),
        F.posexplode(F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("dtype")) for n, t in columns])).alias("position", "c"),
    ).select("row_count", "column_count", "position", "c.column", "c.dtype")


def first_rows_of(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first n rows by row id."""
    return df.orderBy(ROW_ID).limit(n)


# -- many files, many schemas -------------------------------------------------------


def bulk_intake(
    spark: SparkSession, paths: list[str], header_row: int | str = "auto", sep: str | None = None
) -> tuple[DataFrame, dict[int, Intake]]:
    """Group files by schema and read each group as one table.

    Returns the group report (group_index, columns, first_file, file_count,
    total_rows) and the tables by group index; ``profile_groups`` profiles them.
    All groups share one landing, and one job tells all their types: how many jobs
    run depends on neither the files nor the schemas.
    """
    landing = land(spark, paths, header_row, sep)
    schemas = [s for s in landing.schemas if s.columns]
    tables = _intakes(landing, schemas, True, "fail", {"header": header_row, "nrows": None}) if schemas else {}
    report = [(s.group_index, s.columns, s.first_file, s.file_count, tables[s.group_index].total_rows) for s in schemas]
    schema = "group_index int, columns array<string>, first_file string, file_count bigint, total_rows bigint"
    return spark.createDataFrame(report, schema), tables


def profile_groups(tables: dict[int, Intake]) -> DataFrame | None:
    """Profiles of all groups: one row per group and column."""
    from contractframe.operators.profile import profile_full

    found = None
    for index, got in tables.items():
        one = profile_full(got.table).withColumn("group_index", F.lit(index))
        found = one if found is None else found.unionByName(one)
    return found
