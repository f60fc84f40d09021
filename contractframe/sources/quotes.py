"""Where records begin in delimited text whose cells may hold line breaks inside quotes.

Between two characters a reader is in one of three states: outside quotes, inside a quoted cell, or right behind a
quote there, which closes the cell unless another quote follows. A quote opens a cell only where a cell begins; anywhere
else outside quotes it is text. At a line's end only two states are left, outside and inside, so what a line does is
a function on two states: a pair (state after it if it began outside, if inside). Such functions compose, hence
lines of a block can be judged without knowing how the block begins, blocks composed in their order, and then every
line's true state read off. Nearly all lines keep the state they find.

Nothing here leaves the JVM, but for ``Machine``, the same automaton for a stream of lines in a task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16  # lines of a block that are judged together


class Machine:
    """The automaton over a file's lines, one after the other."""

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        cell = rb'(?:"(?:[^"]|"")*+"(?:[^"%s][^%s]*+)?+|(?:[^"%s][^%s]*+)?+)' % (s, s, s, s)
        self.open = False
        self.whole = re.compile(rb"(?s)%s(?:%s%s)*+\Z" % (cell, s, cell))
        self.closing = re.compile(rb'(?s)(?:[^"]|"")*+"(?:[^"%s][^%s]*+)?+(?:%s%s)*+\Z' % (s, s, s, cell))

    def feed(self, line: bytes) -> None:
        if b'"' in line:
            self.open = not (self.closing if self.open else self.whole).match(line)


_HERE = """CASE WHEN acc.first THEN acc.state WHEN acc.state = 0 THEN if(acc.cell, 1, 0) WHEN acc.state = 1 THEN 2 ELSE 1 END"""
_STATE = f"CASE WHEN x <> '' AND {_HERE} = 2 THEN 0 ELSE {_HERE} END"


def _after(line: str, sep: str, inside: bool) -> str:
    """The automaton over one line, folded over what its quotes part: struct(state, cell, n).

    state 0 outside, 1 inside, 2 behind a quote inside; cell: a cell may begin here; n: separators outside quotes.
    ``line`` and ``sep`` are SQL.
    """
    return f"""aggregate(split({line}, '"', -1),
        named_struct('state', {int(inside)}, 'cell', {not inside}, 'n', 0, 'first', true),
        (acc, x) -> named_struct(
            'state', {_STATE},
            'cell', CASE WHEN x = '' THEN acc.first AND acc.cell ELSE ({_STATE}) = 0 AND endswith(x, {sep}) END,
            'n', acc.n + if(({_STATE}) = 0, length(x) - length(replace(x, {sep}, '')), 0),
            'first', false))"""


def ends_inside(line: str, sep: str, inside: bool) -> str:
    """Whether a quote is open behind the line, if it began outside or ``inside`` quotes."""
    return f"""CASE WHEN contains({line}, '"') THEN {_after(line, sep, inside)}.state = 1 ELSE {inside} END"""


def count_cells(record: str, sep: str) -> str:
    """Cells of a whole record; separators are one character."""
    return f"{_after(record, sep, False)}.n + 1"


def with_functions(lines: DataFrame, sep: str) -> DataFrame:
    """Lines with (out, into): the state after each, had it begun outside, or inside quotes; ``sep`` is SQL."""
    return lines.selectExpr("*", f"{ends_inside('value', sep, False)} AS out", f"{ends_inside('value', sep, True)} AS into")


def chunk_functions(lines: DataFrame, *counts: Column) -> DataFrame:
    """One row per (file, block, chunk): the composed function of its lines as (out, into), and further aggregates."""
    composed = """aggregate(
        array_sort(collect_list(CASE WHEN out OR NOT into THEN struct(pos, out, into) END)), named_struct('out', false, 'into', true),
        (acc, x) -> named_struct('out', if(acc.out, x.into, x.out), 'into', if(acc.into, x.into, x.out)))"""
    return lines.groupBy("file", "block", F.expr(f"pos div {CHUNK}").alias("chunk")).agg(
        F.expr(composed).alias("f"), F.bool_or("out").alias("opens"), F.min("pos").alias("first"), F.count("*").alias("n_lines"), *counts
    ).select("*", "f.*").drop("f")


def with_states(rows: DataFrame, keys: list[str], order: list[str], begins: Column | None = None) -> DataFrame:
    """Rows with ``inside``: the state before each, from the functions (out, into) of all rows before it.

    A prefix scan by windows: the state is that of the last row whose function is constant, turned once for
    every later row that swaps the two states. The first row of ``keys`` begins outside, or as ``begins`` says.
    """
    constant, swaps = F.col("out") == F.col("into"), F.col("out") & ~F.col("into")
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_swaps", F.coalesce(F.sum(swaps.cast("bigint")).over(before), F.lit(0)))
    # A constant row does not swap, so what it counted before it holds behind it as well.
    last = F.last(F.when(constant, F.struct(F.col("out").alias("state"), F.col("_swaps").alias("at"))), ignorenulls=True).over(before)
    rows = rows.withColumn("_last", last)
    turned = (F.col("_swaps") - F.coalesce(F.col("_last.at"), F.lit(0))) % 2 == 1
    return rows.withColumn("inside", F.coalesce(F.col("_last.state"), F.lit(False) if begins is None else begins) != turned).drop("_swaps", "_last")
