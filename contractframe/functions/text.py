"""Text expressions.  All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a cell.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Control characters to remove (tab, line feed and carriage return stay).
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"

# The texts that a floating-point parser accepts.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER = (
    rf"(?i)^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)$"
)

# The number texts that the engine's own cast takes, with white space around.
CASTABLE_NUMBER = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?|nan)\s*$"
CASTABLE_INTEGER = r"^\s*[+-]?[0-9]+\s*$"

# How a cell that a spreadsheet would run begins.
FORMULA = r"(?U)^[=@]|^[+-](?!\d)"


def strip_text(c: Column) -> Column:
    """Remove white space at both ends, looking at the ends only; null stays null."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "")


def looks_numeric(c: Column) -> Column:
    """Numeric text, allowing thousands commas, a dollar and a percent sign."""
    return F.coalesce(strip_text(F.translate(c, ",$%", "")).rlike(NUMBER), F.lit(False))


def is_formula(c: Column) -> Column:
    return F.coalesce(strip_text(c).rlike(FORMULA), F.lit(False))
