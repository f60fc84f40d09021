"""Value-by-value coercion to contract types.  Never raises: a value that does not fit becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.contract import Field
from contractframe.functions.text import CASTABLE_INTEGER, CASTABLE_NUMBER, strip_text

_EXACT = float(2**53)  # whole doubles up to here are exact integers

# Strftime letters and the matching datetime pattern letters.
_STRFTIME = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss",
    "f": "SSSSSS", "p": "a", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "j": "DDD",
    "z": "xx", "%": "%",
}


def datetime_pattern(strftime: str) -> str:
    """Write a strftime format as a Spark datetime pattern."""
    out, i = "", 0
    while i < len(strftime):
        ch = strftime[i]
        if ch == "%" and i + 1 < len(strftime):
            i += 1
            out += _STRFTIME.get(strftime[i], strftime[i])
        elif ch.isalpha():
            out += f"'{ch}'"
        else:
            out += ch
        i += 1
    return out


def is_float(t: T.DataType) -> bool:
    return isinstance(t, (T.DoubleType, T.FloatType))


def is_integer(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_number(t: T.DataType) -> bool:
    return is_float(t) or is_integer(t) or isinstance(t, T.DecimalType)


def is_time(t: T.DataType) -> bool:
    return isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType))


def missing(c: Column, t: T.DataType) -> Column:
    """Null, or not-a-number: the engine has one notion of an absent value."""
    return (c.isNull() | F.isnan(c)) if is_float(t) else c.isNull()


def no_nan(c: Column, t: T.DataType) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c) if is_float(t) else c


def text_to_double(text: Column) -> Column:
    """A text that is a number as a double. The pattern first: a cast that fails costs an exception per row."""
    return F.when(text.rlike(CASTABLE_NUMBER), text.try_cast("double"))


def _whole(d: Column, truncate: bool) -> Column:
    fits = F.abs(d) <= _EXACT
    if not truncate:
        fits = fits & (d == F.floor(d).cast("double"))
    # The cast sits in a branch reached only by values that fit.
    return F.when(fits, F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).cast("bigint"))


def coerce(c: Column, source: T.DataType, f: Field, truncate: bool = False) -> Column:
    """``c`` as the field's declared type, null where it cannot be."""
    target = f.spark_type
    if isinstance(target, T.StringType):
        return no_nan(c, source).cast("string")
    if isinstance(target, T.LongType):
        if is_integer(source) or isinstance(source, T.BooleanType):
            return c.cast("bigint")
        if is_number(source):
            return _whole(no_nan(c.cast("double"), T.DoubleType()), truncate)
        text = c.cast("string")
        # '3.0' is read as 3 without going through a double.
        digits = F.when(text.rlike(r"\.0*\s*$"), F.regexp_replace(text, r"\.0*\s*$", "")).otherwise(text)
        return F.coalesce(
            F.when(digits.rlike(CASTABLE_INTEGER), digits.try_cast("bigint")),
            _whole(no_nan(text_to_double(text), T.DoubleType()), truncate),
        )
    if isinstance(target, T.DoubleType):
        if is_number(source) or isinstance(source, T.BooleanType):
            return no_nan(c.cast("double"), T.DoubleType())
        return no_nan(text_to_double(c.cast("string")), T.DoubleType())
    if isinstance(target, T.BooleanType):
        if isinstance(source, T.BooleanType):
            return c
        text = F.lower(strip_text(c.cast("string")))
        return F.when(text.isin("true", "1", "1.0"), F.lit(True)).when(
            text.isin("false", "0", "0.0"), F.lit(False)
        )
    name = "timestamp_ntz" if isinstance(target, T.TimestampNTZType) else "timestamp"
    if is_time(source):
        return c.cast(name)
    text = strip_text(c.cast("string"))
    # ISO first, then month-first, then the declared format.
    month_first = F.when(
        text.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast(name)
    )
    tries = [text.try_cast(name), month_first]
    if f.parse_format:
        tries.append(F.try_to_timestamp(text, F.lit(datetime_pattern(f.parse_format))).cast(name))
    return F.coalesce(*tries)
