"""Personal-data expressions: classify, find, redact.  All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractframe.functions.text import strip_text

# Whole-value classes in the order they are tried.
# (?U) gives \d, \s and \b their Unicode meaning.
VALUE_CLASSES = (
    ("ssn", r"(?U)^\d{3}-\d{2}-\d{4}$"),
    ("email", r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z]{2,}$"),
    ("credit_card", r"(?U)^\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}$"),
    ("partial_card", r"(?iU)(?:ending|last\s*4|card)\s*(?:in\s*)?\d{4}"),
    ("partial_account", r"(?U)^[.*]{2,}\d{3,}$"),
    ("phone", r"(?U)^[+]?[\d\s().-]{10,}$"),
)

# Substring classes in the order they are reported.
TEXT_CLASSES = (
    ("ssn", r"(?U)\b\d{3}-\d{2}-\d{4}\b"),
    ("email", r"(?U)\b[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+(?:\.[a-zA-Z0-9-]+)*\.[a-zA-Z]{2,}\b"),
    ("credit_card", r"(?U)\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"),
    ("partial_card", r"(?iU)(?:ending|last\s*4|card)\s*(?:in\s*)?\d{4}"),
    ("phone", r"(?U)\b\+?\d{3}[\s.-]?\d{3}[\s.-]?\d{4}\b"),
)

# Two to four capitalized words of letters, hyphens and apostrophes.
PERSON_NAME = r"(?U)^\s*\p{Lu}[\p{L}'-]*(?:\s+\p{Lu}[\p{L}'-]*){1,3}\s*$"

ISO_DATE = r"(?U)^\d{4}-\d{2}-\d{2}$"

FINDING = "array<struct<pii_type:string,match:string>>"


def classify_pii(c: Column) -> Column:
    """The class of a value that as a whole is personal data, else null."""
    value = strip_text(c)
    # A phone number needs seven digits and must not be an ISO date.
    is_phone = (F.length(F.regexp_replace(value, r"(?U)\D", "")) >= 7) & ~value.rlike(ISO_DATE)
    out = None
    for name, pattern in VALUE_CLASSES:
        hit = value.rlike(pattern)
        if name == "phone":
            hit = hit & is_phone
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def is_person_name(c: Column) -> Column:
    return F.coalesce(c.rlike(PERSON_NAME), F.lit(False))


def classify_or_name(c: Column) -> Column:
    return F.coalesce(classify_pii(c), F.when(is_person_name(c), F.lit("person_name")))


# ASCII marks that no finding holds and that no word holds either.
_BREAKS = r"""!"#$%&'()*,/:;<=>?\[\\\]^`{|}~"""

#: A stretch between two such marks that holds a digit or an @; tried at its beginning only.
_STRETCH = rf"(?<![^{_BREAKS}])[^{_BREAKS}\p{{Nd}}@]*+[\p{{Nd}}@][^{_BREAKS}]*+"


def _stretches(c: Column) -> Column:
    """What of a text can hold personal data, a mark between the stretches: the same findings, in the same order.

    Every finding holds a digit or an @ and none of the marks, and a mark bounds words as a text's end does.
    """
    return F.array_join(F.regexp_extract_all(c, F.lit(_STRETCH), F.lit(0)), ",")


def _tagged(name: str):
    return lambda m: F.struct(F.lit(name).alias("pii_type"), m.alias("match"))


def find_pii(c: Column) -> Column:
    """All personal data inside a text: array of (pii_type, match), by class then position.

    One scan keeps the stretches that can hold any; the patterns of the classes see nothing else.
    """
    return F.transform(F.array(_stretches(c)), _find)[0]  # one element: the stretches are cut once for all classes


def _find(c: Column) -> Column:
    # Cheap tests that every match of a class passes spare most texts its costly scan.
    digits = c.rlike(r"(?U)\d{3}")
    lowered = F.lower(c)
    # Letters that a pattern without case takes for i and s, although lower-casing does not make them that.
    card_words = ("ending", "last", "card")
    odd_letters = ("\u0131", "\u0130", "\u017f")
    says_card = reduce(or_, [*[F.contains(lowered, F.lit(w)) for w in card_words], *[F.contains(c, F.lit(x)) for x in odd_letters]])
    gates = {
        "ssn": digits & F.contains(c, F.lit("-")),
        "email": F.contains(c, F.lit("@")),
        "credit_card": digits & c.rlike(r"(?U)\d{4}[\s-]?\d{4}"),
        "partial_card": digits & says_card,
        "phone": digits & c.rlike(r"(?U)\d{3}[\s.-]?\d{3}[\s.-]?\d{4}"),
    }
    parts = []
    for name, pattern in TEXT_CLASSES:
        hits = F.when(gates[name], F.regexp_extract_all(c, F.lit(pattern), F.lit(0)))
        parts.append(F.transform(F.coalesce(hits, F.array().cast("array<string>")), _tagged(name)))
    return F.coalesce(F.concat(*parts), F.array().cast(FINDING))


def redaction_tag(pii_type: Column) -> Column:
    return F.concat(F.lit("[REDACTED_"), F.upper(pii_type), F.lit("]"))


def redact_text(c: Column) -> Column:
    """Replace every finding by its tag, longest finding first; a text without any stays as it is."""
    ordered = F.array_sort(
        F.transform(
            find_pii(c),
            lambda x, i: F.struct(
                (-F.length(x["match"])).alias("k"),
                i.alias("i"),
                x["match"].alias("match"),
                redaction_tag(x["pii_type"]).alias("tag"),
            ),
        )
    )
    return F.aggregate(ordered, c, lambda text, x: F.replace(text, x["match"], x["tag"]))


def pii_in_values(values: Column) -> Column:
    """True when any text of an array is, or holds, personal data."""
    return F.coalesce(
        F.exists(values, lambda v: classify_pii(v).isNotNull() | (F.size(find_pii(v)) > 0)),
        F.lit(False),
    )


def masked(c: Column) -> Column:
    """A preview that does not repeat the value: three characters at most."""
    return F.when(F.length(c) > 6, F.concat(F.substring(c, 1, 3), F.lit("..."))).otherwise("...")
