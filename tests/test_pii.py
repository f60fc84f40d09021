import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contractframe.contract import Contract, Field, contract_from_dict
from contractframe.functions import pii, text
from contractframe.operators import privacy
from contractframe.sources import textfiles as files


def one(spark, fn, value):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, kind",
    [("user@example.com", "email"), ("123-45-6789", "ssn"), ("+1 (555) 123-4567", "phone"), ("555.123.4567", "phone"),
     ("4111 1111 1111 1111", "credit_card"), ("4111111111111111", "credit_card"), ("Visa ending in 4122", "partial_card"),
     ("...965", "partial_account"), ("***218", "partial_account"), ("  a@b.co ", "email"), ("192.168.100.200", "phone"),
     ("hello world", None), ("42.99", None), ("2026-03-28", None), ("Merchandise", None), ("", None), (None, None)],
)
def test_value_class(spark, value, kind):
    assert one(spark, pii.classify_pii, value) == kind


def found(spark, value):
    return [tuple(x) for x in one(spark, pii.find_pii, value)]


def test_substrings(spark):
    assert found(spark, "write jo@a.example.co.uk or call 555-123-4567.") == [("email", "jo@a.example.co.uk"), ("phone", "555-123-4567")]
    assert found(spark, "on 2026-03-28 we met") == []
    assert found(spark, "") == [] and found(spark, None) == []
    assert found(spark, "ssn 123-45-6789, Card ending 4122") == [("ssn", "123-45-6789"), ("partial_card", "ending 4122")]


def test_accented_letters_are_word_letters(spark):
    assert found(spark, "é123-45-6789") == []


def test_non_ascii_digits_count_as_digits(spark):
    assert found(spark, "١٢٣-٤٥-٦٧٨٩") == [("ssn", "١٢٣-٤٥-٦٧٨٩")]


def test_stretches_lose_no_finding(spark):
    """The patterns on stretches give what they give on whole texts, whatever the marks and letters around."""
    deal = random.Random(12)
    parts = ["123-45-6789", "4111 1111 1111 1111", "4111-1111\n1111 1111", "555-123-4567", "+555.123.4567", "a.b+c@d-e.co.uk", "x@y.zz", "card", "CARD in", "ending",
             "last 4", "la\u017ft  4", "in", "4122", "12", "\u0661\u0662\u0663-\u0664\u0665-\u0666\u0667\u0668\u0669", "é", "\u0301", "_", "ß", " ", " ", "\n", "\t", "\xa0", ".", "-", "+", "@",
             *"!\"#$%&'()*,/:;<=>?[\\]^`{|}~", "…", "日本"]
    texts = ["".join(deal.choices(parts, k=deal.randrange(12))) for _ in range(4000)] + ["word " * 50_000 + "call 555-123-4567", "9" * 200_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", pii.find_pii(F.col("t")).alias("new"), pii._find(F.col("t")).alias("old")).collect()
    assert sum(bool(r["old"]) for r in got) > 1000
    for r in got:
        assert r["new"] == r["old"], r["t"][:200]


def test_text_redaction(spark):
    assert one(spark, pii.redact_text, "ask jane@example.com, Card ending 4122") == "ask [REDACTED_EMAIL], Card [REDACTED_PARTIAL_CARD]"
    assert one(spark, pii.redact_text, "clean") == "clean"
    assert one(spark, pii.redact_text, None) is None


def test_longest_finding_is_replaced_first(spark):
    assert one(spark, pii.redact_text, "4111 1111 1111 1111 and 111 111 1111") == "[REDACTED_CREDIT_CARD] and [REDACTED_PHONE]"


@pytest.mark.parametrize(
    "value, name",
    [("Mary Ann Lee", True), ("Jean-Luc O'Neil", True), ("Élodie Ünal", True), ("mary lee", False), ("Mary", False),
     ("A B C D E", False), ("Mary Lee2", False), ("Mary & Lee", False), (" Mary  Lee ", True), ("", False), (None, False)],
)
def test_person_name(spark, value, name):
    assert one(spark, pii.is_person_name, value) is name


def test_masked(spark):
    assert one(spark, pii.masked, "jane@example.com") == "jan..." and one(spark, pii.masked, "abcdef") == "..."


@pytest.mark.parametrize("value, clean", [("a\x00b\x01c\x7f", "abc"), ("a\tb\nc\rd", "a\tb\nc\rd"), (None, None)])
def test_control_characters(spark, value, clean):
    assert one(spark, text.strip_control, value) == clean


@pytest.mark.parametrize("value", ["  x ", "\t\nx ", "　x ", "\x1cx\x1f", "x y", "", "   ", None])
def test_strip_is_unicode(spark, value):
    assert one(spark, text.strip_text, value) == (value.strip() if value is not None else None)


@pytest.mark.parametrize("value, numeric", [("1,234.50", True), ("$5", True), ("12%", True), ("1e5", True), ("1_000", True),
                                            ("inf", True), ("abc", False), ("", False), ("$", False), ("3d", False), (None, False)])
def test_looks_numeric(spark, value, numeric):
    assert one(spark, text.looks_numeric, value) is numeric


def test_formula_cells(spark, rows):
    df = spark.createDataFrame(
        [(0, '=CMD("calc")', "ok"), (1, "+1-555-1234", " @SUM(A1:A3) "), (2, "-x", "-5"), (3, "+", None)], "_row_id bigint, a string, b string")
    assert rows(privacy.formula_injection(df)) == sorted([(0, "a", '=CMD("calc")'), (1, "b", "@SUM(A1:A3)"), (2, "a", "-x"), (3, "a", "+")], key=repr)


def test_summary(spark):
    findings = spark.createDataFrame([("l", "email", "a"), ("l", "ssn", "b"), ("l", "email", "c")], privacy.FINDINGS)
    assert tuple(privacy.safety_summary(findings).first()) == (False, 3, "Unsafe (3 findings — email:2, ssn:1)")
    assert tuple(privacy.safety_summary(findings.limit(0)).first()) == (True, 0, "Safe (no PII detected)")


DICTIONARY = contract_from_dict({
    "dataset": {"name": "d"},
    "fields": [
        {"name": "contact", "source_column": "Jane's column", "notes": "ask jane@example.com", "allowed_values": ["a@b.co", "x", 5]},
        {"name": "secret", "notes": "123-45-6789", "shareable": False},
        {"name": "kind", "notes": "call 555-123-4567", "community_notes": "kind of thing", "allowed_values": ["p", "q"]},
    ],
})


def test_dictionary_scan(spark, rows):
    got = privacy.dictionary_pii_scan(privacy.dictionary_frame(spark, [DICTIONARY]))
    assert rows(got, "location", "pii_type", "value") == [
        ("field.contact.allowed_values", "email", "a@b.co"), ("field.contact.notes", "email", "jane@example.com"),
        ("field.kind.notes", "phone", "555-123-4567"),
    ]


def test_share_safe_dictionary(spark, rows):
    got = privacy.share_safe_dictionary(privacy.dictionary_frame(spark, [DICTIONARY]))
    assert rows(got, "field_name", "source_column", "notes", "allowed_values") == [
        ("contact", None, "3 unique values (redacted for community safety). ask [REDACTED_EMAIL]", None),
        ("kind", None, "kind of thing", ["p", "q"]),
    ]


def test_share_safe_table(spark, rows):
    c = Contract(fields=[Field("body", source_column="Text", type="text"), Field("hidden", shareable=False), Field("n", dtype="Int64", type="integer")])
    df = spark.createDataFrame([("mail a@b.co", "h", 1)], "Text string, hidden string, n bigint")
    got = privacy.share_safe_table(df, c)
    assert got.columns == ["body", "n"] and rows(got) == [("mail [REDACTED_EMAIL]", 1)]


def test_scan_text_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_text("write jane@example.com")
    (tmp_path / "a" / "y.yaml").write_text("clean: yes")
    (tmp_path / "a" / "list.yml").write_text("- ask jane@example.com\n- : broken")
    (tmp_path / "z.txt").write_text("b@c.de")
    got = privacy.scan_text_files(spark, str(tmp_path)).collect()
    found = sorted((r["location"].split("/a/")[1], r["pii_type"], r["preview"]) for r in got)
    assert found == [("list.yml:freetext", "email", "jan..."), ("x.md", "email", "jan...")]


CONTRACT = """
dataset: {name: people}
fields:
  - {name: contact, notes: "ask jane@example.com", allowed_values: [a@b.co, plain, 5]}
  - {name: secret, notes: "123-45-6789", shareable: false}
  - {name: kind, notes: null, community_notes: "card ending in 4122"}
  - {name: total, transformation: "a + b", notes: "call 555-123-4567"}
"""


def test_contracts_among_the_files(spark, tmp_path):
    """Their fields are scanned as a dictionary; what may not be shared is skipped."""
    (tmp_path / "c.yaml").write_text(CONTRACT)
    (tmp_path / "d.yml").write_bytes(CONTRACT.encode() + b"# \xff written by bob@example.com\n")
    got = privacy.scan_text_files(spark, str(tmp_path)).collect()
    found = sorted((r["location"].rsplit("/", 1)[1], r["pii_type"], r["preview"]) for r in got)
    assert [f for f in found if f[0].startswith("c.")] == [
        ("c.yaml:field.contact.allowed_values", "email", "..."), ("c.yaml:field.contact.notes", "email", "jan..."),
        ("c.yaml:field.kind.community_notes", "partial_card", "end..."),
    ]
    assert {f[0] for f in found if f[0].startswith("d.")} == {"d.yml:freetext"}  # not UTF-8, hence no contract


@pytest.mark.parametrize("size", [40, 200, 1 << 20])
def test_long_files_are_scanned_in_pieces(spark, tmp_path, monkeypatch, size):
    """Pieces of any size give the findings of the whole text, also of those that go on over lines."""
    deal = random.Random(size)
    lines = ["4111 1111", "1111", "1111 words", "card", "", "  ", "in", "4122", "x@y.zz", "555-123", "4567", "plain words.", "1234", "and 123-45-6789.", "last", "4"]
    text = "\n".join(deal.choices(lines, k=3000))
    (tmp_path / "long.md").write_text(text)
    pieces = list(files.pieces(io.BytesIO(text.encode()).read, size))
    assert "".join(pieces) == text and (size > 1000 or len(pieces) > 50)
    monkeypatch.setattr(files, "PIECE", size)
    whole = spark.createDataFrame([(text,)], "t string").select(F.inline(pii.find_pii(F.col("t")))).collect()
    got = privacy.scan_text_files(spark, str(tmp_path)).collect()
    assert Counter((r["pii_type"], r["preview"]) for r in got) == Counter((r["pii_type"], r["match"][:3] + "..." if len(r["match"]) > 6 else "...") for r in whole)
    assert len(whole) > 300


def test_a_piece_without_a_safe_break_ends_at_a_bound():
    pieces = list(files.pieces(io.BytesIO(b"1234\n" * 10_000).read, 100, 1000))
    assert "".join(pieces) == "1234\n" * 10_000 and max(map(len, pieces)) <= 1100
