"""Tree-reduced byte-level BPE against the tiktoken library."""

import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from contractframe.llm import byte_bpe
from contractframe.llm.catalog import vocabulary

RANKS = vocabulary("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PLAIN = tiktoken.Encoding(
    "plain", pat_str=PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(str.split, RANKS.splitlines())},
)
TEXTS = st.lists(st.sampled_from(
    ["a", "aa", " ", "  ", "\n", "\t", "\x1c", "\xa0", "　", "'", "'r", "e", "'s", "'ll", "v", ".", ",", "É", "ñas", "word", "12", "½", "日本", "…", "́", "ª",
     "_", "\r\n", "🙂", "՘", "\U00012550", "ÿ", "\x00", "ß", "Ω", "the", "ing", "!!", "aaaaaaaaa"]
), max_size=60).map("".join) | st.text(max_size=60)


def ids_of(node):
    return np.frombuffer(b"".join(node.ids), "<u4").tolist()


@settings(max_examples=600, deadline=None)
@given(TEXTS, TEXTS)
def test_two_texts_join(left, right):
    code = byte_bpe.monoid(RANKS, PATTERN)
    both = code.join(code.encode(left), code.encode(right))
    assert "".join(both.matches) == left + right
    assert ids_of(both) == PLAIN.encode_ordinary(left + right)
    assert code.decode(b"".join(both.ids)) == (left + right).encode()


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 9), st.integers(2, 5))
def test_trees_of_tiny_leaves(text, chars, size):
    old = byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES
    byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES = chars, size
    try:
        code = byte_bpe.monoid(RANKS, PATTERN)
        code.known.clear()
        assert ids_of(code.encode(text)) == PLAIN.encode_ordinary(text)
    finally:
        byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES = old
        code.known.clear()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"ab", b"aba", b"\xff", b"\xc3\xa9", b"ing", b" ", b"==", b"--"]), max_size=40).map(b"".join))
def test_halves_of_bytes_are_merged_as_the_whole(text):
    code = byte_bpe.monoid(RANKS, PATTERN)
    assert code.tokens(text) == code.merged(text)


def test_tokens_that_merging_never_makes():
    """A vocabulary where abc is no merge of its parts: whole as a match, in parts inside a longer one."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abcd": 301, b"cd": 299, b"bcd": 302}
    lines = "\n".join(f"{base64.b64encode(t).decode()} {r}" for t, r in ranks.items())
    plain = tiktoken.Encoding("odd", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    code = byte_bpe.Monoid(lines, PATTERN)
    for text in ("abcd", "bcd", "abcdx", "bcdbcd" * 30, "x" + "abcd" * 40, "bcd" + "a" * 90):
        for at in range(len(text)):
            assert ids_of(code.join(code.encode(text[:at]), code.encode(text[at:]))) == plain.encode_ordinary(text)


def expected(rows):
    out = Counter()
    for r in rows:
        ids = np.array(PLAIN.encode_ordinary(r["text"] or ""), "<u4")
        out[(r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text number {i}, and d'être " * (i % 7 * 9)) for i in range(50)]
    rows += [(100, None), (101, ""), (103, "copy"), (103, "copy"), (103, "other"), (None, "no id"), (None, None)]
    rows += [(110, "long words here " * 20_000), (111, "a" * 150_000), (112, " " * 70_001 + "x"), (113, "日本語" * 40_000), (114, "'re" * 30_000)]
    rows += [(115, "0123456789 " * 8_000), (115, "0123456789 " * 8_000), (None, "é!" * 40_000)]
    return spark.createDataFrame([(i, t, b"x", 7) for i, t in rows], "doc_id bigint, text string, ids binary, uid int").repartition(5)


def test_documents(spark, docs):
    got = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    digest = lambda x: hashlib.sha256(x).hexdigest()
    assert Counter((r["doc_id"], len(r["ids"]) // 4, digest(r["ids"]), digest(r["decoded"])) for r in got) == expected(docs.collect())


def test_long_texts_meet_over_several_rounds(spark, docs, monkeypatch):
    """Segments of a few hundred characters, hence several shuffles, in this process."""
    monkeypatch.setattr(byte_bpe, "FAN", 2)
    some = docs.where("doc_id in (110, 112)")
    got = byte_bpe.encode_documents(some, RANKS, PATTERN, segment_bytes=1000).collect()
    want = {r["doc_id"]: PLAIN.encode_ordinary(r["text"]) for r in some.collect()}
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got} == want


def test_no_documents(spark, docs):
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, PATTERN).collect() == []
