"""Token ids, packing and the token store against plain computations."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contractframe.llm import packing, token_ids, token_store
from contractframe.llm.catalog import vocabulary
from contractframe.llm.token_ids import encoder

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", " ", "  ", "\n", "\t", "\x1c", " \x1d", "\xa0", "'s", "'", ".", ",", "É", "ñas", "word", "12", "½", "日本", "…", " ", "<|endoftext|>", "́", "ª", "_", "\r\n"]
), max_size=25).map("".join) | st.text(max_size=30))
def test_pieces_give_the_ids_of_the_whole_text(text):
    got = np.frombuffer(encoder(vocabulary()).ids(text), "<u4").tolist()
    assert got == PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 60), min_size=1))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 16)
    placed = Counter()
    for count, pattern in patterns:
        assert count > 0 and sum(pattern) <= 16
        for length in pattern:
            placed[length] += count
    assert placed == Counter(histogram)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text number {i} " * (i % 7 * 40)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "long word " * 3000), (103, "copy"), (103, "copy"), (None, "no id"), (None, None)]
    rows += [(200 + i, "the same short text") for i in range(40)]
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id bigint, text string, length string, start int").repartition(5)


def test_packing(spark, docs):
    got = packing.pack_documents(docs, vocabulary(), 64).collect()
    want = Counter()
    for r in docs.collect():
        ids = plain_ids(r["text"])
        for at in range(0, len(ids), 64):
            piece = np.array(ids[at : at + 64], "<u4")
            want[(r["doc_id"], at, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    tokens = sum(r["length"] for r in got)
    assert len(sequences) <= -(-tokens // 64) * 1.05 + 2


def test_packing_of_nothing(spark, docs):
    assert packing.pack_documents(docs.limit(0), vocabulary(), 64).collect() == []


def test_ranks_do_not_depend_on_chunks(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "_RANK_CHUNK", 7)
    got = packing.pack_documents(docs, vocabulary(), 64)
    places = got.select("sequence_id", "offset").collect()
    assert len(set(places)) == len(places)


def test_token_store(spark, docs, tmp_path):
    manifest = token_store.write_tokens(docs, f"file://{tmp_path}", vocabulary())
    got = token_store.read_tokens(spark, manifest).collect()
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    want = Counter()
    for r in rows:
        ids = np.array(plain_ids(r["text"]), "<u4")
        want[(r["doc_id"], len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    known = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert known == sorted(known)


def test_one_document_from_its_file(spark, docs, tmp_path):
    manifest = token_store.write_tokens(docs, f"file://{tmp_path}", vocabulary())
    found = {}
    for r in manifest.collect():
        file = token_store.TokenFile(r["path"])
        for doc in (7, 102, 100):
            try:
                found[doc] = file.document(doc).tolist()
            except KeyError:
                pass
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found == {d: plain_ids(texts[d]) for d in (7, 102, 100)}


def test_token_store_of_nothing(spark, docs, tmp_path):
    manifest = token_store.write_tokens(docs.limit(0), f"file://{tmp_path}", vocabulary())
    assert token_store.read_tokens(spark, manifest).collect() == []


def test_ascii_text_is_cut_without_the_whole_tokenizer(monkeypatch):
    text = "it's 12d(d** x'll ... 'S\tq\x1c9\x1f?\r\n ,,7"
    own = token_ids.TextEncoder(vocabulary())
    whole = own._whole_ids(text)
    monkeypatch.setattr(token_ids.TextEncoder, "_whole_ids", None)
    assert own.ids(text) == whole


def test_pieces_met_again_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(token_ids, "_CACHE_ENTRIES", 4)
    asked = []
    pieces = token_ids._Pieces(lambda piece: asked.append(piece) or piece.encode())
    for new in "abcdef":
        assert pieces["x"] == b"x" and pieces[new] == new.encode()
    assert asked.count("x") == 1 and len(pieces) + len(pieces.before) <= 4
