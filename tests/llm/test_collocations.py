"""Collocations against plain counting of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contractframe.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, n bigint, phrase string"


def pieces(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for m in range(1, 6):
                f.update((lang, tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, ws), a in candidates.items():
        inside = lambda longer: any(longer[i : i + len(ws)] == ws for i in range(len(longer) - len(ws) + 1))
        if any(l2 == lang and len(w2) > len(ws) and a2 >= a and inside(w2) for (l2, w2), a2 in candidates.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.append((lang, score, a, " ".join(ws), f[lang, ws[:k]], f[lang, ws[k:]], n[lang]))
    out.sort(key=lambda r: (r[0], -r[1], -r[2], r[3].encode()))
    ranks, rows = Counter(), []
    for lang, score, a, phrase, l, r, total in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase, a, l, r, total, score))
    return rows


def found(df):
    return sorted(((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.fixture(scope="module")
def texts():
    deal = random.Random(5)
    words = ["the", "The", "of", "é", "a", "New", "york", "x\x1cy", "\xa0", "日本", "￾", "zip", "b\x00", "of.the", "to", "be"]
    rows = [(" ".join(deal.choice(words) + deal.choice(["", "", "", "", ",", "\n", "\t", "  ", "\r"]) for _ in range(deal.randrange(80))), deal.choice(["en", "de", None])) for _ in range(300)]
    rows += [("a line that is copied over and over, word for word", "en")] * 90 + [("same same " * 300, "de"), ("", "en"), (None, "en"), (None, None), (" . ,", "fr")]
    rows += [(" ".join(deal.choice(words) for _ in range(30_000)), "en")]
    return rows


@pytest.mark.parametrize("least, top, bits", [(20, 2000, 26), (5, 7, 8), (40, 50, 6)])
def test_every_phrase(spark, texts, least, top, bits):
    df = spark.createDataFrame([(i % 7, t, g, 5, "x") for i, (t, g) in enumerate(texts)], SCHEMA).repartition(5)
    assert found(collocations.collocations(df, least, top, bits)) == plain(texts, least, top)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c d e f g h".split()), max_size=40), max_size=4))
def test_each_phrase_is_counted_in_one_chunk(pieces_):
    block = b"\xff".join(" ".join(p).encode() for p in pieces_)
    chunks = collocations.chunks_of(block)
    got = Counter()
    for (chunk, closed), n in chunks.items():
        ws = chunk.split()
        own = len(ws) - (collocations.OVERLAP if closed else 0)
        for m in range(1, 6):
            for i in range(min(own, len(ws) - m + 1)):
                got[tuple(ws[i : i + m])] += n
    want = Counter()
    for p in pieces_:
        ws = [w.encode() for w in p]
        for m in range(1, 6):
            want.update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    assert got == want


def test_no_chunk_goes_on_past_its_trigger():
    text = " ".join(random.Random(1).choices("abcdefgh", k=5000)).encode()
    closed = [c for (c, is_closed), _ in collocations.chunks_of(text).items() if is_closed]
    chunks = {c for c, _ in collocations.chunks_of(text)}
    assert len(closed) > 100
    assert not any(other != c and other.startswith(c + b" ") for c in closed for other in chunks)


def test_keys_that_collide(monkeypatch):
    """With one key for all phrases the counts by text still stand."""
    monkeypatch.setattr(collocations.Block, "keys", lambda self, size: np.zeros(max(0, len(self.low) - size + 1), "uint64"))
    block = collocations.Block(pa.array(["en", "en"]), pa.array(["a b c", "c a b"]), np.array([False, False]), np.array([2, 5]))
    rows = block.phrases(2)
    got = Counter()
    for phrase, n in zip(rows["phrase"][0].to_pylist(), rows["n"][0]):
        got[phrase] += int(n)
    assert got == {"a b": 7, "b c": 2, "c a": 5}


@pytest.mark.parametrize("held", [0, 2, 1000])
def test_counts_of_a_task_add_up(monkeypatch, held):
    monkeypatch.setattr(collocations, "_HELD", held)
    block = lambda: collocations.Block(pa.array(["en", "de"]), pa.array(["a b a b", "a"]), np.array([False, False]), np.array([2, 5]))
    got = Counter()
    for batch in collocations._combined(block().phrases(1) for _ in range(7)):
        for r in batch.to_pylist():
            got[r["lang"], r["phrase"]] += r["n"]
    assert got == {("en", "a"): 28, ("en", "b"): 28, ("de", "a"): 35}


def test_keys_of_words_are_those_of_blocks():
    block = collocations.Block(pa.array(["x", "de", "en"])[1:], pa.array(["q q", "ä bc d", "e"])[1:], np.array([False, False]), np.array([1, 1]))
    langs, words = pa.array(["de", "de", "de", "en"]), pa.array(["ä", "bc", "d", "e"])
    assert block.keys(1).tolist() == collocations.phrase_keys(langs, words).tolist()
    assert len(set(block.keys(1).tolist())) == 4 and block.inside(2).tolist() == [True, True, False]


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).collect() == []
