"""Nearest codes against brute force."""

import random
from collections import Counter

import pytest

from contractframe.llm import code_search


def vectors(n, seed=1, dims=32):
    r = random.Random(seed)
    centers = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = r.choice(centers)
        rows.append((i, [x + r.gauss(0, 0.6) for x in c], "x"))
    same = [1.0, -1.0] * (dims // 2)
    rows += [(1000 + i, same, "x") for i in range(120)]  # one very frequent vector
    rows += [(2000, None, "x"), (2100, [1.0] * (dims - 1), "x"), (None, same, "x"), (2200, [float("nan")] * dims, "x"), (2300, [0.0] * dims, "x"), (2400, [None] + same[1:], "x")]
    rows += [(3000, centers[0], "x"), (3000, centers[0], "x")]
    return rows


def bits(v):
    return [x is not None and x > 0 for x in v]


def brute(rows, asked, k, dims=32):
    coded = {(i, tuple(bits(v))) for i, v, _ in rows if i is not None and v is not None and len(v) == dims}
    out = Counter()
    for q, code in {(i, b) for i, b in coded if asked(i)}:
        near = sorted((sum(a != b for a, b in zip(code, own)), i) for i, own in coded)[:k]
        out.update((q, n, i, d) for n, (d, i) in enumerate(near, 1))
    return out


@pytest.mark.parametrize(("k", "block"), [(10, 8192), (3, 16), (200, 64)])
def test_search(spark, monkeypatch, k, block):
    monkeypatch.setattr(code_search, "BLOCK", block)
    rows = vectors(400)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, distance string").repartition(3)
    got = code_search.search(table, table.where("vec_id % 50 = 0"), k, dims=32)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 50 == 0, k)


def test_fewer_rows_than_asked(spark):
    rows = vectors(0)[:4]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, distance string")
    got = code_search.search(table, table, 10, dims=32)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, lambda i: True, 10)


def test_nothing(spark):
    table = spark.createDataFrame(vectors(10), "vec_id bigint, embedding array<double>, distance string")
    assert code_search.search(table.limit(0), table.limit(0), dims=32).collect() == []
    assert code_search.search(table.limit(0), table, dims=32).collect() == []
    assert code_search.search(table, table.limit(0), dims=32).collect() == []
