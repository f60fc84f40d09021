"""All orders of the filters against a plain walk over the documents."""

from collections import Counter
from itertools import permutations

import pytest

from contractframe.llm import filter_audit
from conftest import plan_of

SCHEMA = "doc_id bigint, text string, source string, mask int, part string, n bigint"


def fails(doc_id, text, least):
    words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ") if w]
    capitals = sum("A" <= c <= "Z" for c in text)
    bad = {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * capitals > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text), "E": doc_id is not None and least is not None and doc_id > least,
    }
    return {f for f, x in bad.items() if x}


def plain(docs, labels):
    least, good, toxic = {}, set(), set()
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, quality, tox in labels:
        if doc_id is not None:
            good |= {doc_id} if quality == 1 else set()
            toxic |= {doc_id} if tox == 1 else set()
    out, shapley = {}, Counter()
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], fails(d[0], d[1] or "", least.get(d[1] or ""))) for d in docs if (d[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


@pytest.fixture(scope="module")
def tables(spark):
    many = " ".join(f"word{i}" for i in range(250))
    texts = [many, many + " é#", "Short Text", "a b " * 120, "A B " * 120, "", None, many.upper(), "x y", "É é", "tab\tand\x0bline\n", many + "\r", "one $"]
    docs = [(i, texts[i % len(texts)], f"s{i % 3}", 1, "p", 9) for i in range(60)]
    docs += [(100 + i, "the hot copy", "hot", 1, "p", 9) for i in range(70)] + [(None, "the hot copy", "hot", 1, "p", 9)] * 3
    docs += [(200, "said twice", "s1", 1, "p", 9)] * 2 + [(201, "said twice", None, 1, "p", 9), (200, "said twice", "s2", 1, "p", 9)]
    docs += [(300, "very long " * 100_000, "", 1, "p", 9), (None, None, None, 1, "p", 9), (90, "one id", "s0", 1, "p", 9), (90, "two texts", "s0", 1, "p", 9)]
    labels = [(i, i % 2, int(i % 7 == 0), "x") for i in range(0, 160, 3)] + [(3, 0, 1, "x"), (200, None, 1, "x"), (201, 1, None, "x"), (None, 1, 1, "x")]
    return docs, labels, spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, part string")


def test_all_orders(tables):
    docs, labels, docs_df, labels_df = tables
    assert got(filter_audit.filter_audit(docs_df, labels_df)) == plain(docs, [r[:3] for r in labels])


def test_every_order_removes_the_same(tables):
    *_, docs_df, labels_df = tables
    rows = got(filter_audit.filter_audit(docs_df, labels_df))
    last = {}
    for (part, order, step), r in rows.items():
        if step == 5:
            last.setdefault(part, set()).add(r[0])
    assert all(len(kept) == 1 for kept in last.values())


def test_no_documents_and_no_labels(spark, tables):
    docs, _, docs_df, labels_df = tables
    assert filter_audit.filter_audit(docs_df.limit(0), labels_df).collect() == []
    rows = got(filter_audit.filter_audit(docs_df, labels_df.limit(0)))
    assert rows == plain(docs, [])


def test_no_nested_loops(tables):
    *_, docs_df, labels_df = tables
    plan = plan_of(filter_audit.filter_audit(docs_df, labels_df))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
