"""Substring dedup, decontamination and near duplicates against brute force, with awkward rows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from contractframe import storage
from contractframe.llm import decontaminate, minhash_forest, substring_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, n int, anchor string, _k string"


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def made(seed=3):
    """Random documents with copies, near copies, shared passages, repeats inside a text and odd rows."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéÉ\x1c\xa0") for _ in range(r.randint(1, 4)))
    vocabulary = sorted({w for w in (word() for _ in range(300)) if w.strip()})
    prose = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, line = prose(60), prose(20)
    texts = []
    for i in range(40):
        words = prose(r.randint(1, 120))
        if i % 4 == 0:
            at = r.randint(0, len(words))
            words[at:at] = passage[: r.choice([34, 35, 36, 60])]
        if i % 5 == 0:
            words += line
        texts.append(words)
    for i in range(30):
        copy = list(texts[r.randint(0, 39)])
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            copy[r.randrange(len(copy))] = r.choice(vocabulary)
        texts.append(copy)
    base = prose(90)
    for _ in range(60):  # one crowded region of near copies
        copy = list(base)
        for _ in range(r.randint(1, 5)):
            copy[r.randrange(len(copy))] = r.choice(vocabulary)
        texts.append(copy)
    texts += [["la"] * 100, ["la"] * 34, ["la"] * 35, ["ab", "cd"] * 60, prose(3), prose(4), ["One", "TWO"], ["one", "two"], prose(5000)]
    rows = [(7 * i % 1009 - 20, r.choice([" ", "\n", "\t ", "  "]).join(w), i, "x", "y") for i, w in enumerate(texts)]
    rows += [(2000, None, 1, None, None), (2001, "", 1, None, None), (2002, " \t\n", 1, None, None), (2003, "same row " * 30, 1, None, None), (2003, "same row " * 30, 1, None, None)]
    rows += [(None, texts[0][0], 5, "x", "y"), (None, " ".join(texts[3]), 5, "x", "y")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def repeated(texts, size):
    lists = [split(t) for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in lists for i in range(len(w) - size + 1))
    out = []
    for words in lists:
        gone = {j for i in range(len(words) - size + 1) if seen[tuple(words[i : i + size])] > 1 for j in range(i, i + size)}
        out.append((words, [w for j, w in enumerate(words) if j not in gone]))
    return out


@pytest.mark.parametrize("size", [35, 12])
def test_substring_report(docs, rows, size):
    got = Counter(tuple(r) for r in substring_dedup.dedup_report(docs, size).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    want = Counter(
        (r[0], len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for r, (w, k) in zip(rows, repeated([r[1] for r in rows], size))
    )
    assert got == want


def test_substring_report_in_small_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "_BLOCK", 100)
    got = Counter(tuple(r)[:3] for r in substring_dedup.dedup_report(docs, 35).collect())
    assert got == Counter((r[0], len(w), len(w) - len(k)) for r, (w, k) in zip(rows, repeated([r[1] for r in rows], 35)))


def test_cut_documents(docs, rows):
    got = Counter(tuple(r) for r in substring_dedup.cut_documents(docs, 35).collect())
    want = Counter(
        (r[0], r[1] if len(k) == len(w) else " ".join(k), *r[2:]) for r, (w, k) in zip(rows, repeated([r[1] for r in rows], 35))
    )
    assert got == want


def test_substring_of_nothing(docs):
    assert substring_dedup.dedup_report(docs.limit(0)).collect() == []


def shingles(text):
    w = split((text or "").translate(ASCII))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(rows, percent=75):
    sets = [shingles(r[1]) for r in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(r[0], len(s), least[root(i)] if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def test_near_duplicates(docs, rows):
    got = Counter(tuple(r) for r in minhash_forest.near_duplicates(docs).collect())
    assert got == Counter((d, n, c, d is not None and d == c) for d, n, c in near(rows))


def test_near_duplicates_in_small_blocks(docs, rows, monkeypatch):
    for name, value in (("_OUTSIDE", 3), ("_CHUNK", 5), ("PARTNERS", 1)):
        monkeypatch.setattr(minhash_forest, name, value)
    got = Counter(tuple(r)[:3] for r in minhash_forest.near_duplicates(docs).collect())
    assert got == Counter(near(rows))


def test_keep_one(docs, rows):
    kept = [tuple(r) for r in minhash_forest.keep_one(docs).collect()]
    assert set(kept) <= set(rows)
    component = {}
    for r, (_, n, c) in zip(rows, near(rows)):
        component.setdefault((n > 0, c) if n else (False, r), []).append(r)
    for (worded, _), own in component.items():
        assert sum(r in own for r in kept) == (1 if worded else len(own))


def test_keep_one_beside_columns_of_any_name(docs):
    odd = docs.selectExpr("*", "1 AS _row_id_", "2 AS _ROW_TEXT_", "3 AS _own_id", "4 AS label")
    kept = minhash_forest.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(kept.select(docs.columns).collect(), key=repr) == sorted(minhash_forest.keep_one(docs).collect(), key=repr)


def test_rounds_leave_nothing_behind(spark, docs, monkeypatch, tmp_path):
    """Only what the result itself reads is left in the shared folder."""
    monkeypatch.setattr(minhash_forest, "PARTNERS", 1)
    monkeypatch.setattr(storage, "shared_dir", lambda spark: str(tmp_path))
    assert minhash_forest.near_duplicates(docs).count() == docs.count()
    left = Counter(re.sub(r"contractframe-(.*)-[0-9a-f]+$", r"\1", p.name) for p in tmp_path.iterdir())
    assert left == {"signatures": 1, "class-labels": 1}


def test_near_duplicates_of_nothing(docs):
    assert minhash_forest.near_duplicates(docs.limit(0)).collect() == []
    assert minhash_forest.keep_one(docs.limit(0)).collect() == []


def items_of(rows):
    r = random.Random(5)
    out = []
    for i, row in enumerate(rows[:60:4]):
        words = split(row[1])
        at = r.randint(0, max(0, len(words) - 15))
        out.append((i if i % 6 else None, " ".join(words[at : at + 15]).upper(), i))
    out += [(100, "One two", 1), (100, "one TWO", 2), (101, "la", 3), (102, None, 4), (103, "", 5), (104, "...", 6), (105, out[1][1], 7), (106, "la la la", 8), (107, "nowhere at all", 9)]
    return out


def hits(rows, items, size=10):
    windows = {}
    for item, text, _ in items:
        w = WORD.findall((text or "").translate(ASCII))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(ASCII))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    found |= own
        ids = sorted(str(i) for i in found if i is not None)
        out.append((r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def test_contamination(spark, docs, rows):
    items = items_of(rows)
    table = spark.createDataFrame(items, "item_id bigint, text string, pos int")
    got = decontaminate.contamination(docs, table).drop("item_ids")
    want = hits(rows, items)
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    kept = Counter(tuple(r) for r in decontaminate.clean_documents(docs, table).collect())
    assert kept == Counter(r for r, w in zip(rows, want) if not w[5])


def test_contamination_by_long_items_only(spark, docs, rows):
    items = [i for i in items_of(rows) if len(WORD.findall(i[1] or "")) >= 10]
    table = spark.createDataFrame(items, "item_id bigint, text string, pos int")
    assert Counter(tuple(r) for r in decontaminate.contamination(docs, table).drop("item_ids").collect()) == Counter(hits(rows, items))


def test_contamination_of_nothing(spark, docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r["n_hit"] == 0 for r in decontaminate.contamination(docs, none).collect())
    assert decontaminate.contamination(docs.limit(0), none).collect() == []


def test_decontamination_plan_has_no_python(spark, docs):
    plan = decontaminate.contamination(docs, spark.createDataFrame([(1, "one two")], "item_id bigint, text string"))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_one_pass_where_no_class_has_more_pairs(docs, rows, monkeypatch):
    passes, own = [], minhash_forest._rest_pairs
    monkeypatch.setattr(minhash_forest, "_rest_pairs", lambda *given: passes.append(given) or own(*given))
    monkeypatch.setattr(minhash_forest, "PARTNERS", 1000)
    minhash_forest.near_duplicates(docs).collect()
    assert len(passes) == 1


def test_sets_of_odd_white_space():
    texts = ["", None, " a", "A b\tC d\x0be\x0c", "x\x1cy \xa0 z q r\r\n", "a b c d e a b c d e a", "  ", "é É"]
    found, own = minhash_forest._sets(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        runs = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else ()
        assert (own == i).sum() == len(runs)
        assert (found[own == i] == sorted(found[own == i])).all()


def test_agreeing_bytes():
    import numpy as np

    rows = np.random.default_rng(5).integers(0, 3, (50, minhash_forest.HASHES), "uint8")
    rows[7] = rows[3]
    assert (minhash_forest._agreeing(rows, rows[3]) == (rows == rows[3]).sum(axis=1)).all()


def test_one_pass_whatever_partners_were_tried(docs, rows, monkeypatch):
    passes, own = [], minhash_forest._rest_pairs
    monkeypatch.setattr(minhash_forest, "_rest_pairs", lambda *given: passes.append(own(*given)) or passes[-1])
    monkeypatch.setattr(minhash_forest, "PARTNERS", 1)
    got = Counter(tuple(r)[:3] for r in minhash_forest.near_duplicates(docs).collect())
    assert len(passes) == 1 and passes[0].columns == ["x", "y"] and got == Counter(near(rows))


def test_a_block_reports_a_tree_of_links():
    import numpy as np

    words = [f"w{i}" for i in range(60)]
    copies = [" ".join([*words[:i], f"x{i}", *words[i + 1 :]]) for i in (5, 6, 7, 8)]
    texts = [*copies, " ".join(words[::-1]), "other"]
    label = np.array([0, 1, 0, 2, 4, 5])
    names = np.stack([np.arange(6), np.zeros(6, "int64"), label, np.zeros(6, "int64")])
    links = minhash_forest._tree(names, np.array([0, 2, 0, 2, 2, 2]), texts, 75)
    assert len(links) == 2 and {frozenset((label[x], label[y])) for x, y in links} <= {frozenset(p) for p in ((0, 1), (0, 2), (1, 2))}
