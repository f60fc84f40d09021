import random

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from contractframe.contract import Contract, Field
from contractframe.functions import similarity
from contractframe.functions.similarity import TextBatch
from contractframe.operators import cleaning, neardup
from contractframe.storage import discard, materialize, with_rank, with_row_id


def test_strip_keeps_nulls_and_counts(spark, rows):
    df = spark.createDataFrame([(0, " a ", "x"), (1, None, "y "), (2, "b", None)], "_row_id bigint, p string, q string")
    assert rows(cleaning.strip_whitespace(df, ["p", "q", "_row_id"])) == [(0, "a", "x"), (1, None, "y"), (2, "b", None)]
    assert rows(cleaning.strip_counts(df, ["p", "q"])) == [("p", 1), ("q", 1)]


def test_exact_duplicates_keep_the_first_and_nulls_are_equal(spark, rows):
    df = spark.createDataFrame([(5, "a", None), (3, "a", None), (1, "b", 1.0), (9, "a", 1.0)], "_row_id bigint, s string, v double")
    assert rows(cleaning.exact_dedupe(df), "_row_id") == [(1,), (3,), (9,)]
    assert tuple(cleaning.dedupe_counts(df).first()) == (4, 3, 1)
    assert tuple(cleaning.dedupe_counts(df.limit(0)).first()) == (0, 0, 0)


def test_digest_tells_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("null", "a")], "p string, q string")
    assert tuple(cleaning.dedupe_counts(df).first()) == (3, 3, 0)


def test_value_map(spark, rows):
    df = spark.createDataFrame([(0, "Kids Menu"), (1, "Kid's Menu"), (2, None), (3, "Drinks"), (4, "Kids Menu")], "_row_id bigint, c string")
    got = cleaning.apply_value_map(df, "c", {"Kids Menu": "kids", "Kid's Menu": "kids"})
    assert rows(got) == [(0, "kids"), (1, "kids"), (2, None), (3, "Drinks"), (4, "kids")]


def test_value_map_entries(spark, rows):
    df = spark.createDataFrame([(0, "a"), (1, "b")], "_row_id bigint, c string")
    twice = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "y")], "original string, canonical string")
    assert rows(cleaning.apply_value_map(df, "c", twice)) == [(0, "x"), (1, "b")]
    with pytest.raises(ValueError, match="more than one value.*'a'"):
        cleaning.apply_value_map(df, "c", spark.createDataFrame([("a", "x"), ("a", "y")], "original string, canonical string"))
    numbers = spark.createDataFrame([(0, 1.0), (1, 2.5)], "_row_id bigint, v double")
    assert rows(cleaning.apply_value_map(numbers, "v", {1: 7})) == [(0, 7.0), (1, 2.5)]
    assert rows(cleaning.apply_value_map(numbers, "v", {})) == [(0, 1.0), (1, 2.5)]


KINDS = """
    SELECT id AS _row_id, timestamp_micros(1700000000000000 + id % 7) AS t, CASE WHEN id % 2 = 0 THEN 0.0D WHEN id % 3 = 0 THEN double('NaN') ELSE -0.0D END AS d,
           cast(id % 2 AS float) - 1 AS f, cast(concat('b', id % 3) AS binary) AS b, timestamp_ntz'2024-01-01 00:00:00.000001' AS n,
           array(if(id % 5 = 0, null, '1:a'), '-') AS a, named_struct('x', -0.0D * (id % 2), 'y', if(id % 4 = 0, null, '')) AS s, if(id % 6 = 0, null, '-') AS z,
           cast(id % 3 AS decimal(20, 4)) AS m, date_add(date'2024-01-01', cast(id % 2 AS int)) AS e
    FROM range(400)
"""


@pytest.mark.parametrize("columns", [["t"], ["d"], ["f"], ["b"], ["n"], ["a"], ["s"], ["z"], ["m"], ["e"], ["d", "z"], ["a", "z", "t"], None])
def test_counts_agree_with_the_rows_kept(spark, columns):
    df = spark.sql(KINDS)
    groups = df.select(*(columns or [c for c in df.columns if c != "_row_id"])).distinct().count()
    kept = cleaning.exact_dedupe(df, columns)
    assert kept.columns == df.columns and kept.count() == groups
    assert tuple(cleaning.dedupe_counts(df, columns).first()) == (400, groups, 400 - groups)


def test_dedupe_by_some_columns_keeps_whole_first_rows(spark, rows):
    df = spark.createDataFrame([(4, "a", 1), (2, "a", 2), (3, "b", 3)], "_row_id bigint, s string, v int")
    assert rows(cleaning.exact_dedupe(df, ["s"])) == [(2, "a", 2), (3, "b", 3)]


def test_clean_strips_before_it_dedupes(spark, rows):
    c = Contract(fields=[Field("name", type="text"), Field("city", type="categorical")])
    df = spark.createDataFrame([(0, "Alice", "NYC"), (1, " Alice", "NYC"), (2, "Alce", "NYC")], "_row_id bigint, name string, city string")
    cleaned = cleaning.clean(df, c)
    assert rows(cleaned) == [(0, "Alice", "NYC"), (2, "Alce", "NYC")]
    assert neardup.near_duplicates_of(cleaned, c, 80).count() == 1


# -- ranks ------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 8])
def test_rank_is_global_and_consecutive(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(5000).select(F.col("id").alias("_row_id"), (F.col("id") * 7919 % 13).alias("v")).orderBy(F.rand(3))
        ranked, n = with_rank(df, [F.asc("v"), F.asc("_row_id")], "r")
        got = [(r["r"], r["_row_id"]) for r in ranked.orderBy("r").collect()]
        expected = sorted(range(5000), key=lambda i: (i * 7919 % 13, i))
        assert n == 5000 and got == list(enumerate(expected))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_row_ids_follow_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).coalesce(1).write.parquet(path)
    got = with_row_id(spark.read.parquet(path))
    assert got.where("id <> _row_id").count() == 0 and got.count() == 100


def test_discarded_tables_are_gone(spark, tmp_path):
    kept, gone = (materialize(spark.range(3), "t", str(tmp_path / name)) for name in ("kept", "gone"))
    discard(gone, kept.select("id"), spark.range(2))
    assert kept.count() == 3 and not (tmp_path / "gone").exists()


# -- similarity ---------------------------------------------------------------------


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        corner = 0
        for j, y in enumerate(b):
            corner, row[j + 1] = row[j + 1], corner + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def ratio(a, b):
    n = len(a) + len(b)
    return 100.0 if n == 0 else (1.0 - (n - 2 * common_length(a, b)) / n) * 100.0


def test_similarity_against_plain_dynamic_programming():
    pick = random.Random(7)
    texts = ["".join(pick.choice("abcé \U0001F600") for _ in range(pick.choice([0, 1, 5, 20, 63, 64, 65, 130, 300]))) for _ in range(40)]
    batch = TextBatch(texts)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(40)))
    exact = np.array([ratio(texts[i], texts[j]) for i, j in zip(a, b)])
    assert (batch.similarity(a, b) == exact).all()
    for cutoff in (40.0, 85.0):
        assert (exact[~batch.possible(a, b, cutoff)] < cutoff).all()
        cut = batch.similarity(a, b, cutoff)
        assert (cut[exact >= cutoff] == exact[exact >= cutoff]).all() and (cut[exact < cutoff] < cutoff).all()


def test_many_distinct_characters():
    texts = ["".join(chr(0x4E00 + (i * 37 + k) % 3000) for k in range(50)) for i in range(60)]
    batch = TextBatch(texts)
    assert batch.words is None
    a, b = np.arange(59), np.arange(1, 60)
    assert (batch.similarity(a, b) == [ratio(texts[i], texts[j]) for i, j in zip(a, b)]).all()


@pytest.mark.parametrize("words", [0, 2, 24])
def test_long_texts_against_plain_dynamic_programming(monkeypatch, words):
    """Words with carries, long integers in a band, and the leaving of pairs that cannot reach the cutoff."""
    monkeypatch.setattr(similarity, "_WORDS", words)
    pick = random.Random(4)

    def noisy(text, share):
        out = list(text)
        for _ in range(int(len(text) * share) + 1):
            at = pick.randrange(len(out) + 1)
            out[at:at] = pick.choice("abcdé日")
            if out and pick.random() < 0.5:
                out.pop(pick.randrange(len(out)))
        return "".join(out)

    base = ["".join(pick.choices("abcdefgh é", k=n)) for n in (0, 63, 64, 65, 127, 128, 129, 300, 700, 1100)]
    texts = base + [noisy(t, share) for t in base for share in (0.02, 0.1, 0.16, 0.3)] + ["a" * 900, "a" * 1000, "ab" * 450]
    batch = TextBatch(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if abs(len(texts[i]) - len(texts[j])) < 250]
    a, b = np.array(pairs).T
    exact = np.array([ratio(texts[i], texts[j]) for i, j in pairs])
    assert (batch.similarity(a, b) == exact).all()
    for cutoff in (50.0, 70.0, 85.0, 95.0):
        hit = exact >= cutoff
        cut = batch.similarity(a, b, cutoff)
        assert (cut[hit] == exact[hit]).all() and (cut[~hit] < cutoff).all()
        assert batch.possible(a, b, cutoff)[hit].all()


# -- near duplicates ------------------------------------------------------------------


def expected_pairs(records, columns, threshold, window):
    """By definition: rank distance within the window, some column different, similar enough."""
    def key(r):
        first = r[columns[0]]
        return (first is None, first or "", r["_row_id"])

    rank = {r["_row_id"]: i for i, r in enumerate(sorted(records, key=key))}
    text = {r["_row_id"]: " ".join(r[c] or "" for c in columns) for r in records}
    cells = {r["_row_id"]: tuple(r[c] for c in columns) for r in records}
    near = {(a, b) for a in rank for b in rank if 0 < rank[b] - rank[a] <= window and cells[a] != cells[b]}
    scored = {(a, b): ratio(text[a], text[b]) for a, b in near}
    return {(rank[a], rank[b], a, b, s) for (a, b), s in scored.items() if s >= threshold}


def test_near_pair(spark, rows):
    df = spark.createDataFrame([(0, "John Smith", "London"), (1, "John Smyth", "London"), (2, "Ann", "Rome")], "_row_id bigint, name string, city string")
    got = neardup.near_duplicates(df, ["name", "city"])
    assert rows(got, "row_a", "row_b") == [(0, 1)]
    assert rows(neardup.near_duplicate_diffs(got), "column", "value_a", "value_b") == [("name", "John Smith", "John Smyth")]
    assert neardup.near_duplicates(df, ["name", "city"], 99).count() == 0


def test_rows_equal_in_all_text_columns_are_no_pair(spark, rows):
    df = spark.createDataFrame([(0, "a b", "c"), (1, "a b", "c"), (2, "a", "b c"), (3, "a", None), (4, "a", None)], "_row_id bigint, p string, q string")
    assert rows(neardup.near_duplicates(df, ["p", "q"], 100.0), "row_a", "row_b") == [(2, 0), (2, 1)]


def test_no_text_columns_and_no_rows(spark):
    df = spark.createDataFrame([(0, "a")], "_row_id bigint, p string")
    assert neardup.near_duplicates(df, []).count() == 0
    assert neardup.near_duplicates(df.limit(0), ["p"]).count() == 0
    with pytest.raises(ValueError):
        neardup.near_duplicates(df.drop("_row_id"), ["p"])


@pytest.mark.parametrize("window, chunk, partitions", [(500, 1024, 8), (7, 16, 8), (50, 16, 1), (20, 20, 3)])
def test_near_duplicates_against_brute_force(spark, rows, window, chunk, partitions):
    pick = random.Random(11)
    cities = ["London", "Londen", None, "Paris"]
    records = []
    for i in range(240):
        # a third of the rows share one name
        name = "common name" if i % 3 == 0 else "".join(pick.choice("abcd") for _ in range(pick.choice([4, 8, 90]))) if i % 5 else None
        records.append({"_row_id": i, "name": name, "city": pick.choice(cities)})
    pick.shuffle(records)
    df = spark.createDataFrame([(r["_row_id"], r["name"], r["city"]) for r in records], "_row_id bigint, name string, city string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = neardup.near_duplicates(df, ["name", "city"], 70.0, window, chunk)
        assert rows(got.drop("diffs")) == sorted(expected_pairs(records, ["name", "city"], 70.0, window), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_chunks_of_long_texts_are_cut(spark, rows, monkeypatch):
    """A few bytes make a chunk: parts of any size give the same pairs."""
    pick = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta"]
    records = [{"_row_id": i, "name": " ".join(pick.choices(words, k=pick.choice([2, 3, 60])))} for i in range(150)]
    df = spark.createDataFrame([(r["_row_id"], r["name"]) for r in records], "_row_id bigint, name string")
    want = rows(neardup.near_duplicates(df, ["name"], 80.0, 20, 64))
    monkeypatch.setattr(neardup, "CHUNK_BYTES", 300)
    got = neardup.near_duplicates(df, ["name"], 80.0, 20, 64)
    assert rows(got) == want and len(want) > 20
    scored = expected_pairs(records, ["name"], 80.0, 20)
    assert {(r["row_a"], r["row_b"]) for r in got.collect()} == {(a, b) for _, _, a, b, _ in scored}


def test_near_duplicate_plan_has_no_single_task_and_no_pair_join(spark):
    df = spark.range(3000).select(F.col("id").alias("_row_id"), F.col("id").cast("string").alias("t"))
    plan = plan_of(neardup.near_duplicates(df, ["t"]))
    assert "SinglePartition" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_equal_texts_are_compared_once_and_candidates_together(monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghij klmnop") for _ in range(700)) for _ in range(30)]
    texts += [t[:350] + "Z" + t[350:] for t in texts]
    held = [t for t in texts for _ in range(4)]
    rng.shuffle(held)
    chunk = pd.DataFrame({"_row_id": range(240), "_rank": range(240), "c0": held, "_text": held, "_end": 200})
    sizes, calls = [], []
    prepared, parts = neardup.TextBatch.__init__, neardup.TextBatch.possible_by_parts
    monkeypatch.setattr(neardup, "_PAIRS", 500)
    monkeypatch.setattr(neardup.TextBatch, "__init__", lambda self, given: (sizes.append(len(given)), prepared(self, given))[1])
    monkeypatch.setattr(neardup.TextBatch, "possible_by_parts", lambda self, *given: (calls.append(given), parts(self, *given))[1])
    got = neardup._compare(chunk, ["c0"], 100, 85.0)
    stem = [t.replace("Z", "") for t in held]
    want = [(i, j) for i in range(200) for j in range(i + 1, min(i + 101, 240)) if held[i] != held[j] and stem[i] == stem[j]]
    assert sorted(zip(got["rank_a"], got["rank_b"])) == want
    assert sizes[0] == 60 and len(calls) == 1


def test_pairs_side_by_side_against_one_by_one(monkeypatch):
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab" if i % 3 else "abcdefgh") for _ in range(rng.choice([63, 64, 65, 128, 190, 256, 300]))) for i in range(60)]
    texts += [t[: len(t) // 2] + "c" + t[len(t) // 2 :] for t in texts]
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(120) for j in range(i + 1, 120)]))
    got = []
    for many in (16, 1 << 30):
        monkeypatch.setattr(similarity, "_MANY", many)
        for cutoff in (0.0, 85.0):
            s = similarity.TextBatch(texts).similarity(a, b, cutoff)
            got.append(np.where(s >= cutoff, s, 0.0))
    assert np.array_equal(got[0], got[2]) and np.array_equal(got[1], got[3])


@pytest.mark.parametrize("table", [1, 1 << 22])
def test_pairs_side_by_side_stay_in_a_band_and_are_left_early(monkeypatch, table):
    rng = random.Random(12)
    alone = ["".join(rng.choices("abcdefgh ijklé", k=rng.randrange(1500, 1700))) for _ in range(24)]
    copies = [t[:200] + "x" * (5 * i) + t[300 + 7 * i :] for i, t in enumerate(alone)]
    monkeypatch.setattr(similarity, "_TABLE", table)
    batch = TextBatch(alone + copies)
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(48) for j in range(i + 1, 48)]))
    related = b == a + 24
    worked, go_on = [], TextBatch._go_on

    def noted(self, state, x, y, first, end, low, high):
        worked.append((high, end - first, set(zip(x.tolist(), y.tolist()))))
        go_on(self, state, x, y, first, end, low, high)

    monkeypatch.setattr(TextBatch, "_go_on", noted)
    got = batch.similarity(a, b, 85.0)
    assert max(words for _, words, _ in worked) < 14  # of 27
    near = {(i, i + 24) for i in range(24)} | {(i + 24, i) for i in range(24)}
    assert worked and not any(pairs - near for high, _, pairs in worked if high > 900)
    monkeypatch.setattr(similarity, "_MANY", 1 << 30)
    exact = batch.similarity(a[related], b[related])
    assert ((got >= 85) == (related & (got >= 85))).all() and (exact >= 85).sum() == (got >= 85).sum() > 8
    assert (got[related][exact >= 85] == exact[exact >= 85]).all()
    monkeypatch.setattr(similarity, "_PARTED", 256)
    assert batch.possible_by_parts(a, b, 85.0)[got >= 85].all()


def test_marks_of_counts_drop_no_pair_and_spare_the_counts(monkeypatch):
    rng = random.Random(11)
    texts = ["".join(rng.choice("aabbccddeeé0123456789xyzXYZ ÄÖÜäöü!?-+*/()[]") for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [t[:5] + "aaaaaa" + t[9:] for t in texts]
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(120) for j in range(i + 1, 120)]))
    batch = TextBatch(texts)
    exact = batch.similarity(a, b)
    for cutoff in (30.0, 60.0, 85.0):
        assert not (exact[~batch.possible(a, b, cutoff)] >= cutoff).any()
    counted = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            counted.append(np.size(at))
            return np.asarray(self)[at]

    batch.counts = batch.counts.view(Counted)
    batch.possible_by_counts(a, b, 85.0)
    assert max(counted) < len(a) / 10


def test_cells_of_pairs_stay_arrow(spark, monkeypatch):
    df = spark.createDataFrame([(0, "abcdefgh", None), (1, "abcdefgx", "y"), (2, "zzz", "y")], "_row_id bigint, p string, q string")
    got = neardup.near_duplicates(df, ["p", "q"], 70.0)
    assert "FlatMapGroupsInArrow" in plan_of(got)
    assert [(r["column"], r["value_a"], r["value_b"]) for r in got.first()["diffs"]] == [("p", "abcdefgh", "abcdefgx"), ("q", None, "y")]
