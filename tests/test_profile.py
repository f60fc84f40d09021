import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from contractframe.operators import profile

NOW = datetime.datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(0, 1, "a", 1.5, True, None), (1, 2, "bb", float("nan"), False, None), (2, 3, "a", 2.5, True, None), (3, 3, None, 2.0, None, None)],
        "_row_id bigint, id int, name string, score double, ok boolean, nothing string",
    )


def one(df, column):
    return df.where(F.col("column") == column).first()


def test_counts(small):
    assert tuple(profile.profile_table(small).first()) == (4, 5)
    nulls = {r["column"]: (r["null_count"], r["null_pct"]) for r in profile.profile_nulls(small).collect()}
    assert nulls == {"id": (0, 0.0), "name": (1, 25.0), "score": (1, 25.0), "ok": (1, 25.0), "nothing": (4, 100.0)}


def test_distinct(small, rows):
    assert rows(profile.profile_distinct(small)) == [("id", 3), ("name", 2), ("nothing", 0), ("ok", 2), ("score", 3)]
    assert rows(profile.profile_distinct(small, approximate=True)) == [("id", 3), ("name", 2), ("nothing", 0), ("ok", 2), ("score", 3)]


def test_numeric_columns_include_booleans(small):
    got = profile.profile_numeric(small)
    assert tuple(one(got, "score"))[1:] == (1.5, 2.5, 2.0, 0.5)
    assert one(got, "ok")["max_value"] == 1.0 and one(got, "name") is None


def test_one_value_has_no_spread(spark):
    assert profile.profile_numeric(spark.createDataFrame([(5,)], "v int")).first()["std_value"] == 0.0


def test_text_lengths(small, rows):
    assert rows(profile.profile_lengths(small)) == [("name", 1, 2)]


def test_top_values_ties_go_to_the_first_seen(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate("zyxwvuzy")], "_row_id bigint, v string")
    got = profile.profile_top_values(df)
    assert [(r["value"], r["n"]) for r in got.orderBy("rank").collect()] == [("z", 2), ("y", 2), ("x", 1), ("w", 1), ("v", 1)]


def test_long_texts_come_back_whole(spark):
    long = ["x" * 5000 + str(i) for i in range(3)]
    df = spark.createDataFrame([(0, long[1]), (1, long[0]), (2, long[1]), (3, "short")], "_row_id bigint, v string")
    got = [(r["value"], r["n"]) for r in profile.profile_top_values(df).orderBy("rank").collect()]
    assert got == [(long[1], 2), (long[0], 1), ("short", 1)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [r["null_pct"] for r in profile.profile_nulls(df).collect()] == [0.0, 0.0]
    assert profile.profile_top_values(df).count() == 0


def test_full_profile(small):
    got = {r["column"]: r for r in profile.profile_full(small, F.lit(NOW)).collect()}
    assert set(got) == {"id", "name", "score", "ok", "nothing"}
    assert [tuple(x) for x in got["name"]["top_values"]] == [("a", 2), ("bb", 1)]
    assert got["nothing"]["distinct_count"] == 0 and got["nothing"]["top_values"] is None


@pytest.mark.parametrize("age, threshold, stale", [(1, 90, False), (10, 90, False), (120, 90, True), (30, 20, True), (30, 60, False)])
def test_freshness(spark, age, threshold, stale):
    newest = datetime.datetime(2024, 6, 1, tzinfo=datetime.timezone.utc) - datetime.timedelta(days=age)
    df = spark.createDataFrame([(newest,), (newest - datetime.timedelta(days=4),), (None,)], "ts timestamp")
    got = profile.freshness(df, F.lit("2024-06-01 00:00:00").cast("timestamp"), threshold).first()
    assert (got["span_days"], got["staleness_days"], got["is_stale"]) == (4.0, float(age), stale)


def test_freshness_skips_empty_and_other_columns(spark):
    df = spark.createDataFrame([(None, "a")], "ts timestamp_ntz, s string")
    assert profile.freshness(df, F.lit(NOW)).count() == 0
    assert profile.freshness(df.drop("ts"), F.lit(NOW)).count() == 0


def test_redacted_top_values(spark, rows):
    df = spark.createDataFrame(
        [(0, "a@b.co", 1.0), (1, "a@b.co", 2.0), (2, "x", 3.0), (3, "Mary Lee", 4.0)], "_row_id bigint, contact string, amount double")
    top = profile.profile_top_values(df)
    got = rows(profile.redact_top_values(top).where("column = 'contact'"), "rank", "value", "n")
    assert got == [(1, "[REDACTED_EMAIL_1]", 2), (2, "x", 1), (3, "[REDACTED_PERSON_NAME_2]", 1)]
    assert rows(profile.scan_top_values(top)) == [
        ("profile.columns.contact.top_values", "email", "a@b.co"), ("profile.columns.contact.top_values", "person_name", "Mary Lee")]
    assert profile.redact_top_values(top).where("column = 'amount' and value like '%REDACTED%'").count() == 0


def test_value_counts_keep_nulls(spark, rows):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert rows(profile.value_counts(df, "v")) == [("a", 2), (None, 1)]


def test_top_values_are_cut_before_the_shuffle(small):
    plan = plan_of(profile.profile_top_values(small))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "SinglePartition" not in plan


def test_distinct_and_top_values_share_their_shuffles(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").alias("_row_id"), (F.col("id") % 10).alias("v")).write.parquet(path)
    freq = profile.value_frequencies(spark.read.parquet(path))
    both = profile.distinct_of(freq).join(profile.top_of(freq, spark.read.parquet(path)), "column")
    both.collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "ReusedExchange" in plan_of(profile.distinct_of(freq).join(profile.top_of(freq, spark.read.parquet(path)), "column"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_long_texts_without_row_ids(spark):
    df = spark.createDataFrame([("x" * 500,), ("y",), ("x" * 500,)], "v string")
    assert [(r["value"], r["n"]) for r in profile.profile_top_values(df).orderBy("rank").collect()] == [("x" * 500, 2), ("y", 1)]


def test_all_kinds_of_columns_are_counted_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "kinds")
    spark.range(100).select(
        F.col("id").alias("_row_id"), "id", F.col("id").cast("string").alias("s"), (F.col("id") / 3).alias("d"), (F.col("id") > 5).alias("b"),
        F.current_timestamp().alias("t"), F.current_date().alias("day"), F.col("id").cast("decimal(9,2)").alias("m"),
    ).write.parquet(path)
    freq = profile.value_frequencies(spark.read.parquet(path))
    plan = plan_of(freq)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    counts = {r["column"]: r["n"] for r in freq.groupBy("column").agg(F.count("*").alias("n")).collect()}
    assert counts == {"id": 100, "s": 100, "d": 100, "b": 2, "t": 1, "day": 1, "m": 100}
