"""The pipeline's stages: each one's decisions against the operator alone, and planted rows through all of them."""

import pytest

import corpus_pipeline
from contractframe.llm.common import table

SF = "/root/testdata/sf0.001"
MINE, OTHER = (" ".join(f"{x}{i}" for i in range(150)) for x in ("mine", "other"))


@pytest.fixture(scope="module")
def docs(spark):
    documents = table(spark, SF, "documents")
    bench = table(spark, SF, "benchmark").orderBy("item_id").first()["text"]
    clean = " ".join(f"word{i}" for i in range(80))
    passage = " ".join(f"shared{i}" for i in range(60))
    own = [
        (900001, clean, "en", "s", len(clean)), (900002, clean, "en", "s", len(clean)), (900003, clean.replace("word40 ", ""), "en", "s", 1),
        (900004, MINE + " " + passage + " four", "en", "s", 1), (900005, passage + " " + OTHER, "en", "s", 1),
        (900006, "before " + bench + " after", "en", "s", 1), (900007, None, None, None, None), (900008, "", "en", "s", 0),
    ]
    planted = spark.createDataFrame(own, documents.schema)
    return documents.where("doc_id < 100").unionByName(planted).cache()


def test_stages(spark, docs):
    kept = docs
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns, name
        rows[name] = {r["doc_id"]: r for r in kept.collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    assert {900001, 900004, 900005, 900007, 900008} <= set(rows["toxicity"])
    near = rows["near duplicates"]
    assert 900001 in near and 900002 not in near and 900003 not in near and {900004, 900007, 900008} <= set(near)
    cut = rows["substring dedup"]
    assert set(cut) == set(near)
    assert cut[900004]["text"] == f"{MINE} four" and cut[900005]["text"] == OTHER
    assert cut[900001] == before[900001] and cut[900007] == before[900007]
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in cut.values() if r["doc_id"] < 900000)
    clean = rows["decontamination"]
    assert 900006 not in clean and {900001, 900004, 900007, 900008} <= set(clean)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r["doc_id"] for r in last} == set(clean)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns)
    ends = got.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in ends) <= 1024
