"""The stages of the pipeline, each against plain Python on what it was given."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from narrata.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def columns(df):
    return [(c, t) for c, t in df.dtypes]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = columns(docs)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    inputs = []
    for name, step in corpus_pipeline.STAGES:
        inputs.append((name, [(r.doc_id, r.text) for r in docs.collect()]))
        docs = stage(step(spark, docs, SF))
        if name != "sentence_pieces":
            assert columns(docs) == names
    given = dict(inputs)
    assert [n for n, _ in inputs] == ["language_id", "near_duplicates", "repeated_strings", "benchmark_passages", "sentence_pieces"]
    lettered = {d for d, t in given["language_id"] if t and any(c.isalpha() for c in t)}
    assert {d for d, _ in given["near_duplicates"]} <= lettered and len(given["near_duplicates"]) >= len(lettered) - 2
    want = {w[0] for w in brute.near_duplicates(given["near_duplicates"], size=5) if w[3]}
    assert {d for d, _ in given["repeated_strings"]} == want
    kept = {w[0]: w for w in brute.repeated_bytes(given["repeated_strings"])}
    for d, t in given["benchmark_passages"]:
        assert len((t or "").encode()) >= kept[d][1] - kept[d][2] and (kept[d][2] or dict(given["repeated_strings"])[d] == t)
    clean = {w[0] for w in brute.decontaminate(given["benchmark_passages"], items) if not w[5]}
    assert {d for d, _ in given["sentence_pieces"]} == clean
    assert {r.doc_id for r in docs.collect()} == clean and docs.filter("not exact").count() == 0


@pytest.mark.parametrize("empty", ["rows"])
def test_empty_documents(spark, empty):
    docs = table(spark, SF, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF))
    assert docs.count() == 0


def test_awkward_documents(spark):
    docs = table(spark, SF, "documents")
    few = docs.filter("doc_id < 60")
    more = few.filter("doc_id < 3").selectExpr("doc_id + 100000 AS doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(None, "a text without an id but with words of its own to keep", "en", "s", 1), (200000, None, None, None, None), (200001, "", "en", "s", 0), (200002, "123 456", "en", "s", 7)], docs.schema)
    clash = {"_gone": F.lit(1), "_id": F.lit(2), "_key": F.lit(3), "_at": F.lit(4), "key": F.lit(5)}
    rows = few.unionByName(few.filter("doc_id = 5")).unionByName(more).unionByName(odd).withColumns(clash)
    for name, step in corpus_pipeline.STAGES[:-1]:
        names = rows.columns
        rows = stage(step(spark, rows, SF))
        assert rows.columns == names
    ids = {r.doc_id for r in rows.collect()}
    assert not ids & {100000, 100001, 100002, 200000, 200001, 200002}
    assert {(r._gone, r._id, r._key, r._at, r.key) for r in rows.collect()} == {(1, 2, 3, 4, 5)}
