import json

import pytest
from pyspark.sql import functions as F

from narrata.operators import profiling as P
from narrata.operators.tfidf import WORD_UNIGRAMS, FeatureSpec
from narrata.sources import artifacts as A
from narrata.sources import pages as PG
from narrata.sources import tables as TB
from narrata.sources import taxonomy as TX
from narrata.streaming import ingest


@pytest.mark.parametrize("columns, text, category, id", [
    (["Complaint ID", "Product", "Consumer Complaint", "Issue"], "Consumer Complaint", "Product", "Complaint ID"),
    (["Complaint ID", "Product", "Consumer complaint narrative"], "Consumer complaint narrative", "Product", "Complaint ID"),
    (["complaint_id", "product", "complaint_what_happened"], "complaint_what_happened", "product", "complaint_id"),
])
def test_roles(columns, text, category, id):
    assert TB.resolve_columns(columns) == {"text": text, "category": category, "id": id}


def test_missing_roles():
    with pytest.raises(ValueError):
        TB.resolve_columns(["Product"])
    with pytest.raises(ValueError):
        TB.resolve_columns(["text"])
    assert "id" not in TB.resolve_columns(["text", "category"])


def test_summary(spark):
    df = spark.createDataFrame([(1, "A", "some text"), (2, None, "more"), (3, "B", ""), (4, "B", " \n ")],
                               "`Complaint ID` int, Product string, `Consumer Complaint` string")
    s = P.dataset_summary(df, "Consumer Complaint", "Product", "Complaint ID").first()
    assert (s["missing_text_count"], s["missing_category_count"], s["usable_rows_count"]) == (2, 1, 1)


def test_csv(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('Complaint ID,Product,Consumer Complaint\n1,Mortgage,"line one\nline ""two"""\n2,Credit card,\n3,,text\n')
    df = TB.load_csv(spark, path, header_schema=True)
    assert df.count() == 3 and df.filter("complaint_id = '1'").first()["text"] == 'line one\nline "two"'
    assert TB.load_csv(spark, path, header_schema=True, invalid_rows=False).count() == 1
    assert TB.load_csv(spark, path, nrows=2, header_schema=True).count() == 2
    with pytest.raises(FileNotFoundError):
        TB.load_csv(spark, str(tmp_path / "none.csv"))
    empty = str(tmp_path / "e.csv")
    open(empty, "w").write("Product,Consumer Complaint\n")
    with pytest.raises(ValueError):
        TB.load_csv(spark, empty, header_schema=True)
    with pytest.raises(ValueError):
        TB.load(spark, "xml", path)


def test_full_schema_csv(spark, tmp_path):
    path = str(tmp_path / "full.csv")
    open(path, "w").write(",".join(TB.CSV_COLUMNS) + "\n" + ",".join(f"v{i}" for i in range(19)) + "\n")
    df = TB.load_csv(spark, path)
    assert df.first()["text"] == "v6" and "Unnamed: 18" not in TB.drop_junk_columns(df).columns


def hit(id, text, product="Credit card", own=True):
    source = {"product": product, "complaint_what_happened": text, "date_received": "2024-01-15T12:00:00.000Z", "issue": "i"}
    if own:
        source["complaint_id"] = id
    return {"_index": "x", "_id": "h" + id, "_source": source}


def land(folder, pages):
    folder.mkdir(exist_ok=True)
    for i, hits in enumerate(pages):
        (folder / f"p{i}.json").write_text(json.dumps({"hits": {"hits": hits}}, indent=1))


def test_pages(spark, tmp_path):
    land(tmp_path / "in", [[hit("1", " a "), hit("2", None, "")], [hit("1", "a"), hit("3", "c", own=False)], []])
    path = str(tmp_path / "in")
    rows = TB.load(spark, "pages", path).collect()
    assert [(r["complaint_id"], r["category"], r["text"]) for r in rows] == [
        ("1", "Credit card", "a"), ("2", "Unspecified", ""), ("1", "Credit card", "a"), ("h3", "Credit card", "c")]
    assert rows[0].asDict().keys() == set(PG.COLUMNS)
    assert TB.load(spark, "pages", path, max_records=3, drop_empty=True).count() == 3
    with pytest.raises(ValueError):
        TB.load(spark, "pages", path, max_records=0)
    none = TB.load(spark, "pages", path, product="Mortgage")
    assert none.count() == 0 and tuple(none.columns) == PG.COLUMNS


def test_stream_equals_batch(spark, tmp_path):
    land(tmp_path / "in", [[hit("1", "late fee"), hit("2", "b")], [hit("1", "late fee"), hit("3", "")]])
    path = str(tmp_path / "in")
    ingest.write_records(ingest.read_pages(spark, path, 1), str(tmp_path / "out"), str(tmp_path / "s1")).awaitTermination()
    key = ["complaint_id", "category", "text"]
    batch = TB.load(spark, "pages", path, max_records=None)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).select(*key).collect()) == sorted(batch.select(*key).collect())
    once = ingest.drop_repeats(ingest.read_pages(spark, path))
    ingest.write_records(once, str(tmp_path / "once"), str(tmp_path / "s2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "once")).count() == 3
    ingest.score_stream(ingest.read_pages(spark, path), lambda d: d.select("complaint_id", F.length("text").alias("n")),
                        str(tmp_path / "scored"), str(tmp_path / "s3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "scored")).count() == 3


def test_taxonomy_values(spark):
    assert len(TX.CONSERVATIVE) == len(TX.BROAD) == 18
    assert len(set(TX.CONSERVATIVE.values())) == 11 and len(set(TX.BROAD.values())) == 10
    loaded = TX.load_taxonomy(spark, f"{TX.CONFIG}/sources_narrow.json")
    assert {r["category"]: r["normalized_category"] for r in loaded.collect()} == TX.read_config("sources_narrow")
    told = {r["category"]: r for r in TX.taxonomy_entries(spark, f"{TX.CONFIG}/sources_narrow.json").collect()}
    assert told["src0"].source == "release notes" and told["src0"].rationale.startswith("src0") and told["src19"].rationale is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nb')], "id int, text string")
    for kind in ("parquet", "json", "csv"):
        TB.save(df, str(tmp_path / kind), kind)
    assert spark.read.parquet(str(tmp_path / "parquet")).first()["text"] == 'a "q"\nb'
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv")).first()["text"] == 'a "q"\nb'
    with pytest.raises(ValueError):
        TB.save(df, str(tmp_path / "x"), "orc2")


def test_selection_round_trip(spark, tmp_path):
    spec = FeatureSpec(word=WORD_UNIGRAMS, text_stats=True)
    A.save_selection(spark, str(tmp_path / "sel"), spec, {"kind": "logistic", "C": 2.0}, {"macro_f1": 0.5})
    got, clf, m = A.load_selection(spark, str(tmp_path / "sel"))
    assert got == spec and clf["C"] == 2.0 and m["macro_f1"] == 0.5
    with pytest.raises(FileNotFoundError):
        A.load_selection(spark, str(tmp_path / "nothing"))


def test_open_cells(spark):
    grid = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert [r["k"] for r in A.open_cells(grid, grid.filter("k = 'a'"), ["k", "v"]).collect()] == ["b"]


def test_staged_tables_are_released_and_changed_inputs_noticed(spark, tmp_path):
    import os

    from narrata.plans import registry
    from narrata.session import stage, staging_root

    before = set(os.listdir(staging_root(spark)))
    spark.range(3).write.parquet(f"{tmp_path}/in/t.parquet")
    build = lambda: stage(registry.table(spark, f"{tmp_path}/in", "t"))
    assert registry.shared(spark, f"{tmp_path}/in", "t", build).count() == 3
    assert registry.shared(spark, f"{tmp_path}/in", "t", build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/in/t.parquet")
    assert registry.shared(spark, f"{tmp_path}/in", "t", build).count() == 5
    assert len(set(os.listdir(staging_root(spark))) - before) == 2
    assert registry.forget(spark) >= 2 and not set(os.listdir(staging_root(spark))) - before


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_scan_over_byte_ranges(spark, tmp_path, end):
    """Small ranges cut records, quoted line ends and one record of many ranges; the rows are those of a whole read."""
    from narrata.sources import csv_scan

    texts = ["plain", "two\nlines", 'say "hi"\n\n"', "", None, "a,b", "\nstarts", '"', "long\n" * 300, "x" * 700, "Größe\n漢字", " \n "] * 3
    quoted = ["" if t is None else '""' if t == "" else '"' + t.replace('"', '""') + '"' for t in texts]
    for name, part in (("a.csv", range(20)), ("b.csv", range(20, len(texts)))):
        with open(tmp_path / name, "w", encoding="utf-8", newline="") as f:
            f.write(end.join(["id,text", *[f"{i},{quoted[i]}" for i in part]]) + (end if name == "a.csv" else ""))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (257, 1 << 20):
            for k in old:
                spark.conf.set(k, str(size))
            got = csv_scan.scan(spark, str(tmp_path))
            assert sorted((int(r["id"]), r["text"]) for r in got.collect()) == [(i, t or None) for i, t in enumerate(texts)]  # quoted or not, empty is null, as in the whole read
            if size == 257:
                assert csv_scan.physical_lines(spark, str(tmp_path)).select("range").distinct().count() > 10
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert TB.load_csv(spark, str(tmp_path / "a.csv"), schema=got.schema, canonical=False, splittable=True).count() == 20
    with pytest.raises(ValueError):
        csv_scan.scan(spark, str(tmp_path), TB.CSV_SCHEMA)


def test_late_and_undated_records_of_a_stream(spark, tmp_path):
    def dated(id, day):
        h = hit(id, "t")
        h["_source"]["date_received"] = day
        return h

    batches = [[dated("1", "2024-01-01"), dated("2", None)], [dated("1", "2024-01-01"), dated("3", "2024-03-01"), dated("2", "soon")],
               [dated("4", "2024-02-28"), dated("5", "2024-01-02")], [dated("5", "2024-01-02"), dated("3", "2024-03-01")]]
    folder = tmp_path / "in"
    folder.mkdir()
    unique, other = None, None
    for i, hits in enumerate(batches):  # each landing is taken before the next comes, so that the watermark is known
        (folder / f"p{i}.json").write_text(json.dumps({"hits": {"hits": hits}}))
        unique, other = ingest.write_unique(ingest.read_pages(spark, str(folder), 1), str(tmp_path / "out"), str(tmp_path / "state"))
        unique.awaitTermination(), other.awaitTermination()
        if i == 2:
            assert ingest.late_rows(unique) == 1
    # 5 comes on a day more than a week behind the first of March; 4 does not
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out" / "unique")).select("complaint_id").collect()) == ["1", "3", "4"]
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out" / "undated")).select("complaint_id").collect()) == ["2", "2"]
