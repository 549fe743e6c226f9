import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from narrata.operators import bayes as B
from narrata.operators import errors as E
from narrata.operators import evaluation as EV
from narrata.operators import linear as LN
from narrata.operators import lookup as L
from narrata.operators import ranking as R
from narrata.operators import similarity as SIM
from narrata.operators import splits as SP
from narrata.operators import temporal
from narrata.operators import tfidf as V
from narrata.operators.taxonomy import information_loss
from narrata.plans import search
from narrata.sources import artifacts as A
from narrata.sources.taxonomy import mapping_table


def docs(spark, texts, labels=None):
    rows = [(i, t, (labels or [""] * len(texts))[i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


# ---- ranks and quantiles ----


@pytest.mark.parametrize("values", [[0.5] * 50 + [0.1, 0.9], list(np.linspace(0, 1, 101)), [0.999999 + i * 1e-12 for i in range(300)], [3.0]])
def test_quantiles(spark, values):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    got = R.quantiles(df, "g", "v", [0.0, 0.25, 0.5, 0.9, 1.0])["g"]
    np.testing.assert_allclose(got, np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]), rtol=0, atol=1e-15)


def test_order_statistics_of_integers(spark):
    ids = [7, 7, 7, -5, 2**40, 12, 0]
    df = spark.createDataFrame([(0, v) for v in ids], "g int, v bigint")
    got = R.order_statistics(df, "g", "v", {0: range(1, 8)})
    assert [got[0, k] for k in range(1, 8)] == sorted(ids)


def test_quantiles_of_counts(spark):
    values = [1, 1, 2, 5, 9, 9, 9, 30]
    c = spark.createDataFrame([("a", v) for v in values], "k string, v int").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = R.quantiles_of_counts(c, ["k"], "v", "n", [0.1, 0.5, 0.99]).first()
    np.testing.assert_allclose([got["q0"], got["q1"], got["q2"]], np.quantile(values, [0.1, 0.5, 0.99]))


# ---- splits ----


def test_nested_split_sizes(spark):
    df = spark.range(500).withColumn("c", (F.col("id") % 5).cast("string"))
    out = SP.mark_train_val_test(df, "id", "c")
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 320, "val": 80, "test": 100}
    per = out.groupBy("split", "c").count().collect()
    assert {(r["split"], r["count"]) for r in per} == {("train", 64), ("val", 16), ("test", 20)}
    assert {r["leaked_ids"] for r in SP.split_overlap(out, "id").collect()} == {0}


def test_split_fallback_and_errors(spark):
    df = spark.createDataFrame([(i, "only" if i == 0 else "many") for i in range(20)], "id bigint, c string")
    out = SP.mark_split(df, "id", "c")
    assert out.filter("split = 'test'").count() == 4 and out.count() == 20
    with pytest.raises(TypeError):
        SP.mark_split(None, "id", "c")
    with pytest.raises(ValueError):
        SP.mark_split(df.limit(0), "id", "c")
    counts = spark.createDataFrame([("a", 5), ("b", 5)], "c string, n bigint")
    assert {r["c"]: r["quota"] for r in SP.test_quotas(counts, "c", 10, SP.test_rows(10, 0.25)).collect()} == {"a": 2, "b": 1}


def test_split_counts_null_as_a_class(spark):
    labels = [None] * 30 + ["a"] * 41 + ["b"] * 29
    out = SP.mark_split(spark.createDataFrame(list(enumerate(labels)), "id bigint, c string"), "id", "c", 0.2)
    assert {r["c"]: r["n"] for r in out.filter("split = 'test'").groupBy("c").agg(F.count("*").alias("n")).collect()} == {None: 6, "a": 8, "b": 6}
    tied = SP.mark_split(spark.createDataFrame(list(enumerate([None] * 5 + ["a"] * 5)), "id bigint, c string"), "id", "c", 0.25)
    assert {r["c"]: r["n"] for r in tied.filter("split = 'test'").groupBy("c").agg(F.count("*").alias("n")).collect()} == {None: 2, "a": 1}


def test_split_quotas_of_many_classes_are_not_ranked_in_one_task(spark):
    # two rows a class, and a few larger ones and null, so that many classes tie at the cut
    sizes = {f"c{i:04d}": 2 for i in range(400)} | {None: 2, "x": 7, "y": 9, "z": 30}
    n, n_test = sum(sizes.values()), SP.test_rows(sum(sizes.values()), 0.5 + 1e-3)
    counts = spark.createDataFrame(list(sizes.items()), "c string, n bigint").repartition(4)
    for test in (n_test, n // 2, n * 7 // 10, n // 5 + 200):
        order = sorted(sizes, key=lambda c: (-(test * sizes[c] % n), c is not None, c or ""))
        spare = test - sum(test * m // n for m in sizes.values())
        want = {c: test * m // n + (c in order[:spare]) for c, m in sizes.items()}
        quotas = SP.test_quotas(counts, "c", n, test)
        assert {r["c"]: r["quota"] for r in quotas.collect()} == want and sum(want.values()) == test
        assert "Window" not in quotas._jdf.queryExecution().optimizedPlan().toString()


def test_chronological_split_with_one_hot_day(spark):
    df = spark.createDataFrame([(i, "2020-01-01" if i < 90 else f"2020-01-{i - 88:02d}") for i in range(100)], "id bigint, d string")
    out = SP.mark_chronological(df, "id", "d", 0.5)
    assert [r["id"] for r in out.filter("split = 'train'").orderBy("id").collect()] == list(range(50))
    back = SP.mark_chronological(df, "id", "d", 0.8, newest_first=True)
    assert back.filter("split = 'val'").agg(F.max("id")).first()[0] == 19


# ---- features ----


def test_min_df_and_bigrams(spark):
    d = docs(spark, ["recurring_term one", "recurring_term two different_term", "different_term recurring_term rare_term", "x"])
    v = V.fit_vocabulary(d, V.Block("word", (1, 2), min_df=2))
    assert {r["term"] for r in v.collect()} == {"recurring_term", "different_term"}
    terms = {r["term"] for r in V.fit_vocabulary(d, V.Block("word", (1, 2))).collect()}
    assert "recurring_term two" in terms and "x" not in terms


def grams_of_char_wb(text, low, high):
    out = []
    for w in text.split():
        w = f" {w} "
        for n in range(low, high + 1):
            out.append(w[:n])
            out += [w[i:i + n] for i in range(1, len(w) - n + 1)]
            if len(w) <= n:
                break
    return out


@pytest.mark.parametrize("analyzer", ["word", "char", "char_wb"])
def test_weights_against_formula(spark, analyzer):
    texts = ["late fee on card card", "card dispute fee", "mortgage escrow error a", "fee", "loan loan loan", ""]
    block = V.Block(analyzer, (1, 2) if analyzer == "word" else (3, 5), sublinear_tf=True)

    def grams(t):
        if analyzer == "word":
            w = [x for x in t.split() if len(x) > 1]
            return w + [" ".join(p) for p in zip(w, w[1:])]
        if analyzer == "char":
            return [t[i:i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1)]
        return grams_of_char_wb(t, 3, 5)

    bags = [grams(t) for t in texts]
    df = {}
    for b in bags:
        for g in set(b):
            df[g] = df.get(g, 0) + 1
    want = {}
    for i, b in enumerate(bags):
        raw = {g: (1 + math.log(b.count(g))) * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g in set(b)}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        want.update({(i, g): x / norm for g, x in raw.items()})
    _, w = V.fit_transform(docs(spark, texts), block)
    got = {(r["doc_id"], r["term"]): r["w"] for r in w.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


def test_char_grams_are_counted_in_batches(spark):
    texts = ["ab ab\x00", "", "a", "\U0001f600b\U0001f600b\U0001f600", "abab", "".join(chr(0x4e00 + i) for i in range(9000)) + "ab"]
    assert list(V.chunks(["aaa", "b", "cccccc", "", "d"], 4)) == [(0, 2), (2, 3), (3, 5)]
    for part in (texts[:5], texts):  # the whole alphabet is too large to pack
        for n in (1, 3, 5):
            rows, grams, tf, names = V.char_gram_counts(part, n)
            want = {(i, t[j:j + n]): 0 for i, t in enumerate(part) for j in range(len(t) - n + 1)}
            for i, t in enumerate(part):
                for j in range(len(t) - n + 1):
                    want[i, t[j:j + n]] += 1
            assert {(i, names[g]): c for i, g, c in zip(rows.tolist(), grams.tolist(), tf.tolist())} == want
    block = V.Block("char", (3, 5))
    d = docs(spark, texts[:5])
    plan = V.term_counts(d, block)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan  # no gram passes through an interpreted lambda
    plan = V.transform(d, V.fit_vocabulary(d, block), block)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1  # the texts; their terms stay with them
    twice = d.unionByName(d)
    got = {(r["doc_id"], r["term"]): r["tf"] for r in V.term_counts(twice, block).collect()}
    assert got == {(r["doc_id"], r["term"]): 2 * r["tf"] for r in V.term_counts(d, block).collect()}
    assert {(r["term"], r["df"], r["cf"]) for r in V.fit_vocabulary(twice, block).collect()} == {(r["term"], r["df"], 2 * r["cf"]) for r in V.fit_vocabulary(d, block).collect()}


@pytest.mark.parametrize("analyzer", ["word", "char_wb"])
def test_terms_of_parts_meet_the_vocabulary(spark, monkeypatch, analyzer):
    """The cells of a part are weighed where they are, by a vocabulary that is sent or one that is joined with the terms of each part."""
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["card", "fee", "late", "\u00fcber", "x", "loan"], int(rng.integers(0, 9)))) for _ in range(60)]
    d = spark.createDataFrame([(i % 50 if i % 50 else None, t, f"l{i % 2}") for i, t in enumerate(texts)], "doc_id bigint, text string, label string")  # ids repeat, some are null
    block = V.Block(analyzer, (1, 3) if analyzer == "word" else (2, 4), min_df=2, sublinear_tf=True)
    voc = V.fit_vocabulary(d, block)
    counts = {}
    for r in V.term_counts(d, block, carry=("label",)).collect():
        counts[r["doc_id"], r["label"], r["term"]] = r["tf"]
    idf = {r["term"]: r["idf"] for r in voc.collect()}
    raw = {k: (1 + math.log(n)) * idf[k[2]] for k, n in counts.items() if k[2] in idf}
    norm = {}
    for (i, _, _), x in raw.items():
        norm[i] = norm.get(i, 0.0) + x * x
    want = {k: pytest.approx(x / math.sqrt(norm[k[0]]), abs=1e-12) for k, x in raw.items()}
    ids = sorted(r["term_id"] for r in voc.collect())
    assert ids == list(range(len(ids)))
    for sent in (1 << 20, 0):
        monkeypatch.setattr(V, "SENT_TERMS", sent)
        monkeypatch.setattr(V, "PART_CHARS", dict.fromkeys(V.PART_CHARS, 150))
        monkeypatch.setattr(V, "BATCH_CELLS", 40)
        w = V.transform(d, voc, block, carry=("label",), extra=("term_id",))
        assert {(r["doc_id"], r["label"], r["term"]): r["w"] for r in w.collect()} == want
        plan = w._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and ("Join" in plan) == (sent == 0)  # no cell is moved to be normalised
        few = V.transform(d, voc, block, carry=("label",), best=2)
        assert few.count() < w.count()
        top = [sorted(map(tuple, V.top_features(x.drop("label"), 2).drop("weight").collect()), key=repr) for x in (w.drop("term_id"), few)]
        assert top[0] == top[1]
        packed = V.transform_vectors(d, voc, block, carry=("label",)).collect()
        number = {r["term"]: (r["term_id"], r["df"]) for r in voc.collect()}
        cells = {(r["doc_id"], r["label"], t, n): x for r in packed for t, n, x in zip(r["ts"], r["dfs"], r["ws"], strict=True)}
        assert cells == {(i, c, *number[t]): x for (i, c, t), x in want.items()}


def test_portions_of_texts():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"i": pa.array(range(len(t))), "t": pa.array(t, pa.string())}) for t in (["aaa", "b"], [], ["cccccccc", "", "d", "ee"])]
    assert [p.column("t").to_pylist() for p in V.portions(batches, 4)] == [["aaa", "b"], ["cccccccc"], ["", "d", "ee"]]


def test_blocks_are_normalised_apart(spark):
    d = docs(spark, ["late fee on my card", "late fee dispute"])
    spec = V.FeatureSpec(word=V.Block("word"), char=V.Block("char", (3, 5)))
    w = V.transform_features(d, V.fit_features(d, spec), spec)
    for r in w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("n")).collect():
        assert r["n"] == pytest.approx(math.sqrt(2))


def test_validation_text_does_not_leak(spark):
    train, val = docs(spark, ["alpha beta", "alpha gamma"]), docs(spark, ["alpha delta", "omega"])
    v = V.fit_vocabulary(train, V.Block("word"))
    before = sorted(v.collect())
    w = V.transform(val, v, V.Block("word"))
    assert {r["term"] for r in w.collect()} == {"alpha"} and sorted(v.collect()) == before


def test_feature_errors(spark):
    with pytest.raises(ValueError):
        V.FeatureSpec()
    with pytest.raises(ValueError):
        V.fit_vocabulary(docs(spark, []), V.Block("word"))
    with pytest.raises(ValueError):
        V.transform(docs(spark, ["a b"]), None, V.Block("word"))


# ---- similarity ----


def test_cosine_properties(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "y", 1.0), (2, "z", 1.0), (3, "q", 4.0)], "i bigint, term string, w double")
    u = SIM.unit_vectors(a, "i")
    s = {(r["i"], r["j"]): r["score"] for r in SIM.cosine_pairs(u, u.withColumnRenamed("i", "j"), "i", "j").collect()}
    assert all(s[k, k] == pytest.approx(1.0) for k in (1, 2, 3)) and s[1, 2] == pytest.approx(s[2, 1]) and (1, 3) not in s


def test_top_k_rules(spark):
    for bad, err in ((0, ValueError), (-1, ValueError), (2.5, TypeError), ("3", TypeError), (True, TypeError)):
        with pytest.raises(err):
            SIM.check_k(bad)
    d = docs(spark, ["card fee", "loan", "escrow", "card"])
    v, w = V.fit_transform(d, V.Block("word"))
    q = V.transform(spark.createDataFrame([(9, "card"), (10, "unknown words")], "qid bigint, text string"), v, V.Block("word"), id="qid")
    ids = spark.createDataFrame([(9,), (10,)], "qid bigint")
    hits = SIM.find_similar(q, w, d, 10, "qid", "doc_id", ids).orderBy("qid", "rank").collect()
    assert [r["doc_id"] for r in hits] == [3, 0, 1, 2, 0, 1, 2, 3] and [r["score"] for r in hits[3:]] == [0.0] * 5
    near = SIM.nearest(q, w, "qid", "doc_id", all_queries=ids).orderBy("qid").collect()
    assert [(r["qid"], r["nn_id"], r["nn_sim"]) for r in near] == [(9, 3, pytest.approx(1.0)), (10, None, 0.0)]


@pytest.mark.parametrize("threshold", [0.9, 0.7])
def test_near_pairs_against_brute_force(spark, threshold):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    base = [list(rng.choice(words, 12)) for _ in range(25)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(2):
            c = list(b)
            c[int(rng.integers(len(c)))] = str(rng.choice(words))
            texts.append(" ".join(c))
    texts += [texts[0]] * 12  # a group of copies
    labels = [f"l{i % 3}" for i in range(len(texts))]
    d = docs(spark, texts, labels)
    block = V.Block("word", (1, 2), min_df=2, max_df=0.95, sublinear_tf=True)
    v = V.fit_vocabulary(d, block)
    w = V.transform(d, v, block, carry=("label",))
    dense: dict = {}
    for r in w.collect():
        dense.setdefault(r["doc_id"], {})[r["term"]] = r["w"]
    want: dict = {}
    for i in dense:
        for j in dense:
            if i < j and sum(x * dense[j].get(t, 0.0) for t, x in dense[i].items()) >= threshold - 1e-9:
                key = tuple(sorted((labels[i], labels[j])))
                want[key] = want.get(key, 0) + 1
    vectors, counts = SIM.collapse_copies(w, "doc_id", "label")
    pairs = SIM.near_pairs(vectors, v, threshold, "doc_id")
    got = {(r["label_a"], r["label_b"]): r["pairs"] for r in SIM.near_label_pairs(pairs, vectors, counts, "doc_id", "label").collect()}
    assert got == want and sum(got.values()) > 60


@pytest.mark.parametrize("part", [2, 1024])
def test_pairs_are_sifted_and_multiplied_by_neighbourhoods(spark, monkeypatch, part):
    monkeypatch.setattr(SIM, "PART", part)  # 2: neighbourhoods are cut on both sides
    rng = np.random.default_rng(11)
    rows, vecs = [], {}
    for i in range(40):  # ids 0 to 29 resemble each other, the others nothing
        terms = np.arange(50) if i < 30 else 1000 * i + np.arange(50)
        w = rng.uniform(0.8, 1.2, 50)
        w /= np.sqrt(w @ w)
        vecs[i] = dict(zip(terms.tolist(), w.tolist()))
        rows += [(i, f"t{t}", float(x)) for t, x in vecs[i].items()]
    vectors = spark.createDataFrame(rows, "doc_id bigint, term string, w double")
    terms = vectors.select("term").distinct().select("term", F.substring("term", 2, 9).cast("bigint").alias("term_id"), F.lit(2).cast("bigint").alias("df"))
    packed = SIM.packed_vectors(vectors, terms, "doc_id")
    pairs = spark.createDataFrame([(i, j) for i in range(40) for j in range(i + 1, 40)], "a bigint, b bigint")
    dot = lambda i, j: sum(x * vecs[j].get(t, 0.0) for t, x in vecs[i].items())
    left = SIM.within_bits(pairs, packed, 0.81, "doc_id")
    assert left.count() == 30 * 29 // 2  # none that reaches 0.9 is lost, none of the others is moved with a vector
    got = {(r["a"], r["b"]): r["score"] for r in SIM.dot_products(left, packed, "doc_id").collect()}
    assert got == {(i, j): pytest.approx(dot(i, j)) for i in range(30) for j in range(i + 1, 30)}
    whole = {(r["a"], r["b"]) for r in SIM.near_pairs(vectors, terms, 0.98, "doc_id").collect()}
    assert whole == {k for k in got if dot(*k) >= 0.98 - 1e-9} and whole


@pytest.mark.parametrize("budgets", [(3, 40), ()])
def test_search_against_brute_force(spark, budgets):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(words, int(rng.integers(2, 12)), p=share / share.sum())) for _ in range(130)]
    texts += [texts[0]] * 9 + [texts[3]] * 3
    d = docs(spark, texts)
    block = V.Block("word", (1, 1), sublinear_tf=True)
    v, w = V.fit_transform(d, block)
    q = w.filter("doc_id % 4 = 0").withColumnRenamed("doc_id", "qid")
    vecs: dict = {}
    for r in w.collect():
        vecs.setdefault(r["doc_id"], {})[r["term"]] = r["w"]
    want = set()
    for i in range(0, len(texts), 4):
        ranked = sorted((-round(min(sum(x * vecs[j].get(t, 0.0) for t, x in vecs[i].items()), 1.0), 9), j) for j in vecs)
        want |= {(i, j, n + 1, -s) for n, (s, j) in enumerate(ranked[:5]) if s < 0}
    found = SIM.search(q, w, 5, "qid", "doc_id", budgets)
    assert {(r["qid"], r["doc_id"], r["rank"], round(r["score"], 9)) for r in found.collect()} == want


def test_search_moves_vectors_not_pairs(spark):
    rng = np.random.default_rng(8)
    # every record shares a term with every query, so that all pairs would have to meet
    texts = [" ".join(["all", "both", *rng.choice([f"w{i}" for i in range(40)], 5)]) for _ in range(300)]
    block = V.Block("word", (1, 1))
    v, w = V.fit_transform(docs(spark, texts), block)
    written = []
    kept, SIM.stage = SIM.stage, lambda df: written.append(kept(df)) or written[-1]
    try:
        SIM.search(w.withColumnRenamed("doc_id", "qid"), w, 2, "qid", "doc_id").count()
    finally:
        SIM.stage = kept
    assert max(x.count() for x in written) <= 2 * 2 * len(texts)


def test_blocks_of_vectors_are_bounded_and_met_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(SIM, "BLOCK_CELLS", 2000)
    monkeypatch.setattr(SIM, "BLOCK_ROWS", 1000)
    monkeypatch.setattr(SIM, "HITS", 50)
    rng = np.random.default_rng(9)
    dense = np.where(rng.random((120, 80)) < 0.3, rng.random((120, 80)), 0.0)
    dense[40:80] = np.where(rng.random((40, 80)) < 0.05, 0.0, dense[:40])  # near copies
    dense[:, 0] += 0.05
    dense /= np.sqrt((dense ** 2).sum(1, keepdims=True))
    df = (dense > 0).sum(0)
    rows = [(f"d{i:03}", bytes([i]), [int(t) for t in np.flatnonzero(v)], [int(df[t]) for t in np.flatnonzero(v)], [float(x) for x in v[v > 0]]) for i, v in enumerate(dense)]
    packed = spark.createDataFrame(rows, "doc_id string, vec binary, ts array<int>, dfs array<int>, ws array<double>").repartition(3)
    plans = []
    met, made = SIM.meet_blocks, []

    def watched(left, right, *more, **named):
        for side in (left, right):
            made.append([len(np.frombuffer(r["ts" if "ts" in side.columns else "at"], "<i4")) for r in side.collect()])
        plans.append(left.crossJoin(right)._jdf.queryExecution().executedPlan().toString())
        return met(left, right, *more, **named)

    monkeypatch.setattr(SIM, "meet_blocks", watched)
    scores = dense @ dense.T
    got = {(r["a"], r["b"]): r["score"] for r in SIM.near_packed_pairs(packed, 0.8, "doc_id").collect()}
    assert got == {(f"d{i:03}", f"d{j:03}"): pytest.approx(scores[i, j]) for i in range(120) for j in range(i + 1, 120) if scores[i, j] >= 0.8} and len(got) > 20
    found = SIM.search(packed.withColumnRenamed("doc_id", "qid"), packed, 3, "qid", "doc_id").collect()
    want = {(i, j, n + 1) for i in range(120) for n, j in enumerate(np.lexsort((np.arange(120), -np.round(scores[i], 9)))[:3].tolist())}
    assert {(int(r["qid"][1:]), int(r["doc_id"][1:]), r["rank"]) for r in found} == want
    assert all(len(x) > 1 and max(x) <= 2000 for x in made) and not any("hashpartitioning" in x for x in plans)


def test_block_product_against_dense():
    rng = np.random.default_rng(2)
    a, b = (np.where(rng.random((n, 90)) < 0.2, rng.random((n, 90)), 0.0) for n in (70, 50))
    b[:, 0] = 1.0  # a term of all records
    cells = lambda m: ([np.flatnonzero(r) * 7 for r in m], [r[r > 0] for r in m])
    i, j, s = SIM.block_product(*cells(a), *cells(b), 4)
    want = [(q, d) for q in range(70) for d in np.lexsort((np.arange(50), -np.round(a[q] @ b.T, 9)))[:4] if a[q] @ b[d] > 0]
    assert list(zip(i.tolist(), j.tolist())) == want and np.allclose(s, [a[q] @ b[d] for q, d in want])


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(80)]
    share = 1 / np.arange(1, 81)
    texts = [" ".join(rng.choice(words, int(rng.integers(3, 15)), p=share / share.sum())) for _ in range(150)]
    texts += [texts[0]] * 10 + [texts[5] + " w3"] * 5
    d = docs(spark, texts)
    block = V.Block("word", (1, 2), min_df=2, max_df=0.95, sublinear_tf=True)
    v, w = V.fit_transform(d.filter("doc_id < 120"), block)
    q = V.transform(d.filter("doc_id >= 120").withColumnRenamed("doc_id", "qid"), v, block, id="qid")
    got = {r["qid"]: (r["nn_id"], round(r["nn_sim"], 9)) for r in SIM.nearest(q, w, "qid", "doc_id").collect()}
    vecs: dict = {}
    for r in w.collect():
        vecs.setdefault(r["doc_id"], {})[r["term"]] = r["w"]
    asked: dict = {}
    for r in q.collect():
        asked.setdefault(r["qid"], {})[r["term"]] = r["w"]
    want = {}
    for i, x in asked.items():
        o, j = min((-round(sum(a * y.get(t, 0.0) for t, a in x.items()), 9), j) for j, y in vecs.items())
        if o < 0:
            want[i] = (j, -o)
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][1] == pytest.approx(want[i][1], abs=2e-9) and got[i][0] == want[i][0]


# ---- models ----


def test_class_weights():
    assert B.class_weights({"a": 80, "b": 20}) == {"a": 0.625, "b": 2.5}
    assert B.class_weights({"a": 80, "b": 20}, 0.0) == {"a": 1.0, "b": 1.0}
    with pytest.raises(ValueError):
        B.class_weights({"a": 1, "b": 1}, -1)


TEXTS = ["card fee card charge", "credit card fee dispute", "mortgage loan escrow", "escrow mortgage payment", "debt collector calls", "collector debt harass"] * 4
LABELS = ["card", "card", "home", "home", "debt", "debt"] * 4


def test_bayes_and_unknown_text(spark):
    d = docs(spark, TEXTS, LABELS)
    m = B.fit(d, V.Block("word"), "label", alpha=0.1)
    p = B.predict(m, docs(spark, ["card charge", "escrow", "zzz"]))
    got = {r["doc_id"]: r for r in p.collect()}
    assert [got[0]["y_pred"], got[1]["y_pred"]] == ["card", "home"] and got[2]["y_pred"] == "card"
    assert got[2]["conf"] == pytest.approx(1 / 3)
    sums = B.class_scores(p, m.classes).groupBy("doc_id").agg(F.sum("score").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in sums)
    with pytest.raises(ValueError):
        B.fit(docs(spark, ["a b"], ["x"]), V.Block("word"), "label")


def linear_data(spark):
    d = docs(spark, TEXTS, LABELS)
    spec = V.FeatureSpec(word=V.Block("word", (1, 1)))
    voc = V.fit_features(d, spec)
    index = LN.feature_index(voc)
    return d, spec, voc, index, LN.assemble(V.transform_features(d, voc, spec), index, d, "doc_id", ("label",))


def test_logistic_save_load_and_audit(spark, tmp_path):
    d, spec, voc, index, x = linear_data(spark)
    m = LN.fit_logistic(x, "label", C=2.0, power=1.0, max_iter=50)
    p = LN.predict(m, x)
    assert p.filter("label = y_pred").count() == len(TEXTS)
    assert all(sum(r["p"]) == pytest.approx(1.0) for r in p.collect())
    assert LN.coefficient_terms(m, index, 2).filter("category = 'debt'").count() == 2
    path = str(tmp_path / "m")
    A.save_model(m, voc, path)
    back, _ = A.load_model(spark, path)
    again = LN.classify_texts(docs(spark, ["My CARD fee!"]), back, voc, index, spec).first()
    assert again["y_pred"] == "card"
    with pytest.raises(ValueError):
        LN.classify_texts(docs(spark, ["  "]), back, voc, index, spec)
    assert A.validate_artifacts(spark, path, ("word",), index.count(), 3)["is_valid"]
    bad = A.validate_artifacts(spark, path, ("word",), 1, 5)
    assert not bad["is_valid"] and len(bad["errors"]) == 2
    with pytest.raises(FileNotFoundError):
        A.validate_artifacts(spark, str(tmp_path / "none"), raise_on_error=True)
    with pytest.raises(FileNotFoundError):
        A.load_model(spark, str(tmp_path / "none"))
    for bad in ({"C": 0.0}, {"max_iter": 0}):
        with pytest.raises(ValueError):
            LN.fit_logistic(x, "label", **bad)


def test_svc_and_hierarchy(spark):
    d, spec, voc, index, x = linear_data(spark)
    svc = LN.predict(LN.fit_svc(x, "label", 0.5, 1.0, 20), x)
    assert svc.filter("label = y_pred").count() == len(TEXTS)
    mapping = mapping_table(spark, {"card": "money", "debt": "money", "home": "home"})
    models = LN.fit_hierarchy(x, "label", mapping, max_iter=30)
    assert set(models["special"]) == {"money"} and models["single"] == {"home": "home"}
    out = LN.predict_hierarchy(models, x, "doc_id", ("label",))
    assert out.count() == len(TEXTS) and out.filter("label = y_pred").count() == len(TEXTS)
    alone = LN.predict_hierarchy(models, x.filter("label = 'home'"), "doc_id", ("label",))
    assert {r["y_pred"] for r in alone.collect()} == {"home"}  # no row reaches the specialist


def test_logistic_reaches_the_least_loss_in_small_blocks(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from narrata.operators import multinomial as M

    monkeypatch.setattr(M, "BLOCK_CELLS", 40)
    monkeypatch.setattr(M, "RANGE", 4)
    rng = np.random.default_rng(5)
    x = np.where(rng.random((60, 11)) < 0.4, rng.random((60, 11)), 0.0)
    x[3] = 0.0  # a row without terms
    x[:, 7] = 0.0  # a feature without rows
    y = np.where(x[:, 0] + 0.3 * rng.random(60) > 0.4, "a", np.where(x[:, 1] > 0.3, "b", "c"))
    made = [(i, str(c), Vectors.dense(v) if i == 9 else Vectors.sparse(11, [(int(j), float(v[j])) for j in np.flatnonzero(v)]))
            for i, (c, v) in enumerate(zip(y, x, strict=True))]
    rows = spark.createDataFrame(made, ["doc_id", "label", "features"]).repartition(3)
    model = LN.fit_logistic(rows, "label", C=2.0, power=1.0, tol=1e-10)
    assert LN.converged(model) and not LN.converged(LN.fit_logistic(rows, "label", max_iter=1))
    head = model.stages[-1]
    w, b = head.coefficientMatrix.toArray(), head.interceptVector.toArray()
    classes = sorted(set(y))
    each = np.array([60 / (3 * (y == c).sum()) for c in y])
    m = x @ w.T + b
    p = np.exp(m - m.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    slip = (p - (y[:, None] == np.array(classes)[None, :])) * each[:, None] / each.sum()
    assert np.abs(slip.T @ x + w / (2.0 * each.sum())).max() < 1e-4 and np.abs(slip.sum(0)).max() < 1e-4
    assert head.getRegParam() == pytest.approx(1 / (2.0 * each.sum())) and b.sum() == pytest.approx(0, abs=1e-9)
    got = {r["doc_id"]: r["p"] for r in LN.predict(model, rows).collect()}
    assert all(got[i] == pytest.approx(list(p[i])) for i in range(60))


def test_two_class_models_in_a_session_with_a_job_tag(spark):
    d, spec, voc, index, x = linear_data(spark)
    two = x.filter("label <> 'home'")
    session = spark.newSession()  # its tags come with an object that cannot be serialised
    session.addTag("seen")
    rows = session.createDataFrame(two.collect(), two.schema)
    for m in (LN.fit_logistic(rows, "label", max_iter=5), LN.fit_svc(rows, "label", max_iter=5)):
        assert LN.predict(m, rows).filter("label = y_pred").count() == rows.count()
        assert LN.converged(m) in (True, False)


def test_vector_size_is_checked(spark):
    d, spec, voc, index, x = linear_data(spark)
    other = LN.assemble(V.transform_features(d, voc, spec), index.filter("idx < 3"), d, "doc_id", ("label",))
    for m in (LN.fit_logistic(x, "label", max_iter=5), LN.fit_svc(x, "label", max_iter=5)):
        with pytest.raises(ValueError, match="features"):
            LN.predict(m, other)
        with pytest.raises(ValueError, match="empty"):
            LN.predict(m, x.limit(0))


def test_svc_with_text_statistics_as_artifact(spark, tmp_path):
    d = docs(spark, TEXTS, LABELS).withColumn("raw", F.col("text"))
    spec = V.FeatureSpec(word=V.Block("word", (1, 1)), text_stats=True)
    voc = V.fit_features(d, spec)
    index = LN.feature_index(voc, [("text_stats", t) for t in ("log_length", "log_masks", "has_mask")])
    x = LN.assemble(V.transform_features(d, voc, spec, raw="raw"), index, d, "doc_id", ("label",))
    m = LN.fit_svc(x, "label", max_iter=10)
    path = str(tmp_path / "svc")
    A.save_model(m, voc, path, index, spec)
    back, _ = A.load_model(spark, path)
    want = {r["doc_id"]: r["y_pred"] for r in LN.predict(m, x).collect()}
    assert {r["doc_id"]: r["y_pred"] for r in LN.predict(back, x).collect()} == want
    words = voc["word"].count()
    assert index.count() == words + 3 and A.validate_artifacts(spark, path, ("word",), words, 3)["is_valid"]
    assert not A.validate_artifacts(spark, path, ("word",), words, 4)["is_valid"]


def test_experiment_matrix_of_a_linear_model(spark):
    d = docs(spark, TEXTS, LABELS)
    rows = d.withColumn("split", F.lit("train")).unionByName(d.withColumns({"doc_id": F.col("doc_id") + 1000, "split": F.lit("val")}))
    mapping = mapping_table(spark, {"card": "money", "debt": "money", "home": "home"})
    made = search.experiment_matrix(rows, mapping, V.FeatureSpec(word=V.Block("word")), search.Classifier("logistic", C=2.0, max_iter=30), modes=("standard",))
    assert {(r["cleaning"], r["labels"]): r["accuracy"] for r in made.collect()} == {("standard", "all labels"): 1.0, ("standard", "groups"): 1.0}


def test_search_resumes_and_final_runs_once(spark, tmp_path):
    d = docs(spark, TEXTS, LABELS).withColumn("raw", F.col("text"))
    s = search.Search(spark, d, d, str(tmp_path / "results"))
    spec = V.FeatureSpec(word=V.Block("word"))
    grid = [search.Classifier("multinomial", alpha=a) for a in (0.1, 1.0)]
    assert s.run_stage("bayes", [spec], grid).count() == 2
    assert s.run_stage("bayes", [spec], grid + [search.Classifier("complement", alpha=0.1)]).count() == 3
    best, row = s.best("bayes")
    assert best == spec and row["macro_f1"] == 1.0
    assert search.search_report(s.results())["range"].first()["n"] == 3
    done = search.run_final(spark, d, d, spec, grid[0], {"macro_f1": 0.5, "accuracy": 0.5}, str(tmp_path / "final"))
    assert done["promoted"]
    with pytest.raises(RuntimeError):
        search.run_final(spark, d, d, spec, grid[0], {}, str(tmp_path / "final"))
    words, chars = [search.FeatureSpec(word=V.Block("word"))], [search.FeatureSpec(char=V.Block("char", (2, n))) for n in (2, 3)]
    bayes = lambda _: grid[:1]
    t = search.Search(spark, d, d, str(tmp_path / "steps"))
    best, row = t.run((search.Step("word", lambda _: words, bayes), search.Step("character", lambda _: chars, bayes), search.Step("joined", search.joined, bayes)))
    sizes = {(r["stage"], r["features"]): r["dims"] for r in t.results().collect()}
    assert len(sizes) == 6 and all(n > max(m for (s_, f), m in sizes.items() if s_ == "word") for (s_, f), n in sizes.items() if s_ == "joined")
    assert row["macro_f1"] == max(r["macro_f1"] for r in t.results().collect()) and best.describe() == row["features"]
    assert not search.promote({"macro_f1": 0.6, "accuracy": 0.4}, {"macro_f1": 0.5, "accuracy": 0.5})
    assert len(search.word_specs()) == 13 and len(search.char_specs()) == 8


def test_lookup(spark):
    train = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), (None, "x")], "k string, y string")
    levels, overall = L.fit_lookup(train, L.key_of([F.col("k")]), "y")
    out = L.apply_lookup(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string"), levels, overall, L.key_of([F.col("k")]))
    assert {(r["k"], r["y_pred"], r["known"]) for r in out.collect()} == {("a", "x", True), ("b", "y", True), ("c", "x", False), (None, "x", True)}


def test_date_votes_against_rule(spark):
    rng = np.random.default_rng(5)
    train = [(int(i), int(d), f"l{int(rng.integers(3))}") for i, d in enumerate(np.sort(rng.choice([1, 2, 3, 9, 30, 31, 60], 120)))]
    days, k = [0, 2, 5, 31, 45, 99], 15
    want = {}
    for q in days:
        pos = sum(1 for r in train if r[1] < q)
        near = sorted(range(max(0, pos - k), min(len(train), pos + k)), key=lambda j: (abs(train[j][1] - q), j))[:k]
        votes = [train[j][2] for j in near]
        want[q] = min(set(votes), key=lambda l: (-votes.count(l), l))
    t = spark.createDataFrame([("g", *r) for r in train], "g string, id bigint, day int, l string")
    q = spark.createDataFrame([("g", d) for d in days], "g string, day int")
    assert {r["day"]: r["vote"] for r in temporal.date_votes(t, q, "g", "day", "id", "l", k).collect()} == want


# ---- evaluation ----


def preds(spark, pairs):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(pairs)], "doc_id bigint, y_true string, y_pred string")


def test_metrics(spark):
    p = preds(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")])
    m = EV.metrics(p).first()
    assert m["accuracy"] == 0.75 and m["macro_precision"] == pytest.approx((1 + 2 / 3) / 2)
    only_predicted = EV.per_class(EV.confusion_counts(preds(spark, [("a", "z")]))).collect()
    assert {(r["category"], r["precision"], r["recall"], r["f1"]) for r in only_predicted} == {("a", 0.0, 0.0, 0.0), ("z", 0.0, 0.0, 0.0)}


def test_ranking_order(spark):
    rows = [("base", .5, .5, .7, .7), ("higher_mf1", .6, .4, .6, .6), ("higher_acc", .5, .5, .8, .7), ("tie_all_higher_wf1", .5, .5, .7, .75), ("tie_mf1_lower_rec", .5, .4, .9, .9)]
    df = spark.createDataFrame(rows, "candidate string, macro_f1 double, macro_recall double, accuracy double, weighted_f1 double")
    got = [r["candidate"] for r in EV.rank_candidates(df).orderBy("rank").collect()]
    assert got == ["higher_mf1", "higher_acc", "tie_all_higher_wf1", "base", "tie_mf1_lower_rec"]


def test_matrix_rows_sum_to_support(spark):
    p = preds(spark, [("a", "b"), ("a", "a"), ("c", "a"), ("b", "b")])
    c = EV.confusion_counts(p)
    cells = EV.confusion_matrix(c)
    assert cells.count() == 9 and cells.agg(F.sum("n")).first()[0] == 4
    wide = {r["y_true"]: r["a"] + r["b"] + r["c"] for r in EV.confusion_wide(c, ["a", "b", "c"]).collect()}
    assert wide == {"a": 2, "b": 1, "c": 1}
    assert EV.confusion_pairs(c).filter("actual_category = predicted_category").count() == 0


def test_decomposition_precedence(spark):
    rows = [(0, "a1", "a1", .9, .9, "zz"), (1, "a1", "a2", .9, .9, "zz"), (2, "rare", "b", .9, .9, "zz"), (3, "b", "a1", .2, .85, "zz"), (4, "b", "a1", .2, .85, "b"), (5, "b", "a1", .9, .1, "zz")]
    p = spark.createDataFrame(rows, "doc_id bigint, y_true string, y_pred string, conf double, nn_sim double, nn_label string")
    mapping = mapping_table(spark, {"a1": "A", "a2": "A", "b": "B", "rare": "R"})
    counts = spark.createDataFrame([("a1", 100), ("a2", 100), ("b", 100), ("rare", 49)], "category string, n bigint")
    got = {r["doc_id"]: r["error_class"][:1] for r in E.decompose_errors(p, mapping, counts).collect()}
    assert got == {0: "c", 1: "A", 2: "B", 3: "C", 4: "D", 5: "E"}


def test_information_loss_counts(spark):
    rows = spark.createDataFrame([("a1",)] * 3 + [("a2",)] * 2 + [("B",)] * 5, "c string")
    m = mapping_table(spark, {"a1": "A", "a2": "A", "B": "B"})
    r = information_loss(rows, "c", m).first()
    assert (r["records_relabelled"], r["records_in_merged_groups"], r["labels_merged"], r["n_normalized_categories"]) == (5, 5, 2, 2)


def test_percent_and_row_pick(spark):
    df = spark.createDataFrame([("Baseline", "69.82%"), ("Minimal", "0.5"), ("Other", "18")], "experiment string, v string")
    assert [r[0] for r in df.select(E.as_percent(F.col("v"))).collect()] == [69.82, 50.0, 18.0]
    assert E.pick_rows(df, {"experiment": "BASE"}).count() == 1


def test_feature_index_over_many_partitions(spark):
    names = sorted({f"t{i * 7919 % 5000:05}" for i in range(5000)})
    v = spark.createDataFrame([("word", n) for n in names[::2]], "block string, term string").repartition(13)
    c = spark.createDataFrame([("char", n) for n in names[1::2]], "block string, term string").repartition(7)
    index = LN.feature_index({"char": c, "word": v}, [("meta", "a=1")])
    got = [(r["block"], r["term"]) for r in sorted(index.collect(), key=lambda r: r["idx"])]
    assert got == [("word", n) for n in names[::2]] + [("char", n) for n in names[1::2]] + [("meta", "a=1")]
    assert sorted(r["idx"] for r in index.collect()) == list(range(5001)) and dict(index.dtypes)["idx"] == "int"


def test_term_counts_of_repeated_ids_and_empty_rows(spark):
    d = spark.createDataFrame([(1, "b a b"), (1, "a c"), (2, ""), (3, None), (4, "z")], "doc_id bigint, text string")
    for block in (V.Block("word", (1, 1)), V.Block("char", (1, 1)), V.Block("char_wb", (1, 1))):
        whole = {(r["doc_id"], r["term"]): r["tf"] for r in V.term_counts(d, block).collect()}
        assert whole == {(r["doc_id"], r["term"]): r["tf"] for r in V.term_counts(d, block, by_id=False).collect()}
    assert whole[1, "b"] == 2 and whole[1, "a"] == 2 and {i for i, _ in whole} == {1, 4}
    plan = V.term_counts(d.filter("doc_id > 1"), V.Block("word", (1, 2)), by_id=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_newton_reaches_the_optimum(spark, loss):
    from narrata.operators import newton as N

    rng = np.random.default_rng(4)
    x = np.c_[np.ones(90), rng.normal(size=(90, 2))]
    y = np.where(x[:, 1] + 0.5 * rng.normal(size=90) > 0.4, "a", np.where(x[:, 2] > 0, "b", "c"))
    rows = spark.createDataFrame([(i, str(y[i]), *map(float, x[i])) for i in range(90)], "id long, label string, p double, q double, r double")
    train = N.class_weighted(N.prepared(rows, [F.col("p"), F.col("q"), F.col("r")], F.lit("all"), "label", ("id",)), 1.0)
    model = N.fit(train, N.units_of(train), 3, loss, 2.0, 8)
    weight = {c: 90 / (3 * (y == c).sum()) for c in "abc"}
    c = np.array([weight[v] for v in y])
    for r in model.collect():
        w = np.array([r["w_0"], r["w_1"], r["w_2"]])
        t = y == r["unit"]
        m, sign = x @ w, np.where(t, 1.0, -1.0)
        slope = 1 / (1 + np.exp(-m)) - t if loss == "logistic" else np.where(sign * m < 1, 2 * (m - sign), 0)
        assert np.abs(w + x.T @ (2.0 * c * slope)).max() < 1e-6
    got = N.predict(train.drop("c"), model, 3, loss, "id").collect()
    assert np.mean([r["y"] == r["y_pred"] for r in got]) > 0.7
    with pytest.raises(ValueError, match="features"):
        N.predict(train.drop("c", "x_2"), model, 3, loss, "id")
    with pytest.raises(ValueError, match="empty"):
        N.fit(train.limit(0), N.units_of(train), 3, loss)


@pytest.mark.parametrize("kind", ["multinomial", "complement"])
def test_bayes_of_many_classes(spark, kind):
    """3,000 classes, each with a word of its own: the plan is as small as that of three, the scores equal the closed form."""
    import math

    def plan(k):
        rows = [(i, f"own{i} common{i % 7} all", f"class{i}") for i in range(k)]
        d = spark.createDataFrame(rows, "doc_id long, text string, label string")
        m = B.fit(d, V.Block("word", norm=None), "label", kind, 0.1)
        p = B.predict(m, d.filter("doc_id % 100 = 5").withColumnRenamed("label", "y_true"), carry=("y_true",))
        return m, p, len(p._jdf.queryExecution().analyzed().toString().splitlines())

    m, p, lines = plan(3000)
    assert lines == plan(3)[2]
    found = {r["doc_id"]: r for r in p.collect()}
    assert len(found) == 30 and all(r["y_true"] == r["y_pred"] for r in found.values())
    got = found[5]["scores"]
    at = {c: m.classes.index(f"class{c}") for c in (0, 5, 12, 2999)}
    w = {t: math.log(3001 / (1 + df)) + 1 for t, df in (("own5", 1), ("all", 3000), ("common5", sum(i % 7 == 5 for i in range(3000))))}
    size, every = 3000 + 7 + 1, {}
    for i in range(3000):
        every[i] = {f"own{i}": w["own5"], f"common{i % 7}": math.log(3001 / (1 + sum(x % 7 == i % 7 for x in range(3000)))) + 1 if i < 7 else None, "all": w["all"]}
        every[i][f"common{i % 7}"] = every[i % 7][f"common{i % 7}"]
    totals = {t: sum(e.get(t, 0.0) for e in every.values()) for t in w}
    grand = sum(sum(e.values()) for e in every.values())
    for c in (0, 5, 12, 2999):
        own = sum(every[c].values())
        if kind == "multinomial":
            want = math.log(1 / 3000) + sum(x * math.log((every[c].get(t, 0.0) + 0.1) / (own + 0.1 * size)) for t, x in w.items())
        else:
            want = -sum(x * math.log((totals[t] - every[c].get(t, 0.0) + 0.1) / (grand - own + 0.1 * size)) for t, x in w.items())
        assert got[at[c]] == pytest.approx(want, abs=1e-6)


def test_bayes_candidates_in_one_pass(spark):
    d = docs(spark, ["card charge fee", "card fee", "loan escrow", "escrow house loan"], ["a", "a", "b", "b"])
    counts, sums = B.fit_sums(d, V.Block("word"), "label")
    grid = [("multinomial", 0.1), ("complement", 0.3), ("multinomial", 2.0)]
    new = docs(spark, ["card loan", "escrow", "", "zzz"])
    together = {(r["doc_id"], r["candidate"]): r["scores"] for r in B.predict(B.models_from_sums(counts, sums, V.Block("word"), grid), new).collect()}
    for j, (kind, alpha) in enumerate(grid):
        for r in B.predict(B.model_from_sums(counts, sums, V.Block("word"), kind, alpha), new).collect():
            assert together[r["doc_id"], j] == pytest.approx(r["scores"])


def test_common_terms_of_a_bayes_model_are_not_shuffled(spark, monkeypatch, capsys):
    new = docs(spark, ["card charge escrow", "escrow", "zzz", None])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for norm in ("l2", "l1", None):
            counts, sums = B.fit_sums(docs(spark, TEXTS, LABELS), V.Block("word", norm=norm), "label")
            seen = []
            for values in (0, 60, 1_000_000):  # no, some, and all terms are common
                monkeypatch.setattr(B, "COMMON_VALUES", values)
                m = B.model_from_sums(counts, sums, V.Block("word", norm=norm), "complement", 0.3)
                p = B.predict(m, new)
                seen.append({r["doc_id"]: r["scores"] for r in p.collect()})
                plain = V.transform(new, m.table, m.block).select("doc_id", "block", "term", "w")
                m.table = m.table.withColumn("term", F.concat(F.lit("word:"), "term"))
                seen.append({r["doc_id"]: r["scores"] for r in B.predict_weights(m, plain, new).collect()})
            assert all(x == {i: pytest.approx(s) for i, s in seen[0].items()} for x in seen[1:]) and len(seen[0]) == 4
        p.explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
