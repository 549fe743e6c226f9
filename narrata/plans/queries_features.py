"""Queries on splits, features and similarity."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from narrata.functions import dates as D
from narrata.functions import text as T
from narrata.operators import similarity as SIM
from narrata.operators import splits as SP
from narrata.operators import tfidf as V
from narrata.operators.ranking import first_per_key
from narrata.plans import sql as S
from narrata.plans.registry import query, shared, table
from narrata.session import drop, stage

_D = f"docs AS (SELECT doc_id, source, lang, {S.processed('text')} AS c FROM documents)"


def processed(spark, sf_dir):
    """Cleaned documents, staged once: fitting, transforming and splitting all read this table."""
    return shared(spark, sf_dir, "processed", lambda: stage(
        table(spark, sf_dir, "documents").select("doc_id", "source", "lang", T.preprocess("text").alias("text"))))


def vocabulary(spark, sf_dir, block: V.Block):
    """Vocabulary of the processed documents, fitted once per session."""
    return shared(spark, sf_dir, ("vocabulary", block), lambda: V.fit_vocabulary(processed(spark, sf_dir), block))


# ---- splits ----


@query("stratified_split", f"WITH {_D} {S.split('docs', 'doc_id', 'source', 0.2, 42)}")
def stratified_split(spark, sf_dir):
    return SP.mark_split(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", "source")


@query("stratified_split_imbalanced", f"WITH {_D} {S.split('docs', 'doc_id', 'lang', 0.3, 7)}")
def stratified_split_imbalanced(spark, sf_dir):
    return SP.mark_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang", 0.3, 7)


@query("unstratified_fallback", f"""SELECT item_id, CASE WHEN row_number() OVER (ORDER BY {S.hash60('item_id', 42)}, item_id) <= (SELECT ceil(0.2 * count(*)) FROM benchmark)
 THEN 'test' ELSE 'train' END AS split FROM benchmark""")
def unstratified_fallback(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("item_id").cast("string").alias("own_class"))
    return SP.mark_split(items, "item_id", "own_class").select("item_id", "split")


@query("split_many_classes", """SELECT l_orderkey * 10 + l_linenumber AS row_id, CASE WHEN row_number() OVER (ORDER BY h, l_orderkey * 10 + l_linenumber) <= (SELECT ceil(0.2 * count(*)) FROM lineitem)
 THEN 'test' ELSE 'train' END AS split FROM (SELECT *, ('0x' || substr(md5('42-' || (l_orderkey * 10 + l_linenumber)), 1, 15))::BIGINT AS h FROM lineitem)""")
def split_many_classes(spark, sf_dir):
    """Every line item is a class of its own: far more classes than a driver should hold."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"))
    return SP.mark_split(rows.withColumn("own_class", F.col("row_id").cast("string")), "row_id", "own_class").select("row_id", "split")


@query("split_with_null_labels", f"""WITH part_of AS (SELECT doc_id, nullif(lang, 'fr') AS lang FROM documents), parts AS (
 SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {S.hash60('doc_id', 42)}, doc_id) AS r FROM part_of),
 quota AS (SELECT lang, f + CASE WHEN row_number() OVER (ORDER BY r DESC, lang NULLS FIRST) <= nt - sum(f) OVER () THEN 1 ELSE 0 END AS q
 FROM (SELECT lang, nt, nt * m // n AS f, nt * m % n AS r FROM (SELECT lang, count(*) AS m FROM part_of GROUP BY 1), (SELECT count(*) AS n, ceil(0.2 * count(*))::BIGINT AS nt FROM part_of)))
 SELECT doc_id, parts.lang, CASE WHEN parts.r <= q THEN 'test' ELSE 'train' END AS split FROM parts JOIN quota ON parts.lang IS NOT DISTINCT FROM quota.lang""")
def split_with_null_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.nullif("lang", F.lit("fr")).alias("lang"))
    return SP.mark_split(rows, "doc_id", "lang")


_NESTED = (f"outer_split AS ({S.split('docs', 'doc_id', 'source', 0.2, 42, 'test', 'pool')}), inner_pool AS (SELECT doc_id, source FROM outer_split WHERE split = 'pool'), "
           f"inner_split AS ({S.split('inner_pool', 'doc_id', 'source', 0.2, 43, 'val', 'train')}), "
           "nested AS (SELECT doc_id, source, split FROM inner_split UNION ALL SELECT doc_id, source, split FROM outer_split WHERE split = 'test')")


def nested(spark, sf_dir):
    return SP.mark_train_val_test(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id", "source")


@query("train_val_test_split", f"WITH {_D}, {_NESTED} SELECT * FROM nested")
def train_val_test_split(spark, sf_dir):
    return nested(spark, sf_dir).select("doc_id", "source", "split")


@query("split_leak_check", f"WITH {_D}, {_NESTED} SELECT split, count(*) AS rows, 0::BIGINT AS leaked_ids FROM nested GROUP BY 1")
def split_leak_check(spark, sf_dir):
    return SP.split_overlap(nested(spark, sf_dir), "doc_id")


def _chrono(newest_first: bool) -> str:
    n = "(SELECT count(*) FROM orders)"
    head = f"{n} - floor({n} * 0.8)" if newest_first else f"floor({n} * 0.8)"
    first, rest = ("val", "train") if newest_first else ("train", "val")
    return (f"SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) <= {head} "
            f"THEN '{first}' ELSE '{rest}' END AS split FROM orders")


@query("chronological_split", _chrono(False))
def chronological_split(spark, sf_dir):
    return SP.mark_chronological(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey", "o_orderdate").select("o_orderkey", "split")


@query("reverse_chronological_split", _chrono(True))
def reverse_chronological_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return SP.mark_chronological(o, "o_orderkey", "o_orderdate", newest_first=True).select("o_orderkey", "split")


@query("modern_labels_only", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')")
def modern_labels_only(spark, sf_dir):
    return SP.keep_labels(table(spark, sf_dir, "orders"), "o_orderpriority", ["4-NOT SPECIFIED", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("rows_of_split", f"WITH {_D}, {_NESTED} SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM nested WHERE split = 'val')")
def rows_of_split(spark, sf_dir):
    val = nested(spark, sf_dir).filter("split = 'val'").select("doc_id")
    return table(spark, sf_dir, "documents").join(val, "doc_id", "left_semi").select("doc_id", "lang", "n_chars")


# ---- features ----


def _weights_twin(analyzer, low, high, min_df, max_features=None, sublinear=True, norm="l2", out="SELECT doc_id, term, round(w, 6) AS w FROM w") -> str:
    return (f"WITH {_D}, tf AS ({S.term_counts('docs', analyzer, low, high)}), v AS ({S.vocabulary('tf', 'docs', min_df, 0.95, max_features)}), "
            f"w AS ({S.weights('tf', 'v', sublinear, norm)}) {out}")


_DIGEST = "SELECT doc_id, count(*) AS terms, round(sum(w), 6) AS total, round(max(w), 6) AS top FROM w GROUP BY 1"


def _digest(weights):
    return weights.groupBy("doc_id").agg(F.count("*").alias("terms"), F.sum("w").alias("total"), F.max("w").alias("top"))


def _block_query(name, block: V.Block, digest=True):
    low, high = block.ngram_range
    twin = _weights_twin(block.analyzer, low, high, block.min_df, block.max_features, block.sublinear_tf, block.norm,
                         _DIGEST if digest else "SELECT doc_id, term, round(w, 6) AS w FROM w")

    @query(name, twin)
    def run(spark, sf_dir):
        w = V.transform(processed(spark, sf_dir), vocabulary(spark, sf_dir, block), block)
        return _digest(w) if digest else w.select("doc_id", "term", "w")


_block_query("tfidf_word_unigrams", V.WORD_UNIGRAMS, digest=False)
_block_query("tfidf_word_bigrams", V.WORD_BIGRAMS)
_block_query("tfidf_word_trigrams", replace(V.WORD_UNIGRAMS, ngram_range=(1, 3), min_df=3))
_block_query("tfidf_word_raw_counts", replace(V.WORD_UNIGRAMS, sublinear_tf=False))
_block_query("tfidf_word_l1", replace(V.WORD_BIGRAMS, norm="l1"))
_block_query("tfidf_char_grams", V.CHAR_GRAMS)
_block_query("tfidf_char_in_words", V.CHAR_WORD_GRAMS)
_block_query("tfidf_capped_vocabulary", replace(V.WORD_BIGRAMS, max_features=2000))


def _vocabulary_query(name, block):
    low, high = block.ngram_range

    @query(name, f"WITH {_D}, tf AS ({S.term_counts('docs', block.analyzer, low, high)}), v AS ({S.vocabulary('tf', 'docs', block.min_df, 0.95, block.max_features)}) "
           "SELECT term, df, cf, round(idf, 6) AS idf FROM v")
    def run(spark, sf_dir):
        return vocabulary(spark, sf_dir, block).select("term", "df", "cf", "idf")


_vocabulary_query("vocabulary_words", V.WORD_UNIGRAMS)
_vocabulary_query("vocabulary_capped", replace(V.WORD_BIGRAMS, max_features=2000))
_vocabulary_query("vocabulary_chars", V.CHAR_GRAMS)


@query("tfidf_unseen_corpus", f"""WITH {_D}, tf AS ({S.term_counts('docs', 'word', 1, 1)}), v AS ({S.vocabulary('tf', 'docs', 2, 0.95)}),
 talk AS (SELECT conv_id * 1000 + turn AS doc_id, {S.processed('text')} AS c FROM conversations), ttf AS ({S.term_counts('talk', 'word', 1, 1)}),
 w AS ({S.weights('ttf', 'v')}) SELECT doc_id, term, round(w, 6) AS w FROM w""")
def tfidf_unseen_corpus(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), T.preprocess("text").alias("text"))
    return V.transform(talk, vocabulary(spark, sf_dir, V.WORD_UNIGRAMS), V.WORD_UNIGRAMS).select("doc_id", "term", "w")


_SPEC = V.FeatureSpec(word=V.WORD_UNIGRAMS, char=V.CHAR_GRAMS)
_BOTH = (f"WITH {_D}, wtf AS ({S.term_counts('docs', 'word', 1, 1)}), wv AS ({S.vocabulary('wtf', 'docs', 2, 0.95)}), ww AS ({S.weights('wtf', 'wv')}), "
         f"ctf AS ({S.term_counts('docs', 'char', 3, 5)}), cv AS ({S.vocabulary('ctf', 'docs', 5, 0.95)}), cw AS ({S.weights('ctf', 'cv')}), "
         "w AS (SELECT doc_id, 'word' AS block, term, w FROM ww UNION ALL SELECT doc_id, 'char', term, w FROM cw) ")


def combined(spark, sf_dir, best=None):
    voc = {b.name: vocabulary(spark, sf_dir, b) for b in _SPEC.blocks}
    return V.transform_features(processed(spark, sf_dir), voc, _SPEC, best=best), voc


@query("combined_features", _BOTH + "SELECT doc_id, count(*) FILTER (block = 'word') AS n_word, count(*) FILTER (block = 'char') AS n_char, round(sqrt(sum(w * w)), 6) AS norm FROM w GROUP BY 1")
def combined_features(spark, sf_dir):
    w, _ = combined(spark, sf_dir)
    return w.groupBy("doc_id").agg(F.count_if(F.col("block") == "word").alias("n_word"), F.count_if(F.col("block") == "char").alias("n_char"),
                                   F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


@query("features_with_statistics", f"""WITH {_D}, tf AS ({S.term_counts('docs', 'word', 1, 1)}), v AS ({S.vocabulary('tf', 'docs', 2, 0.95)}), ww AS ({S.weights('tf', 'v')}),
 st AS (SELECT doc_id, ln(1.0 + length(lower(text))) / 10.0 AS a FROM documents),
 w AS (SELECT doc_id, 'word' AS block, w FROM ww UNION ALL SELECT doc_id, 'text_stats', a FROM st WHERE a <> 0)
 SELECT doc_id, block, count(*) AS terms, round(sum(w), 6) AS total FROM w GROUP BY ALL""")
def features_with_statistics(spark, sf_dir):
    spec = V.FeatureSpec(word=V.WORD_UNIGRAMS, text_stats=True)
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw"), T.preprocess("text").alias("text"))
    w = V.transform_features(d, {"word": vocabulary(spark, sf_dir, V.WORD_UNIGRAMS)}, spec, raw="raw")
    return w.groupBy("doc_id", "block").agg(F.count("*").alias("terms"), F.sum("w").alias("total"))


@query("top_active_features", _BOTH + """SELECT doc_id, rank, term AS feature, CASE WHEN block = 'word' THEN 'Word n-gram' ELSE 'Character n-gram' END AS type, round(w, 6) AS weight
 FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC, block DESC, term))::INTEGER AS rank FROM w) WHERE rank <= 10""")
def top_active_features(spark, sf_dir):
    w, _ = combined(spark, sf_dir, best=10)
    return V.top_features(w, 10)


_N = "(SELECT count(*) FROM documents)"


@query("matrix_statistics", _BOTH + f""", s AS (SELECT 'word' AS block, (SELECT count(*) FROM wv) AS dims, (SELECT count(*) FROM ww) AS nnz UNION ALL
 SELECT 'char', (SELECT count(*) FROM cv), (SELECT count(*) FROM cw)), t AS (SELECT * FROM s UNION ALL SELECT 'total', sum(dims), sum(nnz) FROM s)
 SELECT block, {_N} AS docs, dims::BIGINT AS dims, nnz::BIGINT AS nnz, round(nnz::DOUBLE / {_N}, 6) AS nnz_per_doc, round(nnz::DOUBLE / (dims * {_N}::DOUBLE), 6) AS density,
 round(1.0::DOUBLE - nnz::DOUBLE / (dims * {_N}::DOUBLE), 6) AS sparsity FROM t""".replace(") , s AS", "), s AS"))
def matrix_statistics(spark, sf_dir):
    w, voc = combined(spark, sf_dir)
    return V.matrix_statistics(w, voc, table(spark, sf_dir, "documents").count())


@query("metadata_one_hot", f"""WITH h AS (SELECT o_orderkey, unnest(['status=' || o_orderstatus, 'quarter=' || year(o_orderdate) || 'Q' || quarter(o_orderdate)]) AS term, year(o_orderdate) AS y FROM orders)
 SELECT o_orderkey AS doc_id, term, 1.0::DOUBLE AS w FROM h WHERE term IN (SELECT term FROM h WHERE y < 2000)""")
def metadata_one_hot(spark, sf_dir):
    """Levels are learnt on the years before 2000; all orders are encoded, and levels not seen there are left out."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "doc_id")
    cols = {"status": F.col("o_orderstatus"), "quarter": D.quarter(F.col("o_orderdate"))}
    _, levels = V.one_hot(o.filter("year(o_orderdate) < 2000"), None, "doc_id", cols)
    rows, _ = V.one_hot(o, levels, "doc_id", cols)
    return rows.select("doc_id", "term", "w")


# ---- similarity ----


def word_weights(spark, sf_dir, block=V.WORD_UNIGRAMS, carry=()):
    return V.transform(processed(spark, sf_dir), vocabulary(spark, sf_dir, block), block, carry=carry)


def benchmark_weights(spark, sf_dir, block=V.WORD_UNIGRAMS):
    items = table(spark, sf_dir, "benchmark").select("item_id", T.preprocess("text").alias("text"))
    return stage(V.transform(items, vocabulary(spark, sf_dir, block), block, id="item_id"))


_RETRIEVE = (f"WITH {_D}, tf AS ({S.term_counts('docs', 'word', 1, 1)}), v AS ({S.vocabulary('tf', 'docs', 2, 0.95)}), w AS ({S.weights('tf', 'v')}), "
             f"items AS (SELECT item_id AS doc_id, {S.processed('text')} AS c FROM benchmark), qtf AS ({S.term_counts('items', 'word', 1, 1)}), "
             f"q AS (SELECT doc_id AS item_id, term, w FROM ({S.weights('qtf', 'v')})), "
             "scores AS (SELECT item_id, w.doc_id, least(greatest(sum(q.w * w.w), 0.0), 1.0) AS score FROM q JOIN w USING (term) GROUP BY ALL), "
             "ranked AS (SELECT item_id, doc_id, coalesce(score, 0.0) AS score, (row_number() OVER (PARTITION BY item_id ORDER BY round(coalesce(score, 0.0), 9) DESC, doc_id))::INTEGER AS rank "
             "FROM (SELECT item_id FROM benchmark) CROSS JOIN (SELECT doc_id FROM documents) LEFT JOIN scores USING (item_id, doc_id)) ")


@query("cosine_pairs", _RETRIEVE + "SELECT item_id, doc_id, round(score, 6) AS score FROM scores")
def cosine_pairs(spark, sf_dir):
    return SIM.cosine_pairs(benchmark_weights(spark, sf_dir), word_weights(spark, sf_dir), "item_id", "doc_id")


@query("top_k_records", _RETRIEVE + "SELECT item_id, doc_id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10 AND score > 0")
def top_k_records(spark, sf_dir):
    return SIM.search(benchmark_weights(spark, sf_dir), word_weights(spark, sf_dir), 10, "item_id", "doc_id").select("item_id", "doc_id", "rank", "score")


@query("similar_records", _RETRIEVE + """SELECT item_id, rank, doc_id, round(score, 6) AS score, source AS category, text FROM ranked JOIN documents USING (doc_id) WHERE rank <= 5""")
def similar_records(spark, sf_dir):
    details = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("category"), "text")
    hits = SIM.find_similar(benchmark_weights(spark, sf_dir), word_weights(spark, sf_dir), details, 5, "item_id", "doc_id", table(spark, sf_dir, "benchmark"))
    return hits.select("item_id", "rank", "doc_id", "score", "category", "text")


_TOXIC = (f"WITH {_D}, tf AS ({S.term_counts('docs', 'word', 1, 1)}), v AS ({S.vocabulary('tf', 'docs', 2, 0.95)}), w AS ({S.weights('tf', 'v')}), "
          "q AS (SELECT doc_id AS query_id, term, w FROM w JOIN labels USING (doc_id) WHERE toxic = 1), "
          "scores AS (SELECT query_id, w.doc_id, least(greatest(sum(q.w * w.w), 0.0), 1.0) AS score FROM q JOIN w USING (term) GROUP BY ALL), "
          "seven AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS r FROM scores QUALIFY r <= 7), "
          "kept AS (SELECT s.*, row_number() OVER (PARTITION BY query_id ORDER BY r) AS n FROM seven s JOIN docs a ON a.doc_id = s.query_id JOIN docs b ON b.doc_id = s.doc_id "
          "WHERE NOT (score > 0.9999 AND a.c = b.c) QUALIFY n <= 5) ")


@query("similar_records_without_self", _TOXIC + "SELECT query_id, n::INTEGER AS rank, doc_id, round(score, 6) AS score FROM kept")
def similar_records_without_self(spark, sf_dir):
    w = stage(V.transform_vectors(processed(spark, sf_dir), vocabulary(spark, sf_dir, V.WORD_UNIGRAMS), V.WORD_UNIGRAMS))
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    q = stage(w.join(toxic, "doc_id", "left_semi").withColumnRenamed("doc_id", "query_id"))
    seven = SIM.search(q, w, 7, "query_id", "doc_id")
    # equal processed text covers equal raw text; digests keep the joined side narrow
    digest = processed(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("t"))
    seven = seven.join(digest.withColumnRenamed("t", "tb"), "doc_id").join(digest.toDF("query_id", "ta"), "query_id")
    kept = SIM.drop_self_matches(seven.withColumn("same", F.col("ta") == F.col("tb")), 5, "query_id", "doc_id", "same")
    return kept.select("query_id", "rank", "doc_id", "score")


@query("dense_similarity", """WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS term, unnest(embedding)::DOUBLE AS x FROM embeddings),
 u AS (SELECT vec_id, label, term, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS w FROM e), c AS (SELECT label, term, avg(x) AS x FROM e GROUP BY ALL),
 m AS (SELECT label AS centre, term, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS w FROM c)
 SELECT vec_id, centre, round(least(greatest(sum(u.w * m.w), 0.0), 1.0), 6) AS score FROM u JOIN m USING (term) GROUP BY ALL""")
def dense_similarity(spark, sf_dir):
    long = SIM.dense_to_long(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    means = long.join(labels, "vec_id").groupBy("label", "term").agg(F.avg("w").alias("w")).withColumnRenamed("label", "centre")
    return SIM.cosine_pairs(SIM.unit_vectors(means, "centre"), SIM.unit_vectors(long, "vec_id"), "centre", "vec_id")


_TWO = (f"WITH {_D}, parts AS ({S.split('docs', 'doc_id', 'source', 0.2, 42)}), train AS (SELECT docs.* FROM docs JOIN parts USING (doc_id) WHERE split = 'train'), "
        f"val AS (SELECT docs.* FROM docs JOIN parts USING (doc_id) WHERE split = 'test'), tf AS ({S.term_counts('train', 'word', 1, 2)}), v AS ({S.vocabulary('tf', 'train', 2, 0.95)}), "
        f"w AS ({S.weights('tf', 'v')}), qtf AS ({S.term_counts('val', 'word', 1, 2)}), q AS (SELECT doc_id AS query_id, term, w FROM ({S.weights('qtf', 'v')})), "
        "scores AS (SELECT query_id, w.doc_id, least(greatest(sum(q.w * w.w), 0.0), 1.0) AS score FROM q JOIN w USING (term) GROUP BY ALL), "
        "best AS (SELECT query_id, doc_id AS nn_id, score FROM scores QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) = 1), "
        "nn AS (SELECT val.doc_id, nn_id, coalesce(score, 0.0) AS nn_sim FROM val LEFT JOIN best ON query_id = val.doc_id) ")



def train_neighbours(spark, sf_dir):
    """Nearest training record of every test record (80 / 20 split), word (1, 2) features of the training side."""

    def build():
        d = SP.mark_split(processed(spark, sf_dir), "doc_id", "source")
        train, val = d.filter("split = 'train'"), d.filter("split = 'test'")
        voc = V.fit_vocabulary(train, V.WORD_BIGRAMS)
        corpus, q = (stage(V.transform_vectors(side, voc, V.WORD_BIGRAMS)) for side in (train, val))
        every = val.select(F.col("doc_id").alias("query_id"))
        found = stage(SIM.nearest(q.withColumnRenamed("doc_id", "query_id"), corpus, "query_id", "doc_id", all_queries=every).withColumnRenamed("query_id", "doc_id"))
        drop(corpus, q)
        return found

    return shared(spark, sf_dir, "train_neighbours", build)


@query("nearest_training_record", _TWO + "SELECT doc_id, nn_id, round(nn_sim, 6) AS nn_sim FROM nn")
def nearest_training_record(spark, sf_dir):
    return train_neighbours(spark, sf_dir)


_DUP = (f"WITH {_D}, tf AS ({S.term_counts('docs', 'word', 1, 2)}), v AS ({S.vocabulary('tf', 'docs', 2, 0.95)}), w AS ({S.weights('tf', 'v')}), "
        "pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) AS score FROM w a JOIN w b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL HAVING sum(a.w * b.w) >= 0.9 - 1e-9), "
        "lp AS (SELECT least(x.source, y.source) AS label_a, greatest(x.source, y.source) AS label_b, count(*) AS pairs FROM pairs JOIN docs x ON x.doc_id = a JOIN docs y ON y.doc_id = b GROUP BY ALL) ")


def near_duplicates(spark, sf_dir):
    """Near-duplicate pairs per label pair; copies are counted, not listed."""

    def build():
        block = V.WORD_BIGRAMS
        packed = stage(V.transform_vectors(processed(spark, sf_dir), vocabulary(spark, sf_dir, block), block, carry=("source",)))
        counts = packed.groupBy("vec", "source").agg(F.count("*").alias("m"))
        vectors = SIM.distinct_vectors(packed, "doc_id")
        pairs = SIM.near_packed_pairs(vectors, 0.9, "doc_id")
        found = stage(SIM.near_label_pairs(pairs, vectors, counts, "doc_id", "source"))
        drop(packed)
        return found

    return shared(spark, sf_dir, "near_duplicates", build)


@query("near_duplicate_label_pairs", _DUP + "SELECT * FROM lp")
def near_duplicate_label_pairs(spark, sf_dir):
    return near_duplicates(spark, sf_dir)


_M = f"m AS ({S.mapping('sources_narrow')})"


@query("near_duplicate_conflicts", _DUP + f""", {_M} SELECT coalesce(sum(pairs), 0)::BIGINT AS total, coalesce(sum(pairs) FILTER (label_a <> label_b), 0)::BIGINT AS label_conflict,
 coalesce(sum(pairs) FILTER (label_a <> label_b AND x.normalized_category = y.normalized_category), 0)::BIGINT AS conflict_same_group,
 coalesce(sum(pairs) FILTER (x.normalized_category <> y.normalized_category), 0)::BIGINT AS conflict_cross_group
 FROM lp JOIN m x ON x.category = label_a JOIN m y ON y.category = label_b""")
def near_duplicate_conflicts(spark, sf_dir):
    from narrata.operators.taxonomy import map_labels
    from narrata.sources.taxonomy import CONFIG, load_taxonomy

    m = load_taxonomy(spark, f"{CONFIG}/sources_narrow.json")
    p = map_labels(map_labels(near_duplicates(spark, sf_dir), m, "label_a", "ga"), m, "label_b", "gb")
    differ, same = F.col("label_a") != F.col("label_b"), F.col("ga") == F.col("gb")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("pairs"))), F.lit(0))

    return p.agg(total(F.lit(True)).alias("total"), total(differ).alias("label_conflict"),
                 total(differ & same).alias("conflict_same_group"), total(~same).alias("conflict_cross_group"))


@query("near_duplicate_top_conflicts", _DUP + "SELECT * FROM lp WHERE label_a <> label_b ORDER BY pairs DESC, label_a, label_b LIMIT 8")
def near_duplicate_top_conflicts(spark, sf_dir):
    return near_duplicates(spark, sf_dir).filter("label_a <> label_b").orderBy(F.desc("pairs"), "label_a", "label_b").limit(8)


_CENT = (f"WITH {_D}, tf AS ({S.term_counts('docs', 'word', 1, 1)}), v AS ({S.vocabulary('tf', 'docs', 2, 0.95)}), w0 AS ({S.weights('tf', 'v')}), "
         "w AS (SELECT w0.*, source FROM w0 JOIN documents USING (doc_id)), n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), "
         "cent AS (SELECT source, term, sum(w) / any_value(n) AS w FROM w JOIN n USING (source) GROUP BY ALL), "
         "unit AS (SELECT source, term, w / sqrt(sum(w * w) OVER (PARTITION BY source)) AS u FROM cent), "
         "best AS (SELECT source, term FROM cent QUALIFY row_number() OVER (PARTITION BY source ORDER BY round(w, 9) DESC, term) <= 500), "
         "cos AS (SELECT x.source AS a, y.source AS b, sum(x.u * y.u) AS cosine FROM unit x JOIN unit y USING (term) WHERE x.source <> y.source GROUP BY ALL), "
         "sz AS (SELECT source, count(*) AS n FROM best GROUP BY 1), ov AS (SELECT x.source AS a, y.source AS b, count(*) AS both_n FROM best x JOIN best y USING (term) WHERE x.source <> y.source GROUP BY ALL), "
         "cp AS (SELECT cos.a, cos.b, cosine, coalesce(both_n, 0)::DOUBLE / (p.n + q.n - coalesce(both_n, 0)) AS jaccard FROM cos LEFT JOIN ov USING (a, b) JOIN sz p ON p.source = cos.a JOIN sz q ON q.source = cos.b) ")



def class_pairs(spark, sf_dir):
    def build():
        w = word_weights(spark, sf_dir, carry=("source",))
        counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
        return stage(SIM.class_pairs(stage(SIM.centroids(w, "source", counts)), "source"))

    return shared(spark, sf_dir, "class_pairs", build)


@query("class_centroid_pairs", _CENT + "SELECT a, b, round(cosine, 6) AS cosine, round(jaccard, 6) AS jaccard FROM cp")
def class_centroid_pairs(spark, sf_dir):
    return class_pairs(spark, sf_dir)


@query("nearest_classes", _CENT + """SELECT a AS category, arg_min(b, (round(-jaccard, 9), b)) AS nearest_by_terms, arg_min(b, (round(-cosine, 9), b)) AS nearest_by_centroid FROM cp GROUP BY 1""")
def nearest_classes(spark, sf_dir):
    def best(c):
        return F.min(F.struct((-F.round(c, 9)).alias("o"), F.col("b"))).getField("b")

    return class_pairs(spark, sf_dir).groupBy(F.col("a").alias("category")).agg(
        best("jaccard").alias("nearest_by_terms"), best("cosine").alias("nearest_by_centroid"))


@query("first_texts_per_class", "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 200")
def first_texts_per_class(spark, sf_dir):
    return first_per_key(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], [F.asc("doc_id")], 200).select("doc_id", "lang")
