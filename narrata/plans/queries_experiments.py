"""Queries on experiments, linear models and streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.functions.dates import quarter
from narrata.operators import bayes, linear
from narrata.operators import tfidf as V
from narrata.operators.splits import mark_split
from narrata.plans import experiments as X
from narrata.plans import sql as S
from narrata.plans.queries_features import processed
from narrata.plans.queries_models import ALPHA, labelled, model, narrow
from narrata.plans.queries_text import _HITS, _hit_pages
from narrata.plans.registry import query, shared, table
from narrata.plans.search import ALPHAS, Classifier, Search, compare_blocks, search_report
from narrata.plans.search import experiment_matrix as cleaning_by_labels
from narrata.session import owned_path, stage
from narrata.sources import csv_scan
from narrata.streaming import ingest

RETIRED = ["src0", "src3", "src5", "src7"]


def dated(spark, sf_dir):
    """All documents with the order date of the same number as their received date; those without such an order get a day by their id."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.to_date("o_orderdate").alias("date"))
    return shared(spark, sf_dir, "dated", lambda: stage(
        processed(spark, sf_dir).join(o, "doc_id", "left").select("doc_id", F.col("source").alias("label"), F.coalesce("date", F.expr("date_add(DATE '1992-01-01', CAST(doc_id % 2400 AS INT))")).alias("date"), "text")))


def _run_ctes(n: str, rows: str, random: bool, newest_first: bool = False) -> str:
    if random:
        marked = f"SELECT r.*, split FROM {rows} r JOIN ({S.split(rows, 'doc_id', 'label', 0.2, 42, 'val', 'train')}) USING (doc_id, label)"
    else:
        head = f"(SELECT count(*) - floor(count(*) * 0.8) FROM {rows})" if newest_first else f"(SELECT floor(count(*) * 0.8) FROM {rows})"
        a, b = ("val", "train") if newest_first else ("train", "val")
        marked = f"SELECT *, CASE WHEN row_number() OVER (ORDER BY date, doc_id) <= {head} THEN '{a}' ELSE '{b}' END AS split FROM {rows}"
    return (f"{n}_all AS ({marked}), {n}_pool AS (SELECT * FROM {n}_all WHERE split = 'train'), {n}_held AS (SELECT * FROM {n}_all WHERE split = 'val'), "
            f"{S.bayes(n, n + '_pool', n + '_held')}, {S.metrics_of(n, n + 'm')}")


def _run_row(n: str, name: str) -> str:
    seen = f"p.y_true IN (SELECT label FROM {n}_pool)"
    return (f"SELECT '{name}' AS run, {S.rounded(('accuracy', 'macro_f1', 'macro_recall', 'weighted_f1'))}, "
            f"(SELECT round(avg((x.normalized_category = y.normalized_category)::INT), 6) FROM {n} p JOIN m x ON x.category = p.y_true JOIN m y ON y.category = p.y_pred) AS group_accuracy, "
            f"(SELECT count(*) FILTER (NOT ({seen})) FROM {n} p) AS unseen_label_rows, (SELECT round(avg((p.y_true = p.y_pred)::INT) FILTER ({seen}), 6) FROM {n} p) AS accuracy_on_seen_labels, "
            + ", ".join(f"(SELECT {e} FROM {n}_{t}) AS {c}" for s, t in (("train", "pool"), ("val", "held")) for c, e in
                        ((f"{s}_rows", "count(*)"), (f"{s}_from", "min(date)"), (f"{s}_to", "max(date)"))) + f" FROM {n}m_sum")


_RUNS = {"ra": ("A random", "dated", True, False), "rb": ("B chronological", "dated", False, False), "rc": ("C reverse chronological", "dated", False, True),
         "rd": ("D random, modern labels", "modern", True, False), "re": ("E chronological, modern labels", "modern", False, False)}
_DATED = (f"WITH m AS ({S.mapping('sources_narrow')}), dated AS (SELECT doc_id, source AS label, coalesce(CAST(o_orderdate AS DATE), DATE '1992-01-01' + CAST(doc_id % 2400 AS INTEGER)) AS date, {S.processed('text')} AS c FROM documents LEFT JOIN orders ON o_orderkey = doc_id), "
          f"modern AS (SELECT * FROM dated WHERE label NOT IN {S.text_list(RETIRED)})")


@query("chronological_experiment", _DATED + ", " + ", ".join(_run_ctes(n, r, rnd, new) for n, (_, r, rnd, new) in _RUNS.items()) + " "
       + " UNION ALL ".join(_run_row(n, v[0]) for n, v in _RUNS.items()))
def chronological_experiment(spark, sf_dir):
    out = None
    for name, rows in X.chronological_splits(dated(spark, sf_dir), RETIRED).items():
        row = X.run_split(rows, name, V.WORD_UNIGRAMS, ALPHA, narrow(spark))
        out = row if out is None else out.unionByName(row)
    return out


@query("streamed_hits", f"WITH {_HITS} SELECT complaint_id, category, text, issue FROM hits")
def streamed_hits(spark, sf_dir):
    """The landed pages read as a stream until all files are taken; equals the batch result."""
    root = owned_path(spark, "stream")
    _hit_pages(spark, sf_dir).select("hits").write.json(f"{root}/in")
    records = ingest.read_pages(spark, f"{root}/in", one_page_per_file=False)
    ingest.write_records(records, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("complaint_id", "category", "text", "issue")


#: Hits of every seventh turn have no date; the others have one of twenty days by their conversation.
_DAY = "CASE WHEN turn % 7 <> 3 THEN CAST(DATE '2024-01-01' + CAST(conv_id % 20 AS INTEGER) AS VARCHAR) END"


@query("streamed_unique_hits", f"""WITH h AS (SELECT CASE WHEN turn > 0 THEN conv_id || '-' || turn ELSE 'h' || conv_id || '-' || turn END AS complaint_id, {_DAY} AS d FROM conversations)
 SELECT complaint_id, d AS date_received, 'unique' AS fate FROM h WHERE d IS NOT NULL UNION ALL SELECT complaint_id, d, 'undated' FROM h, range(3) WHERE d IS NULL""")
def streamed_unique_hits(spark, sf_dir):
    """All pages land three times, one landing a micro-batch: dated records leave their repeats, undated ones keep every copy."""
    root = owned_path(spark, "stream")
    day = F.when(F.expr("element_at(split(coalesce(hit._source.complaint_id, hit._id), '-'), -1) % 7 <> 3"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 20).cast("int")))
    hits = _hit_pages(spark, sf_dir).select("conv_id", F.explode("hits.hits").alias("hit")).withColumn("_d", day.cast("string"))
    page = hits.groupBy("conv_id").agg(F.collect_list(F.col("hit").withField("_source", F.col("hit._source").withField("date_received", F.col("_d")))).alias("hits"))
    pages = stage(page.select(F.struct("hits").alias("hits")))
    for _ in range(3):
        pages.write.mode("append").json(f"{root}/in")
    for stream in ingest.write_unique(ingest.read_pages(spark, f"{root}/in", len(pages.inputFiles()), one_page_per_file=False), f"{root}/out", f"{root}/state", "30 days"):
        stream.awaitTermination()
    parts = [spark.read.parquet(f"{root}/out/{fate}").select("complaint_id", "date_received", F.lit(fate).alias("fate")) for fate in ("unique", "undated")]
    return parts[0].unionByName(parts[1])


@query("streamed_scores", f"""WITH {S.corpus()}, {_HITS}, new AS (SELECT complaint_id AS doc_id, NULL::VARCHAR AS label, {S.processed('text')} AS c FROM hits), heard AS (SELECT * FROM new WHERE c <> ''),
 {S.bayes('ps', held='heard')} SELECT doc_id AS complaint_id, y_pred, round(conf, 6) AS conf FROM ps""")
def streamed_scores(spark, sf_dir):
    """Landed pages scored micro-batch by micro-batch with the model of the labelled documents."""
    root = owned_path(spark, "stream")
    _hit_pages(spark, sf_dir).select("hits").write.json(f"{root}/in")
    known = model(spark, sf_dir)
    score = lambda rows: bayes.predict(known, rows, "complaint_id").select("complaint_id", "y_pred", "conf")
    records = ingest.read_pages(spark, f"{root}/in", 2, one_page_per_file=False)
    ingest.score_stream(records, score, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("complaint_id", "y_pred", "conf")


@query("csv_round_trip", "SELECT doc_id::VARCHAR AS doc_id, source, lang, n_chars::VARCHAR AS n_chars, text FROM documents")
def csv_round_trip(spark, sf_dir):
    """Documents as quoted CSV with line ends inside texts, read back by byte ranges."""
    root = owned_path(spark, "csv")
    docs = table(spark, sf_dir, "documents").select(*[F.col(c).cast("string") for c in ("doc_id", "source", "lang", "n_chars", "text")])
    docs.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root)
    return csv_scan.scan(spark, root, docs.schema)


# ---- model search over Bayes candidates: one pass a feature spec ----


GRID = [(kind, alpha) for kind in ("complement", "multinomial") for alpha in ALPHAS]


def searched(spark, sf_dir):
    """Results of two steps of the search, words alone and with bigrams, on the split of the error analysis."""

    def build():
        d = labelled(spark, sf_dir)
        search = Search(spark, d.filter("split = 'pool'"), d.filter("split = 'test'"), owned_path(spark, "search"))
        candidates = [Classifier(kind, alpha=a) for kind, a in GRID]
        search.run_stage("words", [V.FeatureSpec(word=V.WORD_UNIGRAMS)], candidates)
        return search.run_stage("bigrams", [V.FeatureSpec(word=V.WORD_BIGRAMS)], candidates)

    return shared(spark, sf_dir, "searched", build)


_FOUND = f"""WITH {S.corpus()}, cand AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {a}::DOUBLE)" for k, a in GRID)}) AS t(model, alpha)),
 {S.bayes_grid('gu', 'words', 1, 1)}, {S.bayes_grid('gb', 'bigrams', 1, 2)}, found AS (SELECT * FROM gu UNION ALL SELECT * FROM gb)"""
_SHOWN = "stage, model, alpha, " + S.rounded(S.METRICS)


def shown(results):
    return results.select("stage", "model", F.get_json_object("params", "$.alpha").cast("double").alias("alpha"), *S.METRICS)


@query("search_by_stage", f"{_FOUND} SELECT stage, count(*) AS n, round(min(accuracy), 6) + 0.0 AS accuracy_min, round(max(accuracy), 6) + 0.0 AS accuracy_max, round(max(macro_f1), 6) + 0.0 AS macro_f1_max, 0::BIGINT AS n_unconverged FROM found GROUP BY 1")
def search_by_stage(spark, sf_dir):
    return search_report(searched(spark, sf_dir))["stages"]


@query("search_best_by_model", f"{_FOUND} SELECT {_SHOWN} FROM found QUALIFY row_number() OVER (PARTITION BY model ORDER BY round(macro_f1, 9) DESC, round(accuracy, 9) DESC, stage DESC, model, alpha) = 1")
def search_best_by_model(spark, sf_dir):
    return shown(search_report(searched(spark, sf_dir))["best_by_model"])


@query("search_top_three", f"{_FOUND} SELECT {_SHOWN} FROM found ORDER BY round(accuracy, 9) DESC, round(macro_f1, 9) DESC, stage DESC, model, alpha LIMIT 3")
def search_top_three(spark, sf_dir):
    return shown(search_report(searched(spark, sf_dir))["best_by_accuracy"])


@query("search_range", f"{_FOUND} SELECT count(*) AS n, round(min(accuracy), 6) + 0.0 AS accuracy_min, round(max(accuracy), 6) + 0.0 AS accuracy_max, round(quantile_cont(accuracy, 0.9), 6) + 0.0 AS accuracy_p90, round(min(macro_f1), 6) + 0.0 AS macro_f1_min, round(max(macro_f1), 6) + 0.0 AS macro_f1_max, 0::BIGINT AS n_unconverged FROM found")
def search_range(spark, sf_dir):
    return search_report(searched(spark, sf_dir))["range"]


# ---- cleaning modes x label sets, and metadata beside text ----


_CELLS = [(mode, text, name, target) for mode, text in (("standard", "sc"), ("minimal", "mc")) for name, target in (("all labels", "label"), ("groups", "grp"))]
_MATRIX = (f"WITH m AS ({S.mapping('sources_narrow')}), docs AS (SELECT doc_id, source AS label, coalesce(normalized_category, source) AS grp, {S.processed('text')} AS sc, {S.minimal('text')} AS mc "
           f"FROM documents LEFT JOIN m ON category = source), parts AS ({S.split('docs', 'doc_id', 'label', 0.2, 42, 'val', 'train')}), " + ", ".join(
               f"x{i}_pool AS (SELECT doc_id, docs.{target} AS label, {text} AS c FROM docs JOIN parts USING (doc_id) WHERE split = 'train'), "
               f"x{i}_held AS (SELECT doc_id, docs.{target} AS label, {text} AS c FROM docs JOIN parts USING (doc_id) WHERE split = 'val'), "
               f"{S.bayes(f'x{i}', f'x{i}_pool', f'x{i}_held', 'complement', 0.3)}, {S.metrics_of(f'x{i}', f'x{i}m')}" for i, (_, text, _, target) in enumerate(_CELLS)))


@query("experiment_matrix", _MATRIX + " " + " UNION ALL ".join(f"SELECT '{mode}' AS cleaning, '{name}' AS labels, {S.rounded(S.METRICS)} FROM x{i}m_sum" for i, (mode, _, name, _) in enumerate(_CELLS)))
def experiment_matrix(spark, sf_dir):
    rows = mark_split(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("label"), "text"), "doc_id", "label", 0.2, 42, test="val")
    made = cleaning_by_labels(rows, narrow(spark), V.FeatureSpec(word=V.WORD_UNIGRAMS), Classifier("complement", alpha=0.3))
    return made.select("cleaning", "labels", *S.METRICS)


_RECORD = {"quarter": "year(o_orderdate) || 'Q' || quarter(o_orderdate)", "status": "o_orderstatus", "priority": "o_orderpriority"}
_CUES = ", ".join(f"'{k}=' || coalesce({e}, 'NA')" for k, e in _RECORD.items())
_FEATURE_RUNS = {"text": ("word",), "metadata": ("meta",), "text + metadata": ("word", "meta")}


def _blocks(side: str, members: tuple[str, ...], keys: str) -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{b}:' || term AS term, w FROM {b}_{side}" for b in members)


_AUGMENTED = (f"WITH {S.corpus()}, tf AS ({S.term_counts('pool', 'word', 1, 1, 'doc_id, label')}), v AS ({S.vocabulary('tf', 'pool', 2, 0.95)}), word_w AS ({S.weights('tf', 'v', keys='doc_id, label')}), "
              f"htf AS ({S.term_counts('held', 'word', 1, 1)}), word_hw AS ({S.weights('htf', 'v')}), cues AS (SELECT doc_id, label, split, unnest([{_CUES}]) AS term, 1.0::DOUBLE AS w FROM parts LEFT JOIN orders ON o_orderkey = doc_id), "
              "meta_w AS (SELECT * FROM cues WHERE split = 'pool'), meta_hw AS (SELECT * FROM cues WHERE split = 'test' AND term IN (SELECT term FROM meta_w)), " + ", ".join(
                  f"f{i}_w AS ({_blocks('w', members, 'doc_id, label')}), f{i}_hw AS ({_blocks('hw', members, 'doc_id')}), f{i}_v AS (SELECT DISTINCT term FROM f{i}_w), "
                  f"{S.bayes_of_weights(f'f{i}', 'pool', 'held', 'complement', 0.3)}, {S.metrics_of(f'f{i}', f'f{i}m')}" for i, members in enumerate(_FEATURE_RUNS.values())))


@query("augmented_features_metrics", _AUGMENTED + " " + " UNION ALL ".join(f"SELECT '{name}' AS features, {S.rounded(S.METRICS)} FROM f{i}m_sum" for i, name in enumerate(_FEATURE_RUNS)))
def augmented_features_metrics(spark, sf_dir):
    """Text, metadata, and both in one model. The record of a document is the order of its number; levels are learnt on the pool."""
    d = labelled(spark, sf_dir)
    sides = [d.filter(F.col("split") == s) for s in ("pool", "test")]
    voc = V.fit_vocabulary(sides[0], V.WORD_UNIGRAMS)
    word = [stage(V.transform(side, voc, V.WORD_UNIGRAMS, carry=("label",))) for side in sides]
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate", "o_orderstatus", "o_orderpriority")
    cues = {"quarter": quarter(F.col("o_orderdate")), "status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")}
    meta, levels = [], None
    for side in sides:
        ids = side.select("doc_id", "label")
        hot, levels = V.one_hot(ids.join(o, "doc_id", "left"), levels, "doc_id", cues)
        meta.append(stage(hot.join(ids, "doc_id")))
    made = compare_blocks({"word": word, "meta": meta}, sides, _FEATURE_RUNS, Classifier("complement", alpha=0.3))
    return made.select("features", *S.METRICS)


# ---- linear models: iterative solvers, no SQL twin ----


def vectors(spark, sf_dir):
    """Train and test vectors of the error-analysis split with their index."""

    def build():
        d = labelled(spark, sf_dir)
        pool, test = d.filter("split = 'pool'"), d.filter("split = 'test'")
        spec = V.FeatureSpec(word=V.WORD_UNIGRAMS)
        voc = V.fit_features(pool, spec)
        index = linear.feature_index(voc)
        made = [linear.assemble(V.transform_features(part, voc, spec), index, part, "doc_id", ("label",)) for part in (pool, test)]
        return (*made, index)

    return shared(spark, sf_dir, "vectors", build)


def logistic(spark, sf_dir):
    return shared(spark, sf_dir, "logistic", lambda: linear.fit_logistic(vectors(spark, sf_dir)[0], "label", 2.0, 1.0, max_iter=500))


@query("logistic_predictions")
def logistic_predictions(spark, sf_dir):
    return linear.predict(logistic(spark, sf_dir), vectors(spark, sf_dir)[1]).select("doc_id", F.col("label").alias("y_true"), "y_pred", "conf")


@query("logistic_terms")
def logistic_terms(spark, sf_dir):
    return linear.coefficient_terms(logistic(spark, sf_dir), vectors(spark, sf_dir)[2], 10)


@query("svc_predictions")
def svc_predictions(spark, sf_dir):
    train, test, _ = vectors(spark, sf_dir)
    m = linear.fit_svc(train, "label", 0.5, 1.0, max_iter=100)
    return linear.predict(m, test).select("doc_id", F.col("label").alias("y_true"), "y_pred", "conf")


@query("hierarchical_predictions")
def hierarchical_predictions(spark, sf_dir):
    train, test, _ = vectors(spark, sf_dir)
    models = linear.fit_hierarchy(train, "label", narrow(spark), 2.0, 1.0, 500)
    return linear.predict_hierarchy(models, test, "doc_id", ("label",)).select("doc_id", F.col("label").alias("y_true"), "y_pred")


@query("class_weight_audit")
def class_weight_audit(spark, sf_dir):
    train, test, _ = vectors(spark, sf_dir)
    return linear.weight_audit(train, test, "label", {"none": None, "balanced": 1.0, "power 0.5": 0.5}, C=2.0, max_iter=500)
