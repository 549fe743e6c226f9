"""Queries on classifiers, evaluation and error analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.operators import bayes as B
from narrata.operators import errors as E
from narrata.operators import evaluation as EV
from narrata.operators import lookup as L
from narrata.operators import splits as SP
from narrata.operators import temporal
from narrata.operators import tfidf as V
from narrata.operators.taxonomy import information_loss, map_labels, merged_group_loss
from narrata.plans import sql as S
from narrata.plans.queries_features import _CENT, _TWO, class_pairs, processed, train_neighbours
from narrata.plans.registry import query, shared, table
from narrata.session import drop, stage
from narrata.sources.taxonomy import CONFIG, load_taxonomy

ALPHA = 0.1
_BASE = f"WITH {S.corpus()}, m AS ({S.mapping('sources_narrow')}), mb AS ({S.mapping('sources_broad')})"
_A = f"{_BASE}, {S.bayes('pa')}, {S.metrics_of('pa', 'ma')}"
_B = f"{S.bayes('pb', kind='complement', alpha=0.3)}, {S.metrics_of('pb', 'mb_')}"
_AB = f"{_A}, {_B}"


def narrow(spark):
    return load_taxonomy(spark, f"{CONFIG}/sources_narrow.json")


def broad(spark):
    return load_taxonomy(spark, f"{CONFIG}/sources_broad.json")


def labelled(spark, sf_dir, label="source"):
    """Processed documents with the 80 / 20 split of the error analysis."""
    return shared(spark, sf_dir, ("labelled", label), lambda: stage(SP.mark_split(
        processed(spark, sf_dir).withColumn("label", F.col(label)), "doc_id", "label", train="pool").select("doc_id", "label", "text", "split")))


def sums(spark, sf_dir, block=V.WORD_UNIGRAMS):
    return shared(spark, sf_dir, ("sums", block), lambda: B.fit_sums(
        labelled(spark, sf_dir).filter("split = 'pool'"), block, "label"))


def model(spark, sf_dir, kind="multinomial", alpha=ALPHA, block=V.WORD_UNIGRAMS):
    counts, table_ = sums(spark, sf_dir, block)
    return B.model_from_sums(counts, table_, block, kind, alpha)


def predictions(spark, sf_dir, kind="multinomial", alpha=ALPHA, block=V.WORD_UNIGRAMS):
    """Staged test predictions ``(doc_id, y_true, y_pred, conf, scores)``; all error tables derive from them."""

    def build():
        test = labelled(spark, sf_dir).filter("split = 'test'").withColumnRenamed("label", "y_true")
        return stage(B.predict(model(spark, sf_dir, kind, alpha, block), test, carry=("y_true",)))

    return shared(spark, sf_dir, ("predictions", kind, alpha, block), build)


def other(spark, sf_dir):
    return predictions(spark, sf_dir, "complement", 0.3)


def bundle(spark, sf_dir, kind="multinomial", alpha=ALPHA):
    return shared(spark, sf_dir, ("bundle", kind, alpha), lambda: E.evaluation_bundle(predictions(spark, sf_dir, kind, alpha)))


# ---- models ----


@query("class_weights", f"""{_BASE}, c AS (SELECT label, count(*) AS n FROM docs GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS n_all, count(*) AS k FROM c)
 SELECT label, n, round(1.0::DOUBLE, 6) AS uniform, round(n_all / (k * n), 6) AS balanced, round(pow(n_all / (k * n), 0.5), 6) AS softened FROM c, t""")
def class_weights(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("label"))
    return B.class_weight_table(d, "label", {"uniform": 0.0, "balanced": 1.0, "softened": 0.5})


@query("class_weights_imbalanced", """WITH c AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS n_all, count(*) AS k FROM c)
 SELECT label, n, round(n_all / (k * n), 6) AS balanced, round(pow(n_all / (k * n), 1.25), 6) AS stronger FROM c, t""")
def class_weights_imbalanced(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("label"))
    return B.class_weight_table(d, "label", {"balanced": 1.0, "stronger": 1.25})


@query("multinomial_bayes", f"{_A} SELECT doc_id, y_true, y_pred, round(conf, 6) AS conf FROM pa")
def multinomial_bayes(spark, sf_dir):
    return predictions(spark, sf_dir).select("doc_id", "y_true", "y_pred", "conf")


@query("complement_bayes", f"{_BASE}, {S.bayes('pb', kind='complement', alpha=0.3)} SELECT doc_id, y_true, y_pred, round(conf, 6) AS conf FROM pb")
def complement_bayes(spark, sf_dir):
    return other(spark, sf_dir).select("doc_id", "y_true", "y_pred", "conf")


@query("language_bayes", f"WITH {S.corpus('lang')}, {S.bayes('pl', alpha=1.0)} SELECT doc_id, y_true, y_pred, round(conf, 6) AS conf FROM pl")
def language_bayes(spark, sf_dir):
    d = labelled(spark, sf_dir, "lang")
    m = B.fit(d.filter("split = 'pool'"), V.WORD_UNIGRAMS, "label", alpha=1.0)
    return B.predict(m, d.filter("split = 'test'").withColumnRenamed("label", "y_true"), carry=("y_true",)).select("doc_id", "y_true", "y_pred", "conf")


@query("class_probabilities", f"{_A} SELECT doc_id, label, round(p, 6) AS score FROM pa_prob")
def class_probabilities(spark, sf_dir):
    return B.class_scores(predictions(spark, sf_dir), model(spark, sf_dir).classes)


@query("class_margins", f"{_A} SELECT doc_id, label, round(score, 6) AS score FROM pa_scores")
def class_margins(spark, sf_dir):
    return B.class_scores(predictions(spark, sf_dir), model(spark, sf_dir).classes, probability=False)


@query("top_classes", f"""{_A} SELECT doc_id, rank, label, round(p, 6) AS probability FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY round(p, 9) DESC, label))::INTEGER AS rank FROM pa_prob) WHERE rank <= 5""")
def top_classes(spark, sf_dir):
    return B.top_classes(predictions(spark, sf_dir), model(spark, sf_dir).classes)


@query("top_class_terms", f"""{_A} SELECT label, rank, term, round(theta, 6) AS theta FROM (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY round(theta, 9) DESC, term))::INTEGER AS rank FROM pa_t) WHERE rank <= 25""")
def top_class_terms(spark, sf_dir):
    from narrata.operators.ranking import first_per_key

    return first_per_key(B.term_scores(model(spark, sf_dir)), ["label"], [F.desc(F.round("theta", 9)), "term"], 25).select("label", "rank", "term", "theta")


@query("model_agreement", f"""{_AB}, j AS (SELECT pa.y_true AS t, pa.y_pred AS a, pb.y_pred AS b FROM pa JOIN pb USING (doc_id))
 SELECT round(avg((a = b)::INT), 6) AS agreement, round(avg((a <> t AND b <> t)::INT), 6) AS both_wrong, round(avg((a <> t AND b = t)::INT), 6) AS only_a_wrong,
 round(avg((a = t AND b <> t)::INT), 6) AS only_b_wrong, round(avg((a = t OR b = t)::INT), 6) AS either_right FROM j""")
def model_agreement(spark, sf_dir):
    return E.agreement(predictions(spark, sf_dir), other(spark, sf_dir), "doc_id")


_GRID = (0.01, 0.03, 0.1, 0.3, 1.0)
_CANDS = ", ".join(f"{S.bayes(f'c{i}', alpha=a)}, {S.metrics_of(f'c{i}', f'cm{i}')}" for i, a in enumerate(_GRID))


def candidates(spark, sf_dir):
    """Smoothing grid of the Bayes stage: one set of sums, one pass over the texts, one summary row per candidate."""

    def build():
        grid = B.models_from_sums(*sums(spark, sf_dir), V.WORD_UNIGRAMS, [("multinomial", a) for a in _GRID])
        test = labelled(spark, sf_dir).filter("split = 'test'").withColumnRenamed("label", "y_true")
        rows = EV.metrics(B.predict(grid, test, carry=("y_true",)), keys=("candidate",))
        alphas = F.array(*[F.lit(float(a)) for a in _GRID])
        measured = [c for c in rows.columns if c != "candidate"]
        return stage(rows.select(F.concat(F.lit("c"), F.col("candidate").cast("string")).alias("candidate"), F.get(alphas, F.col("candidate")).alias("alpha"), *measured))

    return shared(spark, sf_dir, "candidates", build)


_ALL_CANDS = " UNION ALL ".join(f"SELECT 'c{i}' AS candidate, {a}::DOUBLE AS alpha, * FROM cm{i}_sum" for i, a in enumerate(_GRID))


@query("ranked_candidates", f"""{_BASE}, {_CANDS}, alls AS ({_ALL_CANDS}) SELECT candidate, alpha, (row_number() OVER (ORDER BY round(macro_f1, 6) DESC, round(macro_recall, 6) DESC,
 round(accuracy, 6) DESC, round(weighted_f1, 6) DESC, candidate))::INTEGER AS rank, {S.rounded(('accuracy', 'macro_f1', 'macro_recall', 'weighted_f1'))} FROM alls""")
def ranked_candidates(spark, sf_dir):
    return EV.rank_candidates(candidates(spark, sf_dir)).select("candidate", "alpha", "rank", "accuracy", "macro_f1", "macro_recall", "weighted_f1")


@query("search_summary", f"""{_BASE}, {_CANDS}, alls AS ({_ALL_CANDS}) SELECT count(*) AS candidates, {S.rounded(('min(accuracy)',)).split(' AS ')[0]} AS accuracy_min, round(max(accuracy), 6) AS accuracy_max,
 round(quantile_cont(accuracy, 0.9), 6) AS accuracy_p90, round(min(macro_f1), 6) AS macro_f1_min, round(max(macro_f1), 6) AS macro_f1_max, arg_min(candidate, (-round(macro_f1, 6), candidate)) AS best_by_macro_f1,
 arg_min(candidate, (-round(accuracy, 6), candidate)) AS best_by_accuracy FROM alls""")
def search_summary(spark, sf_dir):
    def best(c):
        return F.min(F.struct((-F.round(c, 6)).alias("o"), F.col("candidate"))).getField("candidate")

    return candidates(spark, sf_dir).agg(
        F.count("*").alias("candidates"), F.min("accuracy").alias("accuracy_min"), F.max("accuracy").alias("accuracy_max"),
        F.percentile("accuracy", F.lit(0.9)).alias("accuracy_p90"), F.min("macro_f1").alias("macro_f1_min"), F.max("macro_f1").alias("macro_f1_max"),
        best("macro_f1").alias("best_by_macro_f1"), best("accuracy").alias("best_by_accuracy"))


# ---- lookups and time ----

_YEARS = {"custkey": ("o_custkey::VARCHAR", ["o_custkey"]), "status": ("o_orderstatus", ["o_orderstatus"]),
          "year": ("year(o_orderdate)::VARCHAR", ["_year"]), "year_status": ("year(o_orderdate) || '|' || o_orderstatus", ["_year", "o_orderstatus"]),
          "majority": ("''", [])}


def _orders(spark, sf_dir):
    return shared(spark, sf_dir, "orders_split", lambda: stage(SP.mark_split(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("_year"),
                                             F.unix_date(F.to_date("o_orderdate")).alias("day")), "o_orderkey", "o_orderpriority", train="train")))


_OS = (f"WITH parts AS ({S.split('orders', 'o_orderkey', 'o_orderpriority', 0.2, 42)}), o AS (SELECT orders.*, split, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS day "
       "FROM orders JOIN parts USING (o_orderkey)), overall AS (SELECT o_orderpriority AS g FROM o WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


def _lookup_ctes(key: str, n: str) -> str:
    return (f"{n}_t AS (SELECT {key} AS k, o_orderpriority AS l, count(*) AS n FROM o WHERE split = 'train' GROUP BY ALL), "
            f"{n}_m AS (SELECT k, l FROM {n}_t QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, l) = 1), "
            f"{n} AS (SELECT o_orderkey, o_orderpriority AS y_true, coalesce(l, g) AS y_pred, (k IS NOT NULL)::INT AS known FROM "
            f"(SELECT *, {key} AS kk FROM o WHERE split = 'test') LEFT JOIN {n}_m ON kk = k, overall), {S.metrics_of(n, n + 'e')}")


def _lookup(spark, sf_dir, name):
    o = _orders(spark, sf_dir)
    cols = [F.col(c) for c in _YEARS[name][1]]
    key = L.key_of(cols) if cols else F.lit("")
    train = o.filter("split = 'train'")
    levels, overall = L.fit_lookup(train, key, "o_orderpriority")
    rows = L.apply_lookup(o.filter("split = 'test'"), levels, overall, key)
    return rows.select("o_orderkey", F.col("o_orderpriority").alias("y_true"), "y_pred", "known"), levels


@query("lookup_predictions", f"{_OS}, {_lookup_ctes(_YEARS['custkey'][0], 'lk')} SELECT o_orderkey, y_true, y_pred, known::BOOLEAN AS known FROM lk")
def lookup_predictions(spark, sf_dir):
    return _lookup(spark, sf_dir, "custkey")[0]


@query("lookup_baselines", f"{_OS}, " + ", ".join(_lookup_ctes(k, f"lk{i}") for i, (k, _) in enumerate(_YEARS.values())) + " " + " UNION ALL ".join(
    f"SELECT '{name}' AS key, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, (SELECT round(avg(known), 6) FROM lk{i}) AS coverage, (SELECT count(*) FROM lk{i}_m) AS n_levels FROM lk{i}e_sum"
    for i, name in enumerate(_YEARS)))
def lookup_baselines(spark, sf_dir):
    out = None
    for name in _YEARS:
        rows, levels = _lookup(spark, sf_dir, name)
        rows = stage(rows)
        row = EV.metrics(rows).select(
            F.lit(name).alias("key"), "accuracy", "macro_f1", rows.agg(F.avg(F.col("known").cast("double"))).scalar().alias("coverage"),
            levels.agg(F.count("*")).scalar().alias("n_levels"))
        out = row if out is None else out.unionByName(row)
    return out


@query("majority_baseline", f"{_OS} SELECT g AS label, round(avg((o_orderpriority = g)::INT), 6) AS accuracy FROM o, overall WHERE split = 'test' GROUP BY 1")
def majority_baseline(spark, sf_dir):
    o = _orders(spark, sf_dir)
    best = L.mode(o.filter("split = 'train'").groupBy("o_orderpriority").agg(F.count("*").alias("n")), [], "o_orderpriority").select("mode").scalar()
    return o.filter("split = 'test'").select(best.alias("label"), "o_orderpriority").groupBy("label").agg(
        F.avg((F.col("o_orderpriority") == F.col("label")).cast("double")).alias("accuracy"))


def _knn(group: str, k: int = 15) -> str:
    """CTEs ending in votes (grp, qd, vote)."""
    return (f"tr AS (SELECT {group} AS grp, day, o_orderkey, o_orderpriority AS l, row_number() OVER (PARTITION BY {group} ORDER BY day, o_orderkey) - 1 AS pos FROM o WHERE split = 'train'), "
            f"qd AS (SELECT DISTINCT {group} AS grp, day AS qd FROM o WHERE split = 'test'), "
            "qp AS (SELECT grp, qd, (SELECT count(*) FROM tr WHERE tr.grp = qd.grp AND tr.day < qd.qd) AS p FROM qd), "
            f"cand AS (SELECT qp.grp, qp.qd, tr.l FROM qp JOIN tr ON tr.grp = qp.grp AND tr.pos >= p - {k} AND tr.pos < p + {k} "
            f"QUALIFY row_number() OVER (PARTITION BY qp.grp, qp.qd ORDER BY abs(tr.day - qp.qd), tr.pos) <= {k}), "
            "votes AS (SELECT grp, qd, l AS vote FROM (SELECT grp, qd, l, count(*) AS n FROM cand GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY grp, qd ORDER BY n DESC, l) = 1)")


def _votes(spark, sf_dir, group):
    o = _orders(spark, sf_dir).withColumn("grp", group)
    return o, temporal.date_votes(o.filter("split = 'train'"), o.filter("split = 'test'"), "grp", "day", "o_orderkey", "o_orderpriority")


@query("date_votes", f"{_OS}, {_knn("''")} SELECT o_orderkey, o_orderpriority AS y_true, vote AS y_pred FROM o JOIN votes ON qd = day WHERE split = 'test'")
def date_votes(spark, sf_dir):
    o, v = _votes(spark, sf_dir, F.lit(""))
    return o.filter("split = 'test'").join(v, ["grp", "day"]).select("o_orderkey", F.col("o_orderpriority").alias("y_true"), F.col("vote").alias("y_pred"))


@query("date_vote_lifespans", """SELECT o_orderstatus AS grp, o_orderpriority AS category, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
 round(quantile_cont((CAST(o_orderdate AS DATE) - DATE '1970-01-01')::DOUBLE, 0.5), 6) AS median_day, count(*) AS rows FROM orders GROUP BY ALL""")
def date_vote_lifespans(spark, sf_dir):
    """How long each label lived inside the groups in which the dates vote."""
    o = _orders(spark, sf_dir).select(F.struct(F.col("o_orderstatus").alias("grp"), F.col("o_orderpriority").alias("category")).alias("key"), "day")
    return temporal.lifespans(o, "key", "day").select("key.grp", "key.category", F.date_from_unix_date("first_day").alias("first_date"),
                                                      F.date_from_unix_date("last_day").alias("last_date"), "median_day", "rows")


@query("date_votes_by_group", f"""{_OS}, {_knn('o_orderstatus')}, p AS (SELECT grp, o_orderpriority AS t, vote FROM o JOIN votes ON qd = day AND grp = o_orderstatus WHERE split = 'test'),
 mj AS (SELECT grp, max(n)::DOUBLE / sum(n) AS maj FROM (SELECT grp, t, count(*) AS n FROM p GROUP BY ALL) GROUP BY 1)
 SELECT grp, count(*) AS n_val, round(avg((t = vote)::INT), 6) AS date_only_accuracy, round(any_value(maj), 6) AS majority_accuracy FROM p JOIN mj USING (grp) GROUP BY 1""")
def date_votes_by_group(spark, sf_dir):
    o, v = _votes(spark, sf_dir, F.col("o_orderstatus"))
    p = stage(o.filter("split = 'test'").join(v, ["grp", "day"]).groupBy("grp", F.col("o_orderpriority").alias("t"), "vote").agg(F.count("*").alias("n")))
    maj = p.groupBy("grp", "t").agg(F.sum("n").alias("n")).groupBy("grp").agg(EV.ratio(F.max("n"), F.sum("n")).alias("majority_accuracy"))
    hit = F.sum(F.when(F.col("t") == F.col("vote"), F.col("n")).otherwise(0))
    return p.groupBy("grp").agg(F.sum("n").alias("n_val"), EV.ratio(hit, F.sum("n")).alias("date_only_accuracy")).join(maj, "grp")


_VARIANT = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'slow' ELSE 'none' END"


@query("date_resolved_variants", f"""{_OS}, {_lookup_ctes('o_custkey::VARCHAR', 'lk')}, {_knn('(' + _VARIANT + ')')},
 r AS (SELECT lk.o_orderkey, y_true, CASE WHEN gp <> 'none' THEN coalesce(vote, y_pred) ELSE y_pred END AS y_pred FROM (SELECT *, {_VARIANT.replace('o_orderpriority', 'y_pred')} AS gp FROM lk) lk
 JOIN o USING (o_orderkey) LEFT JOIN votes ON votes.grp = gp AND qd = day) SELECT * FROM r""".replace("qd AS (SELECT DISTINCT (" + _VARIANT + ") AS grp, day AS qd FROM o WHERE split = 'test')",
 "qd AS (SELECT DISTINCT grp, day AS qd FROM (SELECT DISTINCT day FROM o WHERE split = 'test') CROSS JOIN (VALUES ('fast'), ('slow'), ('none')) t(grp))"))
def date_resolved_variants(spark, sf_dir):
    """A model picks the group, the dates of the training rows pick the label inside it."""

    def group_of(c):
        return F.when(F.col(c).isin("1-URGENT", "2-HIGH"), "fast").when(F.col(c).isin("3-MEDIUM", "5-LOW"), "slow").otherwise("none")

    o = _orders(spark, sf_dir)
    base, _ = _lookup(spark, sf_dir, "custkey")
    rows = base.join(o.select("o_orderkey", "day"), "o_orderkey").withColumn("grp", group_of("y_pred"))
    train = o.filter("split = 'train'").withColumn("grp", group_of("o_orderpriority"))
    v = temporal.date_votes(train, rows, "grp", "day", "o_orderkey", "o_orderpriority")
    picked = F.when(F.col("grp") != "none", F.coalesce("vote", "y_pred")).otherwise(F.col("y_pred"))
    return rows.join(v, ["grp", "day"], "left").select("o_orderkey", "y_true", picked.alias("y_pred"))


# ---- evaluation ----


@query("accuracy", f"{_A} SELECT round(avg((y_true = y_pred)::INT), 6) AS accuracy FROM pa")
def accuracy(spark, sf_dir):
    return bundle(spark, sf_dir)["summary"].select("accuracy")


@query("averaged_metrics", f"""{_A} SELECT 'macro' AS average, {S.rounded(('macro_precision', 'macro_recall', 'macro_f1')).replace('AS macro_', 'AS ')} FROM ma_sum UNION ALL
 SELECT 'weighted', {S.rounded(('weighted_precision', 'weighted_recall', 'weighted_f1'))} FROM ma_sum UNION ALL SELECT 'micro', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6) FROM ma_sum""")
def averaged_metrics(spark, sf_dir):
    classes = bundle(spark, sf_dir)["classes"]
    out = None
    for a in ("macro", "weighted", "micro"):
        row = EV.averages(classes, a).select(F.lit(a).alias("average"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("metric_summary", f"{_A} SELECT rows, {S.rounded(S.METRICS)} FROM ma_sum")
def metric_summary(spark, sf_dir):
    return bundle(spark, sf_dir)["summary"]


@query("classification_report", f"""{_A} SELECT category AS label, {S.rounded(('precision', 'recall', 'f1'))}, support FROM ma_classes UNION ALL
 SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), rows FROM ma_sum UNION ALL SELECT 'macro avg', {S.rounded(('macro_precision', 'macro_recall', 'macro_f1'))}, rows FROM ma_sum UNION ALL
 SELECT 'weighted avg', {S.rounded(('weighted_precision', 'weighted_recall', 'weighted_f1'))}, rows FROM ma_sum""")
def classification_report(spark, sf_dir):
    return EV.report(bundle(spark, sf_dir)["classes"])


@query("per_category_metrics", f"{_A} SELECT category, support, predicted, correct, {S.rounded(('precision', 'recall', 'f1'))} FROM ma_classes")
def per_category_metrics(spark, sf_dir):
    return bundle(spark, sf_dir)["classes"].orderBy(F.desc("support"), "category")


_CELLS = "labels_ AS (SELECT y_true AS l FROM ma_cells UNION SELECT y_pred FROM ma_cells), grid AS (SELECT a.l AS y_true, b.l AS y_pred, coalesce(n, 0) AS n FROM labels_ a CROSS JOIN labels_ b LEFT JOIN ma_cells ON y_true = a.l AND y_pred = b.l)"


@query("confusion_matrix", f"{_A}, {_CELLS} SELECT * FROM grid")
def confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(bundle(spark, sf_dir)["confusion"])


def _normalized(kind, part):
    total = f"sum(n) OVER ({part})"

    @query(f"confusion_matrix_by_{kind}", f"{_A}, {_CELLS} SELECT y_true, y_pred, n, round(CASE WHEN {total} = 0 THEN 0.0 ELSE n::DOUBLE / {total} END, 6) AS share FROM grid")
    def run(spark, sf_dir):
        return EV.confusion_matrix(bundle(spark, sf_dir)["confusion"], kind)


_normalized("true", "PARTITION BY y_true")
_normalized("pred", "PARTITION BY y_pred")
_normalized("all", "")

_PAIRS = "pairs AS (SELECT y_true AS actual_category, y_pred AS predicted_category, n AS error_count, pct AS pct_of_actual FROM (SELECT *, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY y_true) AS pct FROM ma_cells) WHERE y_true <> y_pred)"


def _pairs(spark, sf_dir):
    return EV.confusion_pairs(bundle(spark, sf_dir)["confusion"], None)


@query("confusion_pairs", f"{_A}, {_PAIRS} SELECT actual_category, predicted_category, error_count, round(pct_of_actual, 6) AS pct_of_actual FROM pairs")
def confusion_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query("top_confusion_pairs", f"{_A}, {_PAIRS} SELECT actual_category, predicted_category, error_count, round(pct_of_actual, 6) AS pct_of_actual FROM pairs ORDER BY error_count DESC, actual_category, predicted_category LIMIT 20")
def top_confusion_pairs(spark, sf_dir):
    return E.top_pairs(_pairs(spark, sf_dir), 20)


_SIB = "sib AS (SELECT y_true, y_pred, n, x.normalized_category = y.normalized_category AS is_sibling, x.normalized_category AS g FROM ma_cells JOIN m x ON x.category = y_true JOIN m y ON y.category = y_pred WHERE y_true <> y_pred)"


@query("sibling_confusion_pairs", f"{_A}, {_SIB} SELECT y_true, y_pred, n, is_sibling, CASE WHEN is_sibling THEN g ELSE 'Cross-Group' END AS normalized_group FROM sib")
def sibling_confusion_pairs(spark, sf_dir):
    return E.sibling_pairs(bundle(spark, sf_dir)["confusion"], narrow(spark))


_PRIM = """prim AS (SELECT c.category, support, correct, support - correct AS incorrect, precision, recall, f1, coalesce(l, '') AS primary_confusion_category, coalesce(n, 0) AS primary_confusion_count
 FROM ma_classes c LEFT JOIN (SELECT y_true, y_pred AS l, n FROM ma_cells WHERE y_true <> y_pred QUALIFY row_number() OVER (PARTITION BY y_true ORDER BY n DESC, y_pred) = 1) ON y_true = c.category)"""


def _primary(spark, sf_dir):
    b = bundle(spark, sf_dir)
    return EV.primary_confusion(b["confusion"], b["classes"])


@query("primary_confusions", f"{_A}, {_PRIM} SELECT category, support, correct, incorrect, {S.rounded(('precision', 'recall', 'f1'))}, primary_confusion_category, primary_confusion_count FROM prim")
def primary_confusions(spark, sf_dir):
    return _primary(spark, sf_dir)


_STRIP = S.rx(S.rx("substring(text, 1, 500)", r"^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+", ""), r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$", "")


@query("error_examples", f"""{_A}, {_PAIRS}, top AS (SELECT * FROM pairs ORDER BY error_count DESC, actual_category, predicted_category LIMIT 10)
 SELECT actual_category, predicted_category, rank, doc_id, {_STRIP} AS complaint_text_truncated FROM (SELECT top.*, doc_id, (row_number() OVER (PARTITION BY y_true, y_pred ORDER BY doc_id))::INTEGER AS rank
 FROM top JOIN pa ON y_true = actual_category AND y_pred = predicted_category) JOIN documents USING (doc_id) WHERE rank <= 5""")
def error_examples(spark, sf_dir):
    return E.error_examples(predictions(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id")


@query("confidence_bands", f"""{_A} SELECT band, y_true = y_pred AS is_correct, count(*) AS n FROM (SELECT *, CASE WHEN conf >= 0.7 THEN 'high' WHEN conf >= 0.4 THEN 'medium' ELSE 'low' END AS band FROM pa) GROUP BY ALL""")
def confidence_bands(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.groupBy(E.confidence_band("conf").alias("band"), (F.col("y_true") == F.col("y_pred")).alias("is_correct")).agg(F.count("*").alias("n"))


@query("confidence_statistics", f"""{_A}, x AS (SELECT pa.doc_id, CASE WHEN pa.y_true = y_pred THEN 'correct' ELSE 'incorrect' END AS outcome, unnest(['predicted_class', 'actual_class']) AS probability, unnest([conf, p]) AS p
 FROM pa JOIN pa_prob q ON q.doc_id = pa.doc_id AND q.label = pa.y_true) SELECT outcome, probability, count(*) AS "count", round(avg(p), 6) AS mean, round(quantile_cont(p, 0.5), 6) AS median, round(quantile_cont(p, 0.25), 6) AS q1,
 round(quantile_cont(p, 0.75), 6) AS q3, round(min(p), 6) AS min, round(max(p), 6) AS max, round(avg((p >= 0.7)::INT) * 100, 6) AS pct_high, round(avg((p >= 0.4 AND p < 0.7)::INT) * 100, 6) AS pct_medium, round(avg((p < 0.4)::INT) * 100, 6) AS pct_low FROM x GROUP BY ALL""")
def confidence_statistics(spark, sf_dir):
    names = F.array(*[F.lit(c) for c in model(spark, sf_dir).classes])
    p = predictions(spark, sf_dir).withColumn("_pos", F.array_position(names, F.col("y_true")).cast("int"))
    p = p.withColumn("true_p", F.try_element_at(B.softmax(F.col("scores")), F.col("_pos")))
    return E.confidence_statistics(p, {"predicted_class": "conf", "actual_class": "true_p"})


@query("confidence_errors", f"""{_A} SELECT count(*) FILTER (y_true <> y_pred) AS errors, count(*) FILTER (y_true <> y_pred AND conf >= 0.7) AS high_confidence_errors, count(*) FILTER (y_true <> y_pred AND conf < 0.4) AS low_confidence_errors,
 round(avg(conf), 6) AS mean_confidence, round(min(conf), 6) AS min_confidence, round(max(conf), 6) AS max_confidence, count(*) FILTER (conf < 0.5) AS below_half, round(avg((conf < 0.5)::INT) * 100, 6) AS below_half_pct, round(quantile_cont(conf, 0.5), 6) AS median_confidence FROM pa""")
def confidence_errors(spark, sf_dir):
    return E.confidence_errors(predictions(spark, sf_dir))


def _two_sums(name="u"):
    return f"ua AS (UNPIVOT (SELECT {', '.join(S.METRICS)} FROM ma_sum) ON {', '.join(S.METRICS)} INTO NAME metric VALUE a), ub AS (UNPIVOT (SELECT {', '.join(S.METRICS)} FROM mb__sum) ON {', '.join(S.METRICS)} INTO NAME metric VALUE b)"


@query("model_comparison", f"{_AB}, {_two_sums()} SELECT metric, round(a, 6) AS baseline, round(b, 6) AS improved, round(b - a, 6) + 0.0 AS absolute_difference, round(CASE WHEN a = 0 THEN 0.0 ELSE (b - a) * 100 / a END, 6) + 0.0 AS relative_change_pct FROM ua JOIN ub USING (metric)")
def model_comparison(spark, sf_dir):
    return E.compare_metrics(bundle(spark, sf_dir)["summary"], bundle(spark, sf_dir, "complement", 0.3)["summary"])


@query("category_comparison", f"""{_AB} SELECT category, coalesce(a.support, b.support) AS support, round(coalesce(a.precision, 0), 6) AS baseline_precision, round(coalesce(a.recall, 0), 6) AS baseline_recall, round(coalesce(a.f1, 0), 6) AS baseline_f1,
 round(coalesce(b.precision, 0), 6) AS improved_precision, round(coalesce(b.recall, 0), 6) AS improved_recall, round(coalesce(b.f1, 0), 6) AS improved_f1, round(coalesce(b.f1, 0) - coalesce(a.f1, 0), 6) + 0.0 AS delta_f1,
 round((coalesce(b.f1, 0) - coalesce(a.f1, 0)) * 100, 6) + 0.0 AS delta_f1_pp FROM ma_classes a FULL JOIN mb__classes b USING (category)""")
def category_comparison(spark, sf_dir):
    return E.compare_classes(bundle(spark, sf_dir)["classes"], bundle(spark, sf_dir, "complement", 0.3)["classes"])


_J = "j AS (SELECT pa.doc_id, pa.y_true AS t, pa.y_pred AS a, pb.y_pred AS b FROM pa JOIN pb USING (doc_id))"


@query("fixed_errors", f"""{_AB}, {_J} SELECT t AS category, count(*) FILTER (a <> t) AS baseline_errors, count(*) FILTER (b <> t) AS improved_errors, count(*) FILTER (a <> t AND b = t) AS fixed,
 count(*) FILTER (a = t AND b <> t) AS introduced, count(*) FILTER (a <> t) - count(*) FILTER (b <> t) AS net FROM j GROUP BY 1""")
def fixed_errors(spark, sf_dir):
    return E.fixed_errors(predictions(spark, sf_dir), other(spark, sf_dir), "doc_id")


def _sibling_sql(cells):
    # a sum over no rows counts as 0
    same, cross = "coalesce(sum(n) FILTER (s), 0)", "coalesce(sum(n) FILTER (NOT s), 0)"
    return (f"SELECT sum(n)::BIGINT AS errors, {same}::BIGINT AS sibling_errors, {cross}::BIGINT AS cross_errors, round({same} * 100.0::DOUBLE / sum(n), 6) AS sibling_pct, "
            f"round({cross} * 100.0::DOUBLE / sum(n), 6) AS cross_pct FROM (SELECT n, x.normalized_category = y.normalized_category AS s FROM {cells} JOIN m x ON x.category = y_true JOIN m y ON y.category = y_pred WHERE y_true <> y_pred)")


@query("sibling_errors", f"{_AB} SELECT 'a' AS model, * FROM ({_sibling_sql('ma_cells')}) UNION ALL SELECT 'b', * FROM ({_sibling_sql('mb__cells')})")
def sibling_errors(spark, sf_dir):
    parts = [E.sibling_errors(p, narrow(spark)).select(F.lit(n).alias("model"), "*") for n, p in (("a", predictions(spark, sf_dir)), ("b", other(spark, sf_dir)))]
    return parts[0].unionByName(parts[1])


_NEAR = _TWO.replace("WITH ", "", 1).replace("docs AS (", "ndocs AS (").replace("'docs'", "'ndocs'").replace("docs.*", "ndocs.*").replace("FROM docs", "FROM ndocs").replace("parts AS", "nparts AS").replace("JOIN parts", "JOIN nparts")
_DEC = f"""{_A}, {_NEAR}, tc AS (SELECT label AS category, count(*) AS n FROM pool GROUP BY 1), dec AS (SELECT pa.doc_id, y_true, y_pred, conf, coalesce(nn_sim, 0.0) AS nn_sim, d.source AS nn_label,
 CASE WHEN y_true = y_pred THEN 'correct' WHEN x.normalized_category = y.normalized_category THEN 'A same-group variant' WHEN coalesce(tc.n, 0) < 50 THEN 'B rare true class'
 WHEN coalesce(nn_sim, 0.0) >= 0.8 AND coalesce(d.source, '') <> y_true THEN 'C near-duplicate contradiction' WHEN conf < 0.5 THEN 'D low confidence' ELSE 'E residual' END AS error_class
 FROM pa JOIN m x ON x.category = y_true JOIN m y ON y.category = y_pred LEFT JOIN tc ON tc.category = y_true LEFT JOIN nn ON nn.doc_id = pa.doc_id LEFT JOIN documents d ON d.doc_id = nn.nn_id)"""


def decomposed(spark, sf_dir):
    def build():
        nn = train_neighbours(spark, sf_dir)
        labels = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("nn_id"), F.col("source").alias("nn_label"))
        rows = predictions(spark, sf_dir).drop("scores").join(nn.join(labels, "nn_id").select("doc_id", "nn_sim", "nn_label"), "doc_id", "left")
        counts = labelled(spark, sf_dir).filter("split = 'pool'").groupBy(F.col("label").alias("category")).agg(F.count("*").alias("n"))
        return stage(E.decompose_errors(rows, narrow(spark), counts))

    return shared(spark, sf_dir, "decomposed", build)


@query("error_decomposition", f"""{_DEC} SELECT error_class, n, round(n * 100.0::DOUBLE / e, 6) AS pct_of_errors, round(n * 100.0::DOUBLE / a, 6) AS pct_of_all FROM (SELECT error_class, count(*) AS n FROM dec GROUP BY 1),
 (SELECT count(*) AS a, count(*) FILTER (error_class <> 'correct') AS e FROM dec) WHERE error_class <> 'correct'""")
def error_decomposition(spark, sf_dir):
    return E.error_shares(decomposed(spark, sf_dir))


@query("decomposed_predictions", f"{_DEC} SELECT doc_id, y_true, y_pred, round(conf, 6) AS conf, round(nn_sim, 6) AS nn_sim, nn_label, error_class FROM dec")
def decomposed_predictions(spark, sf_dir):
    return decomposed(spark, sf_dir).select("doc_id", "y_true", "y_pred", "conf", F.coalesce("nn_sim", F.lit(0.0)).alias("nn_sim"), "nn_label", "error_class")


_BIN = "CASE WHEN nn_sim < 0.5 THEN '[0, 0.5)' WHEN nn_sim < 0.7 THEN '[0.5, 0.7)' WHEN nn_sim < 0.8 THEN '[0.7, 0.8)' WHEN nn_sim < 0.9 THEN '[0.8, 0.9)' WHEN nn_sim < 0.95 THEN '[0.9, 0.95)' WHEN nn_sim < 1.0001 THEN '[0.95, 1.0001)' END"


@query("similarity_bins", f"""{_DEC} SELECT {_BIN} AS bin, count(*) AS n, round(avg(coalesce(nn_label = y_true, false)::INT), 6) AS nn_label_agree, round(avg(coalesce(g.normalized_category = x.normalized_category, false)::INT), 6) AS nn_group_agree,
 round(avg((y_true = y_pred)::INT), 6) AS model_accuracy FROM dec LEFT JOIN m g ON g.category = nn_label JOIN m x ON x.category = y_true GROUP BY 1""")
def similarity_bins(spark, sf_dir):
    from narrata.operators.similarity import similarity_bin

    rows = map_labels(map_labels(decomposed(spark, sf_dir), narrow(spark), "y_true", "gt"), narrow(spark), "nn_label", "gn")

    def share(c):
        return F.avg(F.coalesce(c, F.lit(False)).cast("double"))

    return rows.groupBy(similarity_bin(F.coalesce("nn_sim", F.lit(0.0))).alias("bin")).agg(
        F.count("*").alias("n"), share(F.col("nn_label") == F.col("y_true")).alias("nn_label_agree"),
        share(F.col("gn") == F.col("gt")).alias("nn_group_agree"), share(F.col("y_true") == F.col("y_pred")).alias("model_accuracy"))


@query("family_errors", f"{_A} SELECT count(*) FILTER (y_true <> y_pred AND y_true IN ('src10', 'src11', 'src12') AND y_pred IN ('src10', 'src11', 'src12')) AS family_errors FROM pa")
def family_errors(spark, sf_dir):
    return E.family_errors(predictions(spark, sf_dir), ["src10", "src11", "src12"])


_COLL = f"coll AS (SELECT x.normalized_category AS y_true, y.normalized_category AS y_pred FROM pa JOIN m x ON x.category = pa.y_true JOIN m y ON y.category = pa.y_pred), {S.metrics_of('coll', 'mc')}"


@query("collapsed_metrics", f"{_A}, {_COLL} SELECT rows, {S.rounded(S.METRICS)} FROM mc_sum")
def collapsed_metrics(spark, sf_dir):
    return EV.metrics(E.collapsed(predictions(spark, sf_dir), narrow(spark)))


@query("collapsed_category_metrics", f"{_A}, {_COLL} SELECT category, support, predicted, correct, {S.rounded(('precision', 'recall', 'f1'))} FROM mc_classes")
def collapsed_category_metrics(spark, sf_dir):
    return EV.per_class(EV.confusion_counts(E.collapsed(predictions(spark, sf_dir), narrow(spark))))


@query("variant_exactness", f"""{_A} SELECT x.normalized_category, count(*) FILTER (x.normalized_category = y.normalized_category) AS n_group_correct,
 round(CASE WHEN count(*) FILTER (x.normalized_category = y.normalized_category) = 0 THEN 0.0 ELSE count(*) FILTER (y_true = y_pred)::DOUBLE / count(*) FILTER (x.normalized_category = y.normalized_category) END, 6) AS variant_exact,
 round(avg((x.normalized_category = y.normalized_category)::INT), 6) AS group_accuracy FROM pa JOIN m x ON x.category = y_true JOIN m y ON y.category = y_pred
 WHERE x.normalized_category IN (SELECT normalized_category FROM m GROUP BY 1 HAVING count(*) > 1) GROUP BY 1""")
def variant_exactness(spark, sf_dir):
    return E.variant_exactness(predictions(spark, sf_dir), narrow(spark))


def group_predictions(spark, sf_dir):
    """The same model trained on group labels instead."""

    def build():
        d = map_labels(labelled(spark, sf_dir), narrow(spark), "label", "g").drop("label").withColumnRenamed("g", "label")
        m = B.fit(d.filter("split = 'pool'"), V.WORD_UNIGRAMS, "label", alpha=ALPHA)
        return stage(B.predict(m, d.filter("split = 'test'").withColumnRenamed("label", "y_true"), carry=("y_true",)))

    return shared(spark, sf_dir, "group_predictions", build)


_RE = f"gpool AS (SELECT doc_id, normalized_category AS label, c FROM pool JOIN m ON category = label), gheld AS (SELECT doc_id, normalized_category AS label, c FROM held JOIN m ON category = label), {S.bayes('pg', 'gpool', 'gheld')}"


@query("cross_task_errors", f"""{_A}, {_RE}, x3 AS (SELECT pa.y_true AS t, pa.y_pred AS p, x.normalized_category AS gt, y.normalized_category AS gp, pg.y_pred AS rp FROM pa JOIN pg USING (doc_id) JOIN m x ON x.category = pa.y_true JOIN m y ON y.category = pa.y_pred)
 SELECT count(*) FILTER (t <> p) AS original_errors, count(*) FILTER (t <> p AND gt = gp) AS eliminated_by_collapse, count(*) FILTER (gt <> gp) AS post_hoc_errors, count(*) FILTER (gt <> rp) AS retrained_errors,
 count(*) FILTER (gt <> gp) - count(*) FILTER (gt <> rp) AS net_error_reduction FROM x3""")
def cross_task_errors(spark, sf_dir):
    return E.cross_task(predictions(spark, sf_dir), group_predictions(spark, sf_dir), narrow(spark), "doc_id")


@query("group_task_metrics", f"{_BASE}, {_RE}, {S.metrics_of('pg', 'mg')} SELECT rows, {S.rounded(S.METRICS)} FROM mg_sum")
def group_task_metrics(spark, sf_dir):
    return EV.metrics(group_predictions(spark, sf_dir))


def _intra(name, m):
    j = f"SELECT n, x.normalized_category = y.normalized_category AS s, x.normalized_category AS g FROM ma_cells JOIN {m} x ON x.category = y_true JOIN {m} y ON y.category = y_pred WHERE y_true <> y_pred"
    return (f"SELECT '{name}' AS taxonomy, g AS normalized_group, sum(n)::BIGINT AS errors FROM ({j}) WHERE s GROUP BY g UNION ALL "
            f"SELECT '{name}', '(all groups)', coalesce(sum(n) FILTER (s), 0)::BIGINT FROM ({j})")


@query("intra_group_errors", f"{_A} {_intra('narrow', 'm')} UNION ALL {_intra('broad', 'mb')} UNION ALL SELECT 'none', '(all errors)', sum(n)::BIGINT FROM ma_cells WHERE y_true <> y_pred")
def intra_group_errors(spark, sf_dir):
    return E.intra_group_errors(bundle(spark, sf_dir)["confusion"], narrow(spark), broad(spark))


_LOSS = "x AS (SELECT source, normalized_category AS g, count(*) OVER () AS total, source <> normalized_category AS changed, normalized_category IN (SELECT normalized_category FROM m GROUP BY 1 HAVING count(*) > 1) AS merged FROM documents JOIN m ON category = source)"


@query("information_loss", f"""{_BASE}, {_LOSS} SELECT count(DISTINCT source) AS n_original_categories, count(DISTINCT g) AS n_normalized_categories, count(*) AS rows, count(*) FILTER (changed) AS records_relabelled,
 round(avg(changed::INT) * 100, 6) AS pct_relabelled, count(*) FILTER (merged) AS records_in_merged_groups, round(avg(merged::INT) * 100, 6) AS pct_in_merged_groups,
 (SELECT coalesce(sum(k), 0)::BIGINT FROM (SELECT count(*) AS k FROM m GROUP BY normalized_category HAVING count(*) > 1)) AS labels_merged FROM x""")
def information_loss_query(spark, sf_dir):
    return information_loss(table(spark, sf_dir, "documents"), "source", narrow(spark))


@query("merged_group_loss", f"""{_BASE}, g AS (SELECT normalized_category, array_to_string(list_sort(list(category)), '; ') AS members, count(*) AS n_members FROM m GROUP BY 1 HAVING count(*) > 1),
 r AS (SELECT normalized_category, count(*) AS n FROM documents JOIN m ON category = source GROUP BY 1) SELECT g.normalized_category, members, n_members, coalesce(n, 0) AS records_affected,
 round(coalesce(n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 6) AS pct_of_dataset FROM g LEFT JOIN r USING (normalized_category)""")
def merged_group_loss_query(spark, sf_dir):
    return merged_group_loss(table(spark, sf_dir, "documents"), "source", narrow(spark))


_NEST = (f"np AS ({S.split('pool', 'doc_id', 'label', 0.2, 43, 'val', 'train')}), tri AS (SELECT doc_id, label, split FROM np UNION ALL SELECT doc_id, label, 'test' FROM held), "
         "dist AS (SELECT label AS category, count(*) AS total_count, count(*) FILTER (split = 'train') AS train_count, count(*) FILTER (split = 'val') AS val_count, count(*) FILTER (split = 'test') AS test_count, "
         "count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents) AS total_pct FROM tri GROUP BY 1)")


def distribution(spark, sf_dir):
    def build():
        d = table(spark, sf_dir, "documents").select("doc_id", "source")
        return stage(E.class_distribution(SP.mark_train_val_test(d, "doc_id", "source"), "source", ["train", "val", "test"]))

    return shared(spark, sf_dir, "distribution", build)


@query("class_distribution", f"{_A}, {_NEST} SELECT dist.category, total_count, train_count, val_count, test_count, round(total_pct, 6) AS total_pct, round(coalesce(recall, 0), 6) AS test_recall, round(coalesce(f1, 0), 6) AS test_f1 FROM dist LEFT JOIN ma_classes c ON c.category = dist.category")
def class_distribution(spark, sf_dir):
    return E.with_scores(distribution(spark, sf_dir), bundle(spark, sf_dir)["classes"])


@query("class_split_table", f"{_BASE}, {_NEST} SELECT category, total_count, train_count, val_count, test_count, round(total_pct, 6) AS total_pct, least(train_count, val_count, test_count) > 0 AS in_every_split FROM dist")
def class_split_table(spark, sf_dir):
    return distribution(spark, sf_dir).withColumn("in_every_split", F.least("train_count", "val_count", "test_count") > 0)


_LANGS = f"{S.split('documents', 'doc_id', 'lang', 0.2, 42)}"


@query("class_imbalance", f"""WITH s AS ({_LANGS}), c AS (SELECT lang, count(*) AS n, count(*) FILTER (split = 'train') AS tr FROM s GROUP BY 1)
 SELECT round(max(n)::DOUBLE / min(n), 6) AS imbalance_ratio, round(max(n)::DOUBLE / sum(n), 6) AS majority_share, min(n) AS min_support, count(*) AS n_classes, """ + ", ".join(
    f"count(*) FILTER (tr < {t}) AS classes_lt_{t}" for t in (10, 25, 50, 100, 250)) + " FROM c")
def class_imbalance(spark, sf_dir):
    from narrata.operators.profiling import imbalance

    s = SP.mark_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang")
    return imbalance(s.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("tr")), "n", "tr")


@query("class_shares", "SELECT lang AS category, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 6) AS pct FROM documents GROUP BY 1")
def class_shares(spark, sf_dir):
    from narrata.operators.profiling import class_shares as shares

    return shares(table(spark, sf_dir, "documents"), "lang")


_LSUP = f"WITH {S.corpus('lang')}, {S.bayes('pl', alpha=1.0)}, {S.metrics_of('pl', 'ml')}"


@query("support_correlation", f"{_LSUP} SELECT round(corr(support::DOUBLE, recall), 6) AS corr_support_recall, round(corr(support::DOUBLE, f1), 6) AS corr_support_f1 FROM ml_classes")
def support_correlation(spark, sf_dir):
    p = stage(language_bayes(spark, sf_dir))
    c = EV.per_class(EV.confusion_counts(p)).select(F.col("support").alias("test_count"), F.col("recall").alias("test_recall"), F.col("f1").alias("test_f1"))
    return E.support_correlation(c)


_TOKS = """toks AS (SELECT label AS c, tok, count(*) AS n FROM (SELECT label, unnest(regexp_split_to_array(lower(t), '[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+')) AS tok FROM (SELECT source AS label, text AS t FROM documents)) WHERE length(tok) > 3 GROUP BY ALL), bt AS (SELECT c, list(tok ORDER BY n DESC, tok) AS ts FROM
 (SELECT * FROM toks QUALIFY row_number() OVER (PARTITION BY c ORDER BY n DESC, tok) <= 20) GROUP BY 1)"""


@query("lexical_overlap", f"""{_A}, {_PAIRS}, top AS (SELECT * FROM pairs ORDER BY error_count DESC, actual_category, predicted_category LIMIT 10), {_TOKS}
 SELECT actual_category, predicted_category, array_to_string(list_sort(list_intersect(a.ts, b.ts))[1:30], ' ') AS shared_terms, array_to_string(a.ts[1:15], ' ') AS top_actual_terms, array_to_string(b.ts[1:15], ' ') AS top_predicted_terms
 FROM top JOIN bt a ON a.c = actual_category JOIN bt b ON b.c = predicted_category""")
def lexical_overlap(spark, sf_dir):
    return E.lexical_overlap(table(spark, sf_dir, "documents"), E.top_pairs(_pairs(spark, sf_dir), 10), "doc_id", "source")


LANG_WORDS = {"en": r"\b(the|and|on|in)\b", "fr": r"\b(le|la|un|et)\b", "de": r"\b(der|die|und|ein)\b", "es": r"\b(el|la|un|de)\b"}


@query("lexical_evidence", "SELECT lang AS category, count(*) AS rows, round(avg((CASE lang " + " ".join(
    f"WHEN '{k}' THEN {S.has_word(p)}" for k, p in LANG_WORDS.items()) + " END)::INT) * 100, 6) AS pct_with_lexicon FROM documents GROUP BY 1")
def lexical_evidence(spark, sf_dir):
    return E.lexical_evidence(table(spark, sf_dir, "documents"), "lang", LANG_WORDS)


SOURCE_WORDS = {f"src{i}": LANG_WORDS[k] for i, k in enumerate(("en", "fr", "de", "es"))}


@query("lexicon_absent_errors", f"""{_A}, w AS (SELECT y_true, y_pred, CASE y_true """ + " ".join(f"WHEN '{k}' THEN {S.has_word(p)}" for k, p in SOURCE_WORDS.items()) + f""" END AS hit FROM pa JOIN documents USING (doc_id)
 WHERE y_true <> y_pred AND y_true IN {S.text_list(SOURCE_WORDS)} AND y_pred IN {S.text_list(SOURCE_WORDS)})
 SELECT least(y_true, y_pred) AS label_a, greatest(y_true, y_pred) AS label_b, count(*) AS errors_between, round(avg((NOT hit)::INT) * 100, 6) AS pct_lexicon_absent FROM w GROUP BY ALL""")
def lexicon_absent_errors(spark, sf_dir):
    return E.lexicon_absent(predictions(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id", SOURCE_WORDS)


@query("taxonomy_audit", f"""{_A}, {_NEST}, {_PRIM} SELECT dist.category, total_count AS total_support, round(total_pct, 6) AS percentage_of_dataset, train_count AS train_support, val_count AS validation_support, test_count AS test_support,
 round(coalesce(recall, 0), 6) AS current_recall, round(coalesce(f1, 0), 6) AS current_f1, coalesce(primary_confusion_category, '') AS primary_confusion_category, coalesce(primary_confusion_count, 0) AS primary_confusion_count
 FROM dist LEFT JOIN prim USING (category)""")
def taxonomy_audit(spark, sf_dir):
    return E.taxonomy_audit(distribution(spark, sf_dir), _primary(spark, sf_dir))


_CENT_ONLY = _CENT.replace("WITH ", "", 1).replace("docs AS (", "cdocs AS (").replace("FROM docs", "FROM cdocs").rstrip()


@query("pair_separability", f"""{_A}, {_CENT_ONLY}, wr AS (SELECT least(y_true, y_pred) AS a, greatest(y_true, y_pred) AS b, sum(n)::BIGINT AS k FROM ma_cells WHERE y_true <> y_pred GROUP BY ALL)
 SELECT cp.a, cp.b, coalesce(k, 0) AS confusions, round(cosine, 6) AS cosine, round(jaccard, 6) AS jaccard, x.normalized_category = y.normalized_category AS same_group FROM cp LEFT JOIN wr USING (a, b) JOIN m x ON x.category = cp.a JOIN m y ON y.category = cp.b WHERE cp.a < cp.b""")
def pair_separability(spark, sf_dir):
    return E.separability(bundle(spark, sf_dir)["confusion"], class_pairs(spark, sf_dir), narrow(spark))


@query("class_separability", f"""{_A}, {_CENT_ONLY}, {_SIB}, e AS (SELECT y_true, sum(n)::BIGINT AS errors, coalesce(sum(n) FILTER (is_sibling), 0)::BIGINT AS errors_to_siblings FROM sib GROUP BY 1),
 alt AS (SELECT y_true, string_agg(y_pred || ' (' || n || ')', '; ' ORDER BY n DESC, y_pred) AS top_alternatives FROM (SELECT * FROM sib QUALIFY row_number() OVER (PARTITION BY y_true ORDER BY n DESC, y_pred) <= 2) GROUP BY 1),
 nr AS (SELECT a, arg_min(b, (-round(jaccard, 9), b)) AS nb, max(round(jaccard, 9)) AS nj, max(cosine) AS nc FROM cp GROUP BY 1),
 wm AS (SELECT source AS category, avg({S.word_count('text')}) AS mean_words FROM documents GROUP BY 1),
 tw AS (SELECT label, string_agg(term, ', ' ORDER BY round(s, 9) DESC, term) AS top_words FROM (SELECT * FROM pa_s QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(s, 9) DESC, term) <= 10) GROUP BY 1)
 SELECT wm.category, normalized_category AS normalized_group, coalesce(support, 0) AS support, {', '.join(f"round(coalesce(k.{c}, 0.0), 6) + 0.0 AS {c}" for c in ('precision', 'recall', 'f1'))}, coalesce(top_words, '') AS top_words, round(mean_words, 6) AS mean_words, coalesce(errors, 0) AS errors, coalesce(errors_to_siblings, 0) AS errors_to_siblings, coalesce(top_alternatives, '') AS top_alternatives, nb AS nearest_vocab_category,
 round(nj, 6) AS nearest_vocab_jaccard, round(nc, 6) AS nearest_centroid_cosine FROM wm LEFT JOIN e ON e.y_true = wm.category LEFT JOIN alt ON alt.y_true = wm.category LEFT JOIN nr ON nr.a = wm.category
 LEFT JOIN ma_classes k ON k.category = wm.category LEFT JOIN m ON m.category = k.category LEFT JOIN tw ON tw.label = wm.category""")
def class_separability(spark, sf_dir):
    means = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("category")).agg(F.avg(T.word_count("text")).alias("mean_words"))
    return E.class_separability(bundle(spark, sf_dir)["confusion"], class_pairs(spark, sf_dir), narrow(spark), means,
                                B.class_terms(*sums(spark, sf_dir)))


@query("heatmap_cells", f"{_A}, {_PAIRS}, h AS (SELECT category AS actual, category AS predicted, correct AS n FROM ma_classes UNION ALL SELECT actual_category, predicted_category, error_count FROM pairs) SELECT actual, predicted, n, round(CASE WHEN sum(n) OVER (PARTITION BY actual) = 0 THEN 0.0 ELSE n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY actual) END, 6) AS row_pct FROM h")
def heatmap_cells(spark, sf_dir):
    return E.heatmap_cells(bundle(spark, sf_dir)["classes"], _pairs(spark, sf_dir))


@query("formulation_table", f"""{_A}, {_COLL}, {_RE}, {S.metrics_of('pg', 'mg')} SELECT k AS metric, round(a, 6) AS all_labels, round(b, 6) AS collapsed, round(c, 6) AS retrained FROM
 (SELECT unnest(['accuracy', 'macro_f1', 'weighted_f1']) AS k, unnest([x.accuracy, x.macro_f1, x.weighted_f1]) AS a, unnest([y.accuracy, y.macro_f1, y.weighted_f1]) AS b, unnest([z.accuracy, z.macro_f1, z.weighted_f1]) AS c FROM ma_sum x, mc_sum y, mg_sum z)""")
def formulation_table(spark, sf_dir):
    return E.comparison_table({"all_labels": bundle(spark, sf_dir)["summary"], "collapsed": EV.metrics(E.collapsed(predictions(spark, sf_dir), narrow(spark))),
                               "retrained": EV.metrics(group_predictions(spark, sf_dir))})


# ---- experiments with the exact model ----


def variant_metrics(spark, sf_dir, name):
    """Fit and score one cleaning variant of the preprocessing experiment."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("label"), T.variants("text")[name].alias("text"))
    d = stage(d.join(labelled(spark, sf_dir).select("doc_id", "split"), "doc_id"))  # cleaned once, read by each step
    m = B.fit(d.filter("split = 'pool'"), V.WORD_UNIGRAMS, "label", alpha=ALPHA)
    p = stage(B.predict(m, d.filter("split = 'test'").withColumnRenamed("label", "y_true"), carry=("y_true",)))
    drop(d)
    group = EV.metrics(E.collapsed(p, narrow(spark))).select("accuracy").scalar()
    return EV.metrics(p).select(F.lit(name).alias("variant"), "accuracy", "macro_f1", "macro_recall", "weighted_f1", group.alias("group_accuracy"),
                                F.lit(m.table.count()).cast("bigint").alias("features"))


def _variant_sql(name):
    n = f"x{name.lower()}"
    return (f"{n}_all AS (SELECT doc_id, source AS label, {S.variants('text')[name]} AS c FROM documents), {n}_pool AS (SELECT a.* FROM {n}_all a JOIN parts USING (doc_id) WHERE split = 'pool'), "
            f"{n}_held AS (SELECT a.* FROM {n}_all a JOIN parts USING (doc_id) WHERE split = 'test'), {S.bayes(n, n + '_pool', n + '_held')}, {S.metrics_of(n, n + 'm')}")


@query("preprocessing_experiment", f"{_BASE}, " + ", ".join(_variant_sql(v) for v in "ABCDEFG") + " " + " UNION ALL ".join(
    f"SELECT '{v}' AS variant, {S.rounded(('accuracy', 'macro_f1', 'macro_recall', 'weighted_f1'))}, (SELECT round(avg((x.normalized_category = y.normalized_category)::INT), 6) FROM x{v.lower()} p JOIN m x ON x.category = p.y_true JOIN m y ON y.category = p.y_pred) AS group_accuracy, "
    f"(SELECT count(*) FROM x{v.lower()}_v) AS features FROM x{v.lower()}m_sum" for v in "ABCDEFG"))
def preprocessing_experiment(spark, sf_dir):
    out = None
    for v in "ABCDEFG":
        row = variant_metrics(spark, sf_dir, v)
        out = row if out is None else out.unionByName(row)
    return out
