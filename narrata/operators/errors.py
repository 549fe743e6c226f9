"""Error analysis over prediction tables ``(id, y_true, y_pred, conf, ...)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions.text import excerpt, has_lexicon
from narrata.operators.evaluation import confusion_counts, confusion_pairs, metric_rows, per_class, ratio, summary
from narrata.operators.ranking import first_per_key, quantiles
from narrata.operators.taxonomy import map_labels
from narrata.session import stage

# Confidence bands.
HIGH, MEDIUM = 0.70, 0.40


def confidence_band(conf) -> Column:
    conf = F.col(conf) if isinstance(conf, str) else conf
    return F.when(conf >= HIGH, "high").when(conf >= MEDIUM, "medium").otherwise("low")


def top_pairs(pairs: DataFrame, n: int) -> DataFrame:
    return pairs.orderBy(F.desc("error_count"), "actual_category", "predicted_category").limit(n)


def error_examples(preds: DataFrame, text: DataFrame, id: str, pairs: int = 10, examples: int = 5, length: int = 500) -> DataFrame:
    """First texts of the largest confusion pairs. Only the chosen ids fetch their text."""
    chosen = top_pairs(confusion_pairs(confusion_counts(preds)), pairs).select(
        F.col("actual_category").alias("y_true"), F.col("predicted_category").alias("y_pred"))
    rows = preds.select(id, "y_true", "y_pred").join(F.broadcast(chosen), ["y_true", "y_pred"])
    first = stage(first_per_key(rows, ["y_true", "y_pred"], [F.asc(id)], examples))
    return first.join(text.select(id, "text"), id).select(
        F.col("y_true").alias("actual_category"), F.col("y_pred").alias("predicted_category"), "rank", id,
        excerpt("text", length).alias("complaint_text_truncated"))


def confidence_statistics(preds: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Count, mean, quartiles, range and band shares per outcome and probability column."""
    long = preds.select(F.when(F.col("y_true") == F.col("y_pred"), "correct").otherwise("incorrect").alias("outcome"),
                        F.inline(F.array(*[F.struct(F.lit(k).alias("probability"), F.col(c).alias("p")) for k, c in columns.items()])))
    long = stage(long.filter("p is not null").withColumn("g", F.concat_ws("|", "outcome", "probability")))
    share = {b: F.avg((confidence_band("p") == b).cast("double")) * 100 for b in ("high", "medium", "low")}
    stats = long.groupBy("g", "outcome", "probability").agg(
        F.count("*").alias("count"), F.avg("p").alias("mean"), F.min("p").alias("min"), F.max("p").alias("max"),
        *[c.alias(f"pct_{b}") for b, c in share.items()])
    found = quantiles(long, "g", "p", [0.25, 0.5, 0.75])
    rows = [(g, *map(float, q)) for g, q in sorted(found.items())]
    table = preds.sparkSession.createDataFrame(rows, "g string, q1 double, median double, q3 double")
    return stats.join(table, "g").drop("g")


def confidence_errors(preds: DataFrame) -> DataFrame:
    """Counts of errors by band, and mean, median and range of the confidence of all predictions."""
    wrong = F.col("y_true") != F.col("y_pred")
    median = quantiles(preds.select(F.lit("all").alias("g"), "conf"), "g", "conf", [0.5]).get("all", [None])[0]
    return preds.agg(
        F.lit(median).cast("double").alias("median_confidence"), F.count_if(wrong).alias("errors"), F.count_if(wrong & (F.col("conf") >= HIGH)).alias("high_confidence_errors"),
        F.count_if(wrong & (F.col("conf") < MEDIUM)).alias("low_confidence_errors"),
        F.avg("conf").alias("mean_confidence"), F.min("conf").alias("min_confidence"), F.max("conf").alias("max_confidence"),
        F.count_if(F.col("conf") < 0.5).alias("below_half"),
        (F.avg((F.col("conf") < 0.5).cast("double")) * 100).alias("below_half_pct"))


def compare_metrics(base: DataFrame, improved: DataFrame) -> DataFrame:
    """Absolute and relative change per metric of two one-row summaries."""
    both = metric_rows(base, "baseline").join(metric_rows(improved, "improved"), "metric")
    diff = F.col("improved") - F.col("baseline")
    return both.withColumns({"absolute_difference": diff, "relative_change_pct": ratio(diff * 100, F.col("baseline"))})


def compare_classes(base: DataFrame, improved: DataFrame) -> DataFrame:
    a = base.select("category", F.col("support").alias("sa"), F.col("precision").alias("baseline_precision"),
                    F.col("recall").alias("baseline_recall"), F.col("f1").alias("baseline_f1"))
    b = improved.select("category", F.col("support").alias("sb"), F.col("precision").alias("improved_precision"),
                        F.col("recall").alias("improved_recall"), F.col("f1").alias("improved_f1"))
    both = a.join(b, "category", "full").fillna(0.0)
    delta = F.col("improved_f1") - F.col("baseline_f1")
    return both.select("category", F.coalesce("sa", "sb").alias("support"), "baseline_precision", "baseline_recall",
                       "baseline_f1", "improved_precision", "improved_recall", "improved_f1",
                       delta.alias("delta_f1"), (delta * 100).alias("delta_f1_pp"))


def agreement(a: DataFrame, b: DataFrame, id: str) -> DataFrame:
    """How two models agree, as shares of all rows."""
    both = a.select(id, "y_true", F.col("y_pred").alias("pa")).join(b.select(id, F.col("y_pred").alias("pb")), id)
    ok_a, ok_b = F.col("pa") == F.col("y_true"), F.col("pb") == F.col("y_true")
    share = {"agreement": F.col("pa") == F.col("pb"), "both_wrong": ~ok_a & ~ok_b, "only_a_wrong": ~ok_a & ok_b,
             "only_b_wrong": ok_a & ~ok_b, "either_right": ok_a | ok_b}
    return both.agg(*[F.avg(c.cast("double")).alias(n) for n, c in share.items()])


def fixed_errors(base: DataFrame, improved: DataFrame, id: str) -> DataFrame:
    """Per true class: errors fixed, newly made, and the net gain."""
    both = base.select(id, "y_true", F.col("y_pred").alias("pa")).join(improved.select(id, F.col("y_pred").alias("pb")), id)
    bad_a, bad_b = F.col("pa") != F.col("y_true"), F.col("pb") != F.col("y_true")
    return both.groupBy(F.col("y_true").alias("category")).agg(
        F.count_if(bad_a).alias("baseline_errors"), F.count_if(bad_b).alias("improved_errors"),
        F.count_if(bad_a & ~bad_b).alias("fixed"), F.count_if(~bad_a & bad_b).alias("introduced"),
        (F.count_if(bad_a) - F.count_if(bad_b)).alias("net"))


def sibling_errors(preds: DataFrame, mapping: DataFrame) -> DataFrame:
    """Errors inside and across label groups."""
    cells = confusion_counts(preds).filter("y_true <> y_pred")
    cells = map_labels(map_labels(cells, mapping, "y_true", "gt"), mapping, "y_pred", "gp")
    same = F.sum(F.when(F.col("gt") == F.col("gp"), F.col("n")).otherwise(0))
    total = F.sum("n")
    return cells.agg(total.alias("errors"), same.alias("sibling_errors"), (total - same).alias("cross_errors"),
                     ratio(same * 100, total).alias("sibling_pct"), ratio((total - same) * 100, total).alias("cross_pct"))


def sibling_pairs(confusion: DataFrame, mapping: DataFrame) -> DataFrame:
    cells = confusion.filter("y_true <> y_pred")
    cells = map_labels(map_labels(cells, mapping, "y_true", "gt"), mapping, "y_pred", "gp")
    same = F.col("gt") == F.col("gp")
    return cells.select("y_true", "y_pred", "n", same.alias("is_sibling"),
                        F.when(same, F.col("gt")).otherwise("Cross-Group").alias("normalized_group"))


ERROR_CLASSES = ("A same-group variant", "B rare true class", "C near-duplicate contradiction", "D low confidence", "E residual")


def decompose_errors(preds: DataFrame, mapping: DataFrame, train_counts: DataFrame) -> DataFrame:
    """Add ``error_class``: the first rule that fits, or 'correct'. Needs conf, nn_sim and nn_label."""
    rows = map_labels(map_labels(preds, mapping, "y_true", "_gt"), mapping, "y_pred", "_gp")
    rows = rows.join(train_counts.select(F.col("category").alias("_c"), F.col("n").alias("_n")), F.col("y_true") == F.col("_c"), "left")
    a, b, c, d, e = ERROR_CLASSES
    contradiction = (F.coalesce("nn_sim", F.lit(0.0)) >= 0.8) & (F.coalesce("nn_label", F.lit("")) != F.col("y_true"))
    rule = (F.when(F.col("y_true") == F.col("y_pred"), "correct").when(F.col("_gt") == F.col("_gp"), a)
            .when(F.coalesce("_n", F.lit(0)) < 50, b).when(contradiction, c).when(F.col("conf") < 0.5, d).otherwise(e))
    return rows.withColumn("error_class", rule).drop("_gt", "_gp", "_c", "_n")


def error_shares(decomposed: DataFrame) -> DataFrame:
    counts = decomposed.groupBy("error_class").agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(1))
    wrong = F.sum(F.when(F.col("error_class") != "correct", F.col("n")).otherwise(0)).over(everything)
    out = counts.withColumns({"pct_of_errors": ratio(F.col("n") * 100, wrong), "pct_of_all": ratio(F.col("n") * 100, F.sum("n").over(everything))})
    return out.filter("error_class <> 'correct'")


def family_errors(preds: DataFrame, family: list[str]) -> DataFrame:
    inside = F.col("y_true").isin(family) & F.col("y_pred").isin(family) & (F.col("y_true") != F.col("y_pred"))
    return preds.agg(F.count_if(inside).alias("family_errors"))


def collapsed(preds: DataFrame, mapping: DataFrame) -> DataFrame:
    """Predictions with both labels replaced by their groups."""
    both = map_labels(map_labels(preds, mapping, "y_true", "_t"), mapping, "y_pred", "_p")
    return both.withColumns({"y_true": F.col("_t"), "y_pred": F.col("_p")}).drop("_t", "_p")


def variant_exactness(preds: DataFrame, mapping: DataFrame) -> DataFrame:
    """Among rows whose group is right, the share whose label is right, for groups of several labels."""
    rows = map_labels(map_labels(preds, mapping, "y_true", "gt"), mapping, "y_pred", "gp")
    sizes = mapping.groupBy(F.col("normalized_category").alias("gt")).agg(F.count("*").alias("members"))
    hit = F.col("gt") == F.col("gp")
    per = rows.groupBy("gt").agg(F.count_if(hit).alias("n_group_correct"), F.count("*").alias("n"),
                                 F.sum(F.when(hit, (F.col("y_true") == F.col("y_pred")).cast("int"))).alias("x"))
    return per.join(sizes.filter("members > 1"), "gt").select(
        F.col("gt").alias("normalized_category"), "n_group_correct", ratio("x", "n_group_correct").alias("variant_exact"),
        ratio("n_group_correct", "n").alias("group_accuracy"))


def cross_task(original: DataFrame, retrained: DataFrame, mapping: DataFrame, id: str) -> DataFrame:
    """What collapsing labels removes by itself, and what retraining on the groups adds."""
    rows = map_labels(map_labels(original, mapping, "y_true", "gt"), mapping, "y_pred", "gp")
    rows = rows.join(retrained.select(id, F.col("y_pred").alias("rp")), id)
    wrong, still, again = F.col("y_true") != F.col("y_pred"), F.col("gt") != F.col("gp"), F.col("gt") != F.col("rp")
    return rows.agg(F.count_if(wrong).alias("original_errors"), F.count_if(wrong & ~still).alias("eliminated_by_collapse"),
                    F.count_if(still).alias("post_hoc_errors"), F.count_if(again).alias("retrained_errors"),
                    (F.count_if(still) - F.count_if(again)).alias("net_error_reduction"))


def intra_group_errors(confusion: DataFrame, narrow: DataFrame, broad: DataFrame) -> DataFrame:
    """Errors inside each group of two taxonomies, with totals per taxonomy."""
    parts = []
    for name, mapping in (("narrow", narrow), ("broad", broad)):
        pairs = sibling_pairs(confusion, mapping)
        parts.append(pairs.filter("is_sibling").groupBy("normalized_group").agg(F.sum("n").alias("errors")).select(
            F.lit(name).alias("taxonomy"), "normalized_group", "errors"))
        parts.append(pairs.agg(F.lit(name).alias("taxonomy"), F.lit("(all groups)").alias("normalized_group"),
                               F.coalesce(F.sum(F.when(F.col("is_sibling"), F.col("n"))), F.lit(0)).alias("errors")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.unionByName(confusion.agg(F.lit("none").alias("taxonomy"), F.lit("(all errors)").alias("normalized_group"),
                                         F.sum(F.when(F.col("y_true") != F.col("y_pred"), F.col("n")).otherwise(0)).alias("errors")))


def class_distribution(rows: DataFrame, label: str, splits: list[str], split: str = "split") -> DataFrame:
    """Rows per class in total and per split, with the share of all rows."""
    counts = rows.groupBy(F.col(label).alias("category")).agg(
        F.count("*").alias("total_count"), *[F.count_if(F.col(split) == s).alias(f"{s}_count") for s in splits])
    everything = F.sum("total_count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("total_pct", ratio(F.col("total_count") * 100, everything))


def with_scores(distribution: DataFrame, classes: DataFrame) -> DataFrame:
    scores = classes.select("category", F.col("recall").alias("test_recall"), F.col("f1").alias("test_f1"))
    return distribution.join(scores, "category", "left").fillna(0.0, ["test_recall", "test_f1"])


def support_correlation(distribution: DataFrame, support: str = "test_count") -> DataFrame:
    s = F.col(support).cast("double")
    return distribution.agg(F.corr(s, F.col("test_recall")).alias("corr_support_recall"),
                            F.corr(s, F.col("test_f1")).alias("corr_support_f1"))


def taxonomy_audit(distribution: DataFrame, primary: DataFrame) -> DataFrame:
    return with_scores(distribution, primary).join(
        primary.select("category", "primary_confusion_category", "primary_confusion_count"), "category", "left").select(
        "category", F.col("total_count").alias("total_support"), F.col("total_pct").alias("percentage_of_dataset"),
        F.col("train_count").alias("train_support"), F.col("val_count").alias("validation_support"),
        F.col("test_count").alias("test_support"), F.col("test_recall").alias("current_recall"),
        F.col("test_f1").alias("current_f1"), F.coalesce("primary_confusion_category", F.lit("")).alias("primary_confusion_category"),
        F.coalesce("primary_confusion_count", F.lit(0)).alias("primary_confusion_count"))


def lexical_overlap(texts: DataFrame, pairs: DataFrame, id: str, label: str, per_class: int | None = None, terms: int = 20) -> DataFrame:
    """Frequent long tokens that the two classes of each confusion pair share; of all texts, or the first of a class."""
    sample = texts.select(id, label, "text")
    if per_class is not None:
        sample = first_per_key(sample, [label], [F.asc(id)], per_class)
    words = sample.select(F.col(label).alias("c"), F.explode(F.split(F.lower("text"), r"[\s\x1c-\x1f\x85\p{Z}]+")).alias("tok"))
    counts = words.filter(F.length("tok") > 3).groupBy("c", "tok").agg(F.count("*").alias("n"))
    best = first_per_key(counts, ["c"], [F.desc("n"), F.asc("tok")], terms)
    lists = stage(best.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("rank", "tok"))).alias("x")).select(
        "c", F.col("x.tok").alias("toks")))
    a, b = lists.toDF("actual_category", "ta"), lists.toDF("predicted_category", "tb")
    shared = F.slice(F.array_sort(F.array_intersect("ta", "tb")), 1, 30)
    return pairs.select("actual_category", "predicted_category").join(a, "actual_category").join(b, "predicted_category").select(
        "actual_category", "predicted_category", F.array_join(shared, " ").alias("shared_terms"),
        F.array_join(F.slice("ta", 1, 15), " ").alias("top_actual_terms"),
        F.array_join(F.slice("tb", 1, 15), " ").alias("top_predicted_terms"))


def lexical_evidence(rows: DataFrame, label: str, lexicons: dict[str, str], text: str = "text") -> DataFrame:
    """Per class: rows and the share of them in which the lexicon of the class occurs."""
    hit = None
    for c, pattern in lexicons.items():
        cond = (F.col(label) == c) & has_lexicon(text, pattern)
        hit = cond if hit is None else hit | cond
    return rows.filter(F.col(label).isin(list(lexicons))).groupBy(F.col(label).alias("category")).agg(
        F.count("*").alias("rows"), (F.avg(hit.cast("double")) * 100).alias("pct_with_lexicon"))


def lexicon_absent(preds: DataFrame, texts: DataFrame, id: str, lexicons: dict[str, str]) -> DataFrame:
    """Per unordered error pair with lexicons: errors, and share of them whose true-label lexicon is absent."""
    known = list(lexicons)
    wrong = preds.filter((F.col("y_true") != F.col("y_pred")) & F.col("y_true").isin(known) & F.col("y_pred").isin(known))
    rows = wrong.select(id, "y_true", "y_pred").join(texts.select(id, "text"), id)
    hit = F.lit(False)
    for c, pattern in lexicons.items():
        hit = hit | ((F.col("y_true") == c) & has_lexicon("text", pattern))
    return rows.groupBy(F.least("y_true", "y_pred").alias("label_a"), F.greatest("y_true", "y_pred").alias("label_b")).agg(
        F.count("*").alias("errors_between"), (F.avg((~hit).cast("double")) * 100).alias("pct_lexicon_absent"))


def heatmap_cells(correct: DataFrame, pairs: DataFrame) -> DataFrame:
    """Confusion cells rebuilt from per-class hits and confusion pairs, with the share of their row."""
    diagonal = correct.select(F.col("category").alias("actual"), F.col("category").alias("predicted"), F.col("correct").alias("n"))
    off = pairs.select(F.col("actual_category").alias("actual"), F.col("predicted_category").alias("predicted"), F.col("error_count").alias("n"))
    row = F.sum("n").over(Window.partitionBy("actual"))
    return diagonal.unionByName(off).withColumn("row_pct", ratio(F.col("n") * 100, row))


def comparison_table(summaries: dict[str, DataFrame], metrics=("accuracy", "macro_f1", "weighted_f1")) -> DataFrame:
    """Metrics as rows and formulations as columns."""
    long = None
    for name, s in summaries.items():
        part = metric_rows(s, "value", metrics).withColumn("formulation", F.lit(name))
        long = part if long is None else long.unionByName(part)
    return long.groupBy("metric").pivot("formulation", list(summaries)).agg(F.first("value"))


def as_percent(value) -> Column:
    """A number, a share or text such as '69.82%' on the 0-100 scale; by rule anything up to 1 is a share, '0.8%' too."""
    number = F.regexp_replace(F.trim(value.cast("string")), "%+$", "").try_cast("double")
    return F.when(number <= 1.0, number * 100).otherwise(number)


def pick_rows(table: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Rows whose columns contain the given texts, whatever their case."""
    for column, text in patterns.items():
        table = table.filter(F.contains(F.lower(column), F.lit(text.lower())))
    return table


def separability(confusion: DataFrame, class_pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per unordered class pair: confusions both ways, centroid cosine, term overlap, same group."""
    wrong = confusion.filter("y_true <> y_pred").groupBy(F.least("y_true", "y_pred").alias("a"), F.greatest("y_true", "y_pred").alias("b")).agg(
        F.sum("n").alias("confusions"))
    pairs = class_pairs.filter("a < b").join(wrong, ["a", "b"], "left")
    pairs = map_labels(map_labels(pairs, mapping, "a", "_ga"), mapping, "b", "_gb")
    return pairs.select("a", "b", F.coalesce("confusions", F.lit(0)).alias("confusions"), "cosine", "jaccard",
                        (F.col("_ga") == F.col("_gb")).alias("same_group"))


def class_separability(confusion: DataFrame, class_pairs: DataFrame, mapping: DataFrame, word_means: DataFrame, term_sums: DataFrame,
                       n_words: int = 10) -> DataFrame:
    """Per class: group, support and scores, errors, errors to siblings, two main alternatives, nearest classes, mean words,
    and the words with the largest sums of ``term_sums (category, term, s)``."""
    scores = map_labels(per_class(confusion), mapping, "category", "normalized_group").select(
        "category", "normalized_group", "support", "precision", "recall", "f1")
    words = first_per_key(term_sums, ["category"], [F.desc(F.round("s", 9)), F.asc("term")], n_words).groupBy("category").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("top_words"))
    pairs = sibling_pairs(confusion, mapping)
    errs = pairs.groupBy(F.col("y_true").alias("category")).agg(
        F.sum("n").alias("errors"), F.sum(F.when(F.col("is_sibling"), F.col("n")).otherwise(0)).alias("errors_to_siblings"))
    two = first_per_key(pairs, ["y_true"], [F.desc("n"), F.asc("y_pred")], 2).groupBy(F.col("y_true").alias("category")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "y_pred", "n"))),
                                 lambda x: F.concat(x["y_pred"], F.lit(" ("), x["n"].cast("string"), F.lit(")"))), "; ").alias("top_alternatives"))
    near = class_pairs.groupBy(F.col("a").alias("category")).agg(
        F.min(F.struct((-F.round("jaccard", 9)).alias("o"), F.col("b"))).alias("x"), F.max("cosine").alias("nearest_centroid_cosine"))
    out = word_means
    for part in (scores, errs, two, near, words):
        out = out.join(part, "category", "left")
    return out.select(
        "category", "normalized_group", F.coalesce("support", F.lit(0)).alias("support"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")],
        F.coalesce("top_words", F.lit("")).alias("top_words"), "mean_words", F.coalesce("errors", F.lit(0)).alias("errors"),
        F.coalesce("errors_to_siblings", F.lit(0)).alias("errors_to_siblings"),
        F.coalesce("top_alternatives", F.lit("")).alias("top_alternatives"), F.col("x.b").alias("nearest_vocab_category"),
        (-F.col("x.o")).alias("nearest_vocab_jaccard"), "nearest_centroid_cosine")


def evaluation_bundle(preds: DataFrame) -> dict[str, DataFrame]:
    """Summary, per-class table and confusion counts from one staged confusion table."""
    confusion = stage(confusion_counts(preds))
    classes = per_class(confusion)
    return {"confusion": confusion, "classes": classes, "summary": summary(classes)}
