"""Classification metrics. Everything derives from the confusion counts, one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1",
           "weighted_precision", "weighted_recall", "weighted_f1")


def ratio(a, b) -> Column:
    """a / b, and 0 where b is 0."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(preds: DataFrame, true: str = "y_true", pred: str = "y_pred", keys=()) -> DataFrame:
    return preds.groupBy(*keys, F.col(true).alias("y_true"), F.col(pred).alias("y_pred")).agg(F.count("*").alias("n"))


def per_class(confusion: DataFrame, keys=()) -> DataFrame:
    """Support, precision, recall and F1 of every true or predicted label; 0 / 0 counts as 0."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y_true").alias("category"), F.col("n").alias("s"), zero.alias("p"), hit.cast("bigint").alias("t")),
        F.struct(F.col("y_pred").alias("category"), zero.alias("s"), F.col("n").alias("p"), zero.alias("t")))
    sums = confusion.select(*keys, F.inline(sides)).groupBy(*keys, "category").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("correct"))
    return sums.select(*keys, "category", "support", "predicted", "correct",
                       ratio("correct", "predicted").alias("precision"), ratio("correct", "support").alias("recall"),
                       ratio(2 * F.col("correct"), F.col("support") + F.col("predicted")).alias("f1"))


def summary(classes: DataFrame, keys=()) -> DataFrame:
    """Accuracy (= micro average) with macro and weighted averages, one row per key."""
    total = F.sum("support")
    cols = [F.sum("support").alias("rows"), ratio(F.sum("correct"), total).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        cols.append(F.avg(m).alias(f"macro_{m}"))
    for m in ("precision", "recall", "f1"):
        cols.append(ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}"))
    return classes.groupBy(*keys).agg(*cols) if keys else classes.agg(*cols)


def metrics(preds: DataFrame, true: str = "y_true", pred: str = "y_pred", keys=()) -> DataFrame:
    return summary(per_class(confusion_counts(preds, true, pred, keys), keys), keys)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def averages(classes: DataFrame, average: str) -> DataFrame:
    """Precision, recall and F1 under one averaging rule: macro, weighted or micro."""
    s = summary(classes)
    if average == "micro":
        return s.select(*[F.col("accuracy").alias(m) for m in ("precision", "recall", "f1")])
    if average not in ("macro", "weighted"):
        raise ValueError(f"unknown average {average!r}")
    return s.select(*[F.col(f"{average}_{m}").alias(m) for m in ("precision", "recall", "f1")])


def metric_rows(summary_row: DataFrame, value: str = "value", names=METRICS) -> DataFrame:
    return summary_row.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias(value)) for m in names])))


def report(classes: DataFrame) -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages."""
    s = summary(classes)
    rows = s.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.col("accuracy").alias("precision"),
                 F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"), F.col("rows").alias("support")),
        *[F.struct(F.lit(f"{a} avg").alias("label"), F.col(f"{a}_precision").alias("precision"),
                   F.col(f"{a}_recall").alias("recall"), F.col(f"{a}_f1").alias("f1"), F.col("rows").alias("support"))
          for a in ("macro", "weighted")])))
    per = classes.select(F.col("category").alias("label"), "precision", "recall", "f1", "support")
    return per.unionByName(rows)


def confusion_matrix(confusion: DataFrame, normalize: str | None = None) -> DataFrame:
    """Every cell of labels x labels, also the empty ones, in long form."""
    labels = confusion.select(F.explode(F.array("y_true", "y_pred")).alias("label")).distinct()
    both = labels.agg(F.array_sort(F.collect_list("label")).alias("_l")).select(
        F.explode("_l").alias("y_true"), "_l").select("y_true", F.explode("_l").alias("y_pred"))
    cells = both.join(confusion, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))
    if normalize is None:
        return cells
    part = {"true": ["y_true"], "pred": ["y_pred"], "all": []}[normalize]
    total = F.sum("n").over(Window.partitionBy(*part))
    return cells.withColumn("share", ratio(F.col("n"), total))


def confusion_wide(confusion: DataFrame, labels: list) -> DataFrame:
    return confusion.groupBy("y_true").pivot("y_pred", labels).agg(F.sum("n")).fillna(0)


def confusion_pairs(confusion: DataFrame, digits: int | None = 2) -> DataFrame:
    """Wrong cells with their share of the true class."""
    support = Window.partitionBy("y_true")
    share = ratio(F.col("n") * 100, F.sum("n").over(support))
    pairs = confusion.withColumn("share", share if digits is None else F.round(share, digits))
    return pairs.filter("y_true <> y_pred").select(
        F.col("y_true").alias("actual_category"), F.col("y_pred").alias("predicted_category"),
        F.col("n").alias("error_count"), F.col("share").alias("pct_of_actual"))


def primary_confusion(confusion: DataFrame, classes: DataFrame) -> DataFrame:
    """Per class: hits, misses and the label it is most often taken for ('' and 0 without misses)."""
    wrong = confusion.filter("y_true <> y_pred").groupBy(F.col("y_true").alias("category")).agg(
        F.min(F.struct((-F.col("n")).alias("o"), F.col("y_pred").alias("l"))).alias("best"))
    return classes.join(wrong, "category", "left").select(
        "category", "support", "correct", (F.col("support") - F.col("correct")).alias("incorrect"),
        "precision", "recall", "f1", F.coalesce("best.l", F.lit("")).alias("primary_confusion_category"),
        F.coalesce(-F.col("best.o"), F.lit(0)).alias("primary_confusion_count"))


def rank_candidates(results: DataFrame, id: str = "candidate") -> DataFrame:
    """Best first by macro F1, macro recall, accuracy, weighted F1, each compared at 6 decimals."""
    order = [F.desc(F.round(m, 6)) for m in ("macro_f1", "macro_recall", "accuracy", "weighted_f1")]
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*order, id)))
