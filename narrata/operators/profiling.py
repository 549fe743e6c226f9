"""Profiles of a labelled text table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions.text import is_blank
from narrata.operators.evaluation import ratio
from narrata.operators.ranking import quantiles_of_counts


def dataset_summary(df: DataFrame, text: str, category: str, id: str | None = None) -> DataFrame:
    """Rows, columns, unusable texts, missing values and usable rows in one pass."""
    blank = is_blank(text)
    no_class = F.col(category).isNull()
    return df.agg(
        F.count("*").alias("total_rows"), F.lit(len(df.columns)).alias("total_columns"),
        F.count_if(blank).alias("missing_text_count"), F.count_if(no_class).alias("missing_category_count"),
        (F.count_if(F.col(id).isNull()) if id else F.lit(0).cast("bigint")).alias("missing_id_count"),
        F.count_if(~blank & ~no_class).alias("usable_rows_count"), F.count_distinct(category).alias("num_unique_categories"))


def top_values(df: DataFrame, column, n: int | None = 8) -> DataFrame:
    """Value counts, most frequent first, ties by value."""
    c = F.col(column) if isinstance(column, str) else column
    counts = df.groupBy(c.alias("value")).agg(F.count("*").alias("n")).filter("value is not null")
    ordered = counts.orderBy(F.desc("n"), "value")
    return ordered if n is None else ordered.limit(n)


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and share per column, only columns that miss values, from one pass."""
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(df.columns)])
    return one.select("rows", F.inline(cells)).filter("missing > 0").select(
        "column", "missing", ratio(F.col("missing") * 100, F.col("rows")).alias("missing_pct"))


def metadata_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing share and distinct values per column. Values are counted per column after one
    unpivot, so that no single task holds a whole value set."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column").agg(
        ratio(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) * 100, F.sum("n")).alias("missing_pct"),
        F.count("value").alias("distinct_values"))


def duplicate_counts(df: DataFrame, id: str, text: str) -> DataFrame:
    """Rows that repeat an earlier id or text. Texts are grouped by digest."""
    def repeats(key: Column) -> DataFrame:
        per = df.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
        return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("x"))

    return df.agg(F.count("*").alias("rows")).select(
        "rows", repeats(F.col(id)).scalar().alias("duplicate_ids"), repeats(F.sha2(text, 256)).scalar().alias("duplicate_texts"))


def duplicate_groups(df: DataFrame, cleaned: str, label: str) -> DataFrame:
    """Groups of equal cleaned texts ``(digest, size, labels)``; counted per label first, so that a
    group of any size stays small."""
    # empty texts go after the count: a filter on the cleaned text would move below the cleaning and run it again
    per_label = df.groupBy(F.sha2(cleaned, 256).alias("digest"), F.col(label).alias("l")).agg(
        F.count("*").alias("n"), F.max(F.length(cleaned)).alias("size")).filter("size > 0").drop("size")
    return per_label.groupBy("digest").agg(F.sum("n").alias("size"), F.array_sort(F.collect_list("l")).alias("labels")).filter("size > 1")


def duplicate_summary(groups: DataFrame) -> DataFrame:
    conflict = F.size("labels") > 1
    return groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("rows_in_groups"), F.count("*").alias("groups"),
                      F.count_if(conflict).alias("label_conflict_groups"))


def conflict_examples(groups: DataFrame, n: int = 10) -> DataFrame:
    return groups.filter(F.size("labels") > 1).orderBy("digest").limit(n).select("digest", "size", F.array_join("labels", "; ").alias("labels"))


def variant_only_conflicts(groups: DataFrame, mapping: DataFrame) -> DataFrame:
    """Conflict groups whose labels all fall into one label group."""
    rows = groups.filter(F.size("labels") > 1).select("digest", F.explode("labels").alias("l"))
    m = mapping.select(F.col("category").alias("l"), "normalized_category")
    per = rows.join(m, "l", "left").groupBy("digest").agg(F.count_distinct(F.coalesce("normalized_category", "l")).alias("k"))
    return per.agg(F.count("*").alias("conflict_groups"), F.count_if(F.col("k") == 1).alias("variant_only_conflicts"))


WORD_QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)  # fixed values


def word_count_profile(df: DataFrame, words: Column) -> DataFrame:
    """Quantiles of the word count and the number of very short and very long texts."""
    counts = df.groupBy(words.alias("v")).agg(F.count("*").alias("n"))
    quant = quantiles_of_counts(counts.withColumn("all", F.lit(1)), ["all"], "v", "n", WORD_QUANTILES)
    names = {f"q{i}": f"p{round(p * 100):02d}" for i, p in enumerate(WORD_QUANTILES)}
    tails = counts.agg(F.lit(1).alias("all"), *[
        F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name) for name, c in (
            ("lt10", F.col("v") < 10), ("lt20", F.col("v") < 20), ("gt500", F.col("v") > 500), ("gt1000", F.col("v") > 1000))])
    return quant.withColumnsRenamed(names).join(tails, "all").drop("all")


SMALL_CLASSES = (10, 25, 50, 100, 250)  # fixed values


def imbalance(counts: DataFrame, n: str, train: str) -> DataFrame:
    """Imbalance ratio, majority share, smallest class and number of classes below each train size."""
    return counts.agg(
        ratio(F.max(n), F.min(n)).alias("imbalance_ratio"), ratio(F.max(n), F.sum(n)).alias("majority_share"),
        F.min(n).alias("min_support"), F.count("*").alias("n_classes"),
        *[F.count_if(F.col(train) < t).alias(f"classes_lt_{t}") for t in SMALL_CLASSES])


def class_shares(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("category")).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", ratio(F.col("n") * 100, F.sum("n").over(Window.partitionBy(F.lit(1)))))
