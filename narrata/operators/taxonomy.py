"""Label groups: mapping tables, collapsing labels, and what collapsing loses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.operators.evaluation import ratio


def map_labels(df: DataFrame, mapping: DataFrame, label: str, out: str) -> DataFrame:
    """Add the group of ``label``; a label without a group stays itself."""
    m = mapping.select(F.col("category").alias("_mc"), F.col("normalized_category").alias("_mn"))
    return df.join(m, F.col(label) == F.col("_mc"), "left").withColumn(out, F.coalesce("_mn", F.col(label))).drop("_mc", "_mn")


def merged_groups(mapping: DataFrame) -> DataFrame:
    groups = mapping.groupBy("normalized_category").agg(
        F.array_sort(F.collect_list("category")).alias("members"), F.count("*").alias("n_members"))
    return groups.filter("n_members > 1")


def information_loss(rows: DataFrame, label: str, mapping: DataFrame) -> DataFrame:
    """One row: rows whose label text changes, rows in merged groups, and labels merged."""
    counts = rows.groupBy(F.col(label).alias("category")).agg(F.count("*").alias("n"))
    mapped = map_labels(counts, mapping, "category", "g")
    merged = merged_groups(mapping).select(F.col("normalized_category").alias("_m"), "n_members")
    joined = mapped.join(merged, F.col("g") == F.col("_m"), "left")
    changed = F.sum(F.when(F.col("category") != F.col("g"), F.col("n")).otherwise(0))
    inside = F.sum(F.when(F.col("_m").isNotNull(), F.col("n")).otherwise(0))
    return joined.agg(
        F.count_distinct("category").alias("n_original_categories"), F.count_distinct("g").alias("n_normalized_categories"),
        F.sum("n").alias("rows"), changed.alias("records_relabelled"), ratio(changed * 100, F.sum("n")).alias("pct_relabelled"),
        inside.alias("records_in_merged_groups"), ratio(inside * 100, F.sum("n")).alias("pct_in_merged_groups"),
    ).withColumn("labels_merged", F.coalesce(merged.agg(F.sum("n_members")).scalar(), F.lit(0)))


def merged_group_loss(rows: DataFrame, label: str, mapping: DataFrame) -> DataFrame:
    """Per merged group: members, rows and share of all rows."""
    counts = rows.groupBy(F.col(label).alias("category")).agg(F.count("*").alias("n"))
    mapped = map_labels(counts, mapping, "category", "normalized_category")
    per = mapped.groupBy("normalized_category").agg(F.sum("n").alias("records_affected"))
    return merged_groups(mapping).join(per, "normalized_category", "left").select(
        "normalized_category", F.array_join("members", "; ").alias("members"), "n_members",
        F.coalesce("records_affected", F.lit(0)).alias("records_affected"),
        ratio(F.coalesce("records_affected", F.lit(0)) * 100, counts.agg(F.sum("n")).scalar()).alias("pct_of_dataset"))
