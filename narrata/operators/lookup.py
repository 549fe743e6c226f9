"""Majority lookup models and purity of metadata keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.operators.evaluation import ratio
from narrata.session import stage


def key_of(columns: list[Column]) -> Column:
    """One lookup key; a missing part becomes NA."""
    parts = [F.coalesce(c.cast("string"), F.lit("NA")) for c in columns]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def mode(counts: DataFrame, keys, label: str, n: str = "n") -> DataFrame:
    """Most frequent label per key from ``(keys, label, n)``; ties go to the first label."""
    best = F.min(F.struct((-F.col(n)).alias("o"), F.col(label).alias("l")))
    return counts.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.l").alias("mode"))


def fit_lookup(train: DataFrame, key: Column, label: str) -> tuple[DataFrame, object]:
    """Staged ``(key, mode)`` and the overall mode. Counting first keeps a hot key cheap."""
    counts = stage(train.groupBy(key.alias("key"), F.col(label).alias("l")).agg(F.count("*").alias("n")))
    overall = mode(counts.groupBy("l").agg(F.sum("n").alias("n")), [], "l").first()["mode"]
    return stage(mode(counts, ["key"], "l")), overall


def apply_lookup(rows: DataFrame, table: DataFrame, overall, key: Column) -> DataFrame:
    """Add ``y_pred`` and ``known``; an unseen key gets the overall mode."""
    t = table.withColumnRenamed("key", "_k")
    out = rows.withColumn("_key", key).join(t, F.col("_key") == F.col("_k"), "left")
    return out.withColumns({"y_pred": F.coalesce("mode", F.lit(overall)), "known": F.col("_k").isNotNull()}).drop(
        "_key", "_k", "mode")


def key_purity(rows: DataFrame, key: Column, label: str) -> DataFrame:
    """Share of rows whose label is the commonest of their key; share of keys with one label."""
    counts = rows.filter(key.isNotNull() & F.col(label).isNotNull()).groupBy(
        key.alias("k"), F.col(label).alias("l")).agg(F.count("*").alias("n"))
    per_key = counts.groupBy("k").agg(F.max("n").alias("top"), F.sum("n").alias("rows"), F.count("*").alias("labels"))
    return per_key.agg(F.count("*").alias("keys"), ratio(F.sum("top"), F.sum("rows")).alias("purity"),
                       (F.avg((F.col("labels") == 1).cast("double")) * 100).alias("single_label_pct"))
