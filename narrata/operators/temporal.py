"""Nearest-in-time label votes and category timelines, computed on day-level tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata.operators.lookup import mode
from narrata.operators.ranking import first_per_key, quantiles_of_counts, running_total
from narrata.session import stage


def date_votes(train: DataFrame, query_days: DataFrame, group: str, day: str, id: str, label: str, k: int = 15) -> DataFrame:
    """Label vote per ``(group, day)``: among the k training rows before and the k from that day
    on, in (day, id) order, the k closest in days vote; ties go to the earlier row and first label.

    A row takes part only if it is among the first or last k of its group and day, so the vote
    works on at most 2k rows per group and day and never sorts a whole group.
    """
    rows = train.select(F.col(group).alias("g"), F.col(day).alias("d"), F.col(id).alias("i"), F.col(label).alias("l"))
    counts = stage(rows.groupBy("g", "d").agg(F.count("*").alias("n")))
    starts = running_total(counts, ["g"], ["d"], "n", "start")
    head = first_per_key(rows, ["g", "d"], [F.asc("i")], k).join(starts, ["g", "d"]).select(
        "g", "d", "l", (F.col("start") + F.col("rank") - 1).alias("pos"))
    tail = first_per_key(rows, ["g", "d"], [F.desc("i")], k).join(starts, ["g", "d"]).select(
        "g", "d", "l", (F.col("start") + F.col("n") - F.col("rank")).alias("pos"))
    ends = stage(head.unionByName(tail).distinct())
    days = query_days.select(F.col(group).alias("g"), F.col(day).alias("d")).distinct().withColumn("n", F.lit(None).cast("bigint"))
    # rows of the group on earlier days; several rows per day are fine because they are summed by range
    w = Window.partitionBy("g").orderBy("d").rangeBetween(Window.unboundedPreceding, -1)
    placed = counts.unionByName(days).withColumn("pos", F.coalesce(F.sum("n").over(w), F.lit(0))).filter("n is null")
    near = placed.select("g", F.col("d").alias("qd"), F.explode(F.sequence(
        F.greatest(F.col("pos") - k, F.lit(0)), F.col("pos") + k - 1)).alias("pos"))
    gap = F.abs(F.col("d") - F.col("qd"))
    chosen = first_per_key(near.join(ends, ["g", "pos"]), ["g", "qd"], [gap, F.asc("pos")], k)
    votes = chosen.groupBy("g", "qd", "l").agg(F.count("*").alias("n"))
    return mode(votes, ["g", "qd"], "l").select(F.col("g").alias(group), F.col("qd").alias(day), F.col("mode").alias("vote"))


def lifespans(df: DataFrame, label: str, day: str) -> DataFrame:
    """First, last and median day with the row count of every category."""
    counts = df.filter(F.col(day).isNotNull()).groupBy(label, day).agg(F.count("*").alias("n"))
    spans = counts.groupBy(label).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.sum("n").alias("rows"))
    return spans.join(quantiles_of_counts(counts, [label], day, "n", [0.5]), label).withColumnRenamed("q0", "median_day")


def crosstab(df: DataFrame, label: str, period) -> DataFrame:
    """Rows per category and period, also where there are none, in long form."""
    counts = df.groupBy(F.col(label).alias("category"), period.alias("period")).agg(F.count("*").alias("n"))
    counts = stage(counts.filter("category is not null and period is not null"))
    lists = counts.agg(F.collect_set("category").alias("c"), F.collect_set("period").alias("p"))
    grid = lists.select(F.explode("c").alias("category"), "p").select("category", F.explode("p").alias("period"))
    return grid.join(counts, ["category", "period"], "left").select("category", "period", F.coalesce("n", F.lit(0)).alias("n"))
