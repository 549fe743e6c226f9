"""Ranks, order statistics and quantiles that never sort one group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.session import small_rows

_BUCKETS = 1024


def first_per_key(df: DataFrame, keys, order, n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key. Spark keeps only ``n`` per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def running_total(counts: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a summary table (one row per key and step)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def order_statistics(df: DataFrame, group: str, value: str, positions: dict) -> dict:
    """Exact k-th smallest values, ``{(group, k): value}``, for ``positions = {group: [k, ...]}``.

    Each pass counts the rows of the still open intervals in 1024 buckets and narrows every
    interval to the bucket with the wanted rank. Only counts travel, so a group of any size and
    any number of ties is handled by map-side aggregation.
    """
    df = df.select(F.col(group).alias("g"), F.col(value).alias("v")).filter(F.col("v").isNotNull())
    spark = df.sparkSession
    ends = small_rows(df.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")))
    bounds = {r["g"]: (r["lo"], r["hi"], r["n"]) for r in ends}
    done: dict = {}
    pending: dict = {}
    for g, ks in positions.items():
        lo, hi, n = bounds[g]
        for k in set(ks):
            if not 1 <= k <= n:
                raise ValueError(f"position {k} is outside the {n} rows of group {g}")
            pending[g, k] = (lo, hi, k)
    while pending:
        for key, (lo, hi, _) in list(pending.items()):
            if lo == hi:
                done[key] = lo
                del pending[key]
        if not pending:
            break
        spans = sorted({(g, lo, hi) for (g, _), (lo, hi, _) in pending.items()}, key=str)
        ids = {span: i for i, span in enumerate(spans)}
        g_type, v_type = df.schema["g"].dataType.simpleString(), df.schema["v"].dataType.simpleString()
        local = spark.createDataFrame([(i, *s) for s, i in ids.items()], f"i int, sg {g_type}, lo {v_type}, hi {v_type}")
        share = (F.col("v").cast("double") - F.col("lo")) / (F.col("hi").cast("double") - F.col("lo"))
        # the two ends always part, so that every pass narrows the interval
        bucket = (
            F.when(F.col("v") == F.col("lo"), 0)
            .when(F.col("v") == F.col("hi"), _BUCKETS + 1)
            .otherwise(1 + F.least(F.floor(share * _BUCKETS), F.lit(_BUCKETS - 1)))
        )
        hits = df.join(local, (F.col("g") == F.col("sg")) & F.col("v").between(F.col("lo"), F.col("hi")))
        rows = hits.groupBy("i", bucket.alias("b")).agg(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")
        )
        found = small_rows(rows)
        by_span: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["i"], r["b"])):
            by_span.setdefault(r["i"], []).append(r)
        for key, (lo, hi, k) in pending.items():
            for r in by_span[ids[key[0], lo, hi]]:
                if k <= r["n"]:
                    pending[key] = (r["lo"], r["hi"], k)
                    break
                k -= r["n"]
    return done


def quantiles(df: DataFrame, group: str, value: str, probs) -> dict:
    """Exact quantiles with linear interpolation, ``{group: [value per prob]}``."""
    sizes = {r["g"]: r["n"] for r in small_rows(
        df.filter(F.col(value).isNotNull()).groupBy(F.col(group).alias("g")).agg(F.count("*").alias("n")))}
    spots = {g: [(int((n - 1) * p), (n - 1) * p - int((n - 1) * p)) for p in probs] for g, n in sizes.items()}
    wanted = {g: [k for i, _ in s for k in (i + 1, min(i + 2, sizes[g]))] for g, s in spots.items()}
    at = order_statistics(df, group, value, wanted) if wanted else {}
    out = {}
    for g, s in spots.items():
        out[g] = []
        for i, frac in s:
            low, high = float(at[g, i + 1]), float(at[g, min(i + 2, sizes[g])])
            out[g].append(low + (high - low) * frac)
    return out


def quantiles_of_counts(counts: DataFrame, keys, value: str, n: str, probs) -> DataFrame:
    """Quantiles of a discrete value from its ``(keys, value, n)`` histogram, as columns q0, q1, ..."""
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(
        *keys, value, F.sum(n).over(upto).alias("_upto"), F.sum(n).over(whole).alias("_total")
    )

    def at(position: Column) -> Column:  # the smallest value whose running count passes the position
        return F.min(F.when(F.col("_upto") > position, F.col(value).cast("double")))

    columns = []
    for i, p in enumerate(probs):
        place = (F.col("_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(place)), at(F.ceil(place))
        frac = F.max(place - F.floor(place))
        columns.append((low + (high - low) * frac).alias(f"q{i}"))
    return ranked.groupBy(*keys).agg(*columns)


