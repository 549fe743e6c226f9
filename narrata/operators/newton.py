"""Linear classifiers on a few dense features, fitted by a fixed number of Newton steps.

One model per *unit* (a class, or a group of classes) against the other rows of its group. A step is one aggregate: the
gradient and the upper half of the Hessian of every unit, summed over the rows of its group and combined map-side. The
systems are solved by Cholesky's method in columns, one row a unit, so units are rows and nothing goes through the driver.

Loss, penalty and settings are those of the linear models: 0.5 w'w + C * sum of weight * loss, the constant feature being
penalised like the others. ``logistic`` is the log loss, ``squared_hinge`` max(0, 1 - y m) ** 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.operators.bayes import softmax
from narrata.session import stage

LOSSES = ("logistic", "squared_hinge")


def cholesky(d: int) -> list[dict[str, str]]:
    """Levels of {name: expression} that lead from the system a_i_j (i >= j), g_i to its solution s_0, s_1, ...; the
    expressions of a level use only names of the levels before it."""
    levels = []
    minus = lambda first, terms: " - ".join([first, *terms])
    for j in range(d):
        levels.append({f"l_{j}_{j}": f"sqrt({minus(f'a_{j}_{j}', [f'l_{j}_{k} * l_{j}_{k}' for k in range(j)])})"})
        levels.append({f"l_{i}_{j}": f"({minus(f'a_{i}_{j}', [f'l_{i}_{k} * l_{j}_{k}' for k in range(j)])}) / l_{j}_{j}" for i in range(j + 1, d)})
    levels += [{f"z_{i}": f"({minus(f'g_{i}', [f'l_{i}_{k} * z_{k}' for k in range(i)])}) / l_{i}_{i}"} for i in range(d)]
    levels += [{f"s_{i}": f"({minus(f'z_{i}', [f'l_{k}_{i} * s_{k}' for k in range(i + 1, d)])}) / l_{i}_{i}"} for i in reversed(range(d))]
    return [level for level in levels if level]


def _names(d: int) -> list[str]:
    return [f"w_{i}" for i in range(d)]


def _margin(d: int) -> Column:
    out = F.col("w_0") * F.col("x_0")
    for i in range(1, d):
        out = out + F.col(f"w_{i}") * F.col(f"x_{i}")
    return out


def prepared(rows: DataFrame, features: list[Column], group: Column, label: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(*carry, grp, y, x_0, x_1, ...) of raw rows."""
    return rows.select(*carry, group.alias("grp"), F.col(label).alias("y"), *[x.cast("double").alias(f"x_{i}") for i, x in enumerate(features)])


def class_weighted(rows: DataFrame, power: float | None) -> DataFrame:
    """Add ``c``: (rows of the group / (classes * rows of the class)) ** power."""
    counts = rows.groupBy("grp", "y").agg(F.count("*").alias("_m"))
    whole = Window.partitionBy("grp")  # one row a class
    c = F.pow(F.sum("_m").over(whole) / (F.count("*").over(whole) * F.col("_m")), F.lit(float(power or 0.0)))
    return rows.join(counts.select("grp", "y", c.alias("c")), ["grp", "y"])


def units_of(rows: DataFrame, unit: str = "y") -> DataFrame:
    """Staged (grp, unit): what is fitted. Groups of one unit need no model, but keep their row."""
    return stage(rows.select("grp", F.col(unit).alias("unit")).distinct())


def fit(rows: DataFrame, units: DataFrame, d: int, loss: str = "logistic", C: float = 1.0, steps: int = 6) -> DataFrame:
    """Staged (grp, unit, w_0, ...) from ``rows`` (grp, y, c, x_0, ...)."""
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}")
    if C <= 0 or steps <= 0:
        raise ValueError(f"C and steps must be positive, got {C} and {steps}.")
    if rows.isEmpty():
        raise ValueError("Cannot fit on an empty table.")
    model = units.select("grp", "unit", *[F.lit(0.0).alias(w) for w in _names(d)])
    hit, m = F.col("y") == F.col("unit"), _margin(d)
    if loss == "logistic":
        share = 1.0 / (1.0 + F.exp(-F.col("_m")))
        slope, bend = share - F.when(hit, 1.0).otherwise(0.0), share * (1.0 - share)
    else:
        sign = F.when(hit, 1.0).otherwise(-1.0)
        inside = sign * F.col("_m") < 1.0
        slope, bend = F.when(inside, 2.0 * (F.col("_m") - sign)).otherwise(0.0), F.when(inside, 2.0).otherwise(0.0)
    x = [F.col(f"x_{i}") for i in range(d)]
    for _ in range(steps):
        each = rows.join(model, "grp").withColumn("_m", m).withColumns({"_g": C * F.col("c") * slope, "_h": C * F.col("c") * bend})
        half = [(F.sum(F.col("_h") * x[i] * x[j]) + (1.0 if i == j else 0.0)).alias(f"a_{i}_{j}") for i in range(d) for j in range(i + 1)]
        sums = each.groupBy("grp", "unit", *_names(d)).agg(*half, *[F.sum(F.col("_g") * x[i]).alias(f"_g_{i}") for i in range(d)])
        ready = sums.withColumns({f"g_{i}": F.col(f"_g_{i}") + F.col(f"w_{i}") for i in range(d)})
        solved = stage(ready)  # one row a unit; the levels below then start from a table and not from the aggregate
        for level in cholesky(d):
            solved = solved.withColumns({n: F.expr(e) for n, e in level.items()})
        model = stage(solved.select("grp", "unit", *[(F.col(f"w_{i}") - F.col(f"s_{i}")).alias(f"w_{i}") for i in range(d)]))
    return model


def predict(rows: DataFrame, model: DataFrame, d: int, loss: str, id: str) -> DataFrame:
    """(id, y, y_pred, conf) of ``rows`` (id, grp, y, x_0, ...): the best unit of the row's group, ties by name."""
    if len([c for c in rows.columns if c.startswith("x_")]) != d or len([c for c in model.columns if c.startswith("w_")]) != d:
        raise ValueError(f"The model and the rows need {d} features each.")
    listed = model.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("unit", F.array(*_names(d)).alias("w")))).alias("_u"))  # classes of a group
    x = F.array(*[f"x_{i}" for i in range(d)])
    margin = lambda u: F.aggregate(F.zip_with(u["w"], x, lambda w, v: w * v), F.lit(0.0), lambda a, v: a + v)
    rows = rows.join(listed, "grp").withColumn("_s", F.transform("_u", margin))
    if loss == "logistic":
        odds = F.transform("_s", lambda s: 1.0 / (1.0 + F.exp(-s)))
        shares = F.transform(odds, lambda p: p / F.aggregate(odds, F.lit(0.0), lambda a, v: a + v))
    else:
        shares = softmax(F.col("_s"))
    rounded = F.transform("_p", lambda s: F.round(s, 9))
    best = F.array_position(rounded, F.array_max(rounded)).cast("int")
    return rows.withColumn("_p", shares).select(id, "y", F.element_at("_u", best)["unit"].alias("y_pred"), F.array_max("_p").alias("conf"))
