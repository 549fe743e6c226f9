"""Queries of the linear models on dense text features, with both losses, class weights and a hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.operators import newton as N
from narrata.operators import splits as SP
from narrata.operators.evaluation import metrics
from narrata.plans import sql as S
from narrata.plans.registry import query, shared, table
from narrata.session import stage

#: Text features in plain SQL that both engines read alike: length, and the shares of a few letters and blanks.
FEATURES = ["1.0", "ln(1.0 + length(t)) / 10.0", *[f"20.0 * (length(t) - length(translate(t, '{c}', ''))) / greatest(length(t), 1)" for c in ("äöüß", "éèêç", "ñíó")]]
D, C, STEPS = len(FEATURES), 2.0, 6
FAMILY = "CASE WHEN {0} IN ('en', 'de') THEN 'germanic' ELSE 'romance' END"


def rows(spark, sf_dir):
    """(doc_id, grp, y, split, x_0, ...) of all documents, language as label, 80 / 20 split."""

    def build():
        d = SP.mark_split(table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("t")), "doc_id", "lang", train="pool")
        return stage(N.prepared(d, [F.expr(e) for e in FEATURES], F.lit("all"), "lang", ("doc_id", "split")))

    return shared(spark, sf_dir, "newton_rows", build)


def part(spark, sf_dir, split):
    return rows(spark, sf_dir).filter(F.col("split") == split).drop("split")


def fitted(train, loss, power, group=None, unit=None):
    train = train if group is None else train.withColumn("grp", group)
    train = train if unit is None else train.withColumn("y", unit)
    return N.fit(N.class_weighted(train, power), N.units_of(train), D, loss, C, STEPS)


def predicted(spark, sf_dir, loss, power):
    build = lambda: stage(N.predict(part(spark, sf_dir, "test"), fitted(part(spark, sf_dir, "pool"), loss, power), D, loss, "doc_id"))
    return shared(spark, sf_dir, ("newton", loss, power), build)


# ---- twins ----

_X = ", ".join(f"{e} AS x_{i}" for i, e in enumerate(FEATURES))
_ROWS = (f"docs AS (SELECT doc_id, lang AS label, coalesce(text, '') AS t FROM documents), parts AS ({S.split('docs', 'doc_id', 'label', 0.2, 42, 'test', 'pool')}), "
         f"x AS (SELECT docs.doc_id, docs.label AS y, 'all' AS grp, split, {_X} FROM docs JOIN parts USING (doc_id)), "
         "pool AS (SELECT * FROM x WHERE split = 'pool'), held AS (SELECT * FROM x WHERE split = 'test')")


def _fit(n: str, train: str, loss: str, power: float) -> str:
    """CTEs ending in {n} (grp, unit, w_0, ...)."""
    w, dot = [f"w_{i}" for i in range(D)], " + ".join(f"w_{i} * x_{i}" for i in range(D))
    if loss == "logistic":
        slope, bend = "(1.0 / (1.0 + exp(-m)) - t)", "(1.0 / (1.0 + exp(-m)) * (1.0 - 1.0 / (1.0 + exp(-m))))"
    else:
        slope, bend = "CASE WHEN (2 * t - 1) * m < 1 THEN 2.0 * (m - (2 * t - 1)) ELSE 0.0 END", "CASE WHEN (2 * t - 1) * m < 1 THEN 2.0 ELSE 0.0 END"
    out = [f"{n}_c AS (SELECT grp, y, pow(sum(m) OVER (PARTITION BY grp) / (count(*) OVER (PARTITION BY grp) * m), {power}) AS c FROM (SELECT grp, y, count(*) AS m FROM {train} GROUP BY ALL))",
           f"{n}_r AS (SELECT r.*, c FROM {train} r JOIN {n}_c USING (grp, y))",
           f"{n}_0 AS (SELECT DISTINCT grp, y AS unit, {', '.join(f'0.0::DOUBLE AS {c}' for c in w)} FROM {train})"]
    for k in range(STEPS):
        sums = ", ".join([f"sum(h * x_{i} * x_{j}){' + 1.0' if i == j else ''} AS a_{i}_{j}" for i in range(D) for j in range(i + 1)] + [f"sum(g * x_{i}) + w_{i} AS g_{i}" for i in range(D)])
        body = (f"SELECT grp, unit, {', '.join(w)}, {sums} FROM (SELECT *, {C} * c * {slope} AS g, {C} * c * {bend} AS h FROM "
                f"(SELECT *, {dot} AS m, (y = unit)::INT AS t FROM {n}_r JOIN {n}_{k} USING (grp))) GROUP BY grp, unit, {', '.join(w)}")
        for level in N.cholesky(D):
            body = f"SELECT *, {', '.join(f'{e} AS {c}' for c, e in level.items())} FROM ({body})"
        out.append(f"{n}_{k + 1} AS MATERIALIZED (SELECT grp, unit, {', '.join(f'{c} - s_{i} AS {c}' for i, c in enumerate(w))} FROM ({body}))")
    return ", ".join(out) + f", {n} AS (SELECT * FROM {n}_{STEPS})"


def _predict(n: str, model: str, rows_: str, loss: str) -> str:
    dot = " + ".join(f"w_{i} * x_{i}" for i in range(D))
    raw = "1.0 / (1.0 + exp(-m))" if loss == "logistic" else "exp(m - max(m) OVER (PARTITION BY doc_id))"
    return (f"{n} AS (SELECT doc_id, y AS y_true, unit AS y_pred, p / total AS conf FROM (SELECT *, sum(p) OVER (PARTITION BY doc_id) AS total FROM (SELECT *, {raw} AS p FROM "
            f"(SELECT r.doc_id, r.y, unit, {dot} AS m FROM {rows_} r JOIN {model} USING (grp)))) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(p / total, 9) DESC, unit) = 1)")


def _both(n: str, loss: str, power: float) -> str:
    return f"{_fit(n + 'f', 'pool', loss, power)}, {_predict(n, n + 'f', 'held', loss)}"


_OUT = "SELECT doc_id, y_true, y_pred, round(conf, 6) AS conf FROM p"


@query("newton_logistic", f"WITH {_ROWS}, {_both('p', 'logistic', 1.0)} {_OUT}")
def newton_logistic(spark, sf_dir):
    return predicted(spark, sf_dir, "logistic", 1.0).withColumnRenamed("y", "y_true")


@query("newton_squared_hinge", f"WITH {_ROWS}, {_both('p', 'squared_hinge', 1.0)} {_OUT}")
def newton_squared_hinge(spark, sf_dir):
    return predicted(spark, sf_dir, "squared_hinge", 1.0).withColumnRenamed("y", "y_true")


@query("newton_coefficients", f"WITH {_ROWS}, {_fit('f', 'pool', 'logistic', 1.0)} SELECT unit, i AS feature, round([{', '.join(f'w_{i}' for i in range(D))}][i + 1], 6) AS w FROM f, (SELECT unnest(range({D}))::INTEGER AS i)")
def newton_coefficients(spark, sf_dir):
    model = shared(spark, sf_dir, "newton_model", lambda: fitted(part(spark, sf_dir, "pool"), "logistic", 1.0))
    return model.select("unit", F.posexplode(F.array(*[f"w_{i}" for i in range(D)])).alias("feature", "w"))


@query("newton_hierarchy", f"WITH {_ROWS}, tops AS (SELECT * REPLACE ({FAMILY.format('y')} AS y) FROM pool), {_fit('f', 'tops', 'logistic', 1.0)}, {_predict('g', 'f', 'held', 'logistic')}, "
       f"fine AS (SELECT * REPLACE ({FAMILY.format('y')} AS grp) FROM pool), {_fit('s', 'fine', 'logistic', 1.0)}, "
       f"routed AS (SELECT held.* REPLACE (g.y_pred AS grp) FROM held JOIN g USING (doc_id)), {_predict('p', 's', 'routed', 'logistic')} {_OUT}")
def newton_hierarchy(spark, sf_dir):
    """The model of the groups routes each row to the units of its group; all specialists are fitted in one pass."""
    train, test = part(spark, sf_dir, "pool"), part(spark, sf_dir, "test")
    family = F.expr(FAMILY.format("y"))
    top = fitted(train, "logistic", 1.0, unit=family)
    routed = N.predict(test, top, D, "logistic", "doc_id").select("doc_id", F.col("y_pred").alias("grp"))
    special = fitted(train, "logistic", 1.0, group=family)
    return N.predict(test.drop("grp").join(routed, "doc_id"), special, D, "logistic", "doc_id").withColumnRenamed("y", "y_true")


_POWERS = {"none": 0.0, "balanced": 1.0, "power 0.5": 0.5}


@query("newton_weight_audit", f"WITH {_ROWS}, " + ", ".join(f"{_both(f'p{k}', 'logistic', p)}, {S.metrics_of(f'p{k}', f'm{k}')}" for k, p in enumerate(_POWERS.values())) + " "
       + " UNION ALL ".join(f"SELECT '{name}' AS weights, {S.rounded(('accuracy', 'macro_f1', 'macro_recall', 'weighted_f1'))} FROM m{k}_sum" for k, name in enumerate(_POWERS)))
def newton_weight_audit(spark, sf_dir):
    out = None
    for name, power in _POWERS.items():
        p = predicted(spark, sf_dir, "logistic", power).select(F.col("y").alias("y_true"), "y_pred")
        row = metrics(p).select(F.lit(name).alias("weights"), "accuracy", "macro_f1", "macro_recall", "weighted_f1")
        out = row if out is None else out.unionByName(row)
    return out


_TALK = f"talk AS (SELECT conv_id * 1000 + turn AS doc_id, role AS y, 'all' AS grp, {_X} FROM (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations))"


@query("newton_narratives", f"WITH {_ROWS}, {_TALK}, {_fit('f', 'pool', 'logistic', 1.0)}, {_predict('p', 'f', 'talk', 'logistic')} SELECT doc_id, y_pred, round(conf, 6) AS conf FROM p")
def newton_narratives(spark, sf_dir):
    """New texts, straight from raw to class and confidence."""
    model = shared(spark, sf_dir, "newton_model", lambda: fitted(part(spark, sf_dir, "pool"), "logistic", 1.0))
    talk = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "role", F.coalesce("text", F.lit("")).alias("t"))
    talk = N.prepared(talk, [F.expr(e) for e in FEATURES], F.lit("all"), "role", ("doc_id",))
    return N.predict(talk, model, D, "logistic", "doc_id").drop("y")
