"""Naive Bayes by aggregation: exact closed forms, no solver, one pass to fit and one to score.

Classes are rows and array entries, never expressions of a plan: only (term, class) cells with weight are stored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.operators.tfidf import Block, Part, fit_vocabulary, in_parts, meet_parts, part_of, schema_of, transform, weigh
from narrata.session import small_rows, stage


@dataclass
class BayesModel:
    """One or several candidates ``(kind, alpha)`` over the same sums; ``prior`` and ``slope`` hold a list of classes for each."""

    candidates: list[tuple[str, float]]
    classes: list
    prior: list[list[float]]
    slope: list[list[float]]
    block: Block | None  # None for a model over several blocks
    table: DataFrame  # term, idf, total weight, base, cells (class number, corrections) and sums (class number, weight) of the classes in which the term occurs
    common: float | None = None  # terms of a larger total are sent to every task; found when first needed


def class_counts(df: DataFrame, label: str) -> dict:
    rows = small_rows(df.groupBy(label).agg(F.count("*").alias("n")))
    return {r[label]: r["n"] for r in sorted(rows, key=lambda r: str(r[label]))}


def class_weights(counts: dict, power: float = 1.0) -> dict:
    """(n / (k * n_c)) ** power: 0 gives uniform, 1 gives balanced weights."""
    if power < 0:
        raise ValueError("power must be non-negative")
    n, k = sum(counts.values()), len(counts)
    return {c: (n / (k * m)) ** power for c, m in counts.items()}


def class_weight_label(power: float | None) -> str:
    return {None: "None", 1.0: "balanced"}.get(power, f"power={power}")


def class_weight_table(df: DataFrame, label: str, powers: dict[str, float]) -> DataFrame:
    """Weights of every class under several powers, from one count per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    n, k = counts.agg(F.sum("n")).scalar(), counts.agg(F.count("*")).scalar()
    base = counts.withColumn("_r", n.cast("double") / (k * F.col("n")))
    return base.select(label, "n", *[F.pow("_r", F.lit(float(p))).alias(name) for name, p in powers.items()])


def fit_sums(docs: DataFrame, block: Block, label: str, id: str = "doc_id", text: str = "text"):
    """Class counts and weight sums ``(term, idf, cells)``; several models can share them."""
    if docs.limit(1).count() == 0:
        raise ValueError("Cannot fit on an empty table.")
    counts = class_counts(docs, label)
    if len(counts) < 2:
        raise ValueError("A classifier needs at least two classes.")
    vocabulary = fit_vocabulary(docs, block, id, text)
    cells = _cells(transform(docs, vocabulary, block, id, text, carry=(label,)), label, counts)
    return counts, stage(vocabulary.select("term", "idf").join(cells, "term", "left"))


def _cells(weights: DataFrame, label: str, counts: dict) -> DataFrame:
    """``(term, cells)``: the class number and weight sum of every class in which the term occurs, in class order."""
    kind = weights.schema[label].dataType.simpleString()
    numbers = weights.sparkSession.createDataFrame([(i, c) for i, c in enumerate(counts)], f"c int, _l {kind}")
    sums = weights.join(F.broadcast(numbers), F.col(label).eqNullSafe(F.col("_l"))).groupBy("term", "c").agg(F.sum("w").alias("s"))
    return sums.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("c", "s"))).alias("cells"))


def class_terms(counts: dict, sums: DataFrame, label: str = "category") -> DataFrame:
    """Long form ``(label, term, s)`` of the cells with weight."""
    return sums.select("term", F.explode("cells").alias("x")).select(F.get(_names(list(counts)), F.col("x.c")).alias(label), "term", "x.s")


def literal_array(values, kind: str) -> Column:
    """An array as one literal of the plan, whatever its length; numbers are folded before the plan runs."""
    if kind == "double":
        return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def models_from_sums(counts: dict, sums: DataFrame, block: Block | None, candidates: list[tuple[str, float]]) -> BayesModel:
    """One table for all ``(kind, alpha)`` candidates over the same sums.

    A score is a class constant, plus the total weight of the text times the slope of the class, plus what each term adds
    in all classes, plus corrections of the cells in which the term occurs. Only these cells are stored.
    """
    kinds = {kind for kind, _ in candidates}
    if kinds - {"multinomial", "complement"}:
        raise ValueError(f"unknown kind in {sorted(kinds)}")
    k, n = len(counts), sum(counts.values())
    found = small_rows(sums.select(F.explode("cells").alias("x")).groupBy("x.c").agg(F.sum("x.s").alias("t")))
    by_class = {r["c"]: r["t"] for r in found}
    totals, size = [by_class.get(i, 0.0) for i in range(k)], sums.count()
    everything = sum(totals)
    cells = F.coalesce("cells", F.array().cast("array<struct<c: int, s: double>>"))
    total = F.aggregate(cells, F.lit(0.0), lambda a, x: a + x["s"])
    prior, slope, base = [], [], []

    def gain(kind: str, alpha: float, s: Column) -> Column:
        if kind == "multinomial":
            return F.log(s + alpha) - math.log(alpha)
        return F.log(F.col("_all") + alpha) - F.log(F.col("_all") - s + alpha)

    for kind, alpha in candidates:
        if kind == "multinomial":
            prior.append([math.log(m / n) for m in counts.values()])
            slope.append([math.log(alpha) - math.log(t + alpha * size) for t in totals])
            base.append(F.lit(0.0))
        else:
            prior.append([0.0] * k)
            slope.append([math.log(everything - t + alpha * size) for t in totals])
            base.append(-F.log(F.col("_all") + alpha))
    table = sums.withColumn("_all", total).select(
        "term", "idf", F.col("_all").alias("total"), F.array(*base).alias("base"),
        F.transform(cells, lambda x: F.struct(x["c"].alias("c"), F.array(*[gain(q, a, x["s"]) for q, a in candidates]).alias("d"))).alias("cells"), cells.alias("sums"))
    return BayesModel(list(candidates), list(counts), prior, slope, block, table)


def model_from_sums(counts: dict, sums: DataFrame, block: Block | None, kind: str, alpha: float) -> BayesModel:
    return models_from_sums(counts, sums, block, [(kind, alpha)])


def fit(docs: DataFrame, block: Block, label: str, kind: str = "multinomial", alpha: float = 1.0,
        id: str = "doc_id", text: str = "text") -> BayesModel:
    counts, sums = fit_sums(docs, block, label, id, text)
    return model_from_sums(counts, sums, block, kind, alpha)


def block_terms(weights: DataFrame) -> DataFrame:
    """Terms that also say which block they are of."""
    return weights.withColumn("term", F.concat_ws(":", "block", "term"))


def sums_of_weights(weights: DataFrame, docs: DataFrame, label: str):
    """As ``fit_sums``, from a long weight table of any blocks that carries ``label``."""
    counts = class_counts(docs, label)
    if len(counts) < 2:
        raise ValueError("A classifier needs at least two classes.")
    return counts, stage(_cells(block_terms(weights), label, counts).withColumn("idf", F.lit(1.0)))


def predict_weights(model: BayesModel, weights: DataFrame, docs: DataFrame, id: str = "doc_id", carry=()) -> DataFrame:
    """As ``predict``, for rows of ``docs`` whose weights over any blocks are given."""
    rows = block_terms(weights).select(id, "term", "w")
    parts = max(2, -(-rows.count() // PART_WEIGHTS))
    part = F.pmod(F.xxhash64(id), F.lit(parts)).cast("int").alias(f"{id}_part")
    return _scored(model, rows.select(part, id, "term", "w").repartition(parts, f"{id}_part"), _part_of_weights, docs, id, carry, lambda part, grams, _: _given(part, grams))


#: Weights that are scored at once.
PART_WEIGHTS = 1 << 21


def _part_of_weights(rows: pa.Table) -> Part:
    """The part of a long table (part, id, term, w)."""
    ids, coded = rows.select([1]), rows.column("term").combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = ids.column(0).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    by_doc = np.argsort(codes, kind="stable")
    first = np.unique(codes, return_index=True)[1]
    known = coded.dictionary.take(pa.array(order))
    return Part(ids.take(pa.array(first)), np.arange(len(first)), codes[by_doc], rank[coded.indices.to_numpy()][by_doc],
                rows.column("w").to_numpy()[by_doc], len(order), lambda numbers: known.take(pa.array(numbers)))


def _given(part: Part, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = np.full(part.size, -1)
    place[grams] = np.arange(len(grams))
    at = place[part.gram]
    cells = np.flatnonzero(at >= 0)
    return cells, at[cells], part.tf[cells]


def predict(model: BayesModel, docs: DataFrame, id: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    """``(id, *carry, y_pred, conf, scores)``; documents without known terms get the prior. A model of several candidates
    gives one row for each, with its number in ``candidate``."""
    block = model.block
    rows = in_parts(docs.select(id, text), block, id, text)
    return _scored(model, rows, lambda part: part_of(part, [id], block), docs, id, carry, lambda part, grams, known: weigh(part, grams, known.column("idf").to_numpy(), block))


#: Numbers of a model that are sent to every task.
COMMON_VALUES = 1_000_000


def _common_and_rest(model: BayesModel) -> tuple[DataFrame, DataFrame]:
    """The terms of the largest total weight, as many as ``COMMON_VALUES`` allows, and all others.

    The common terms make up most of a text and occur in most classes. Their cells are broadcast, so that only the rest of the terms of
    a part, which have few cells, is shuffled to meet its cells.
    """
    if model.common is None:
        n = COMMON_VALUES // (len(model.classes) * (len(model.candidates) + 4))
        top = model.table.select("total").orderBy(F.desc("total")).limit(n + 1).agg(F.count("*").alias("n"), F.min("total").alias("least")).first()
        model.common = top["least"] if top["n"] > n else -math.inf
    is_common = F.col("total") > F.lit(model.common)
    return F.broadcast(model.table.filter(is_common)), model.table.filter(~is_common)


def _filled(cells: Column, k: int, empty: Column) -> Column:
    """The cells ``(c, d)`` of all classes in order, with ``empty`` where there is none; sorting, not searching, places them."""
    absent = F.array_except(F.sequence(F.lit(0), F.lit(k - 1)), F.transform(cells, lambda x: x["c"]))
    return F.array_sort(F.concat(cells, F.transform(absent, lambda c: F.struct(c.alias("c"), empty.alias("d")))))


#: Products of a weight and a cell, and scores, that are held at once.
SCORED = 2_000_000


def _part_scores(model: BayesModel) -> Callable[[Part, np.ndarray, np.ndarray, np.ndarray, pa.Table], Iterator[tuple[int, int, np.ndarray]]]:
    """A function that gives ranges of documents with their scores, ``(documents, candidates, classes)``; it holds no table."""
    candidates, k = list(model.candidates), len(model.classes)
    prior, slope = np.array(model.prior), np.array(model.slope)

    def scores(part: Part, cells: np.ndarray, at: np.ndarray, w: np.ndarray, known: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
        cs, ss = (known.column(c).combine_chunks() if len(known) else pa.array([], pa.list_(pa.float64())) for c in ("cs", "ss"))
        sizes = pc.list_value_length(ss).to_numpy(zero_copy_only=False).astype(np.int64)
        c, s = cs.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ss.flatten().to_numpy(zero_copy_only=False)
        total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=s, minlength=len(sizes))
        first, every = np.cumsum(sizes) - sizes, np.repeat(total, sizes)
        gains, bases = [], []
        for kind, alpha in candidates:
            if kind == "multinomial":
                gains.append(np.log(s + alpha) - np.log(alpha))
                bases.append(np.zeros(len(total)))
            else:
                gains.append(np.log(every + alpha) - np.log(every - s + alpha))
                bases.append(-np.log(total + alpha))
        doc = part.doc[cells]
        ends = np.searchsorted(doc, np.arange(len(part.docs) + 1))
        work = np.r_[0, np.cumsum(sizes[at])][ends] + k * np.arange(len(ends))
        start = 0
        while start < len(part.docs):
            end = max(start + 1, int(np.searchsorted(work, work[start] + SCORED, side="right")) - 1)
            some, n = slice(ends[start], ends[end]), end - start
            d, t, x = doc[some] - start, at[some], w[some]
            spread = sizes[t]
            place = np.arange(spread.sum()) + np.repeat(first[t] - np.cumsum(spread) + spread, spread)
            key, weight = np.repeat(d, spread) * k + c[place], np.repeat(x, spread)
            whole = np.bincount(d, weights=x, minlength=n)
            out = np.empty((n, len(candidates), k))
            for i in range(len(candidates)):
                own = np.bincount(key, weights=weight * gains[i][place], minlength=n * k).reshape(n, k)
                out[:, i] = prior[i] + whole[:, None] * slope[i] + np.bincount(d, weights=x * bases[i][t], minlength=n)[:, None] + own
            yield start, end, out
            start = end

    return scores


def _scored(model: BayesModel, rows: DataFrame, count: Callable[[pa.Table], Part], docs: DataFrame, id: str, carry,
            weights_of: Callable[[Part, np.ndarray, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """``docs`` with the scores that their parts in ``rows`` get. Terms of a part meet the weight sums of their classes once, and each part
    is scored where it is: what is shuffled beside the texts are distinct terms of parts and sums of classes, for all candidates alike."""
    j, scores = len(model.candidates), _part_scores(model)

    def known(terms: DataFrame) -> DataFrame:
        common, rest = _common_and_rest(model)
        far = terms.join(F.broadcast(common.select("term")), "term", "left_anti")
        both = terms.join(common, "term").select("_part", "_gram", "idf", "sums").unionByName(far.join(rest, "term").select("_part", "_gram", "idf", "sums"))
        return both.select("_part", "_gram", "idf", F.col("sums.c").alias("cs"), F.col("sums.s").alias("ss"))

    def use(part: Part, grams: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
        cells, at, w = weights_of(part, grams, table) if len(grams) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for start, end, out in scores(part, cells, at, w, table):
            n, _, k = out.shape
            inner = pa.ListArray.from_arrays(pa.array(np.arange(n * j + 1, dtype=np.int32) * np.int32(k)), pa.array(out.ravel()))
            ids = part.docs.column(0).slice(start, n).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(j)), inner)], names=[id, "_scores"])

    per = meet_parts(rows, count, known, use, schema_of(docs, [id], "_scores array<array<double>>"))
    unknown = F.array(*[literal_array(p, "double") for p in model.prior])
    found = docs.select(id, *carry).join(per, id, "left").withColumn("_scores", F.coalesce("_scores", unknown))
    if j == 1:
        return with_label(found.select(id, *carry, F.get("_scores", F.lit(0)).alias("scores")), model.classes)
    return with_label(found.select(id, *carry, F.posexplode("_scores").alias("candidate", "scores")), model.classes)


def term_scores(model: BayesModel) -> DataFrame:
    """Long form ``(term, label, theta)`` of the first candidate, for all classes: what one unit of the term adds to a class."""
    zero = F.array(*[F.lit(0.0)] * len(model.candidates))
    full = model.table.withColumn("_d", _filled(F.col("cells"), len(model.classes), zero))
    zipped = F.arrays_zip(_names(model.classes).alias("label"), literal_array(model.slope[0], "double").alias("g"), F.col("_d.d").alias("d"))
    return full.select("term", "base", F.explode(zipped).alias("x")).select(
        "term", F.col("x.label").alias("label"), (F.col("x.g") + F.get("base", F.lit(0)) + F.get("x.d", F.lit(0))).alias("theta"))


def _names(classes: list) -> Column:
    if all(isinstance(c, str) or c is None for c in classes):
        return literal_array(classes, "string")
    return F.array(*[F.lit(c) for c in classes])


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for the row: a lambda over an array of one binds what it is given."""
    return F.transform(F.array(value), use)[0]


def softmax(scores: Column) -> Column:
    """Shares in one pass over the scores, however often a lambda asks for their maximum and total."""

    def shares(s: Column) -> Column:
        powers = _once(F.array_max(s), lambda top: F.transform(s, lambda x: F.exp(x - top)))
        return _once(powers, lambda p: _once(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(p, lambda x: x / total)))

    return _once(scores, shares)


def with_label(df: DataFrame, classes: list) -> DataFrame:
    """Best class (ties: first label) and its softmax share."""
    rounded = F.transform("scores", lambda s: F.round(s, 9))
    names = _names(classes)
    best = F.element_at(names, F.array_position(rounded, F.array_max(rounded)).cast("int"))
    return df.withColumn("_p", softmax(F.col("scores"))).withColumns(
        {"y_pred": best, "conf": F.array_max("_p")}).drop("_p")


def class_scores(df: DataFrame, classes: list, id: str = "doc_id", probability: bool = True) -> DataFrame:
    """Long form ``(id, label, score)``."""
    values = softmax(F.col("scores")) if probability else F.col("scores")
    names = _names(classes)
    return df.select(id, F.inline(F.arrays_zip(names.alias("label"), values.alias("score"))))


def top_classes(df: DataFrame, classes: list, n: int = 5, id: str = "doc_id") -> DataFrame:
    """The ``n`` likeliest classes per row: sorted inside the row, no shuffle."""
    names = _names(classes)
    pairs = F.transform(F.arrays_zip(names.alias("label"), softmax(F.col("scores")).alias("p")),
                        lambda x: F.struct((-F.round(x["p"], 9)).alias("o"), x["label"].alias("label"), x["p"].alias("p")))
    best = F.slice(F.array_sort(pairs), 1, n)
    return df.select(id, F.posexplode(best).alias("pos", "x")).select(
        id, (F.col("pos") + 1).alias("rank"), F.col("x.label").alias("label"), F.col("x.p").alias("probability"))
