"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

Everything is built-in column functions. One pass over the texts gives counts and votes per document, which are
staged; expectation-maximisation then runs over the counts of the distinct vote patterns of all documents (at most
3 ** rules rows), as one higher-order expression. Only the fitted prior and accuracies come back to the driver.

Defined cases: null and empty texts have no words, fail the base rules and are not kept. Repeated rows and ids each
keep their row. An empty table gives an empty result. Other columns are ignored. A rule that never votes keeps its
first guesses; a tied posterior (0.5) keeps the document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import stage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
ROUNDS = 40
#: First guesses: a rule's accuracy on good and on bad documents, the share of good documents; the bounds that accuracies keep to.
GOOD, BAD, PRIOR, LOWEST, HIGHEST = 0.9, 0.5, 0.8, 0.001, 0.999


def measures(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per document. Each ``select`` below materialises what later ones use more than once."""
    df = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    df = df.select(
        "doc_id", F.array_remove(F.split("t", SPACE), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"))
    word = lambda i: F.get("words", i)
    df = df.withColumns({
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_words": F.size("words").cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "windows": F.when(F.size("words") > 2, F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.concat_ws(" ", word(i), word(i + 1), word(i + 2)))),
    }).drop("words", "lines")
    none = F.array().cast("array<struct<w:string,i:int>>")
    df = df.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).otherwise(none)).drop("windows")
    same = lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))
    twice = F.filter("sorted", lambda p, k: F.when(k > 0, same(p, F.get("sorted", k - 1))).otherwise(False) | same(p, F.get("sorted", k + 1)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2)))))
    return df.withColumn("n_repeat_words", covered.cast("long")).drop("sorted")


def three_way(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def votes() -> dict[str, Column]:
    """1 for good, -1 for bad, 0 to abstain; columns are those of ``measures``."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    mean, chars = F.col("word_chars") / n, F.greatest(F.col("word_chars"), F.lit(1))
    symbols, repeated = F.col("n_symbols") / n, F.col("n_repeat_words") / n
    dup, letters = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_letters") / chars
    return {
        "length": three_way(F.col("n_words") >= 100, F.col("n_words") < 50),
        "word_length": three_way(mean.between(3, 8), (mean < 2) | (mean > 12)),
        "symbols": three_way(symbols < 0.02, symbols > 0.1),
        "repetition": three_way(repeated < 0.1, repeated > 0.3),
        "lines": three_way((F.col("n_lines") > 1) & (dup == 0), dup > 0.4),
        "letters": three_way(letters > 0.9, letters < 0.7),
    }


def fit(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[float, list[float], list[float]]:
    """The prior of good documents, and per rule its accuracy on good and on bad documents (given that it votes)."""
    counts = voted.groupBy(*names).agg(F.count("*").cast("double").alias("n"))
    patterns = counts.agg(F.sort_array(F.collect_list(F.struct(F.array(*names).alias("v"), F.col("n")))).alias("patterns"))
    clip = lambda x, low, high: F.greatest(F.lit(low), F.least(F.lit(high), x))
    zeros = F.array_repeat(F.lit(0.0), len(names))
    chance = lambda up, v: F.when(v == 0, 1.0).when(v > 0, up).otherwise(1 - up)

    def posterior(v: Column, s: Column) -> Column:
        good = F.zip_with(v, s["good"], lambda x, a: F.log(chance(a, x)))
        bad = F.zip_with(v, s["bad"], lambda x, a: F.log(chance(1 - a, x)))
        odds = F.aggregate(F.zip_with(good, bad, lambda g, b: g - b), F.lit(0.0), lambda t, x: t + x)
        return 1 / (1 + F.exp(-odds - F.log(s["prior"] / (1 - s["prior"]))))

    def step(state: Column, _) -> Column:
        soft = F.transform("patterns", lambda p: F.struct(p["v"].alias("v"), (p["n"] * posterior(p["v"], state)).alias("g"), p["n"].alias("n")))
        begin = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("g"), *[zeros.alias(k) for k in ("up_good", "all_good", "down_bad", "all_bad")])
        add = lambda to, v, vote, weight: F.zip_with(to, v, lambda t, x: t + F.when(vote(x), weight).otherwise(0.0))

        def sweep(s: Column, p: Column) -> Column:
            bad = p["n"] - p["g"]
            return F.struct(
                (s["n"] + p["n"]).alias("n"), (s["g"] + p["g"]).alias("g"),
                add(s["up_good"], p["v"], lambda x: x > 0, p["g"]).alias("up_good"), add(s["all_good"], p["v"], lambda x: x != 0, p["g"]).alias("all_good"),
                add(s["down_bad"], p["v"], lambda x: x < 0, bad).alias("down_bad"), add(s["all_bad"], p["v"], lambda x: x != 0, bad).alias("all_bad"))

        # one more vote than were cast, at the first guess, keeps a rule without votes defined
        rate = lambda part, whole, guess: F.zip_with(part, whole, lambda x, n: clip((x + guess) / (n + 1), LOWEST, HIGHEST))
        return F.aggregate(soft, begin, sweep, lambda s: F.struct(
            clip(s["g"] / F.greatest(s["n"], F.lit(1.0)), 0.02, 0.98).alias("prior"),
            rate(s["up_good"], s["all_good"], GOOD).alias("good"), rate(s["down_bad"], s["all_bad"], BAD).alias("bad")))

    start = F.struct(F.lit(PRIOR).alias("prior"), F.array_repeat(F.lit(GOOD), len(names)).alias("good"), F.array_repeat(F.lit(BAD), len(names)).alias("bad"))
    model = patterns.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("m")).first()["m"]
    return model["prior"], list(model["good"]), list(model["bad"])


def posterior_of(names: list[str], prior: float, good: list[float], bad: list[float]) -> Column:
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, g, b in zip(names, good, bad, strict=True):
        odds = odds + F.when(F.col(name) > 0, math.log(g / (1 - b))).when(F.col(name) < 0, math.log((1 - g) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures, votes, ``quality`` (the posterior of being good), ``base_failed`` and ``kept`` per document."""
    rules = {f"vote_{k}": v for k, v in votes().items()}
    voted = stage(measures(docs, id, text).withColumns(rules))
    names = list(rules)
    prior, good, bad = fit(voted, names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.withColumn("quality", posterior_of(names, prior, good, bad)).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= 0.5))
