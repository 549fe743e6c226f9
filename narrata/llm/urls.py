"""URL filter by a ratio of two character language models, beside explicit host and path rules.

The URLs that a rule decides are the labelled rows: allowed ones train the model of accepted URLs, blocked ones that
of rejected URLs. Each is a variable-order Markov model over characters with Witten-Bell smoothing, orders 0 to
``ORDER``: P(c | context) = (n(context c) + t(context) P(c | shorter context)) / (n(context) + t(context)), where t is
the number of distinct characters seen after the context. The score of a URL is the difference of both
log-likelihoods over its length, less a threshold halfway between the mean scores of accepted and rejected URLs. The
models read the whole URL (scheme, host, path, query and fragment), with A-Z lower-cased in the host alone; only the
rules look at host and path.

Only built-in functions are used. A model is a table of n-grams; URLs are counted once each with their number of
pages, so that a host with many pages weighs by count and not by rows.

Defined cases: a null URL, or one without ``://``, has an empty host and path and no rule. A null or empty URL has no
character to judge and is allowed, as is every URL while one of both classes has no labelled row. Repeated rows keep
their row.
A tied score (equal to the threshold) allows. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import stage

ORDER = 4
#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    found = lambda group: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))
    return F.translate(found(1), ASCII_UPPER, ASCII_LOWER), found(2)


def whole(url: Column) -> Column:
    """The URL with A-Z lower-cased in its host; null counts as empty."""
    found = lambda group: F.regexp_extract(url, r"(?s)^(.*?://)([^/?#]*)(.*)$", group)
    lowered = F.concat(found(1), F.translate(found(2), ASCII_UPPER, ASCII_LOWER), found(3))
    return F.coalesce(F.when(F.contains(url, F.lit("://")), lowered).otherwise(url), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, f"{h}{p}").otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def grams(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """A row for each character with its context: ``g`` has ORDER + 1 characters, padded at the start."""
    padded = F.concat(F.lit("\u0002" * ORDER), F.col(text))
    at = F.sequence(F.lit(1), F.length(text))
    return df.filter(F.length(text) > 0).withColumn("_p", padded).select(*keep, F.explode(F.transform(at, lambda i: F.substring(F.col("_p"), i, F.lit(ORDER + 1)))).alias("g"))


def log_ratio(labelled: DataFrame) -> DataFrame:
    """(g, ratio): log P(accepted) - log P(rejected) of the last character of g after the others, for every g.

    ``labelled`` has (g, a, r): the weighted counts of each full n-gram among accepted and rejected URLs (0: none).
    Shorter orders are sums over the full n-grams, so that all statistics come from this one table.
    """
    df = labelled.withColumn("pa", F.lit(1.0 / 65536)).withColumn("pr", F.lit(1.0 / 65536))
    for order in range(ORDER + 1):
        gram = F.substring("g", ORDER + 1 - order, order + 1)
        context = F.substring("g", ORDER + 1 - order, order) if order else F.lit("")
        seen = labelled.groupBy(gram.alias("_g")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
        cut = F.substring("_g", 1, order) if order else F.lit("")
        after = seen.groupBy(cut.alias("_c")).agg(
            F.sum("na").alias("ca"), F.sum("nr").alias("cr"), F.count(F.when(F.col("na") > 0, 1)).alias("ta"), F.count(F.when(F.col("nr") > 0, 1)).alias("tr"))
        df = df.withColumns({"_g": gram, "_c": context}).join(seen, "_g").join(after, "_c")
        for k in ("a", "r"):
            total = F.col(f"c{k}") + F.col(f"t{k}")
            df = df.withColumn(f"p{k}", F.when(total > 0, (F.col(f"n{k}") + F.col(f"t{k}") * F.col(f"p{k}")) / total).otherwise(F.col(f"p{k}")))
        df = df.select("g", "pa", "pr")
    return df.select("g", (F.log("pa") - F.log("pr")).alias("ratio"))


def judge(pages: DataFrame, id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict and score (0 where a rule decides nothing and nothing is known)."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col(f"`{id}`").alias("page_id"), F.col(f"`{url}`").alias("url")).withColumns({"host": host, "path": path})
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": ruled, "key": whole(F.col("url"))})
    urls = stage(rows.groupBy("key", "ruled").agg(F.count("*").alias("n")))
    spelled = grams(urls, "key", ["key", "ruled", "n"])
    labelled = stage(spelled.groupBy("g").agg(
        F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("r")))
    model = stage(log_ratio(labelled))
    scores = stage(spelled.join(model, "g").groupBy("key", "ruled", "n").agg(F.avg("ratio").alias("raw")))
    of = lambda what: F.sum(F.when(F.col("ruled") == what, F.col("raw") * F.col("n"))) / F.sum(F.when(F.col("ruled") == what, F.col("n")))
    ends = scores.agg(of("allow").alias("allow"), of("block").alias("block")).first()
    known = ends["allow"] is not None and ends["block"] is not None
    middle = (ends["allow"] + ends["block"]) / 2 if known else 0.0
    score = F.coalesce(F.col("raw") - middle, F.lit(0.0)) if known else F.lit(0.0)
    # the same key has one rule result: it holds the host and path that rules look at
    judged = rows.join(scores.select("key", "raw"), "key", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(score >= 0, "allow").otherwise("block")).alias("verdict"), score.alias("score"))
