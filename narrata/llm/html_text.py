"""Main text of web pages: gradient-boosted trees judge the blocks of a page, a tree-wide decoding makes them agree.

Blocks (see ``dom``) are judged by text, link and punctuation density of their subtree, attribute tokens, element,
depth, and statistics of their siblings and ancestors. Decoding gives every block one of three states by dynamic
programming over the tree: *mixed* (no text of its own taken, children free), *in* (children in or out) or *out* (all
below out), with the greatest sum of log-odds. So nothing inside a rejected block is ever taken, and nothing outside
an accepted one.

Training uses random labelled pages of a grammar and a bounded sample of the given pages (``SAMPLE`` rows of at most
``PAGE_CHARS`` characters, by hash of the id; longer pages are judged like all others), labelled where one article or main element, or one declared article body, says itself what the article is.
Half of the copies of the given pages hide element names and attributes, so that densities are learnt too.

Defined cases: a null or empty page, or one without an article, has an empty text. Repeated rows and null ids keep
their row. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm import boosting
from narrata.llm.common import pieces, tidy
from narrata.llm.dom import Page
from narrata.llm.page_grammar import Grammar

SAMPLE, GRAMMAR_PAGES, PAGE_CHARS, TEXT_BYTES = 200, 500, 200_000, 1 << 20
CLIP, MIXED, INNER = 6.0, 0.05, 0.5
#: Elements inside an article that are never a part of it.
OUTER = frozenset("nav aside footer form".split())


def own_label(page: Page) -> bool:
    """Label ``page`` by its own article or main element; False where it has none or several."""
    for name in ("article", "main"):
        found = [i for i, t in enumerate(page.tag) if t == name]
        if len(found) == 1:
            page.label = [1 if i == found[0] else 0 if t in OUTER or t == "body" else None for i, t in enumerate(page.tag)]
            return True
    return False


def token_odds(pages: list[Page]) -> dict[str, float]:
    """Smoothed log-odds of the article for the attribute tokens of at least three pages."""
    yes, no, on = defaultdict(float), defaultdict(float), defaultdict(int)
    for page in pages:
        page.sums()
        for token in {t for tokens in page.tokens for t in tokens}:
            on[token] += 1
        for i, y in enumerate(page.truth()):
            for token in page.tokens[i] if y >= 0 else ():
                (yes if y else no)[token] += 1
    return {t: float(np.log((yes[t] + 0.5) / (no[t] + 0.5))) for t, n in on.items() if n >= 3}


def fit(sources: list[str], seed: int = 3) -> tuple[boosting.Model, dict[str, float]]:
    grammar = Grammar(seed)
    made = [Page(grammar.page()) for _ in range(GRAMMAR_PAGES)]
    given = [p for p in (Page(s, given=True) for s in sources) if own_label(p)]
    odds = token_odds(made)
    rows, labels, weights = [], [], []
    for pages, blind, weight in ((made, False, 1.0), (given, False, 1.0), (given[::2], True, 0.5)):
        for page in pages:
            x, y = page.features(odds, blind), page.truth()
            rows.append(x[y >= 0])
            labels.append(y[y >= 0])
            weights.append(np.full((y >= 0).sum(), weight))
    return boosting.fit(np.concatenate(rows), np.concatenate(labels), np.concatenate(weights)), odds


def decode(page: Page, score: np.ndarray) -> list[int]:
    """The blocks with text that are in."""
    n = len(page.tag)
    score = np.clip(score, -CLIP, CLIP)
    gain = [0.0] * n
    inside, outside, mixed = [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n):
        # a block's own text counts whole, a container's judgement half
        gain[i] = float(score[i]) * (1.0 if i in page.texts else INNER) if page.chars[i] else 0.0
    below = [[] for _ in range(n)]
    for i in range(1, n):
        below[page.parent[i]].append(i)
    for i in sorted(range(n), key=lambda i: -page.depth[i]):
        outside[i] = -gain[i] + sum(outside[c] for c in below[i])
        inside[i] = gain[i] + sum(max(inside[c], outside[c]) for c in below[i])
        mixed[i] = -MIXED + sum(max(mixed[c], inside[c], outside[c]) for c in below[i]) if i not in page.texts else -np.inf
    state = [""] * n
    taken = set()
    todo = [0]
    while todo:
        i = todo.pop()
        above = state[page.parent[i]] if i else "mixed"
        choices = {"outside": outside[i]}
        if above != "outside":
            choices["inside"] = inside[i]
        if above == "mixed":
            choices["mixed"] = mixed[i]
        state[i] = max(choices, key=choices.__getitem__) if i else "mixed"
        if state[i] == "inside" and i in page.texts:
            taken.add(i)
        if state[i] != "outside":
            todo += below[i]
    return [i for i in page.order if i in taken]


def extract(sources: list[str], model: boosting.Model, odds: dict[str, float]) -> list[str]:
    pages = [Page(s, given=True) for s in sources]
    x = [p.features(odds) for p in pages]
    score = model.scores(np.concatenate(x)) if x else np.zeros(0)
    ends = np.cumsum([len(f) for f in x])
    return [" ".join(page.texts[i] for i in decode(page, score[end - len(f):end])) for page, f, end in zip(pages, x, ends, strict=True)]


def sample(pages: DataFrame, id: str, html: str) -> list[str]:
    """At most ``SAMPLE`` pages, by hash of the id: the bound of the hash is found first, so that few pages move."""
    rows = pages.filter(F.col(f"`{html}`").isNotNull() & (F.length(F.col(f"`{html}`")) <= PAGE_CHARS))
    keyed = rows.select(F.col(f"`{html}`").alias("h"), F.xxhash64(F.col(f"`{id}`"), F.lit("sample")).alias("k"))
    first = [r["k"] for r in keyed.select("k").orderBy("k").limit(SAMPLE).collect()]
    return [r["h"] for r in keyed.filter(F.col("k") <= first[-1]).orderBy("k", "h").limit(SAMPLE).collect()] if first else []


def texts(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row."""
    model, odds = fit(sample(pages, id, html))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html", TEXT_BYTES):
            found = extract(batch.column("html").fill_null("").to_pylist(), model, odds)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return rows.mapInArrow(tidy(run), "page_id long, url string, text string, n_chars long")
