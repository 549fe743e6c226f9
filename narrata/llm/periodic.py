"""Periodic runs of words, found by a dictionary of basic factors.

A run is a maximal stretch of words with smallest period q and a length of at least ``max(LEAST, 2 q)``.

1. Every factor of 2**k words gets a name; the names of one level come from pairs of names of the level below, so equal
   names mean equal words. A factor that occurs once in its text gets a name of its own and drops out of higher levels.
2. At level k the occurrences of a factor, m = 2**k words long, are cut into *chains*: arithmetic progressions whose
   step is at most m / 2, so that the step is the smallest period of the factor. At most five chains begin within 2 m
   words. They propose periods m <= q < 2 m: each occurrence with the heads of the chains after it, and the head of
   each chain with each occurrence of the chains after it.
3. A proposal (i, i + q) whose preceding words agree does not begin a run. Any other is extended to the right by the
   names of all levels; what is long enough is a run. Of equal stretches the smallest period stays.

No run is lost: let s be the start of a run with period q, and u its first m words, m <= q < 2 m. u stands at s and at
s + q, and not in one chain, else q would not be the smallest period. The words before the two places differ (or s is
the text's start), so not both chains go on to the left: s or s + q is a head, and (s, s + q) is proposed.

Defined cases: a null, empty or blank text has no words and no runs; repeated rows and null ids keep their row; a text of
any length is one row of one task, in memory that grows with its words times the levels that repeat. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import pieces, tidy

LEAST, TEXT_BYTES = 12, 1 << 20
WORD = r"[^\x20\x09-\x0D]+"
_word = re.compile(WORD)


def occurrences(name: np.ndarray, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions ``at`` by name and then place, whether the one before has the same name in the same text)."""
    at = at[np.argsort(name[at], kind="stable")]
    same = np.zeros(len(at), bool)
    same[1:] = (name[at[1:]] == name[at[:-1]]) & (owner[at[1:]] == owner[at[:-1]])
    return at, same


def proposals(at: np.ndarray, same: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places at a distance from m to 2 m - 1 that the chains of all factors of one length propose."""
    head = ~same
    head[1:] |= 2 * (at[1:] - at[:-1]) > m
    chain = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    factor = np.cumsum(~same) - 1
    left, right = [], []
    for forward in (True, False):
        who = np.arange(len(at))
        step = 0
        while len(who):
            step += 1 if forward else -1
            other = chain[who] + step
            who = who[(other >= 0) & (other < len(heads))]
            there = heads[chain[who] + step]
            close = (factor[there] == factor[who]) & (np.abs(at[there] - at[who]) < 2 * m)
            who, there = who[close], there[close]
            a, b = (at[who], at[there]) if forward else (at[there], at[who])
            far = b - a >= m
            left.append(a[far])
            right.append(b[far])
    return np.concatenate(left), np.concatenate(right)


def extended(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from ``a`` on agree with those from ``b`` > ``a`` on."""
    size = len(names[0])
    a, b = a.copy(), b.copy()
    start = a.copy()
    for k in range(len(names) - 1, -1, -1):
        inside = b < size
        agree = np.zeros(len(a), bool)
        agree[inside] = names[k][a[inside]] == names[k][b[inside]]
        a[agree] += 1 << k
        b[agree] += 1 << k
    return a - start


def find(words: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs of texts that lie one after another, by text, start and period.

    ``words`` holds a number per word, equal for equal words; ``sizes`` the words of each text.
    """
    n = len(words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    begin, stop = (ends - sizes)[owner], ends[owner]
    alone = -1 - np.arange(n, dtype=np.int64)
    name, at, m = words.astype(np.int64), np.arange(n), 1
    names, pairs = [], []
    while len(at):
        at, same = occurrences(name, at, owner)
        again = same.copy()
        again[:-1] |= same[1:]
        level = alone.copy()
        level[at[again]] = np.cumsum(~same)[again]
        names.append(level)
        at, same = at[again], same[again]
        if not len(at):
            break
        pairs.append(proposals(at, same, m))
        at = np.sort(at)
        at = at[at + 2 * m <= stop[at]]
        at = at[level[at + m] >= 0]
        name = alone.copy()
        name[at] = level[at] * (n + 1) + level[at + m]
        m *= 2
    if not pairs:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    a, b = (np.concatenate(side) for side in zip(*pairs, strict=True))
    first = (a == begin[a]) | (words[a - 1] != words[b - 1])
    a, b = a[first], b[first]
    period = b - a
    length = period + extended(names, a, b)
    whole = length >= np.maximum(2 * period, least)
    a, length, period = a[whole], length[whole], period[whole]
    order = np.lexsort((period, length, a))
    a, length, period = a[order], length[order], period[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (length[1:] != length[:-1])
    a, length, period = a[new], length[new], period[new]
    order = np.lexsort((period, a))
    a, length, period = a[order], length[order], period[order]
    return owner[a], a - begin[a], length, period


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) per row: the runs by start and period, and the words that no run repeats.

    ``collapsed`` leaves out each word that a run contains after its first period, and joins the rest by one space.
    """
    spans = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            split = [_word.findall(t) if t else [] for t in batch.column("text").to_pylist()]
            known: dict[str, int] = {}
            sizes = np.array([len(w) for w in split], np.int64)
            numbers = np.fromiter((known.setdefault(w, len(known)) for ws in split for w in ws), np.int64, sizes.sum())
            owner, start, length, period = find(numbers, sizes, least)
            edges = np.searchsorted(owner, np.arange(len(split) + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(spans)))
            kept = []
            for words, x, y in zip(split, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if x < y:
                    covered = np.zeros(len(words) + 1, np.int64)
                    np.add.at(covered, start[x:y] + period[x:y], 1)
                    np.add.at(covered, start[x:y] + length[x:y], -1)
                    words = [w for w, c in zip(words, np.cumsum(covered).tolist(), strict=False) if not c]
                kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(id: Column, text: Column) -> Column:
    """``text`` with a periodic tail where the checksum of the decimal id is a multiple of ten, else as it is."""
    h = F.crc32(id.cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        a = F.pmod(g, n).cast("int")
        p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")

    split = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when(h % 10 == 0, F.transform(F.array(split), repeated)[0]).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The runs as counts, the longest run and checksums."""
    longest = F.when(F.size("runs") > 0, F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.withColumn("_m", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_m.s").alias("start"), (-F.col("_m.l")).alias("length"),
        F.col("_m.p").alias("period"), F.floor(-1000 * F.col("_m.l") / F.col("_m.p")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
