"""Benchmark decontamination by suffix arrays of the training text.

Each task cuts its documents into shards of about ``SHARD_BYTES`` and sorts word suffixes of a shard. Only suffixes
whose first two words (or last word of a document) can open a benchmark window are sorted; for these it is the full
suffix order to the depth of a window. Every benchmark suffix is then found by binary search, all of them in step, and
the interval of equal suffixes gives all its places in the shard. ``matches`` follows a hit on to the longest verbatim
match. Nothing is shuffled: a document lies whole in one shard, and benchmark blocks of bounded size go to the tasks.

Words are runs of characters other than ASCII punctuation, white space and control characters, A-Z lower-cased, and
compare as 64-bit hashes of their bytes.

Defined cases: null or empty texts have no words and no hits; benchmark items without words are skipped; an item with
fewer words than a window is one window; equal windows of several items count for each; rows that repeat keep their
row; empty tables give no hits or no rows. Null item ids are skipped. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import mixed, pieces, tidy, utf8, word_hashes

WINDOW = 10
#: Bytes of text of a shard, of text hashed at once, and of benchmark text in a block.
SHARD_BYTES, HASH_BYTES, BLOCK_BYTES = 4 << 20, 1 << 20, 8 << 20

# Bytes that are no part of a word become 0, A-Z become a-z.
FOLD = np.arange(256, dtype=np.uint8)
for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    FOLD[low:high + 1] = 0
FOLD[0x41:0x5B] += 32


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text); 0 is no word's hash and stands for the end of a document."""
    hashes, counts = word_hashes(data, offsets, FOLD == 0, FOLD)
    hashes[hashes == 0] = 1
    return hashes, counts


class Queries:
    """The windows of some benchmark items: distinct rows of word hashes, padded with 0, and the items of each."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        hashes, counts = words_of(*utf8(pa.array([t for _, t in items], pa.string())))
        ends = np.cumsum(counts)
        rows, owners = [], []
        for k, (n, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
            if n:
                size = min(n, window)
                block = np.zeros((n - size + 1, window), np.uint64)
                block[:, :size] = np.lib.stride_tricks.sliding_window_view(hashes[end - n:end], size)
                rows.append(block)
                owners.append(np.full(len(block), k))
        self.window = window
        self.names = [i for i, _ in items]
        every = np.concatenate(rows) if rows else np.zeros((0, window), np.uint64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.lexsort(every.T[::-1])
        every, owner = every[order], owner[order]
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]).any(1)
        self.rows = every[new]
        self.sizes = (self.rows != 0).sum(1)
        self.group = np.cumsum(new) - 1
        self.owner, self.bounds = owner, np.concatenate([np.flatnonzero(new), [len(every)]])
        self.pairs = np.unique(self.pair(self.rows[:, 0], self.rows[:, 1])) if len(self.rows) else np.zeros(0, np.uint64)
        self.singles = np.unique(self.rows[self.sizes == 1, 0])

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed(a) ^ b


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    # a bit table rules out most values before the exact search
    table = np.zeros(1 << 20, bool)
    table[(of & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    out = table[(values & np.uint64((1 << 20) - 1)).astype(np.int64)]
    at = np.flatnonzero(out)
    spot = np.minimum(np.searchsorted(of, values[at]), len(of) - 1)
    out[at] = of[spot] == values[at]
    return out


class Shard:
    """The suffix array of some documents' words."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, queries: Queries):
        w = queries.window
        self.words, self.counts = hashes, counts
        self.ends = np.cumsum(counts)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        follow = np.zeros(len(hashes), np.uint64)
        follow[:-1] = hashes[1:]
        full = counts > 0
        follow[self.ends[full] - 1] = 0
        keep = member(Queries.pair(hashes, follow), queries.pairs)
        if len(queries.singles):
            keep |= member(hashes, queries.singles)
        at = np.flatnonzero(keep)
        left = self.ends[self.doc[at]] - at
        padded = np.concatenate([hashes, np.zeros(w, np.uint64)])
        columns = [np.where(left > k, padded[at + k], np.uint64(0)) for k in range(w)]
        order = np.lexsort(columns[::-1]) if len(at) else np.zeros(0, np.int64)
        self.suffixes = at[order]
        self.columns = [c[order] for c in columns]

    def bound(self, queries: Queries, after: bool) -> np.ndarray:
        """For each query the first suffix not before it, or (``after``) past all that begin with it."""
        n, q = len(self.suffixes), len(queries.rows)
        low, high = np.zeros(q, np.int64), np.full(q, n)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            less = np.zeros(len(open_), bool)
            equal = np.arange(len(open_))
            for k in range(queries.window):
                a, b = self.columns[k][middle[equal]], queries.rows[open_[equal], k]
                live = queries.sizes[open_[equal]] > k
                less[equal[live & (a < b)]] = True
                equal = equal[live & (a == b)]
                if not len(equal):
                    break
            if after and queries.window:
                whole = np.ones(len(open_), bool)
                for k in range(queries.window):
                    live = queries.sizes[open_] > k
                    whole &= ~live | (self.columns[k][middle] == queries.rows[open_, k])
                less |= whole
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]

    def find(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """(query, place of its first word in the shard) of every occurrence."""
        if not len(self.suffixes) or not len(queries.rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high = self.bound(queries, False), self.bound(queries, True)
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        place = self.suffixes[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return which, place


def shards(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """(batches, word hashes, words per row) of about SHARD_BYTES of text each."""
    held: list = []
    size = 0
    for batch in pieces(batches, column, HASH_BYTES):
        data, offsets = utf8(batch.column(column))
        held.append((batch, *words_of(data, offsets)))
        size += len(data)
        if size >= SHARD_BYTES:
            yield [h[0] for h in held], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            held, size = [], 0
    if held:
        yield [h[0] for h in held], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])


def benchmark_blocks(benchmark: DataFrame, id: str, text: str, window: int) -> list:
    """Broadcast blocks of benchmark windows; the driver holds one block of about BLOCK_BYTES at a time."""
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col(f"`{id}`").cast("long").alias("i"), F.col(f"`{text}`").alias("t")).filter("i is not null and t is not null")
    blocks, held, size = [], [], 0
    for row in rows.toLocalIterator():
        held.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= BLOCK_BYTES:
            blocks.append(context.broadcast(Queries(held, window)))
            held, size = [], 0
    if held:
        blocks.append(context.broadcast(Queries(held, window)))
    return blocks


def hits(queries: Queries, shard: Shard, hit: np.ndarray) -> np.ndarray:
    """Mark the words of ``hit``; returns distinct (document << 32 | item) pairs."""
    which, place = shard.find(queries)
    if not len(which):
        return np.zeros(0, np.int64)
    size = queries.sizes[which]
    edges = np.zeros(len(hit) + 1, np.int64)
    np.add.at(edges, place, 1)
    np.add.at(edges, place + size, -1)
    hit |= np.cumsum(edges[:-1]) > 0
    once = np.unique(shard.doc[place] << 32 | which)
    doc, which = once >> 32, once & 0xFFFFFFFF
    n = queries.bounds[which + 1] - queries.bounds[which]
    item = queries.owner[np.repeat(queries.bounds[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    return np.unique(np.repeat(doc, n) << 32 | item)


def screen(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items array): hit words and the benchmark items found, per row of ``docs``."""
    blocks = benchmark_blocks(benchmark, item_id, item_text, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, hashes, counts in shards(batches, "text"):
            hit = np.zeros(len(hashes), bool)
            found: list[list[int]] = [[] for _ in counts]
            for block in blocks:
                queries = block.value
                for pair in hits(queries, Shard(hashes, counts, queries), hit).tolist():
                    found[pair >> 32].append(queries.names[pair & 0xFFFFFFFF])
            totals = np.concatenate([[0], np.cumsum(hit)])
            ends = np.concatenate([[0], np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([b.column("doc_id") for b in group]), pa.array(counts.astype(np.int64)),
                pa.array(totals[ends[1:]] - totals[ends[:-1]], pa.int64()), pa.array([sorted(set(f)) for f in found], pa.list_(pa.int64()))],
                ["doc_id", "n_words", "n_hit", "items"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_words long, n_hit long, items array<long>")


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with all their columns."""
    blocks = benchmark_blocks(benchmark, item_id, item_text, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, hashes, counts in shards(batches, text):
            hit = np.zeros(len(hashes), bool)
            for block in blocks:
                hits(block.value, Shard(hashes, counts, block.value), hit)
            totals, ends = np.concatenate([[0], np.cumsum(hit)]), np.concatenate([[0], np.cumsum(counts)])
            clean = totals[ends[1:]] == totals[ends[:-1]]
            at = 0
            for batch in group:
                yield batch.filter(pa.array(clean[at:at + batch.num_rows]))
                at += batch.num_rows

    return docs.mapInArrow(tidy(run), docs.schema)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words): the longest verbatim matches, of a window at least (or a whole shorter item)."""
    context, blocks = benchmark.sparkSession.sparkContext, []
    rows = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("i"), F.col(f"`{item_text}`").alias("t")).filter("i is not null and t is not null")
    held: list = []
    for row in rows.toLocalIterator():
        held.append((row["i"], row["t"]))
        if sum(len(t) for _, t in held) >= BLOCK_BYTES:
            blocks.append(context.broadcast(held))
            held = []
    if held:
        blocks.append(context.broadcast(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, hashes, counts in shards(batches, "text"):
            ids = pa.concat_arrays([b.column("doc_id") for b in group]).to_pylist()
            for block in blocks:
                queries = Queries(block.value, window)
                words, sizes = words_of(*utf8(pa.array([t for _, t in block.value], pa.string())))
                ends, shard = np.cumsum(sizes), Shard(hashes, counts, queries)
                starts: dict[bytes, list[int]] = {}
                for k, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True)):
                    for at in range(end - n, end - min(n, window) + 1) if n else ():
                        row = np.zeros(window, np.uint64)
                        row[: min(n, window)] = words[at:at + min(n, window)]
                        starts.setdefault(row.tobytes(), []).append((k << 32) | at)
                which, place = shard.find(queries)
                out = []
                for q, p in zip(which.tolist(), place.tolist(), strict=True):
                    d = int(shard.doc[p])
                    first, last = int(shard.ends[d] - counts[d]), int(shard.ends[d])
                    for key in starts[queries.rows[q].tobytes()]:
                        k, at = key >> 32, key & 0xFFFFFFFF
                        begin, end = int(ends[k] - sizes[k]), int(ends[k])
                        if p > first and at > begin and hashes[p - 1] == words[at - 1]:
                            continue  # told of at an earlier place
                        n = min(last - p, end - at)
                        differ = np.flatnonzero(hashes[p:p + n] != words[at:at + n])
                        out.append((ids[d], queries.names[k], p - first, at - begin, int(differ[0]) if len(differ) else n))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((),) * 5)], ["doc_id", "item_id", "doc_word", "item_word", "n_words"])

    return docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tidy(run), "doc_id long, item_id long, doc_word long, item_word long, n_words long")

