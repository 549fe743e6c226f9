"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from narrata import session

#: Spark then deletes the shuffle files of a query when the query has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files, of no more use then, go at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        return session.stage(df)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside those of later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """A map over Arrow batches that gives its memory back when its partition ends."""

    @functools.wraps(run)
    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return through


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the n + 1 offsets; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows again in batches whose ``column`` has about ``limit`` bytes at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """64-bit polynomial hashes of any byte range of one buffer, from prefix sums modulo 2**64.

    Each byte value stands for a random word. Meant for short ranges: strings of a thousand bytes can be made to collide
    under any base, and ``range_hashes`` is there for ranges of any length.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.words = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**59, 2**60)) * 8 + 5
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def prepare(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.powers) < n:
            size = max(n, 1 << 16)
            self.powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, np.uint64(self.base))])
            self.inverses = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, np.uint64(self.inverse))])
        sums = np.zeros(n, np.uint64)
        terms = self.words[data]
        terms *= self.powers[: n - 1]
        np.cumsum(terms, out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.inverses[start]


_keys = np.random.default_rng(2024).integers(0, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ends = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], np.uint64)


def range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges that are not empty: each eight bytes are scrambled with their place in the range, and the
    sum is scrambled with the range's length. No structure of the bytes makes two sums agree, as it does for polynomials."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
    size = end - begin
    lanes = (size + 7) >> 3
    first = np.cumsum(lanes) - lanes
    lane = np.arange(lanes.sum()) - np.repeat(first, lanes)
    at = np.repeat(begin, lanes) + 8 * lane
    value = eights[at] & _ends[np.minimum(np.repeat(end, lanes) - at, 8)]
    value = mixed(mixed(value ^ _keys[0]) + mixed(lane.astype(np.uint64) + _keys[1]))
    total = np.add.reduceat(value, first) if len(first) else value
    return mixed(total ^ (size.astype(np.uint64) * _keys[0]))


def word_hashes(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text) for texts that lie one after another.

    A word is a run of bytes for which ``parts`` (by byte value) is false; it is hashed as ``fold`` maps its bytes.
    """
    inside = ~parts[data]
    opening, closing = inside.copy(), inside.copy()
    opening[1:] &= ~inside[:-1]
    closing[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    opening[heads], closing[tails] = inside[heads], inside[tails]
    begin, end = np.flatnonzero(opening), np.flatnonzero(closing) + 1
    return range_hashes(fold[data], begin, end), np.diff(np.searchsorted(begin, offsets))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches in which rows of a key stand together; keys are integer columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        starts = np.flatnonzero(new).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
