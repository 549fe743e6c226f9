"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a ``SIZE``-byte string that also starts earlier in the corpus (smaller doc id, or earlier in the
document) is removed, exactly, in six steps that are each a scan or one shuffle:

1. Triggers. A rolling hash over ``GRAM`` bytes is taken at each place; the trigger of a window (a ``SIZE``-byte
   string) is its least hash among the first ``WIDTH`` places, the leftmost of equals. It depends on the window's bytes
   alone, so equal windows have equal triggers. Windows in a row with one trigger form a phrase; the phrases of a
   document are its parse. Each phrase has a core (the bytes from its trigger on that all of its windows contain) and a
   hull (all bytes of its windows, which is the phrase with the start of the parse's next phrases).
2. Parse. Phrases of equal core stand together in the order (core, hull, doc, key, place). Where the hull has occurred
   before, the whole phrase repeats. A core with a single hull has no other repeats.
3. Dictionary. What is left are the first occurrences of distinct hulls that share a core: the dictionary entries
   whose suffixes have to be compared. Their bytes are fetched from the texts.
4. Suffix arrays. Entries are dealt by core and sorted shard by shard: the suffix array of all their windows. Equal
   neighbours form classes, whose members in corpus order are a first one and repeats. A shard holds whole cores.
5. Only a core with more than ``SHARD`` entries is spread over shards; the first ones of its classes meet by a 128-bit
   fingerprint, as in step 2.
6. Repeats are gathered by document and cut from its text.

Only the phrases (one for some 29 bytes), the dictionary and the repeats are shuffled, and each text twice. A group of
any size is sorted by Spark and read as a stream; nothing is collected.

Defined cases: null and empty texts have no bytes and no windows; texts shorter than ``SIZE`` bytes lose nothing. Rows
that share an id are not earlier than each other, equal texts or not; each is told from the other by a hash of its
text (``key``) and keeps its own places. Rows without an id keep their text and are no earlier place for others. Empty
tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import RangeHash, mixed, pieces, stage, tidy, utf8

SIZE, GRAM, WIDTH = 100, 16, 64
CORE = SIZE - WIDTH + 1
#: Bytes hashed at once, longest stretch of one text parsed at once, dictionary entries of a shard.
TEXT_BYTES, STRETCH, SHARD = 1 << 20, 4 << 20, 8192
INDEX_BITS = 23

_one, _two = RangeHash(101), RangeHash(202)
PARSE = "core long, hull long, doc_id long, key long, at long"


def parse(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, core hash, hull hash) of every phrase; texts lie one after another, below 2 ** 23 bytes."""
    n = len(data)
    if n < SIZE:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    one, two = _one.prepare(data), _two.prepare(data)
    at = np.arange(n - GRAM + 1)
    least = mixed(_one.of(one, at, at + GRAM))
    least >>= np.uint64(INDEX_BITS)
    least <<= np.uint64(INDEX_BITS)
    least |= at.astype(np.uint64)
    span = 1
    while span < WIDTH:  # least of 2, 4, ... WIDTH places
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - SIZE + 1, 0)
    start = np.repeat(offsets[:-1] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    trigger = (least[start] & np.uint64((1 << INDEX_BITS) - 1)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin, core = start[first], trigger[first]
    return begin, count, _one.of(one, core, core + CORE), _two.of(two, begin, begin + count - 1 + SIZE)


def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (core, hull, doc_id, key, at) of each text; ``at`` is the first window's place * 128 + the number of windows."""
    for batch in pieces(batches, "text", TEXT_BYTES):
        data, offsets = utf8(batch.column("text"))
        ids, keys = batch.column("doc_id").to_numpy(), batch.column("key").to_numpy()
        # a text over the stretch is parsed in parts that overlap by a window less one byte
        parts = [(data, offsets, 0)] if len(data) <= STRETCH else [
            (data[b:min(b + STRETCH + SIZE - 1, len(data))], np.array([0, min(STRETCH + SIZE - 1, len(data) - b)]), b) for b in range(0, len(data), STRETCH)]
        for part, ends, base in parts:
            begin, count, core, hull = parse(part, ends)
            owner = np.searchsorted(ends, begin, "right") - 1
            at = (begin - ends[owner] + base) << 7 | count
            yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(hull.view(np.int64)), pa.array(ids[owner]), pa.array(keys[owner]), pa.array(at)], ["core", "hull", "doc_id", "key", "at"])


def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order (core, hull, doc_id, key, at): repeats, with a null core, and firsts that share a core.

    A hull has one first in each row (key) of its first doc. The state between batches is the last first and whether it
    still waits for a second one of its core.
    """
    last = None  # core, hull, doc, key and place of the last first of the running hull
    waiting = None  # that first's row while its core has no other
    for batch in batches:
        if not batch.num_rows:
            continue
        core, hull, doc, key, at = (batch.column(c).to_numpy() for c in ("core", "hull", "doc_id", "key", "at"))
        n = len(core)
        new_core = np.ones(n, bool)
        new_core[1:] = core[1:] != core[:-1]
        if last is not None:
            new_core[0] = core[0] != last[0]
        new = new_core.copy()
        new[1:] |= hull[1:] != hull[:-1]
        if last is not None:
            new[0] |= hull[0] != last[1]
        top = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        other = doc == (np.where(top >= 0, doc[top], last[2]) if last is not None else doc[top])  # of the hull's first doc
        other[1:] &= key[1:] != key[:-1]
        other[0] &= last is not None and key[0] != last[3]
        new |= other
        head = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        running = head < 0
        first_doc, first_at = doc[np.maximum(head, 0)], at[np.maximum(head, 0)]
        if running.any():
            first_doc[running], first_at[running] = last[2], last[4]
        repeat = ~new & ((doc != first_doc) | (at != first_at))
        group = np.cumsum(new_core)  # 0: the core that ran over from before
        firsts = np.bincount(group[new], minlength=group[-1] + 1)
        if firsts[0]:  # the running core has got another first
            firsts[0] = 2
        send = new & (firsts[group] > 1)
        extra = [waiting] if waiting is not None and firsts[0] else []
        if firsts[0] or new_core.any():
            waiting = None
        end = group[-1]
        if end and firsts[end] == 1:
            spot = int(np.flatnonzero(new)[-1])
            waiting = (int(core[spot]), int(doc[spot]), int(key[spot]), int(at[spot]))
        if new.any():
            spot = int(np.flatnonzero(new)[-1])
            last = (core[spot], hull[spot], doc[spot], key[spot], at[spot])
        pick = repeat | send
        columns = [core[pick], doc[pick], key[pick], at[pick]]
        mask = repeat[pick]
        if extra:
            columns = [np.append(c, extra[0][k]) for k, c in enumerate(columns)]
            mask = np.append(mask, False)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], mask=mask), *map(pa.array, columns[1:])], ["core", "doc_id", "key", "at"])


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, doc_id, key, at, data): the bytes of the hulls that ``firsts`` (structs of core and at) of each text name."""
    for batch in pieces(batches, "text", TEXT_BYTES):
        data, offsets = utf8(batch.column("text"))
        raw = data.tobytes()
        lists = batch.column("firsts")
        n = lists.value_lengths().to_numpy()
        flat = lists.flatten()
        core, at = flat.field("core"), flat.field("at").to_numpy()
        owner = np.repeat(np.arange(len(n)), n)
        begin = offsets[:-1][owner] + (at >> 7)
        end = begin + (at & 127) - 1 + SIZE
        bodies = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        doc, key = (pa.array(batch.column(c).to_numpy()[owner]) for c in ("doc_id", "key"))
        yield pa.RecordBatch.from_arrays([core, doc, key, pa.array(at), pa.array(bodies, pa.binary())], ["core", "doc_id", "key", "at", "data"])


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(entries, whether the entry's core also has entries in another shard), from entries in the order of their cores.

    A shard ends between two cores, so that it holds all entries of its cores, unless one core fills it alone.
    """
    held: pa.Table | None = None
    split = None  # the core of which an earlier shard had a part
    for batch in batches:
        held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
        while held.num_rows > SHARD:
            core = held.column("core").to_numpy()
            ends = np.flatnonzero(core[1:SHARD + 1] != core[:SHARD]) + 1
            cut = int(ends[-1]) if len(ends) else SHARD
            if not len(ends):
                split = core[0]
            yield held.slice(0, cut), np.full(cut, split is not None) & (core[:cut] == split)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held, np.full(held.num_rows, split is not None) & (held.column("core").to_numpy() == split)


def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays of dictionary shards: (null, null, doc_id, key, at) of each window that repeats an earlier one
    of the shard; and of cores with entries in several shards (core, hull, doc_id, key, at) of the firsts of each class,
    where core and hull are now two fingerprints of the window."""
    for shard, spread in shards(batches):
        data = np.frombuffer(b"".join(shard.column("data").to_pylist()) + bytes(8), np.uint8)
        doc, at = shard.column("doc_id").to_numpy(), shard.column("at").to_numpy()
        key = shard.column("key").to_numpy() if "key" in shard.column_names else np.zeros(len(doc), np.int64)  # ids of one row each
        count = at & 127
        length = count - 1 + SIZE
        base = np.cumsum(length) - length
        owner = np.repeat(np.arange(len(count)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin, place = base[owner] + step, (at >> 7)[owner] + step
        words = np.lib.stride_tricks.sliding_window_view(data, 8)
        keys = [np.ascontiguousarray(words[begin + o]).view(">u8").ravel().astype(np.uint64) for o in [*range(0, SIZE - 8, 8), SIZE - 8]]
        order = np.lexsort((place, key[owner], doc[owner], *keys[::-1]))
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
        window, where, whose, row = begin[order], place[order], doc[owner][order], key[owner][order]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        new[1:] |= (whose[1:] == whose[head[1:]]) & (row[1:] != row[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        repeat = (whose != whose[head]) | (where != where[head])
        pick = repeat | (new & spread[owner][order])
        if pick.any():
            one, two = _one.prepare(data), _two.prepare(data)
            chosen, mask = window[pick], repeat[pick]
            yield pa.RecordBatch.from_arrays([
                pa.array(_one.of(one, chosen, chosen + SIZE).view(np.int64), mask=mask), pa.array(_two.of(two, chosen, chosen + SIZE).view(np.int64), mask=mask),
                pa.array(whose[pick]), pa.array(row[pick]), pa.array(where[pick] << 7 | 1)], ["core", "hull", "doc_id", "key", "at"])


def sifted(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition("core").sortWithinPartitions("core", "hull", "doc_id", "key", "at")
    return ordered.mapInArrow(tidy(sift), "core long, doc_id long, key long, at long")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, key, at): stretches of windows that have occurred before; ``docs`` has (doc_id, key, text)."""
    found = stage(sifted(docs.mapInArrow(tidy(phrases), PARSE)))
    firsts = found.filter("core is not null").groupBy("doc_id", "key").agg(F.collect_list(F.struct("core", "at")).alias("firsts"))
    dictionary = docs.join(firsts, ["doc_id", "key"]).mapInArrow(tidy(entries), "core long, doc_id long, key long, at long, data binary")
    windows = stage(dictionary.repartition("core").sortWithinPartitions("core").mapInArrow(tidy(classes), PARSE))
    late = sifted(windows.filter("core is not null")).filter("core is null")
    parts = [t.filter("core is null").select("doc_id", "key", "at") for t in (found, windows, late)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def marks(at: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` bytes the windows cover."""
    begin = at >> 7
    edges = np.bincount(begin, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(begin + (at & 127) - 1 + SIZE, n), minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def cut(docs: DataFrame, id: str, text: str, columns, schema: str) -> DataFrame:
    """Rows of ``docs`` with what ``columns(bytes, covered, raw text)`` makes of each text."""
    # columns go by their place, whatever they are called
    names = docs.columns
    aside = docs.select(*[F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)])
    id, text = f"c{names.index(id)}", f"c{names.index(text)}"
    key = F.xxhash64(text)
    rows = aside.filter(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("doc_id"), key.alias("key"), F.col(text).alias("text"))
    gathered = repeated(rows).groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("at").alias("_at"))
    joined = aside.join(gathered, (F.col(id).cast("long") == F.col("_id")) & (key == F.col("_key")), "left").drop("_id", "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, TEXT_BYTES):
            data, offsets = utf8(batch.column(text))
            lists = batch.column("_at")
            flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            pairs = []
            for k in range(batch.num_rows):
                part, at = data[offsets[k]:offsets[k + 1]], flat[ends[k]:ends[k + 1]]
                pairs.append((part, marks(at, len(part)) if len(at) else np.zeros(len(part), bool)))
            yield columns(batch, pairs)

    return joined.mapInArrow(tidy(run), schema)


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row."""

    def columns(batch, pairs):
        sums = [hashlib.sha256(data[~gone].tobytes()).hexdigest() for data, gone in pairs]
        spans = [int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()) for _, gone in pairs]
        numbers = [pa.array([f(data, gone) for data, gone in pairs], pa.int64()) for f in (lambda d, g: len(d), lambda d, g: int(g.sum()))]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *numbers, pa.array(spans, pa.int64()), pa.array(sums, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return cut(docs.select(id, text), id, text, columns, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut from ``text``; a character goes when all of its bytes are covered."""
    names = docs.columns

    def columns(batch, pairs):
        kept = []
        for valid, (data, gone) in zip(batch.column(names.index(text)).is_valid().to_pylist(), pairs, strict=True):
            if valid and gone.any():
                lead = (data & 0xC0) != 0x80
                char = np.cumsum(lead) - 1
                whole = np.bincount(char, gone) == np.bincount(char)
                data = data[~whole[char]]
            kept.append(data.tobytes().decode() if valid else None)
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()) if n == text else batch.column(k) for k, n in enumerate(names)], names)

    return cut(docs, id, text, columns, docs.schema)
