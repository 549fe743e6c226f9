"""TF-IDF as long tables: one row per document and term."""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from narrata.functions.text import text_statistics
from narrata.session import small_rows, stage

_WORD = r"[\p{L}\p{N}_]{2,}"
BLOCK_NAMES = {"word": "Word n-gram", "char": "Character n-gram"}


@dataclass(frozen=True)
class Block:
    """Settings of one term block. ``analyzer`` is word, char or char_wb (char inside words)."""

    analyzer: str = "word"
    ngram_range: tuple[int, int] = (1, 1)
    min_df: int | float = 1
    max_df: int | float = 1.0
    max_features: int | None = None
    sublinear_tf: bool = False
    norm: str | None = "l2"

    @property
    def name(self) -> str:
        return "word" if self.analyzer == "word" else "char"

    def describe(self) -> str:
        shown = sorted(k for k in self.__dataclass_fields__ if getattr(self, k) is not None)
        return self.name + "(" + ",".join(f"{k}={getattr(self, k)}" for k in shown) + ")"


@dataclass(frozen=True)
class FeatureSpec:
    """Which blocks make up the features; at least one of word and char."""

    word: Block | None = None
    char: Block | None = None
    text_stats: bool = False

    def __post_init__(self):
        if self.word is None and self.char is None:
            raise ValueError("FeatureSpec needs at least one of the word and char blocks.")

    @property
    def blocks(self) -> list[Block]:
        return [b for b in (self.word, self.char) if b is not None]

    def describe(self) -> str:
        parts = [b.describe() for b in self.blocks] + (["text_stats"] if self.text_stats else [])
        return " + ".join(parts)


# Settings of the experiments.
WORD_UNIGRAMS = Block("word", (1, 1), min_df=2, max_df=0.95, sublinear_tf=True)
WORD_BIGRAMS = replace(WORD_UNIGRAMS, ngram_range=(1, 2))
CHAR_GRAMS = Block("char", (3, 5), min_df=5, max_df=0.95, sublinear_tf=True)
CHAR_WORD_GRAMS = Block("char_wb", (3, 5), min_df=5, max_df=0.95, sublinear_tf=True)


#: Characters of texts whose terms are counted at once: a part of a table. n-grams of characters are some ten times as many.
PART_CHARS = {"word": 1 << 23, "char": 1 << 21, "char_wb": 1 << 21}
#: Terms of a vocabulary that is sent to every task; a larger one is joined with the terms of each part.
SENT_TERMS = 1 << 21
#: Cells of a batch that leaves Python.
BATCH_CELLS = 1 << 18


def chunks(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with about ``size`` characters; a longer text is a range of its own."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def char_gram_counts(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Rows, gram numbers, counts and grams: how often every run of ``n`` characters occurs in each text.

    A gram is packed into one integer, some bits a character of the alphabet of the texts, above the number of its row, and sorted as such.
    """
    return next(char_grams_of_lengths(texts, (n, n)))


def char_grams_of_lengths(texts: list[str], ngram_range: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """``char_gram_counts`` for every length of a range."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.bincount(flat)
    alphabet = np.flatnonzero(seen)
    letter = (np.cumsum(seen > 0) - 1)[flat]
    row = np.repeat(np.arange(len(texts)), sizes)
    bits, row_bits = max(1, (len(alphabet) - 1).bit_length()), (len(texts) - 1).bit_length()
    for n in range(ngram_range[0], ngram_range[1] + 1):
        if n * bits + row_bits > 62:  # an alphabet too large to pack
            bags = [Counter(t[j:j + n] for j in range(len(t) - n + 1)) for t in texts]
            names = {g: i for i, g in enumerate(sorted(set().union(*bags)))}
            found = [(i, names[g], c) for i, bag in enumerate(bags) for g, c in bag.items()]
            yield *np.array(found, dtype=np.int64).reshape(-1, 3).T, list(names)
            continue
        size = max(len(letter) - n + 1, 0)
        key = letter[:size].copy()
        for j in range(1, n):
            key <<= bits
            key |= letter[j:j + size]
        inside = row[:size] == row[len(row) - size:]
        key = (key[inside] << row_bits) | row[:size][inside]
        key.sort()
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        tf, key = np.diff(starts, append=len(key)), key[starts]
        packed = key >> row_bits
        fresh = np.diff(packed, prepend=-1) != 0
        digits = packed[fresh][:, None] >> (np.arange(n - 1, -1, -1) * bits) & ((1 << bits) - 1)
        joined = alphabet[digits].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        yield key & ((1 << row_bits) - 1), np.cumsum(fresh) - 1, tf, [joined[i:i + n] for i in range(0, len(joined), n)]


def _texts(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


@dataclass
class Cells:
    """Row, gram number and count of every term of some texts, by row. The number of a gram depends only on which texts there
    are, not on their order; ``names`` gives the terms of numbers."""

    rows: np.ndarray
    grams: np.ndarray
    tf: np.ndarray
    size: int
    names: Callable[[np.ndarray], pa.Array]


def _by_row(rows: np.ndarray) -> np.ndarray:
    """Stable order of rows; short numbers are sorted by their digits."""
    return np.argsort(rows.astype(np.uint16) if rows.max(initial=0) < 1 << 16 else rows, kind="stable")


def _joined(levels: list[tuple]) -> Cells:
    """One numbering for several (rows, grams, tf, size, names)."""
    first = np.cumsum([0, *(x[3] for x in levels)])
    rows, tf = (np.concatenate([x[i] for x in levels]) for i in (0, 2))
    grams = np.concatenate([x[1] + f for x, f in zip(levels, first[:-1], strict=True)])
    order = _by_row(rows)

    def names(numbers: np.ndarray) -> pa.Array:
        if len(levels) == 1:
            return levels[0][4](numbers)
        level = np.searchsorted(first, numbers, side="right") - 1
        found = [x[4](numbers[level == i] - first[i]) for i, x in enumerate(levels)]
        place = np.empty(len(numbers), np.int64)
        place[np.argsort(level, kind="stable")] = np.arange(len(numbers))
        return pa.concat_arrays(found).take(pa.array(place))

    return Cells(rows[order], grams[order], tf[order], int(first[-1]), names)


def _summed(rows: np.ndarray, grams: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of equal row and gram are added up."""
    top = int(values.max(initial=0)) + 1
    key = rows * max(size, 1) + grams
    if (int(key.max(initial=0)) + 1) * top < 1 << 62:
        key = np.sort(key * top + values)
        key, values = key // top, key % top
    else:
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[starts]
    return key // max(size, 1), key % max(size, 1), np.add.reduceat(values, starts) if len(starts) else values[:0]


def word_cells(words: pa.Array, ngram_range: tuple[int, int]) -> Cells:
    """n-grams of texts whose words stand between single blanks."""
    low, high = ngram_range
    lists = pc.split_pattern(words, " ")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(words)), sizes)
    coded = lists.flatten().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    known = coded.dictionary.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word = rank[coded.indices.to_numpy()]
    if len(known) and known[0].as_py() == "":  # of a text without words
        row, word = row[word > 0], word[word > 0]
    levels, at, code, named = [], np.arange(len(word)), word, known.take
    for n in range(1, high + 1):
        if n > 1:
            fits = np.flatnonzero(at + n - 1 < len(word))
            fits = fits[row[at[fits]] == row[at[fits] + n - 1]]
            at, code = at[fits], code[fits] * len(known) + word[at[fits] + n - 1]
        seen, code = np.unique(code, return_inverse=True)

        def names(numbers: np.ndarray, n=n, seen=seen, named=named) -> pa.Array:
            if n == 1:
                return known.take(pa.array(seen[numbers]))
            return pc.binary_join_element_wise(named(seen[numbers] // len(known)), known.take(pa.array(seen[numbers] % len(known))), " ")

        named = names
        if n >= low:
            cell, tf = np.unique(row[at] * max(len(seen), 1) + code, return_counts=True)
            levels.append((cell // max(len(seen), 1), cell % max(len(seen), 1), tf, len(seen), names))
    return _joined(levels)


def _named(names: list[str]) -> Callable[[np.ndarray], pa.Array]:
    known = pa.array(names, pa.string())
    return lambda numbers: known.take(pa.array(numbers))


def char_cells(texts: list[str], ngram_range: tuple[int, int]) -> Cells:
    levels = []
    for rows, grams, tf, names in char_grams_of_lengths(texts, ngram_range):
        order = _by_row(rows)
        rows, grams, tf = rows[order], grams[order], tf[order]
        levels.append((rows, grams, tf, len(names), _named(names)))
    return _joined(levels)


def padded_word_cells(words: pa.Array, ngram_range: tuple[int, int]) -> Cells:
    """Character n-grams of words with a blank on both sides, made once per distinct word; a short word counts once."""
    low, high = ngram_range
    own = word_cells(words, (1, 1))
    padded = [f" {w} " for w in _texts(own.names(np.arange(own.size)))]
    inside = char_cells(padded, ngram_range)
    short = np.array([i for i, p in enumerate(padded) if len(p) < low], np.int64)
    alone = _named([padded[i] for i in short])
    inside = _joined([(inside.rows, inside.grams, inside.tf, inside.size, inside.names), (short, np.arange(len(short)), np.ones(len(short), np.int64), len(short), alone)])
    starts = np.searchsorted(inside.rows, np.arange(own.size + 1))
    sizes = np.diff(starts)[own.grams]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[own.grams] - ends + sizes, sizes)
    rows, grams, tf = _summed(np.repeat(own.rows, sizes), inside.grams[at], np.repeat(own.tf, sizes) * inside.tf[at], inside.size)
    return Cells(rows, grams, tf, inside.size, inside.names)


def prepared(text: str, analyzer: str) -> Column:
    """What ``count_cells`` takes: the words of a text, or its characters, with single blanks."""
    text = F.coalesce(F.col(text), F.lit(""))
    if analyzer == "word":
        return F.array_join(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), " ")
    if analyzer == "char":
        return one_blank(text)
    if analyzer == "char_wb":
        return F.trim(F.regexp_replace(text, r"\s+", " "))
    raise ValueError(f"unknown analyzer {analyzer!r}")


def count_cells(texts: pa.Array, block: Block) -> Cells:
    if block.analyzer == "char":
        return char_cells(_texts(texts), block.ngram_range)
    return (word_cells if block.analyzer == "word" else padded_word_cells)(texts, block.ngram_range)


def portions(batches: Iterable[pa.RecordBatch], size: int, lengths: Callable[[pa.Array], pa.Array] = pc.binary_length) -> Iterator[pa.Table]:
    """Tables of neighbouring rows with about ``size`` bytes of text (or other ``lengths``) in the last column; a longer text is alone or the last."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        ends = total + np.cumsum(lengths(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(batch):
            end = min(int(np.searchsorted(ends, size)) + 1, len(batch))
            held.append(batch.slice(start, end - start))
            total = int(ends[end - 1])
            if total >= size:
                yield pa.Table.from_batches(held)
                held, ends, total = [], ends - total, 0
            start = end
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Part:
    """Documents (id, *carry) and their cells, in order of documents. ``who`` numbers the ids."""

    docs: pa.Table
    who: np.ndarray
    doc: np.ndarray
    gram: np.ndarray
    tf: np.ndarray
    size: int
    names: Callable[[np.ndarray], pa.Array]


def _numbers(rows: pa.Table) -> np.ndarray:
    """Equal rows get equal numbers, from 0, in the order in which they come."""
    seen: dict = {}
    values = zip(*([repr(v) for v in c.to_pylist()] for c in rows.columns), strict=True)
    return np.array([seen.setdefault(v, len(seen)) for v in values], np.int64)


def part_of(rows: pa.Table, keys: list[str], block: Block) -> Part:
    """Rows (*keys, text) counted; those that share all keys become one document."""
    cells = count_cells(rows.column(rows.num_columns - 1).combine_chunks(), block)
    docs = rows.select(keys)
    who = _numbers(docs.select(keys[:1]))
    if len(who) == int(who.max(initial=-1)) + 1:
        return Part(docs, who, cells.rows, cells.grams, cells.tf, cells.size, cells.names)
    number = _numbers(docs)
    first = np.unique(number, return_index=True)[1]
    doc, gram, tf = _summed(number[cells.rows], cells.grams, cells.tf, cells.size)
    return Part(docs.take(pa.array(first)), who[first], doc, gram, tf, cells.size, cells.names)


def batches_of(part: Part, known: np.ndarray, columns: Callable[[slice], list[tuple[str, pa.Array]]], together: str | None = None) -> Iterator[pa.RecordBatch]:
    """One row a document with the cells ``known`` (in order of documents), as lists: ``columns`` gives the values of a slice of them.
    With ``together`` the cells are one list of structs of that name."""
    ends = np.searchsorted(part.doc[known], np.arange(len(part.docs) + 1))
    start = 0
    while start < len(part.docs):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + BATCH_CELLS, side="right")) - 1)
        made = columns(slice(ends[start], ends[end]))
        if together:
            made = [(together, pa.StructArray.from_arrays([c for _, c in made], [n for n, _ in made]))]
        offsets = pa.array((ends[start:end + 1] - ends[start]).astype(np.int32))
        keys = part.docs.slice(start, end - start).combine_chunks()
        arrays = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in keys.columns]
        yield pa.RecordBatch.from_arrays([*arrays, *[pa.ListArray.from_arrays(offsets, c) for _, c in made]], names=[*keys.column_names, *[n for n, _ in made]])
        start = end


def schema_of(docs: DataFrame, keys: list[str], more: str) -> StructType:
    kept = docs.select(*keys).schema
    return StructType([*kept.fields, *StructType.fromDDL(more).fields])


def in_parts(docs: DataFrame, block: Block, id: str, text: str, carry=()) -> DataFrame:
    """``(part, id, *carry, text)``: texts dealt by their id into parts that hold about ``PART_CHARS`` characters."""
    flat = prepared(text, block.analyzer)
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    most = PART_CHARS[block.analyzer]
    parts = max(2, -(-chars // most), min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-16 * chars // most)))
    part = F.pmod(F.xxhash64(id), F.lit(parts)).cast("int").alias(f"{id}_part")
    return docs.select(part, id, *carry, flat.alias("_t")).repartition(parts, f"{id}_part")


def terms_of_parts(rows: DataFrame, count: Callable[[pa.Table], Part]) -> DataFrame:
    """``(_part, _gram, term)``: the distinct terms of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        part, own = rows.column(0)[0].as_py(), count(rows)
        for a in range(0, own.size, BATCH_CELLS):
            numbers = np.arange(a, min(a + BATCH_CELLS, own.size))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(numbers), part, np.int32)), pa.array(numbers.astype(np.int32)), own.names(numbers)], names=["_part", "_gram", "term"])

    return rows.groupBy(rows.columns[0]).applyInArrow(run, "_part int, _gram int, term string")


#: What makes rows of a part: its documents and cells, the numbers of the grams that are known, and a row of their table for each.
Use = Callable[[Part, np.ndarray, pa.Table], Iterator[pa.RecordBatch]]


def meet_parts(rows: DataFrame, count: Callable[[pa.Table], Part], known: Callable[[DataFrame], DataFrame], use: Use, schema: StructType) -> DataFrame:
    """What ``use`` makes of each part of ``rows`` (part, ...), once ``known`` has joined the distinct terms of all parts with a table."""
    found = known(terms_of_parts(rows, count))
    empty = to_arrow_schema(schema).empty_table()

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        if len(left):
            grams = right.column("_gram").to_numpy() if len(right) else np.zeros(0, np.int64)
            made = list(use(count(left), grams, right))
        return pa.Table.from_batches(made) if made else empty

    return rows.groupBy(rows.columns[0]).cogroup(found.groupBy("_part")).applyInArrow(met, schema)


def meet_terms(docs: DataFrame, block: Block, id: str, text: str, carry, known: DataFrame, use: Use, schema: StructType) -> DataFrame:
    """What ``use`` makes of each part of the texts.

    Texts are dealt once, and counted where they are; their cells never leave a part. A small ``known`` table (term and other columns) is
    sent to every task, a large one meets the distinct terms of each part.
    """
    keys = [id, *carry]
    rows = in_parts(docs, block, id, text, carry)

    def count(part: pa.Table) -> Part:
        return part_of(part, keys, block)

    if known.limit(SENT_TERMS + 1).count() > SENT_TERMS:
        return meet_parts(rows, count, lambda terms: terms.join(known, "term").drop("term"), use, schema)
    sent = docs.sparkSession.sparkContext.broadcast(known.toArrow().combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, terms = count(pa.Table.from_batches(list(batches))), sent.value.column("term")
        at = pc.index_in(part.names(np.arange(part.size)), value_set=terms.chunk(0) if terms.num_chunks else pa.array([], terms.type))
        grams = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        yield from use(part, grams, sent.value.take(at.drop_null()))

    return rows.groupBy(rows.columns[0]).applyInArrow(run, schema)


def unique_ids(docs: DataFrame, id: str) -> bool:
    """Whether no two rows share an id; reads and shuffles the ids alone."""
    return docs.groupBy(id).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def one_blank(text: str | Column) -> Column:
    return F.regexp_replace(text, r"\s\s+", " ")


def document_frequencies(docs: DataFrame, block: Block, id: str, text: str) -> DataFrame:
    """``(term, df, cf)`` of every term, added up over many documents before they leave a task."""

    def counted(doc: np.ndarray, gram: np.ndarray, tf: np.ndarray, size: int, names) -> Iterator[pa.RecordBatch]:
        df, cf = np.bincount(gram, minlength=size), np.bincount(gram, weights=tf, minlength=size).astype(np.int64)
        for a in range(0, size, BATCH_CELLS):
            b = min(a + BATCH_CELLS, size)
            yield pa.RecordBatch.from_arrays([names(np.arange(a, b)), pa.array(df[a:b]), pa.array(cf[a:b])], names=["term", "df", "cf"])

    schema = "term string, df bigint, cf bigint"
    if unique_ids(docs, id):  # the texts stay where they are

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in portions(batches, PART_CHARS[block.analyzer]):
                c = count_cells(rows.column(0).combine_chunks(), block)
                yield from counted(c.rows, c.grams, c.tf, c.size, c.names)

        found = docs.select(prepared(text, block.analyzer).alias("_t")).mapInArrow(run, schema)
    else:

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = part_of(pa.Table.from_batches(list(batches)), [id], block)
            yield from counted(p.doc, p.gram, p.tf, p.size, p.names)

        rows = in_parts(docs, block, id, text)
        found = rows.groupBy(rows.columns[0]).applyInArrow(merged, schema)
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def term_counts(docs: DataFrame, block: Block, id: str = "doc_id", text: str = "text", carry=(), by_id: bool = True) -> DataFrame:
    """``(id, *carry, term, tf)``. Terms are counted inside each row; rows that share an id are added up.

    With ``by_id`` the text is partitioned by id before its terms multiply its size, and all later grouping by document
    reuses that partitioning. Without, as for document frequencies, the text stays where it is. A count by id and term is
    needed only where ids repeat.
    """
    keys = [id, *carry]
    base = docs.select(*keys, prepared(text, block.analyzer).alias("_t"))
    if by_id:  # a stated number keeps the planner from coalescing by the size of the text, which its terms multiply
        base = base.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in portions(batches, PART_CHARS[block.analyzer]):
            c = count_cells(rows.column(rows.num_columns - 1).combine_chunks(), block)
            part = Part(rows.select(keys), np.arange(len(rows)), c.rows, c.grams, c.tf, c.size, c.names)
            yield from batches_of(part, np.arange(len(c.rows)), lambda s, c=c: [("term", c.names(c.grams[s])), ("tf", pa.array(c.tf[s].astype(np.int64)))], "_c")

    merge = not unique_ids(docs, id)
    counted = base.mapInArrow(run, schema_of(docs, keys, "_c array<struct<term: string, tf: bigint>>")).select(*keys, F.inline("_c"))
    return counted.groupBy(*keys, "term").agg(F.sum("tf").alias("tf")) if merge else counted


def fit_vocabulary(docs: DataFrame, block: Block, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged table ``(block, term, df, cf, idf, term_id)`` of the terms that survive pruning."""
    n = docs.select(id).count()
    if n == 0:
        raise ValueError("Cannot fit a vocabulary on an empty corpus.")
    low = block.min_df if isinstance(block.min_df, int) else block.min_df * n
    high = block.max_df if isinstance(block.max_df, int) else block.max_df * n
    counts = document_frequencies(docs, block, id, text)
    kept = counts.filter((F.col("df") >= low) & (F.col("df") <= high))
    if block.max_features is not None:
        kept = kept.orderBy(F.desc("cf"), "term").limit(block.max_features)
    idf = F.log(F.lit(1.0 + n) / (1.0 + F.col("df"))) + 1.0
    kept = stage(kept.select(F.lit(block.name).alias("block"), "term", "df", "cf", idf.alias("idf"),
                             F.monotonically_increasing_id().alias("term_id")))
    return kept.withColumn("term_id", dense_number(kept, "term_id"))


def dense_number(rows: DataFrame, number: str) -> Column:
    """The values of ``monotonically_increasing_id`` without gaps: only the sizes of the partitions, one each, are counted."""
    place = F.shiftright(number, 33)
    sizes = sorted((r["p"], r["n"]) for r in small_rows(rows.groupBy(place.alias("p")).agg(F.count("*").alias("n"))))
    first = dict(zip([p for p, _ in sizes], np.cumsum([0, *(n for _, n in sizes)]).tolist()))
    starts = F.from_json(F.lit(json.dumps([first.get(p, 0) for p in range(sizes[-1][0] + 1 if sizes else 0)])), "array<bigint>")
    return F.get(starts, place.cast("int")) + F.col(number).bitwiseAND(F.lit((1 << 33) - 1))


def fit_features(docs: DataFrame, spec: FeatureSpec, id: str = "doc_id", text: str = "text") -> dict[str, DataFrame]:
    return {b.name: fit_vocabulary(docs, b, id, text) for b in spec.blocks}


def weigh(part: Part, grams: np.ndarray, idf: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of known grams, the place of their gram among ``grams``, and their weights."""
    place = np.full(part.size, -1)
    place[grams] = np.arange(len(grams))
    at = place[part.gram]
    cells = np.flatnonzero(at >= 0)
    at, tf = at[cells], part.tf[cells].astype(float)
    w = (1.0 + np.log(tf) if block.sublinear_tf else tf) * idf[at]
    if block.norm is not None:
        who = part.who[part.doc[cells]]
        norm = np.bincount(who, weights=w * w if block.norm == "l2" else np.abs(w), minlength=len(part.docs) + 1)
        w = w / (np.sqrt(norm) if block.norm == "l2" else norm)[who]
    return cells, at, w


def strongest(doc: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Places of the cells that may be among the ``n`` largest weights of their document, after rounding to nine digits."""
    ends = np.flatnonzero(np.diff(doc, append=-1)) + 1
    kept = []
    for a, b in zip(np.r_[0, ends[:-1]], ends):
        least = np.partition(w[a:b], b - a - n)[b - a - n] - 2e-9 if b - a > n else -np.inf
        kept.append(a + np.flatnonzero(w[a:b] >= least))
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def transform(docs: DataFrame, vocabulary: DataFrame, block: Block, id: str = "doc_id", text: str = "text",
              carry=(), extra=(), best: int | None = None) -> DataFrame:
    """``(id, *carry, block, term, w, *extra)``; unknown terms drop out, ``extra`` are vocabulary columns. With ``best`` only the
    terms that may be among so many strongest ones of a document leave it."""
    if vocabulary is None:
        raise ValueError("The vocabulary is not fitted.")
    keys, extra = [id, *carry], list(extra)
    kinds = vocabulary.select(*extra).schema
    inside = StructType([StructField("term", StringType()), StructField("w", DoubleType()), *kinds.fields])
    schema = StructType([*docs.select(*keys).schema.fields, StructField("_c", ArrayType(inside))])

    def use(part: Part, grams: np.ndarray, known: pa.Table) -> Iterator[pa.RecordBatch]:
        cells, at, w = weigh(part, grams, known.column("idf").to_numpy(), block)
        if best is not None:
            kept = strongest(part.doc[cells], w, best)
            cells, at, w = cells[kept], at[kept], w[kept]
        more = [(c, known.column(c).combine_chunks()) for c in extra]
        yield from batches_of(part, cells, lambda s: [("term", part.names(part.gram[cells[s]])), ("w", pa.array(w[s])), *[(c, x.take(pa.array(at[s]))) for c, x in more]], "_c")

    made = meet_terms(docs, block, id, text, carry, vocabulary.select("term", "idf", *extra), use, schema)
    return made.select(*keys, F.inline("_c")).select(*keys, F.lit(block.name).alias("block"), "term", "w", *extra)


def transform_vectors(docs: DataFrame, vocabulary: DataFrame, block: Block, id: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    """As ``transform``, one row a document with known terms: ``(id, *carry, vec, ts, dfs, ws)``, numbers of its terms, their frequencies and
    weights. Equal vectors share ``vec``."""
    keys = [id, *carry]

    def use(part: Part, grams: np.ndarray, known: pa.Table) -> Iterator[pa.RecordBatch]:
        cells, at, w = weigh(part, grams, known.column("idf").to_numpy(), block)
        ts, dfs = (known.column(c).to_numpy().astype(np.int32)[at] for c in ("term_id", "df"))
        for batch in batches_of(part, cells, lambda s: [("ts", pa.array(ts[s])), ("dfs", pa.array(dfs[s])), ("ws", pa.array(w[s]))]):
            ends = batch.column("ts").offsets.to_numpy()
            t, r = batch.column("ts").values.to_numpy(), np.round(batch.column("ws").values.to_numpy(), 12)
            vec = [hashlib.sha256(t[a:b].tobytes() + r[a:b].tobytes()).digest() for a, b in zip(ends[:-1], ends[1:])]
            full = pa.array(np.diff(ends) > 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], pa.array(vec, pa.binary()), *batch.columns[len(keys):]], names=[*keys, "vec", "ts", "dfs", "ws"]).filter(full)

    schema = schema_of(docs, keys, "vec binary, ts array<int>, dfs array<int>, ws array<double>")
    return meet_terms(docs, block, id, text, carry, vocabulary.select("term", "idf", "term_id", "df"), use, schema)


def transform_features(docs: DataFrame, vocabularies: dict[str, DataFrame], spec: FeatureSpec, id: str = "doc_id",
                       text: str = "text", raw: str | None = None, carry=(), extra=(), best: int | None = None) -> DataFrame:
    """All blocks of the spec in one long table; every block is normalised on its own."""
    parts = [transform(docs, vocabularies[b.name], b, id, text, carry, extra, best) for b in spec.blocks]
    if spec.text_stats:
        if raw is None:
            raise ValueError("text_stats needs the raw text.")
        stats = text_statistics(F.col(raw))
        named = F.array(*[F.struct(F.lit(k).alias("term"), c.cast("double").alias("w")) for k, c in stats.items()])
        parts.append(docs.select(id, *carry, F.inline(named)).filter("w <> 0").select(
            id, *carry, F.lit("text_stats").alias("block"), "term", "w"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def fit_transform(docs: DataFrame, block: Block, id: str = "doc_id", text: str = "text", carry=()):
    vocabulary = fit_vocabulary(docs, block, id, text)
    return vocabulary, transform(docs, vocabulary, block, id, text, carry)


def top_features(weights: DataFrame, n: int = 10, id: str = "doc_id") -> DataFrame:
    """Strongest features per document over all blocks."""
    w = Window.partitionBy(id).orderBy(F.desc(F.round("w", 9)), F.desc("block"), "term")
    names = F.when(F.col("block") == "word", BLOCK_NAMES["word"]).otherwise(BLOCK_NAMES["char"])
    ranked = weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return ranked.select(id, "rank", F.col("term").alias("feature"), names.alias("type"), F.col("w").alias("weight"))


def matrix_statistics(weights: DataFrame, vocabularies: dict[str, DataFrame], n_docs: int, id: str = "doc_id") -> DataFrame:
    """Documents, dimensions, non-zeros, density and sparsity per block and in total."""
    sizes = None
    for v in vocabularies.values():
        part = v.groupBy("block").agg(F.count("*").alias("dims"))
        sizes = part if sizes is None else sizes.unionByName(part)
    per_block = weights.groupBy("block").agg(F.count("*").alias("nnz"))
    table = sizes.join(per_block, "block", "left").select("block", "dims", F.coalesce("nnz", F.lit(0)).alias("nnz"))
    total = table.agg(F.lit("total").alias("block"), F.sum("dims").alias("dims"), F.sum("nnz").alias("nnz"))
    cells = F.col("dims") * F.lit(float(n_docs))
    return table.unionByName(total).select(
        "block", F.lit(n_docs).cast("bigint").alias("docs"), "dims", "nnz",
        (F.col("nnz") / F.lit(float(n_docs))).alias("nnz_per_doc"),
        (F.col("nnz") / cells).alias("density"), (1.0 - F.col("nnz") / cells).alias("sparsity"))


def one_hot(rows: DataFrame, levels: DataFrame | None, id: str, columns: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Metadata as a block of weight 1. Levels are learnt when ``levels`` is None; others drop out."""
    cells = F.array(*[F.concat(F.lit(k + "="), F.coalesce(c.cast("string"), F.lit("NA"))) for k, c in columns.items()])
    long = rows.select(id, F.explode(cells).alias("term"))
    if levels is None:
        levels = stage(long.select("term").distinct())
    kept = long.join(levels, "term", "left_semi")
    return kept.select(id, F.lit("meta").alias("block"), "term", F.lit(1.0).alias("w")), levels
