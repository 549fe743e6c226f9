"""Cosine similarity over long TF-IDF tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata import session
from narrata.operators.ranking import first_per_key
from narrata.operators.tfidf import dense_number, portions
from narrata.session import small_rows, stage


def unit_vectors(vectors: DataFrame, id: str, term: str = "term", w: str = "w") -> DataFrame:
    norm = F.sqrt(F.sum(F.col(w) * F.col(w)).over(Window.partitionBy(id)))
    return vectors.withColumn("_n", norm).filter("_n > 0").withColumn(w, F.col(w) / F.col("_n")).drop("_n")


def dense_to_long(df: DataFrame, id: str, array: str) -> DataFrame:
    return df.select(id, F.posexplode(array).alias("term", "w")).withColumn("w", F.col("w").cast("double"))


def cosine_pairs(a: DataFrame, b: DataFrame, a_id: str, b_id: str) -> DataFrame:
    """``(a_id, b_id, score)`` of all pairs that share a term; any other pair has score 0.

    Both sides must be unit vectors. The smaller side is broadcast when its size allows; rows of
    ``b`` then stay where their document is, and no pair is shuffled before it is summed up.
    """
    left = a.select(F.col(a_id), F.col("term"), F.col("w").alias("_wa"))
    right = b.select(F.col(b_id), F.col("term"), F.col("w").alias("_wb"))
    pairs = right.join(left, "term").groupBy(b_id, a_id).agg(F.sum(F.col("_wa") * F.col("_wb")).alias("score"))
    return pairs.select(a_id, b_id, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def check_k(k) -> int:
    if isinstance(k, bool) or not isinstance(k, int):
        raise TypeError(f"The number of matches has to be an int, not {type(k).__name__}.")
    if k <= 0:
        raise ValueError(f"The number of matches has to be above 0, not {k}.")
    return k


def top_k(scores: DataFrame, k: int, query_id: str, doc_id: str) -> DataFrame:
    """Best ``k`` per query, score first and id second."""
    order = [F.desc(F.round("score", 9)), F.asc(doc_id)]
    return first_per_key(scores, [query_id], order, check_k(k))


def pad_top_k(top: DataFrame, queries: DataFrame, corpus: DataFrame, k: int, query_id: str, doc_id: str) -> DataFrame:
    """Fill queries with fewer than ``k`` matches with the first unmatched documents at score 0."""
    first = [r[0] for r in small_rows(corpus.select(doc_id).orderBy(doc_id).limit(k))]
    if not first:
        raise ValueError("There are no records to search.")
    found = queries.select(query_id).join(top.groupBy(query_id).agg(F.count("*").alias("_m")), query_id, "left")
    short = found.filter(F.coalesce("_m", F.lit(0)) < k).select(
        query_id, F.explode(F.array(*[F.lit(i) for i in first])).alias(doc_id))
    extra = short.join(top.select(query_id, doc_id), [query_id, doc_id], "left_anti").withColumn("score", F.lit(0.0))
    both = top.drop("rank").unionByName(extra)
    return top_k(both, k, query_id, doc_id)


def find_similar(queries: DataFrame, corpus: DataFrame, details: DataFrame, k: int, query_id: str, doc_id: str,
                 all_queries: DataFrame | None = None) -> DataFrame:
    """Ranked matches of many queries with the columns of ``details`` (one row per document).

    ``all_queries`` names every query: one whose text has no known term has no row in ``queries``, and gets the
    first documents at score 0.
    """
    top = stage(search(queries, corpus, k, query_id, doc_id))
    ids = (queries if all_queries is None else all_queries).select(query_id).distinct()
    return details.join(pad_top_k(top, ids, details, k, query_id, doc_id), doc_id)


def drop_self_matches(matches: DataFrame, k: int, query_id: str, doc_id: str, same: str) -> DataFrame:
    """Drop matches above 0.9999 whose text equals the query (column ``same``), keep ``k``, re-rank."""
    kept = matches.filter(~((F.col("score") > 0.9999) & F.col(same)))
    w = Window.partitionBy(query_id).orderBy("rank")
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def vector_keys(weights: DataFrame, id: str, carry=()) -> DataFrame:
    """Staged ``(id, *carry, vec)``: documents with the same vector have the same ``vec``."""
    cells = F.array_sort(F.collect_list(F.struct("term", F.round("w", 12).alias("r"))))  # of one document
    return stage(weights.groupBy(id, *carry).agg(F.sha2(F.to_json(cells), 256).alias("vec")))


def one_per_vector(weights: DataFrame, keys: DataFrame, id: str) -> DataFrame:
    """``(id, vec, term, w)`` of the first document of every vector."""
    first = stage(keys.groupBy("vec").agg(F.min(id).alias(id)))
    return weights.select(id, "term", "w").join(first, id)


def collapse_copies(weights: DataFrame, id: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Documents with the same vector become one; returns (vectors of one copy each, label counts).

    A group of copies is then one vector with counts, however many rows it holds.
    """
    keys = vector_keys(weights, id, (label,))
    counts = keys.groupBy("vec", label).agg(F.count("*").alias("m"))
    return one_per_vector(weights, keys, id), counts


def packed_vectors(vectors: DataFrame, terms: DataFrame, id: str) -> DataFrame:
    """Staged ``(id, ts, dfs, ws)``, one row a vector: numbers of its terms, in no order, their frequencies and weights."""
    cells = F.collect_list(F.struct("df", "term_id", "w"))  # of one vector
    rows = vectors.select(id, "term", "w").join(terms, "term").groupBy(id).agg(cells.alias("_c"))
    return stage(rows.select(id, F.col("_c.term_id").alias("ts"), F.col("_c.df").alias("dfs"), F.col("_c.w").alias("ws")))


#: Vectors of a side that meet in one part of a large neighbourhood.
PART = 1024


def products_of_pairs(pairs: pd.DataFrame, vectors: pd.DataFrame) -> np.ndarray:
    """Dot products of ``pairs`` (a, b) of ``vectors`` (v, ts, ws). The weights of a are laid out once for all its b."""
    if pairs.empty:
        return np.zeros(0)
    sizes = vectors["ts"].map(len).to_numpy()
    _, number = np.unique(np.concatenate(vectors["ts"].tolist()), return_inverse=True)
    weights, first = np.concatenate(vectors["ws"].tolist()), np.cumsum(sizes) - sizes
    place = pd.Index(vectors["v"])
    a, b = place.get_indexer(pairs["a"]), place.get_indexer(pairs["b"])
    order = np.argsort(a, kind="stable")
    laid, out = np.zeros(number.max() + 1), np.zeros(len(pairs))
    for group in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
        own = slice(first[a[group[0]]], first[a[group[0]]] + sizes[a[group[0]]])
        laid[number[own]] = weights[own]
        for i in group:
            other = slice(first[b[i]], first[b[i]] + sizes[b[i]])
            out[i] = laid[number[other]] @ weights[other]
        laid[number[own]] = 0.0
    return out


def dot_products(pairs: DataFrame, packed: DataFrame, id: str) -> DataFrame:
    """``pairs`` (a, b) of a staged table with the dot product of their ``packed`` vectors.

    A pair meets in the neighbourhood of its a: the least vector that a has a pair with, or a itself. Vectors that resemble each other
    mostly share it, so a vector is moved about once, however many pairs it has, and never once a pair unless all its pairs
    lie in different neighbourhoods. Large neighbourhoods are cut into parts on both sides; small ones share a task.
    """
    spark = pairs.sparkSession
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    home = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("_g")))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-home.count() // PART))
    dealt = pairs.join(home, "a")
    # estimates are enough, they only say into how many parts a neighbourhood is cut
    parts = dealt.groupBy("_g").agg(*[F.ceil(F.approx_count_distinct(s) / PART).cast("int").alias(f"_n{s}") for s in ("a", "b")])
    place = [F.pmod(F.xxhash64(s), F.col(f"_n{s}")) for s in ("a", "b")]
    dealt = stage(dealt.join(parts, "_g").select("a", "b", F.pmod(F.xxhash64("_g", *place), F.lit(buckets)).alias("_k")))
    needed = dealt.select("_k", F.col("a").alias(id)).unionByName(dealt.select("_k", F.col("b").alias(id))).distinct()
    moved = needed.join(packed.select(id, "ts", "ws"), id).select(F.col("_k").alias("_at"), F.col(id).alias("v"), "ts", "ws")

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return left[["a", "b"]].assign(score=products_of_pairs(left, right))

    kind = pairs.schema["a"].dataType.simpleString()
    return dealt.groupBy("_k").cogroup(moved.groupBy("_at")).applyInPandas(scored, f"a {kind}, b {kind}, score double")


def bit_of(terms: np.ndarray, bits: int) -> np.ndarray:
    x = terms.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)  # mixed twice: neighbouring numbers must not give a pattern
    return (x ^ (x >> np.uint64(32))) % np.uint64(bits)


def term_bits(packed: DataFrame, id: str) -> DataFrame:
    """Staged ``(id, bits)``: a bitmap of the hashed terms of each vector, two bits a term and 128 at least.

    Some 40 % of the bits are set, so that much of the weight of a vector that shares nothing is let through: far below the thresholds in use.
    """

    def run(batches):
        for rows in batches:
            maps = []
            for t in rows["ts"]:
                held = np.zeros(max(128, -(-len(t) // 4) * 8), bool)
                held[bit_of(t, len(held))] = True
                maps.append(np.packbits(held).tobytes())
            yield pd.DataFrame({id: rows[id], "bits": maps})

    return stage(packed.select(id, "ts").mapInPandas(run, f"{id} {packed.schema[id].dataType.simpleString()}, bits binary"))


def within_bits(pairs: DataFrame, packed: DataFrame, floor: float, id: str) -> DataFrame:
    """Staged ``pairs`` (a, b) but those whose a has too little weight in the terms that b may have, by its bitmap, for a
    squared product of ``floor``. No pair that reaches it is lost; pairs move with a bitmap, not with a vector."""

    def run(batches):
        for rows in batches:
            kept = []
            for t, w, raw in zip(rows["ts"], rows["ws"], rows["bits"]):
                held = np.unpackbits(np.frombuffer(raw, np.uint8))
                kept.append((w * w) @ held[bit_of(t, len(held))] >= floor)
            yield rows.loc[np.array(kept, bool), ["a", "b"]]

    kind = pairs.schema["a"].dataType.simpleString()
    met = pairs.join(term_bits(packed, id).withColumnRenamed(id, "b"), "b").join(packed.select(F.col(id).alias("a"), "ts", "ws"), "a")
    return stage(met.select("a", "b", "ts", "ws", "bits").mapInPandas(run, f"a {kind}, b {kind}"))


#: Cells of a block of vectors, and rows of a block: a task multiplies two blocks and holds nothing else.
BLOCK_CELLS, BLOCK_ROWS = 3_000_000, 16_384


def blocks_of(packed: DataFrame, id: str, lists: tuple[str, ...], least: int, fill: Callable[[pa.Table], dict[str, np.ndarray]], kinds: dict[str, str]) -> DataFrame:
    """Vectors in blocks of bounded size, ``least`` at least: staged, one row and one file a block, with its number ``b``, the ``ids`` in
    order, and the arrays that ``fill`` makes of its vectors, as bytes. ``lists`` are columns of ``packed``; the last one counts the cells."""
    size = packed.agg(F.count("*").alias("n"), F.sum(F.size(lists[-1])).alias("cells")).first()
    own = BLOCK_CELLS // BLOCK_ROWS  # what a row weighs beside its cells
    weight = (size["cells"] or 0) + own * size["n"]
    blocks = max(1, min(size["n"], least), -(-weight // BLOCK_CELLS))
    room, rows = max(1, -(-weight // blocks)), max(1, size["n"] // blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, room, lambda x: pc.add(pc.list_value_length(x), own)):
            for start in range(0, len(part), rows if least > 1 else len(part)):
                held = part.slice(start, rows if least > 1 else len(part))
                held = held.take(pc.sort_indices(held.column(0))).combine_chunks()
                made = fill(held)
                yield pa.RecordBatch.from_arrays([pa.array([held.column(0).to_pylist()], pa.list_(held.schema.field(0).type)), *[pa.array([made[c].astype(t).tobytes()], pa.binary()) for c, t in kinds.items()]], names=["ids", *kinds])

    kind = packed.schema[id].dataType.simpleString()
    made = packed.select(id, *lists).coalesce(blocks).mapInArrow(run, f"ids array<{kind}>, " + ", ".join(f"{c} binary" for c in kinds))
    return session.stage(made.withColumn("b", F.monotonically_increasing_id()), file_rows=1)


def unpacked(block: dict, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(block[c].as_buffer(), t) for c, t in kinds.items()}


def meet_blocks(left: DataFrame, right: DataFrame, kinds: tuple[dict[str, str], dict[str, str]], use: Callable[..., pa.RecordBatch | None], schema: str, once: bool = False) -> DataFrame:
    """Staged rows that ``use`` makes of every block of one side and every block of the other: (ids, arrays, ids, arrays, whether both are one block).
    With ``once`` the sides are the same and two blocks meet once. Blocks are read where they meet, and nothing is shuffled."""
    spark = left.sparkSession
    sides = [x.select(*[F.col(c).alias(f"{name}_{c}") for c in ("b", "ids", *own)]) for name, x, own in zip("qd", (left, right), kinds)]
    met = sides[0].join(sides[1], F.col("q_b") <= F.col("d_b")) if once else sides[0].crossJoin(sides[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                q, d = ({c: batch.column(f"{name}_{c}")[i] for c in ("ids", *own)} for name, own in zip("qd", kinds))
                made = use(q["ids"].values, unpacked(q, kinds[0]), d["ids"].values, unpacked(d, kinds[1]), once and batch.column("q_b")[i] == batch.column("d_b")[i])
                if made is not None and len(made):
                    yield made

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")  # a row is two blocks
    try:
        return stage(met.mapInArrow(run, schema))
    finally:
        spark.conf.set(name, before)
        session.drop(*({left._staged_path: left, right._staged_path: right}.values()))


#: Arrays of a block of ``near_pairs``: cells of its vectors, rare terms first; sizes, largest weight and sum of weights of each; and its
#: heads in order: number of the term plus the part of the squared norm before it, and row.
_NEAR = {"sizes": "<i4", "ts": "<i4", "ws": "<f8", "top": "<f8", "sum": "<f8", "at": "<f8", "row": "<i4"}
#: Common head terms of pairs of vectors that are held at once.
HITS = 4_000_000


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def headed(rows: pa.Table, floor: float) -> dict[str, np.ndarray]:
    """The arrays ``_NEAR`` of vectors (id, ts, dfs, ws). The head of a vector are its rare terms, until what is left of its
    squared norm is below ``floor``."""
    sizes = pc.list_value_length(rows.column("ts")).to_numpy(zero_copy_only=False)
    ts, dfs, ws = (_flat(rows.column(c)) for c in ("ts", "dfs", "ws"))
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((ts, dfs, row))
    ts, ws = ts[order], ws[order]
    starts = np.cumsum(sizes) - sizes
    before = np.cumsum(ws * ws) - ws * ws
    left = 1.0 - (before - np.repeat(before[starts[sizes > 0]], sizes[sizes > 0]))
    head = np.flatnonzero(left >= floor - 1e-8)  # sums are rounded
    at = ts[head] + np.clip(1.0 - left[head], 0.0, 0.99)
    order = np.argsort(at)
    full = starts[sizes > 0]
    top, total = np.zeros(len(sizes)), np.zeros(len(sizes))
    if len(full):
        top[sizes > 0], total[sizes > 0] = np.maximum.reduceat(ws, full), np.add.reduceat(ws, full)
    return {"sizes": sizes, "ts": ts, "ws": ws, "top": top, "sum": total, "at": at[order], "row": row[head][order]}


#: Buckets of hashed terms of a vector.
FOLDS = 1024


def folded(side: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Norms of the weights of some rows by buckets of hashed terms: the dot product of two vectors is at most that of their norms."""
    starts, out = np.cumsum(side["sizes"]) - side["sizes"], np.empty((len(rows), FOLDS), np.float32)
    for low in range(0, len(rows), 1024):
        some = rows[low:low + 1024]
        sizes = side["sizes"][some]
        at = np.arange(sizes.sum()) + np.repeat(starts[some] - np.cumsum(sizes) + sizes, sizes)
        place = np.repeat(np.arange(len(some)), sizes) * FOLDS + bit_of(side["ts"][at], FOLDS).astype(np.int64)
        out[low:low + 1024] = np.sqrt(np.bincount(place, weights=side["ws"][at] ** 2, minlength=len(some) * FOLDS)).reshape(-1, FOLDS)
    return out


def near_of_blocks(a: dict[str, np.ndarray], b: dict[str, np.ndarray], threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a, rows of b and dot products of the pairs that reach ``threshold``; with ``same`` each pair of rows of the one block once."""
    least = threshold - 1e-9
    # nothing is shared before the first common term: what both have left there must do. Numbers and parts of the norm are one float, so with room for its rounding
    term = np.floor(a["at"])
    far = 1.0 - (threshold * threshold - 1e-5) / (1.0 - (a["at"] - term))
    first = np.searchsorted(b["at"], term, side="left")
    counts = np.maximum(np.searchsorted(b["at"], term + np.minimum(far, 0.995), side="right") - first, 0)
    ends = np.cumsum(counts)
    n_b = len(b["sizes"])
    keys, start = [], 0
    while start < len(counts):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HITS, side="right")))
        some = slice(start, end)
        x = np.repeat(a["row"][some].astype(np.int64), counts[some])
        before = ends[some] - counts[some]
        y = b["row"][np.arange(len(x)) + np.repeat(first[some] - before + before[0], counts[some])]
        if same:
            x, y = x[x < y], y[x < y]
        small = np.minimum(a["top"][x] * b["sum"][y], b["top"][y] * a["sum"][x]) >= least
        keys.append(np.unique(x[small] * n_b + y[small]))
        start = end
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    x, y = keys // max(n_b, 1), keys % max(n_b, 1)
    if len(x):
        (rows, i), (others, j) = (np.unique(z, return_inverse=True) for z in (x, y))
        norms, theirs = folded(a, rows), folded(b, others)
        fits = np.concatenate([np.einsum("ij,ij->i", norms[i[low:low + 1024]], theirs[j[low:low + 1024]]) for low in range(0, len(x), 1024)]) >= least - 1e-4
        x, y = x[fits], y[fits]
    score = np.zeros(len(x))
    if len(x):
        met = []
        for side, rows in ((a, np.unique(x)), (b, np.unique(y))):
            starts = np.cumsum(side["sizes"]) - side["sizes"]
            met.append((rows, [slice(starts[i], starts[i] + side["sizes"][i]) for i in rows]))
        flat = [np.concatenate([side["ts"][c] for c in cells]) for side, (_, cells) in zip((a, b), met)]
        known, number = np.unique(np.concatenate(flat), return_inverse=True)
        numbers = []
        for part, (rows, cells) in zip(np.split(number, [len(flat[0])]), met):
            numbers.append(dict(zip(rows.tolist(), np.split(part, np.cumsum([c.stop - c.start for c in cells])[:-1]))))
        own, other = (dict(zip(rows.tolist(), [side["ws"][c] for c in cells])) for side, (rows, cells) in zip((a, b), met))
        laid, edge = np.zeros(len(known)), np.flatnonzero(np.diff(x, prepend=-1, append=-1))
        for low, high in zip(edge[:-1], edge[1:]):
            i = int(x[low])
            laid[numbers[0][i]] = own[i]
            for k in range(low, high):
                j = int(y[k])
                score[k] = laid[numbers[1][j]] @ other[j]
            laid[numbers[0][i]] = 0.0
    kept = score >= least
    return x[kept], y[kept], score[kept]


def near_pairs(vectors: DataFrame, vocabulary: DataFrame, threshold: float, id: str) -> DataFrame:
    """All pairs ``(a, b, score)``, a < b, of distinct unit vectors with cosine >= threshold. Exact."""
    return near_packed_pairs(packed_vectors(vectors, vocabulary.select("term", "term_id", "df"), id), threshold, id)


def near_packed_pairs(packed: DataFrame, threshold: float, id: str) -> DataFrame:
    """``near_pairs`` of vectors (id, ts, dfs, ws), one row each.

    Terms are ordered from rare to frequent. Each vector keeps the shortest prefix of rare terms
    whose remaining norm is below the threshold: a pair that shares no prefix term cannot reach
    it (all-pairs similarity search, Bayardo, Ma and Srikant, WWW 2007). Every two blocks of vectors meet once in a task,
    which joins their prefixes, drops pairs by three bounds - what the norms from the first common term on allow, what the
    largest weight of one vector times the weight sum of the other allows, and what their norms by hashed terms allow - and multiplies the rest. So neither
    postings nor pairs are shuffled, only pairs that reach the threshold are written, and memory is that of two blocks.
    """
    floor = threshold * threshold - 1e-9
    spread = min(int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-packed.count() // 4096))
    blocks = blocks_of(packed, id, ("ts", "dfs", "ws"), spread, lambda rows: headed(rows, floor), _NEAR)

    def use(a_ids, a, b_ids, b, same) -> pa.RecordBatch:
        x, y, score = near_of_blocks(a, b, threshold, same)
        left, right = a_ids.take(pa.array(x)), b_ids.take(pa.array(y))
        return pa.RecordBatch.from_arrays([pc.min_element_wise(left, right), pc.max_element_wise(left, right), pa.array(np.minimum(score, 1.0))], names=["a", "b", "score"])

    kind = packed.schema[id].dataType.simpleString()
    return meet_blocks(blocks, blocks, (_NEAR, _NEAR), use, f"a {kind}, b {kind}, score double", once=True)


def distinct_vectors(packed: DataFrame, id: str) -> DataFrame:
    """The first document of every vector of ``packed`` (id, vec, ...); only ids and digests are shuffled where these are few enough to be sent."""
    first = stage(packed.groupBy("vec").agg(F.min(id).alias(id)))
    return packed.join(first.select(id), id, "left_semi")


def near_label_pairs(pairs: DataFrame, vectors: DataFrame, counts: DataFrame, id: str, label: str) -> DataFrame:
    """Number of near-duplicate document pairs per unordered label pair ``(label_a, label_b, pairs)``.

    Pairs inside a group of copies follow from its label counts and are never listed.
    """
    keyed = vectors.select(id, "vec").distinct()
    # inside one vector
    x = counts.select("vec", F.col(label).alias("la"), F.col("m").alias("ma"))
    y = counts.select("vec", F.col(label).alias("lb"), F.col("m").alias("mb"))
    inside = x.join(y, "vec").filter("la <= lb").select("la", "lb", F.when(
        F.col("la") == F.col("lb"), F.col("ma") * (F.col("ma") - 1) / 2).otherwise(F.col("ma") * F.col("mb")).cast("bigint").alias("p"))
    # across two vectors
    k = counts.join(keyed, "vec").select(id, label, "m")
    ka = k.select(F.col(id).alias("a"), F.col(label).alias("la"), F.col("m").alias("ma"))
    kb = k.select(F.col(id).alias("b"), F.col(label).alias("lb"), F.col("m").alias("mb"))
    across = pairs.join(ka, "a").join(kb, "b").select(
        F.least("la", "lb").alias("la"), F.greatest("la", "lb").alias("lb"), (F.col("ma") * F.col("mb")).alias("p"))
    return inside.unionByName(across).groupBy(F.col("la").alias("label_a"), F.col("lb").alias("label_b")).agg(
        F.sum("p").alias("pairs")).filter("pairs > 0")


#: Queries whose scores are held at once, and terms of a block that are multiplied densely, because many of its records have them.
BATCH, DENSE = 256, 512
#: Twice what a product of ``DENSE`` 32-bit weights of unit vectors may be off.
OFF = 2.5e-4


def numbered_vectors(weights: DataFrame, terms: DataFrame, id: str) -> DataFrame:
    """Staged ``(id, vec, ts, ws)``, one row a vector: the known ``terms``, as numbers, and their weights. Equal vectors share ``vec``."""
    cells = F.array_sort(F.collect_list(F.struct("t", "w")))  # of one document
    rows = weights.select(id, "term", "w").join(terms, "term").groupBy(id).agg(cells.alias("_c"))
    digest = F.sha2(F.to_json(F.transform("_c", lambda x: F.struct(x["t"].alias("t"), F.round(x["w"], 12).alias("w")))), 256)
    return stage(rows.select(id, digest.alias("vec"), F.col("_c.t").alias("ts"), F.col("_c.w").alias("ws")))


def by_term(sizes: np.ndarray, ts: np.ndarray, ws: np.ndarray) -> dict[str, np.ndarray]:
    """Postings of a block of records: its terms, how many records have each, and rows and weights in order of terms."""
    order = np.argsort(ts, kind="stable")
    known, df = np.unique(ts[order], return_counts=True)
    return {"known": known, "df": df, "at": np.repeat(np.arange(len(sizes)), sizes)[order], "w": ws[order]}


def block_product(q_terms, q_weights, d_terms, d_weights, k: int):
    """``(query, record, score)`` of the ``k`` best records of every query in a block, as row numbers; ties by lower number."""
    index = by_term(np.array([len(x) for x in d_terms]), np.concatenate(d_terms), np.concatenate(d_weights))
    return best_of_block(q_terms, q_weights, index, len(d_terms), k)


def best_of_block(q_terms, q_weights, index: dict[str, np.ndarray], n: int, k: int):
    """``block_product`` with ``n`` records given by their postings.

    Terms of many records are multiplied as dense rows, the others by their postings. The dense product is in 32 bits and only picks the
    records that may be among the best, whose scores are then made in 64 bits. Memory is some rows of scores.
    """
    known, df, at, w = (index[c] for c in ("known", "df", "at", "w"))
    first = np.cumsum(df) - df
    often = np.argsort(-df, kind="stable")[:DENSE]
    often = often[df[often] * 16 > n]
    place = np.full(len(known), -1)
    place[often] = np.arange(len(often))
    dense = np.zeros((n, len(often)))
    for i, t in enumerate(often):
        dense[at[first[t]:first[t] + df[t]], i] = w[first[t]:first[t] + df[t]]
    rough = np.ascontiguousarray(dense.T, np.float32)
    found = []
    for start in range(0, len(q_terms), BATCH):
        held, rare = np.zeros((min(BATCH, len(q_terms) - start), len(often))), []
        for i in range(len(held)):
            t = np.minimum(np.searchsorted(known, q_terms[start + i]), len(known) - 1)
            met = known[t] == q_terms[start + i]
            t, x = t[met], np.asarray(q_weights[start + i])[met]
            is_often = place[t] >= 0
            held[i, place[t[is_often]]] = x[is_often]
            rare.append((t[~is_often], x[~is_often]))
        scores = held.astype(np.float32) @ rough
        for i, (t, x) in enumerate(rare):
            ends = np.cumsum(df[t])
            exact = np.zeros(n)
            if len(t):
                posting = np.arange(ends[-1]) + np.repeat(first[t] - ends + df[t], df[t])
                exact = np.bincount(at[posting], weights=w[posting] * np.repeat(x, df[t]), minlength=n)
            some = scores[i] + exact
            least = np.partition(some, n - k)[n - k] if k < n else 0.0
            fit = np.flatnonzero(some >= max(least - OFF, 0.0)) if k < n else np.arange(n)
            score = exact[fit] + dense[fit] @ held[i]
            fit, score = fit[score > 0], score[score > 0]
            best = np.lexsort((fit, -np.round(score, 9)))[:k]
            found.append((np.full(len(best), start + i), fit[best], score[best]))
    return [np.concatenate(x) for x in zip(*found)]


#: Arrays of a block of the search: sizes, terms and weights of its vectors; of records, their postings.
_VECTORS, _POSTINGS = {"sizes": "<i4", "ts": "<i4", "ws": "<f8"}, {"known": "<i4", "df": "<i4", "at": "<i4", "w": "<f8"}


def search(queries: DataFrame, corpus: DataFrame, k: int, query_id: str, doc_id: str, blocks: tuple[int, ...] = ()) -> DataFrame:
    """The ``k`` best matches ``(query_id, doc_id, score, rank)`` of every query, above score 0. Exact, ties by lowest id.

    Both sides are long tables of unit vectors without negative weights, of which only terms that queries have are kept; or staged tables
    of ``tfidf.transform_vectors``, one row a vector, with terms numbered by one vocabulary. Copies are searched once and listed at the end.

    Both sides are put into blocks of bounded size. Every block of queries meets every block of records in a task of its own, which
    reads both, multiplies them and gives the ``k`` best records of each query. What is written are each vector once,
    in its block, and ``k`` rows for each query and block of records: never the pairs that share a term, nor their terms, and no
    vector again for each block of the other side. ``blocks`` states the least number of blocks of queries and of records.
    """
    check_k(k)
    spark = queries.sparkSession
    if "ws" in queries.columns:
        q, c = queries, corpus
    else:
        terms = stage(queries.select("term").distinct().withColumn("t", F.monotonically_increasing_id()))
        terms = terms.withColumn("t", dense_number(terms, "t").cast("int"))
        q, c = numbered_vectors(queries, terms, query_id), numbered_vectors(corpus, terms, doc_id)
    # smaller blocks of records keep more tasks busy
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-c.count() // 1024))
    least = tuple(max(x) for x in zip(blocks or (1, 1), (1, spread)))

    def cells(rows: pa.Table) -> dict[str, np.ndarray]:
        return {"sizes": pc.list_value_length(rows.column("ts")).to_numpy(zero_copy_only=False), "ts": _flat(rows.column("ts")), "ws": _flat(rows.column("ws"))}

    made, leads = [], []
    for rows, id, n, fill, kinds in ((q, query_id, least[0], cells, _VECTORS), (c, doc_id, least[1], lambda rows: by_term(**cells(rows)), _POSTINGS)):
        leads.append(stage(rows.groupBy("vec").agg(F.min(id).alias("_first"))))
        lead = leads[-1].select(F.col("_first").alias(id))
        made.append(blocks_of(rows.join(lead, id, "left_semi"), id, ("ts", "ws"), n, fill, kinds))

    def best_of_blocks(q_ids, q, d_ids, d, _) -> pa.RecordBatch | None:
        if not (len(q["ts"]) and len(d["at"])):
            return None
        i, j, score = best_of_block(*[np.split(q[n], np.cumsum(q["sizes"])[:-1]) for n in ("ts", "ws")], d, len(d_ids), k)
        return pa.RecordBatch.from_arrays([q_ids.take(pa.array(i)), d_ids.take(pa.array(j)), pa.array(score)], names=["q", "d", "score"])

    q_kind, d_kind = (x.schema[i].dataType.simpleString() for x, i in ((q, query_id), (c, doc_id)))
    scored = meet_blocks(*made, (_VECTORS, _POSTINGS), best_of_blocks, f"q {q_kind}, d {d_kind}, score double")
    best = first_per_key(scored, ["q"], [F.desc(F.round("score", 9)), F.asc("d")], k).select("q", "d", F.least("score", F.lit(1.0)).alias("score"))
    # a copy of a match is a match of its own: the first k ids of each vector are all that k ranks can hold
    copies = first_per_key(c.select(doc_id, "vec"), ["vec"], [F.asc(doc_id)], k).join(leads[1], "vec").select(F.col("_first").alias("d"), doc_id)
    listed = top_k(stage(best).join(copies, "d"), k, "q", doc_id)
    asked = q.select(query_id, "vec").join(leads[0], "vec").select(query_id, F.col("_first").alias("q"))
    return asked.join(listed, "q").select(query_id, doc_id, "score", "rank")


def nearest(queries: DataFrame, corpus: DataFrame, query_id: str, doc_id: str, all_queries: DataFrame | None = None) -> DataFrame:
    """Best match per query (ties: lowest id) as ``(query_id, nn_id, nn_sim)``, by ``search``. Exact.

    A query of ``all_queries`` that shares no term with any record keeps its row, with no record and similarity 0.
    """
    found = search(queries, corpus, 1, query_id, doc_id).select(query_id, F.col(doc_id).alias("nn_id"), F.col("score").alias("nn_sim"))
    rows = (queries if all_queries is None else all_queries).select(query_id).distinct().join(found, query_id, "left")
    return rows.withColumn("nn_sim", F.coalesce("nn_sim", F.lit(0.0)))


BIN_EDGES = (0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 1.0001)  # fixed values


def similarity_bin(sim):
    out = None
    for low, high in zip(BIN_EDGES, BIN_EDGES[1:]):
        name = f"[{low:g}, {high:g})"
        out = F.when(sim < high, name) if out is None else out.when(sim < high, name)
    return out


def centroids(weights: DataFrame, label: str, counts: DataFrame) -> DataFrame:
    """Mean TF-IDF vector per class, ``(label, term, w)``."""
    sums = weights.groupBy(label, "term").agg(F.sum("w").alias("s"))
    return sums.join(counts, label).select(label, "term", (F.col("s") / F.col("n")).alias("w"))


def class_pairs(means: DataFrame, label: str, top: int = 500) -> DataFrame:
    """Centroid cosine and top-term Jaccard of every two classes ``(a, b)``, a <> b."""
    unit = unit_vectors(means, label)
    one = unit.withColumnRenamed(label, "a")
    cos = cosine_pairs(one, unit.withColumnRenamed(label, "b"), "a", "b")
    best = first_per_key(means, [label], [F.desc(F.round("w", 9)), "term"], top)
    best = stage(best.select(F.col(label).alias("l"), "term"))
    sizes = best.groupBy("l").agg(F.count("*").alias("n"))
    shared = best.select(F.col("l").alias("a"), "term").join(best.select(F.col("l").alias("b"), "term"), "term")
    shared = shared.groupBy("a", "b").agg(F.count("*").alias("both"))
    grid = label_grid(sizes, "l").filter("a <> b")
    jac = grid.join(shared, ["a", "b"], "left").join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    both = F.coalesce("both", F.lit(0)).cast("double")
    return jac.join(cos.withColumnRenamed("score", "cosine"), ["a", "b"], "left").select(
        "a", "b", F.coalesce("cosine", F.lit(0.0)).alias("cosine"), (both / (F.col("na") + F.col("nb") - both)).alias("jaccard"))


def label_grid(labels: DataFrame, label: str) -> DataFrame:
    """Every ordered pair ``(a, b)`` of a class-level table."""
    listed = labels.agg(F.array_sort(F.collect_set(label)).alias("_l"))
    return listed.select(F.explode("_l").alias("a"), "_l").select("a", F.explode("_l").alias("b"))
