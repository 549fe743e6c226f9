"""Near-duplicate groups by MinHash: inverted lists over signature coordinates, then exact confirmation.

1. Each document gets its set of word shingles and ``COORDINATES`` minima. Documents with equal sets are one class.
2. Every (coordinate, value) of a class is a token. Tokens of one class only cannot collide; classes with fewer than
   ``MATCHES`` shared tokens have no partner. A class is posted under its rarest shared tokens only: two classes with
   ``MATCHES`` common tokens share one of the first ``shared - MATCHES + 1`` in the order (frequency, token), so
   frequent tokens are skipped as a rule.
3. Each list of posts counts the collisions of its members, whole signatures against each other, and gives a spanning
   forest of the pairs with ``MATCHES`` collisions or more.
4. Members of a connected component of these pairs are confirmed against each other on their full sets. The confirmed
   links again leave a task as a spanning forest, which keeps every reachability: no list of all pairs is ever made.

Lists and components over ``BLOCK`` members are first compared with their smallest member: one row a member, one edge at
most. What stays apart from it is then compared with everything, in pairs of chunks (see ``linked``): where r of m members
stay apart, a chunk of ``BLOCK`` costs r / ``BLOCK`` copies, and no edge repeats a connection that is known.

``MATCHES`` = 14 of 32 misses a pair at exactly 80 % with a probability of some 1e-6, and closer pairs less.

Defined cases: texts without words (null and empty ones too) have an empty set, are linked with nothing and are kept.
Fewer words than a shingle are one shingle. Rows with the same id count as one document for links; a row without an
id takes part in no group: its component is null and it is kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import mixed, pieces, runs, stage, tidy, utf8, word_hashes
from narrata.llm.graph import components

COORDINATES, MATCHES, BLOCK, TEXT_BYTES = 32, 14, 512, 1 << 20
#: Columns of a shingle matrix at once, and members up to which pairs are compared one by one.
COLUMNS, FEW = 4096, 12
#: Values of the filter that spares texts without candidates the shuffle; bounds the broadcast of it to 8 MB of longs.
FILTER_VALUES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_seeds = np.random.default_rng(5)
FACTORS = _seeds.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _seeds.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, ascending, one text after another; shingles per text)."""
    words, counts = word_hashes(*utf8(texts), SPACE, LOWER)
    ends = np.cumsum(counts)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(n)), n)
    at = (ends - counts)[owner] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(counts, size)[owner]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    value = length.astype(np.uint64)
    for k in range(size):
        value = value + np.where(length > k, padded[at + k] * PLACES[k], np.uint64(0))
    value = mixed(value)
    stops = np.cumsum(n).tolist()
    for a, b in zip([0, *stops[:-1]], stops, strict=True):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(n))


def signatures(docs: DataFrame, size: int, id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, signature): the set's size, a 128-bit digest of it, and its minima (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            sets, counts = shingle_sets(batch.column("text"), size)
            full = counts > 0
            starts = (np.cumsum(counts) - counts)[full]
            minima = np.zeros((len(counts), COORDINATES), np.int32)
            digest = np.zeros((2, len(counts)), np.int64)
            if len(starts):
                for k in range(COORDINATES):
                    minima[full, k] = np.minimum.reduceat(((sets * FACTORS[k]) >> np.uint64(33)).astype(np.int32), starts)
                digest[0, full] = np.add.reduceat(mixed(sets), starts).view(np.int64)
                digest[1, full] = np.add.reduceat(mixed(sets ^ FACTORS[0]), starts).view(np.int64)
            flat = pa.array(minima.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(counts) + 1, dtype=np.int32) * COORDINATES), flat, mask=pa.array(~full))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(digest[0]), pa.array(digest[1]), lists], ["doc_id", "n_shingles", "d1", "d2", "signature"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_shingles long, d1 long, d2 long, signature array<int>")


class Forest:
    """Union-find over the members of one block; members of one ``root`` are together from the start."""

    def __init__(self, roots: np.ndarray):
        first: dict[int, int] = {}
        self.up = [first.setdefault(root, k) for k, root in enumerate(roots.tolist())]

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` were apart until now."""
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
        """The pairs that join what was apart; pairs within one tree are dropped wholesale every so often."""
        while len(left):
            if len(left) > 2000:
                roots = np.array([self.root(x) for x in range(len(self.up))])
                apart = roots[left] != roots[right]
                left, right = left[apart], right[apart]
            for a, b in zip(left[:2000].tolist(), right[:2000].tolist(), strict=True):
                if self.join(a, b):
                    yield a, b
            left, right = left[2000:], right[2000:]


def sides(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The members to compare with each other: all with all where i = j, else those of side i with those of side j."""
    i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
    if i == j:
        return (np.arange(block.num_rows),) * 2
    side = block.column("side").to_numpy()
    return np.flatnonzero(side == i), np.flatnonzero(side == j)


def chunks(n: Column) -> Column:
    return F.ceil(n / BLOCK).cast("int")


def linked(members: DataFrame, payload: DataFrame, compare: Callable) -> DataFrame:
    """Edges (a, b) that connect what ``compare`` links among the ``members`` (grp, rep) of each group.

    ``compare`` maps blocks, in the order of (grp, i, j), to edges between members that no earlier edge connects. A group
    of ``BLOCK`` members at most is one block. A larger one is first compared with its smallest member alone, in chunks: one
    row a member and one of the centre per chunk. Only members which that leaves apart from the centre are then compared
    with all others, in pairs of chunks, knowing what is connected already.
    """
    sizes = stage(members.groupBy("grp").agg(F.count("*").alias("n"), F.min("rep").alias("centre")).filter("n > 1"))
    sized = members.join(sizes, "grp")
    zero, out = F.lit(0), F.lit(-1)

    def block(rows: DataFrame, i: Column, j: Column, side: Column, root: Column) -> DataFrame:
        return rows.select("grp", i.alias("i"), j.alias("j"), side.alias("side"), root.alias("root"), "rep")

    def compared(blocks: DataFrame) -> DataFrame:
        keys = ["grp", "i", "j"]
        dealt = blocks.join(payload, "rep").repartition(*keys).sortWithinPartitions(*keys)
        return dealt.mapInArrow(tidy(compare), "a long, b long")

    part = lambda n: F.pmod(F.xxhash64("rep"), chunks(n)).cast("int")
    large = sized.filter((F.col("n") > BLOCK) & (F.col("rep") != F.col("centre")))
    centres = sizes.filter(F.col("n") > BLOCK).select("grp", F.col("centre").alias("rep"), F.explode(F.sequence(zero, chunks(F.col("n")) - 1)).alias("_k"))
    whole = block(sized.filter(F.col("n") <= BLOCK), zero, zero, zero, F.col("rep"))
    star = block(large, part(F.col("n")), out, out, F.col("rep")).unionByName(block(centres, F.col("_k"), out, F.col("_k"), F.col("rep")))
    if sizes.filter(F.col("n") > BLOCK).isEmpty():
        return compared(whole)
    found = stage(compared(whole.unionByName(star)))
    near = found.select(F.col("a").alias("centre"), F.col("b").alias("rep"), F.lit(False).alias("apart")).distinct()
    named = sized.filter(F.col("n") > BLOCK).join(near, ["centre", "rep"], "left")
    apart = F.coalesce("apart", F.col("rep") != F.col("centre"))
    split = stage(named.select("grp", "rep", apart.alias("apart"), F.when(apart, F.col("rep")).otherwise(F.col("centre")).alias("root")))
    counts = split.groupBy("grp").agg(F.sum(F.col("apart").cast("int")).alias("r"), F.sum((~F.col("apart")).cast("int")).alias("l")).filter("r > 0")
    split = split.join(counts, "grp")
    if split.isEmpty():
        return found
    lists = lambda n: F.sequence(zero, chunks(F.col(n)) - 1)
    rest = split.filter("apart").withColumn("_k", part(F.col("r")))
    with_rest = block(rest.withColumn("_o", F.explode(lists("r"))), F.least("_k", "_o"), F.greatest("_k", "_o"), F.col("_k"), F.col("root"))
    with_core = block(rest.withColumn("_o", F.explode(lists("l"))), F.col("_k"), -1 - F.col("_o"), F.col("_k"), F.col("root"))
    core_side = split.filter("not apart").withColumn("_k", -1 - part(F.col("l"))).withColumn("_o", F.explode(lists("r")))
    blocks = with_rest.unionByName(with_core).unionByName(block(core_side, F.col("_o"), F.col("_k"), F.col("_k"), F.col("root")))
    return found.unionByName(compared(blocks))


def collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the pairs whose signatures agree in ``MATCHES`` coordinates, block by block."""
    out: list[tuple[int, int]] = []
    for block in runs(batches, ["grp", "i", "j"]):
        left, right = sides(block)
        if len(left) and len(right) and block.num_rows > 1:
            ids = block.column("rep").to_pylist()
            signature = pc_flat(block.column("signature")).reshape(block.num_rows, COORDINATES)
            agree = np.zeros((len(left), len(right)), np.int16)
            for k in range(COORDINATES):
                agree += signature[left, k][:, None] == signature[right, k][None, :]
            a, b = np.nonzero(agree >= MATCHES)
            a, b = left[a], right[b]
            apart = a < b if left is right else a != b
            out += [(ids[x], ids[y]) for x, y in Forest(block.column("root").to_numpy()).add(a[apart], b[apart])]
        if len(out) > 50_000:
            yield pairs_batch(out)
            out = []
    if out:
        yield pairs_batch(out)


def pc_flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks])


def pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["a", "b"])


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each of ``left`` has in common with each of ``right``: products of 0-1 matrices."""
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    code = np.cumsum(new) - 1
    often = np.bincount(code)[code] > 1
    owner, code = owner[often], code[often]
    _, code = np.unique(code, return_inverse=True)
    out = np.zeros((len(left), len(right)), np.float32)
    row, edges = np.full((2, len(sets)), -1), np.searchsorted(code, np.arange(0, (code[-1] if len(code) else -1) + 1 + COLUMNS, COLUMNS))
    row[0, left], row[1, right] = np.arange(len(left)), np.arange(len(right))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        sides = []
        for k, n in ((0, len(left)), (1, len(right))):
            mine = row[k, owner[a:b]]
            matrix = np.zeros((n, COLUMNS), np.float32)
            matrix[mine[mine >= 0], (code[a:b] % COLUMNS)[mine >= 0]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out


def confirmed(threshold: int, size: int):
    """Spanning forests of the links between full shingle sets, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for block in runs(batches, ["grp", "i", "j"]):
            n = block.num_rows
            values, counts = shingle_sets(block.column("text").combine_chunks(), size)
            sets, ids = np.split(values, np.cumsum(counts)[:-1]), block.column("rep").to_pylist()
            forest, (left, right) = Forest(block.column("root").to_numpy()), sides(block)
            if left is right and n <= FEW:
                for x in range(n):
                    for y in range(x):
                        small, large = sorted((counts[x], counts[y]))
                        if 100 * small >= threshold * large and forest.root(x) != forest.root(y):
                            same = len(sets[x]) + len(sets[y]) - len(np.union1d(sets[x], sets[y]))
                            if 100 * same >= threshold * (counts[x] + counts[y] - same) and forest.join(x, y):
                                out.append((ids[x], ids[y]))
            elif len(left) and len(right):
                same = common_counts(sets, left, right).astype(np.int64)
                a, b = np.nonzero(100 * same >= threshold * (counts[left][:, None] + counts[right][None, :] - same))
                a, b = left[a], right[b]
                apart = (a < b) if left is right else (a != b)
                out += [(ids[x], ids[y]) for x, y in forest.add(a[apart], b[apart])]
            if len(out) > 50_000:
                yield pairs_batch(out)
                out = []
        if out:
            yield pairs_batch(out)

    return run


def may_match(rows: DataFrame, id: str, wanted: DataFrame) -> DataFrame:
    """The rows whose id has a hash value of an id in ``wanted`` (one column): all that match, and a few others.

    The values are dealt over ``FILTER_VALUES`` numbers, so the broadcast side is at most that many longs however many
    ids are wanted; were most numbers taken, rows would pass that the join after it drops.
    """
    value = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_VALUES))
    taken = wanted.select(value(F.col(wanted.columns[0])).alias("_v")).distinct()
    return rows.withColumn("_v", value(F.col(id))).join(F.broadcast(taken), "_v", "left_semi").drop("_v")


def groups(docs: DataFrame, size: int = 4, threshold: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row: links are pairs with 100 * common >= threshold * united shingles."""
    signed = stage(signatures(docs, size, id, text))
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")))
    tokens = classes.select("rep", F.posexplode("signature").alias("c", "v")).select("rep", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v")).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = tokens.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens")).filter(F.size("tokens") >= MATCHES)
    first = F.slice("tokens", F.lit(1), F.size("tokens") - (MATCHES - 1))
    posts = stage(ranked.select("rep", F.explode(first).alias("t")).select("rep", F.col("t.token").alias("token")))
    candidates = linked(posts.withColumnRenamed("token", "grp"), classes.select("rep", "signature"), collide)
    near = components(candidates)
    texts = docs.select(F.col(f"`{id}`").cast("long").alias("rep"), F.col(f"`{text}`").alias("text"))
    texts = may_match(texts, "rep", near.select("node"))
    links = linked(near.select(F.col("component").alias("grp"), F.col("node").alias("rep")), texts, confirmed(threshold, size))
    grouped = components(links)
    named = classes.select("d1", "d2", "rep").join(grouped.withColumnRenamed("node", "rep"), "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("d1")).alias("d1"), "d2").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def remove(docs: DataFrame, size: int = 5, threshold: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group, that of the smallest id."""
    found = groups(docs, size, threshold, id, text).filter(~F.col("kept")).select("doc_id").distinct()
    name = "_gone" + "_" * max(map(len, docs.columns))  # longer than any column of ``docs``
    gone = found.withColumnRenamed("doc_id", name)
    return docs.join(gone, F.col(f"`{id}`").cast("long") == F.col(name), "left_anti")
