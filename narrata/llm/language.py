"""Language identification of whole texts by a bidirectional recurrent network over bytes (see ``bigru``).

Training rows are a bounded sample: of each language at most ``SAMPLE_DOCS`` documents, by hash of their id, and of
each at most ``WINDOWS`` windows of ``SPAN`` characters spread over the text. Only text and language of those rows are
used. Prediction reads every byte of every text: a text is cut to windows of ``SPAN`` bytes, each labelled position by
position in both directions; the probabilities of all positions are pooled by their mean.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text while no row can be
learnt from. Repeated rows and null ids keep their row; a null id is not held out. A tie goes to the language first in
order. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.llm import bigru
from narrata.llm.common import pieces, tidy, utf8

SAMPLE_DOCS, WINDOWS, SPAN, FOLDS, TEXT_BYTES, LANES = 600, 3, 128, 5, 1 << 20, 512
CUT_BITS = 16  # slots of the hash that are counted before rows of the sample move
UNKNOWN = "und"


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], dict | None]:
    """(languages, model) from the rows that are not held out; the model is None without such rows."""
    rows = docs.select(F.col(f"`{id}`").alias("i"), F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter(~held_out(F.col("i")) & F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64(F.col("i"), F.lit("sample")))
    size = F.length("t")
    cut = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda k: F.substring("t", F.when(size > SPAN, (size - SPAN) * k / (WINDOWS - 1)).otherwise(0).cast("int") + 1, F.lit(SPAN)))
    short = rows.select("lang", "h", F.array_distinct(cut).alias("w"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "w"))
    chosen = below_cut(rows, short).withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_DOCS).select("lang", "w").collect()
    found = sorted((r["lang"], w) for r in chosen for w in r["w"])
    languages = sorted({lang for lang, _ in found})
    if not languages:
        return [], None
    windows, lengths = np.zeros((len(found), SPAN), np.uint8), np.zeros(len(found), np.int64)
    for i, (_, w) in enumerate(found):
        data = np.frombuffer(w.encode()[:SPAN], np.uint8)
        windows[i, : len(data)], lengths[i] = data, len(data)
    labels = np.array([languages.index(lang) for lang, _ in found])
    return languages, bigru.train(windows, lengths, labels, len(languages))


def below_cut(rows: DataFrame, short: DataFrame) -> DataFrame:
    """The rows of ``short`` that can be among the first ``SAMPLE_DOCS`` of their language by hash ``h``.

    Rows are counted by language and the first ``CUT_BITS`` bits of their hash; all slots up to the one that completes the
    sample stay. So a language sends to its task the sample and one slot, whatever the number of rows or map tasks. Rows of
    one hash (repeated ids) share their slot.
    """
    slot = F.shiftright("h", 64 - CUT_BITS)
    counts = rows.groupBy("lang", slot.alias("slot")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    open_slots = counts.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < SAMPLE_DOCS)
    last = open_slots.groupBy("lang").agg(F.max("slot").alias("last"))  # one row a language
    return short.join(last, "lang").filter(slot <= F.col("last")).select(*short.columns)


def pooled(model: dict, data: np.ndarray, offsets: np.ndarray, languages: int) -> np.ndarray:
    """Mean probabilities over the positions of each text: (text, language); zeros for an empty text."""
    sizes = np.diff(offsets)
    n = -(-sizes // SPAN)
    owner = np.repeat(np.arange(len(sizes)), n)
    start = offsets[:-1][owner] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * SPAN
    length = np.minimum(SPAN, offsets[1:][owner] - start)
    out = np.zeros((len(sizes), languages))
    order = np.argsort(-length, kind="stable")
    padded = np.concatenate([data, np.zeros(SPAN, np.uint8)])
    for at in range(0, len(order), LANES):
        rows = order[at:at + LANES]
        steps = np.arange(length[rows[0]])[:, None]
        inside = steps < length[rows][None, :]
        x = np.where(inside, padded[start[rows][None, :] + steps], 0)
        p = bigru.position_probs(model, x)
        if not inside[-1].all():
            p *= inside[:, None, :]
        np.add.at(out, owner[rows], p.sum(0).T)
    return out / np.maximum(sizes, 1)[:, None]


def identify(docs: DataFrame, languages: list[str], model: dict | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` (names that clash are replaced) with ``lang_pred`` and ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, TEXT_BYTES):
            p = pooled(model, *utf8(batch.column(text)), len(languages))
            best = p.argmax(1)
            names = pa.array([languages[k] for k in best], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names, pa.array(np.clip(p.max(1), 0, 1))], [*batch.schema.names, "lang_pred", "score"])

    docs = docs.drop("lang_pred", "score")
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    found = docs.mapInArrow(tidy(run), schema) if model else docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    letters = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return found.withColumns({"lang_pred": F.when(letters, F.col("lang_pred")).otherwise(UNKNOWN), "score": F.when(letters, F.col("score")).otherwise(0.0)})


def accepted(docs: DataFrame, languages: list[str], model: dict | None, least: float = 0.35, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with a pooled probability of ``least`` at least; all columns stay."""
    names = docs.columns
    aside = docs.select(*[F.col(f"`{n}`").alias(f"_{i}") for i, n in enumerate(names)])
    found = identify(aside, languages, model, f"_{names.index(text)}").filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])
