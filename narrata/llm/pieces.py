"""SentencePiece ids, spans and decoded texts of whole documents, as a column-wise job without a shuffle.

Defined cases: a null text counts as empty: no ids, an empty decoded text. Repeated rows and null ids each keep their
row. An empty table gives an empty result. Other columns are ignored unless asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import pieces, tidy

TEXT_BYTES = 2 << 20

_encoders: dict = {}


def _encoder(path: str):
    from narrata.llm.piece_bpe import PieceEncoder

    if path not in _encoders:  # one per worker process
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _map(docs: DataFrame, model: str, id: str, text: str, schema: str, columns: Callable) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            encoder = _encoder(model)
            arrays = columns(encoder, encoder.encode(batch.column("text").fill_null("").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays.values()], ["doc_id", *arrays])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id long, {schema}")


def encode(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, begins, ends): each piece with its span of bytes in the UTF-8 form of the original text."""

    def columns(_, found):
        lists = lambda name, kind: pa.array([getattr(f, name) for f in found], pa.list_(kind))
        return {"ids": lists("ids", pa.int32()), "begins": lists("begins", pa.int64()), "ends": lists("ends", pa.int64())}

    return _map(docs, model, id, text, "ids array<int>, begins array<long>, ends array<long>", columns)


def tokens(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, exact): the ids of each text, and whether they decode to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            encoder = _encoder(model)
            texts = batch.column("text").fill_null("").to_pylist()
            found = [f.ids for f in encoder.encode(texts)]
            exact = [encoder.decode(i.tolist()) == t for i, t in zip(found, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(i) for i in found], pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(exact, pa.bool_())], ["doc_id", "n_tokens", "ids", "exact"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_tokens long, ids array<int>, exact boolean")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = _encoder(model)
            texts = [encoder.decode(i or []) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(tidy(run), encoded.withColumn("decoded", F.lit("")).schema)


def digests(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes): what ``encode`` and ``decode`` give, as digests.

    ``covered_bytes`` is how many bytes of the text lie in the span of a piece.
    """
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def columns(encoder, found):
        lists = [f.ids.tolist() for f in found]
        covered = [int(np.maximum(f.ends[1:] - np.maximum(f.begins[1:], f.ends[:-1]), 0).sum() + (f.ends[:1] - f.begins[:1]).sum()) for f in found]
        return {
            "n_tokens": pa.array([len(i) for i in lists], pa.int64()), "ids_sha256": pa.array([sha(",".join(map(str, i))) for i in lists], pa.string()),
            "decoded_sha256": pa.array([sha(encoder.decode(i)) for i in lists], pa.string()), "covered_bytes": pa.array(covered, pa.int64())}

    return _map(docs, model, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long", columns)
