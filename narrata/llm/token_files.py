"""Token ids of documents in files: frames of the adaptive range coder in one table, in ascending order of doc id.

``write`` deals the documents by ranges of doc id, so that the parts in order hold all documents in order, and writes
rows (part, frame, first_doc, n_docs, n_tokens, data); ``data`` is a frame of ``token_codec`` with about
``FRAME_TOKENS`` ids, and never splits a document. Spark commits the files, so a lost executor only repeats its task.
``read`` decodes and checks every frame.

Defined cases: a null or empty text has only the end id. A null doc id comes before all others; rows that share an id
are in the order of their texts. An empty table makes an empty file. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.llm.common import pieces, tidy
from narrata.llm.token_codec import decode_frame, encode_frame

END_ID, FRAME_TOKENS, TEXT_BYTES = 2, 1 << 22, 2 << 20
FILE = "part int, frame int, first_doc long, n_docs long, n_tokens long, data binary"

_encoders: dict = {}


def _encoder(path: str):
    from narrata.llm.byte_bpe import WordEncoder

    if path not in _encoders:  # one per worker process
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    end = np.array([end_id], "<u4").tobytes()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids: list = []
        coded: list[bytes] = []
        held = 0

        def frame() -> pa.RecordBatch:
            first = next((d for d in ids if d is not None), None)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([held], pa.int64()), pa.array([encode_frame(ids, coded)], pa.binary())], ["part", "frame", "first_doc", "n_docs", "n_tokens", "data"])

        for batch in pieces(batches, "text", TEXT_BYTES):
            for doc, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").fill_null("").to_pylist()), strict=True):
                if ids and held + len(raw) // 4 + 1 > FRAME_TOKENS:
                    yield frame()
                    ids, coded, held, number = [], [], 0, number + 1
                ids.append(doc)
                coded.append(raw + end)
                held += len(raw) // 4 + 1
        if ids:
            yield frame()

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(tidy(frames), FILE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(part, frame, doc_id, tokens binary): the ids of each document as little-endian unsigned 32-bit integers."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, frame, data in zip(*(batch.column(c).to_pylist() for c in ("part", "frame", "data")), strict=True):
                docs, counts, ids = decode_frame(data)
                ends = np.concatenate([[0], np.cumsum(counts)]) * 4
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(docs), pa.int32()), pa.array([frame] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                    pa.array([raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], ["part", "frame", "doc_id", "tokens"])

    return spark.read.schema(FILE).parquet(path).select("part", "frame", "data").mapInArrow(tidy(decoded), "part int, frame int, doc_id long, tokens binary")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file: doc_id, start (ids before it in the whole file), n_tokens, ids_crc32, part, frame."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, frame, data in zip(*(batch.column(c).to_pylist() for c in ("part", "frame", "data")), strict=True):
                docs, counts, ids = decode_frame(data)
                ends = np.concatenate([[0], np.cumsum(counts)])
                view = memoryview(ids.tobytes())
                sums = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(docs), part, np.int32)), pa.array(np.full(len(docs), frame, np.int32)), pa.array(docs, pa.int64()),
                    pa.array(ends[:-1]), pa.array(counts), pa.array(sums, pa.int64())], ["part", "frame", "doc_id", "inside", "n_tokens", "ids_crc32"])

    file = spark.read.schema(FILE).parquet(path)
    docs = file.select("part", "frame", "data").mapInArrow(tidy(listed), "part int, frame int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # ids before each frame: those of earlier parts, from one row a part, and those of earlier frames of its part
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    frames = file.select("part", "frame", "n_tokens").withColumn("in_part", before(Window.partitionBy("part").orderBy("frame")))
    parts = file.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", before(Window.orderBy("part")).alias("of_parts"))
    starts = frames.join(parts, "part").select("part", "frame", (F.col("in_part") + F.col("of_parts")).alias("first"))
    return docs.join(starts, ["part", "frame"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "part", "frame")
