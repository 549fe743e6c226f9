"""An adaptive range coder for token ids, in blocks that stand alone.

A block of ``BLOCK`` ids is coded with fresh statistics. Two small tables give the id that last followed the two
previous ids (order 2) and the previous id (order 1); an adaptive distribution over magnitudes gives order 0. The
three are mixed in one interval of 65,536 parts: a part for the order-2 id, whose width is an adaptive weight chosen
by that entry's record of hits, a part for the order-1 id with a weight of its own, and the rest dealt over
magnitudes (number of bits) by order 0, whose remaining bits follow as equal parts. The range coder is carry-less
with a 64-bit low end and 16-bit output words.

All blocks of a frame are coded in step, one numpy operation for all of them, which is what independent blocks allow.

Frame: MAGIC, then seven little-endian unsigned 32-bit integers (version, ids a block, magnitudes, documents, blocks,
null ids, reserved), then doc ids (signed 64), ids per document (unsigned 32), null flags (bytes), words per block
(unsigned 32), CRC-32 of each block's ids as little-endian unsigned 32-bit integers, and the words of all blocks. The
last block is filled up with zeros. Decoding checks every block and raises ``ValueError`` on a mismatch.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION, BLOCK, LANES = b"NTOK", 1, 1024, 2048
SLOTS = 1 << 9
#: Ids after which order 0 is dealt anew, and what a count counts.
DEAL, COUNT = 16, 24
TOP, BOTTOM, SHIFT = np.uint64(48), np.uint64(1 << 32), np.uint64(16)
LOW_BITS = np.uint64((1 << 32) - 1)
#: Bounds of the order-2 and order-1 weights and least part of a magnitude, of 65,536; rates are shifts.
MOST2, MOST1, LEAST, LEAST_CLASS = 57_344, 49_152, 256, 32
RATE = 4


class Lanes:
    """The statistics of ``n`` blocks, the same for both directions."""

    def __init__(self, n: int, classes: int):
        self.n, self.classes, self.steps = n, classes, 0
        self.lane = np.arange(n)
        self.table2, self.table1 = np.zeros(n * SLOTS, np.int32), np.zeros(n * SLOTS, np.int32)
        self.at, self.at4 = self.lane * SLOTS, self.lane * 4
        self.weight2, self.weight1 = np.tile(np.array([2048, 16384, 32768, 49152], np.int32), n), np.tile(np.array([2048, 16384, 32768, 40960], np.int32), n)
        self.counts = np.ones((classes, n), np.int32)
        self.cum = np.zeros((classes + 1, n), np.int32)
        self.last = self.before = np.zeros(n, np.int32)
        self.deal()

    def deal(self) -> None:
        """Widths of order 0 from the counts so far; older counts fade by halves."""
        total = self.counts.sum(0)
        fading = total > 4096
        if fading.any():
            self.counts[:, fading] = (self.counts[:, fading] + 1) >> 1
            total = self.counts.sum(0)
        np.cumsum(self.counts, 0, out=self.cum[1:])
        self.cum[1:] *= (65536 - self.classes * LEAST_CLASS) >> 2  # below 2 ** 31
        self.cum[1:] //= total
        self.cum[1:] <<= 2
        self.cum += (np.arange(self.classes + 1) * LEAST_CLASS).astype(np.int32)[:, None]

    def predict(self) -> None:
        self.i2 = self.at + (((self.before * 40503 + self.last * 30011) >> 4) & (SLOTS - 1))
        self.i1 = self.at + (((self.last * 40503) >> 3) & (SLOTS - 1))
        self.e2, self.e1 = self.table2.take(self.i2), self.table1.take(self.i1)
        self.p2, self.p1 = self.e2 >> 2, self.e1 >> 2
        self.j2, self.j1 = self.at4 + (self.e2 & 3), self.at4 + (self.e1 & 3)
        self.w2, self.w1 = self.weight2.take(self.j2), self.weight1.take(self.j1)
        self.f1 = ((65536 - self.w2) * (self.w1 >> 2)) >> 14
        self.escape = self.w2 + self.f1
        self.rest = (65536 - self.escape) >> 1

    def part(self, edge: np.ndarray) -> np.ndarray:
        """Where an edge of order 0 falls among what the predictions leave."""
        return self.escape + ((self.rest * (edge >> 1)) >> 14)

    def learn(self, x, hit2, same1, hit1, k) -> None:
        """``k`` counts for ids that neither prediction gave."""
        self.weight2[self.j2] = np.clip(self.w2 + ((hit2 * np.int32(65536) - self.w2) >> RATE), LEAST, MOST2)
        self.weight1[self.j1] = np.clip(self.w1 + ((hit1 * np.int32(65536) - self.w1) >> RATE), LEAST, MOST1)
        fresh = x << 2
        self.table2[self.i2] = np.where(hit2, np.minimum(self.e2 + 1, self.e2 | 3), fresh)
        self.table1[self.i1] = np.where(same1, np.minimum(self.e1 + 1, self.e1 | 3), fresh)
        spot = k * self.n + self.lane
        counts = self.counts.ravel()
        counts[spot] += COUNT * ~(hit2 | same1)
        self.steps += 1
        if self.steps % DEAL == 0 or self.steps < DEAL:
            self.deal()
        self.before, self.last = self.last, x


def _magnitudes(ids: np.ndarray) -> np.ndarray:
    return np.frexp(ids.astype(np.float64))[1].astype(np.int32)


def _encode_lanes(ids: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, words per lane) of ``ids`` (lane, BLOCK)."""
    n, length = ids.shape
    model = Lanes(n, classes)
    steps = np.ascontiguousarray(ids.T.astype(np.int32))
    classes_of, lane = _magnitudes(steps), model.lane
    low, width = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)
    out, filled = np.zeros((n, 3 * length + 8), "<u2"), np.arange(n) * (3 * length + 8)
    flat, begin = out.ravel(), filled.copy()
    cum = model.cum.ravel()
    for x, k in zip(steps, classes_of, strict=True):
        model.predict()
        hit2, same1 = model.p2 == x, model.p1 == x
        hit1 = same1 & ~hit2
        at = k * n + lane
        start = model.part(cum.take(at))
        size = model.part(cum.take(at + n)) - start
        bits = np.maximum(k - 1, 0)
        raw = x - (np.int32(1) << bits)
        np.copyto(start, model.w2, where=hit1)
        np.copyto(size, model.f1, where=hit1)
        np.copyto(start, 0, where=hit2)
        np.copyto(size, model.w2, where=hit2)
        known = hit2 | same1 | (k == 0)
        np.copyto(bits, 0, where=known)
        np.copyto(raw, 0, where=known)
        part = width >> SHIFT
        low += part * start.astype(np.uint64)
        part *= size.astype(np.uint64)
        width = part >> bits.astype(np.uint64)
        low += width * raw.astype(np.uint64)
        who = np.flatnonzero((((low ^ (low + width)) >> TOP) == 0) | (width < BOTTOM))
        while len(who):
            lo, wi = low.take(who), width.take(who)
            wi = np.where(((lo ^ (lo + wi)) >> TOP) == 0, wi, (~lo + np.uint64(1)) & LOW_BITS)
            spot = filled.take(who)
            flat[spot] = lo >> TOP
            filled[who] = spot + 1
            lo <<= SHIFT
            wi <<= SHIFT
            low[who], width[who] = lo, wi
            who = who[(((lo ^ (lo + wi)) >> TOP) == 0) | (wi < BOTTOM)]
        model.learn(x, hit2, same1, hit1, k)
    for _ in range(4):
        flat[filled] = low >> TOP
        filled += 1
        low <<= SHIFT
    filled -= begin
    return out[np.arange(out.shape[1])[None, :] < filled[:, None]], filled


def _decode_lanes(words: np.ndarray, counts: np.ndarray, classes: int, length: int) -> np.ndarray:
    n = len(counts)
    model = Lanes(n, classes)
    lane = model.lane
    words = np.concatenate([words, np.zeros(8, "<u2")])
    most = len(words) - 1
    at = np.cumsum(counts) - counts
    low, width, code = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64), np.zeros(n, np.uint64)
    for _ in range(4):
        code = (code << SHIFT) | words[at].astype(np.uint64)
        at = at + 1
    out = np.zeros((length, n), np.int32)
    for step in range(length):
        model.predict()
        part = width >> SHIFT
        value = np.minimum((code - low) // np.maximum(part, np.uint64(1)), np.uint64(65535)).astype(np.int32)
        hit2 = value < model.w2
        inside1 = ~hit2 & (value < model.escape)
        scaled = model.part(model.cum)
        k = (scaled[1:] <= value).view(np.int8).sum(0, dtype=np.int8).astype(np.int32)
        np.minimum(k, classes - 1, out=k)  # a damaged block may ask for more; its checksum tells
        np.copyto(k, 0, where=hit2 | inside1)
        spot = k * n + lane
        flat = scaled.ravel()
        start = flat.take(spot)
        size = flat.take(spot + n) - start
        np.copyto(start, model.w2, where=inside1)
        np.copyto(size, model.f1, where=inside1)
        np.copyto(start, 0, where=hit2)
        np.copyto(size, model.w2, where=hit2)
        bits = np.maximum(k - 1, 0)
        low += part * start.astype(np.uint64)
        part *= size.astype(np.uint64)
        width = part >> bits.astype(np.uint64)
        raw = ((code - low) // np.maximum(width, np.uint64(1))).astype(np.int32)
        np.copyto(raw, 0, where=bits == 0)
        low += width * raw.astype(np.uint64)
        x = (np.int32(1) << bits) + raw
        np.copyto(x, 0, where=k == 0)
        np.copyto(x, model.p1, where=inside1)
        np.copyto(x, model.p2, where=hit2)
        who = np.flatnonzero((((low ^ (low + width)) >> TOP) == 0) | (width < BOTTOM))
        while len(who):
            lo, wi, co, spot = low.take(who), width.take(who), code.take(who), at.take(who)
            wi = np.where(((lo ^ (lo + wi)) >> TOP) == 0, wi, (~lo + np.uint64(1)) & LOW_BITS)
            lo <<= SHIFT
            wi <<= SHIFT
            co <<= SHIFT
            co |= words.take(np.minimum(spot, most))
            at[who], low[who], width[who], code[who] = spot + 1, lo, wi, co
            who = who[(((lo ^ (lo + wi)) >> TOP) == 0) | (wi < BOTTOM)]
        same1 = model.p1 == x
        model.learn(x, hit2, same1, same1 & ~hit2, k)
        out[step] = x
    return out.T


def encode_frame(doc_ids: list[int | None], docs: list[bytes]) -> bytes:
    """One frame of whole documents; ``docs`` are ids as little-endian unsigned 32-bit integers, each below 2**29."""
    ids = np.frombuffer(b"".join(docs), "<u4")
    blocks = max(1, -(-len(ids) // BLOCK)) if len(ids) else 0
    padded = np.zeros((blocks, BLOCK), "<u4")
    padded.ravel()[: len(ids)] = ids
    classes = int(ids.max(initial=0)).bit_length() + 1
    parts = [_encode_lanes(padded[i:i + LANES], classes) for i in range(0, blocks, LANES)]
    sizes = np.concatenate([c for _, c in parts]) if parts else np.zeros(0)
    sums = np.array([zlib.crc32(b) for b in padded], "<u4")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    head = struct.pack("<7I", VERSION, BLOCK, classes, len(docs), blocks, int(nulls.sum()), 0)
    return b"".join([
        MAGIC, head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([len(d) // 4 for d in docs], "<u4").tobytes(), nulls.tobytes(),
        sizes.astype("<u4").tobytes(), sums.tobytes(), *[w.tobytes() for w, _ in parts]])


def decode_frame(frame: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, ids per document, all ids)."""
    if frame[:4] != MAGIC:
        raise ValueError("not a token frame")
    version, block, classes, n_docs, blocks, _, _ = struct.unpack_from("<7I", frame, 4)
    if version != VERSION:
        raise ValueError(f"token frame of version {version}")
    at = 32

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(frame, kind, n, at)
        at += got.nbytes
        return got

    doc_ids, counts, nulls = take("<i8", n_docs).tolist(), take("<u4", n_docs).astype(np.int64), take("u1", n_docs)
    sizes, sums = take("<u4", blocks).astype(np.int64), take("<u4", blocks)
    words = take("<u2", int(sizes.sum()))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    parts = [_decode_lanes(words[ends[i]:ends[min(i + LANES, blocks)]], sizes[i:i + LANES], classes, block) for i in range(0, blocks, LANES)]
    ids = np.concatenate(parts).astype("<u4") if parts else np.zeros((0, block), "<u4")
    for i, (row, want) in enumerate(zip(ids, sums.tolist(), strict=True)):
        if zlib.crc32(row.tobytes()) != want:
            raise ValueError(f"checksum of block {i} does not fit")
    return [None if null else d for d, null in zip(doc_ids, nulls.tolist(), strict=True)], counts, ids.ravel()[: int(counts.sum())]
