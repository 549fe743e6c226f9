"""SentencePiece encoding that keeps offsets, and decoding.

The model file is read field by field. Its normaliser is applied here: at each place the longest prefix known to the
compiled character map (a double-array trie with its replacement strings) is replaced, else one character is kept;
white space is handled as the model says, and every normalised character records the byte of the source it came from.
Each piece is thus projected to a span of original bytes.

Merges of a BPE model stay inside a chunk (white-space marks and what follows them) if no piece has a mark after
another character, which is checked. So each distinct chunk is segmented once per worker by the sentencepiece library
and its ids and piece lengths are kept; models without that property go to the library text by text.

Defined cases: null counts as empty; an empty text has no ids, no spans and decodes to an empty text.
"""

from __future__ import annotations

import itertools
import re
import struct
from dataclasses import dataclass

import numpy as np

MARK = "▁"
#: Most chunks a worker keeps before it starts anew. A matter of memory only.
KEPT_CHUNKS = 300_000
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message; values are integers or bytes."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = data[i:i + size], i + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a 32-bit size, a double array of that many bytes, and NUL-ended replacement strings."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes replaced, replacement) of the longest known prefix at ``at``."""
        if not self.units:
            return None
        found, node = None, 0
        unit = self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & (0x80000000 | 255) != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                value = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.strings[value:self.strings.index(b"\0", value)]
        return found


@dataclass
class Encoded:
    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class PieceEncoder:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [dict(_fields(v)) for k, v in model if k == 1]
        self.pieces = [p[1].decode() for p in entries]
        self.is_byte = np.array([p.get(3, 1) == 6 for p in entries])
        spec = dict(_fields(next((v for k, v in model if k == 3), b"")))
        trainer = dict(_fields(next((v for k, v in model if k == 2), b"")))
        self.map = CharacterMap(spec.get(2, b""))
        self.dummy, self.squeeze, self.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
        user = any(p.get(3, 1) == 4 for p in entries)
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.by_chunk = bool(
            trainer.get(3) == 2 and self.dummy and self.escape and not self.squeeze and not user and not trainer.get(24, 0)
            and not any(crossing.search(p) for p in self.pieces) and trainer.get(35, 0))
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text (marks for spaces) and, for each of its characters and its end, a byte of the source."""
        data = text.encode()
        if not self.map.units and not self.squeeze:
            body = text.replace(" ", MARK) if self.escape else text
            lead = [0] if self.dummy and text else []
            starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            return (MARK if self.escape else " ") * len(lead) + body, np.concatenate([lead, starts, [len(data)]]).astype(np.int64)
        chars: list[str] = []
        source: list[int] = []
        at = 0
        while at < len(data):
            match = self.map.longest(data, at)
            if match:
                size, new = match
            else:
                size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                new = data[at:at + size]
            for c in new.decode():
                if not (self.squeeze and c == " " and (not chars or chars[-1] == " ")):
                    chars.append(c)
                    source.append(at)
            at += size
        while self.squeeze and chars and chars[-1] == " ":
            chars.pop()
            source.pop()
        if chars and self.dummy:
            chars.insert(0, " ")
            source.insert(0, source[0])
        end = len(data) if not self.squeeze else len(data.rstrip(b" "))
        norm = "".join(chars)
        return norm.replace(" ", MARK) if self.escape else norm, np.array([*source, end], np.int64)

    def _learn(self, keys: list[str]) -> None:
        """Keep the ids (int32) of each chunk and the characters that each of its pieces covers (uint16)."""
        for key, ids in zip(keys, self.library.encode([k.replace(MARK, " ") for k in keys], num_threads=1), strict=True):
            if not key:
                ids = [self.library.piece_to_id(MARK)]
            covered = self._covered(MARK + key, ids)
            self.known[key] = np.array(ids, np.int32).tobytes(), np.array(covered, np.uint16).tobytes()

    def _covered(self, norm: str, ids: list[int]) -> list[int]:
        """Characters of ``norm`` that each piece covers; the bytes of one character count it at the last byte."""
        out, at, left = [], 0, 0
        for i in ids:
            if self.is_byte[i]:
                left = left or len(norm[at].encode())
                left -= 1
                out.append(0 if left else 1)
            else:
                out.append(len(self.pieces[i]) if i != self.library.unk_id() else 1)
            at += out[-1]
        return out

    def keys(self, text: str) -> list[str]:
        """The chunks of a text without their first mark."""
        if self.map.units or MARK in text or "  " in text or text[:1] in ("", " ") or text[-1] == " ":
            return [c[1:] for c in CHUNKS.findall(self.normalise(text)[0])]
        return text.split(" ")

    def learn(self, texts: list[str]) -> list[list[str]]:
        parts = [self.keys(t) for t in texts]
        if len(self.known) > KEPT_CHUNKS:
            self.known.clear()
        new = set(itertools.chain.from_iterable(parts)).difference(self.known)
        if new:
            self._learn(list(new))
        return parts

    def encode(self, texts: list[str]) -> list[Encoded]:
        """Ids as the library gives them, without begin or end ids, and the original byte span of each piece."""
        normal = [self.normalise(t) for t in texts]
        if self.by_chunk:
            parts = self.learn(texts)
            ids = [np.frombuffer(b"".join([self.known[c][0] for c in p]), np.int32) for p in parts]
            covered = [np.frombuffer(b"".join([self.known[c][1] for c in p]), np.uint16).astype(np.int64) for p in parts]
        else:
            ids = [np.array(i, np.int32) for i in self.library.encode(texts, num_threads=1)]
            covered = [np.array(self._covered(n, i.tolist()), np.int64) for (n, _), i in zip(normal, ids, strict=True)]
        out = []
        for i, c, (_, source) in zip(ids, covered, normal, strict=True):
            stop = np.cumsum(c)
            start = stop - c
            # the bytes of one character share its span
            start = np.where(c == 0, stop, start)
            last = np.minimum(stop + (c == 0), len(source) - 1)
            out.append(Encoded(i, source[start], np.maximum(source[last], source[start])))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)
