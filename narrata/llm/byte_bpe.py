"""Byte-level BPE ids of whole texts with the tokenizers library, each distinct word encoded once per worker.

A byte-level tokenizer splits a text by a fixed pattern and merges inside the parts only, so equal parts have equal
ids. ``WordEncoder`` splits texts of common characters itself, asks the library for parts it has not seen, and joins
their ids. Texts with other characters, or with the string of an added token, go to the library whole.
"""

from __future__ import annotations

import itertools
import os
import re
import struct

import numpy as np

# The split pattern of this kind of tokenizer, for the characters below U+0250; letters, digits and white
# space are written out since the regular expressions of Python and of the library differ in them.
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t\n\x0b\x0c\r \x85\xa0"
PARTS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
# Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
PRINTABLE = {b: 256 + k for k, b in enumerate(_HIDDEN)}
UNCOMMON = re.compile("[^\x00-ɏ]")
#: Most words a worker keeps; it then starts anew. A matter of memory only.
KEPT_WORDS = 500_000


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Ask the library's merges for words, spelled in the printable characters that stand for bytes there."""
        split = self.library.model.tokenize
        for word in words:
            ids = [t.id for t in split(word.encode().decode("latin-1").translate(PRINTABLE))]
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        odd = [i for i, t in enumerate(texts) if UNCOMMON.search(t) or any(a in t for a in self.added)]
        aside = dict(zip(odd, self.whole([texts[i] for i in odd]), strict=True)) if odd else {}
        parts = [[] if i in aside else PARTS.findall(t) for i, t in enumerate(texts)]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = set(itertools.chain.from_iterable(parts)).difference(self.known)
        if new:
            self.learn(list(new))
        take = self.known.__getitem__
        return [aside[i] if i in aside else b"".join(map(take, p)) for i, p in enumerate(parts)]
