"""Personal data in texts: fixed patterns, and boosted trees over candidates that looser patterns propose.

1. ``base`` applies one strict pattern per kind, leftmost and without overlaps, and drops matches that fail its check.
2. Generators of high recall propose further spans, which may overlap: written-out or bracketed mail addresses, addresses
   with disguised dots and of version 6, card numbers with odd separators, phone numbers in national form.
3. Boosted trees judge a candidate by its format (digits, groups, separators, check sum, name endings) and its context
   (neighbouring characters, cue words before it, how common its first word is).
4. A scale fitted on held-out candidates turns scores into probabilities, and each kind takes the lowest threshold that
   reaches ``PRECISION`` there. Chosen spans do not overlap base spans or each other; the more probable one wins.

The model learns from at most ``SAMPLE`` texts of the table, by hash of the text, with personal data and look-alikes of a
grammar set between their words. Nothing else is sampled; all texts are searched whole, and every base span is returned.

Defined cases: a null or empty text has no spans; repeated rows and null ids keep their row. Positions count code points,
ends are exclusive. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm import boosting
from narrata.llm.common import pieces, tidy

KINDS = ("email", "ip", "card", "phone")
SAMPLE, PRECISION, TEXT_BYTES, PLANTED = 300, 0.98, 1 << 20, 12

Span = tuple[int, int, int]  # start, number of the kind, end

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_domain = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# what fails from the start of a run of digits fails from within it, too: (?<![0-9]{2}) leaves the start only
_ip = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digits = re.compile(r"[0-9]+")


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def byte_parts(parts: list[str]) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in parts)


def base(text: str) -> list[Span]:
    """The spans of the strict patterns, by start and kind."""
    out, last = [], 0
    for m in _domain.finditer(text) if "@" in text else ():
        local = text[last:m.start()]
        start = last + len(local.rstrip(LOCAL))
        last = m.start() + 1
        if start < m.start():
            out.append((start, 0, m.end()))
            last = m.end()
    if _digits.search(text):
        out += [(m.start(), 1, m.end()) for m in _ip.finditer(text) if byte_parts(m.group().split("."))]
        for m in _card.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _phone.finditer(text) if "+" in text else ():
            if 9 <= sum(map(len, _digits.findall(m.group()))) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s)"
_mail = re.compile(rf"[@Aa](?:(?<=@)|(?<=[\s\[({{<][Aa])[Tt](?=[\s\])}}>]))[\s\])}}>]{{0,3}}([A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++)")
_before_mail = re.compile(r"[^\s@<>()\[\]{},;:\"']+$")
_odd_ip = re.compile(rf"[0-9](?<![0-9.][0-9])[0-9]{{0,2}}(?:(?:{_DOT}|\s?\.\s?)[0-9]{{1,3}}){{3}}(?![0-9])")
_ip6 = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_odd_card = re.compile(r"[0-9](?<![0-9]{2})(?:[ .\-/_\xa0]{0,3}[0-9]){11,18}(?![0-9])")
_odd_phone = re.compile(r"[0-9(](?<![0-9A-Za-z+][0-9(])[0-9]{1,6}\)?(?:[ .\-/]{0,2}\(?[0-9]{2,6}\)?){1,5}(?![0-9])")


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data, by start and kind; they may overlap."""
    out = set()
    for m in _mail.finditer(text):
        head = text[max(0, m.start() - 80):m.start()].rstrip(" \t\n[({<")
        local = _before_mail.search(head)
        if local:
            start = max(0, m.start() - 80) + local.start()
            out.add((start, 0, m.end()))
            ends = [d.start() for d in re.finditer(_DOT, m.group(1))]
            if len(ends) > 1:  # the last label may be the next sentence
                out.add((start, 0, m.start(1) + ends[-1]))
    if _digits.search(text):
        for kind, pattern in ((1, _odd_ip), (2, _odd_card), (3, _odd_phone)):
            out |= {(m.start(), kind, m.end()) for m in pattern.finditer(text)}
    if ":" in text:
        out |= {(m.start(), 1, m.end()) for m in _ip6.finditer(text) if m.end() - m.start() > 5}
    return sorted(c for c in out if c[1] != 3 or 7 <= sum(map(len, _digits.findall(text[c[0]:c[2]]))) <= 15)


# fixed values: words that stand before personal data or before other numbers
CUES = (
    "mail email e-mail write contact reach correo courriel schreiben",
    "ip host server address client dirección adresse",
    "card credit visa mastercard pay payment tarjeta carte karte kreditkarte",
    "phone tel telephone call mobile cell fax teléfono móvil téléphone appelez telefon anrufen rufnummer",
    "version v release section chapter page pages isbn issn order invoice no nr id ref ticket date year vol score ratio version",
)
_cue_of = {w: k for k, words in enumerate(CUES) for w in words.split()}
_word = re.compile(r"[\w-]+")


def features(text: str, span: Span, common: dict[str, float]) -> list[float]:
    """Format and context of one candidate."""
    start, kind, end = span
    s = text[start:end]
    groups = _digits.findall(s)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    words = [w.lower() for w in _word.findall(text[max(0, start - 40):start])[-4:]]
    cues = {_cue_of[w] for w in words if w in _cue_of}
    first = (_word.findall(s) or [""])[0].lower()
    ending = s[max(s.rfind(c) for c in ". )]}>") + 1:]
    seen = [c in s for c in "@.-/()[] :_"]
    before, after = text[start - 1:start], text[end:end + 1]
    ip = len(groups) == 4 and byte_parts(groups)
    hexes = [g for g in s.split(":") if g] if ":" in s else []
    return [
        kind, len(s), len(digits), len(digits) / len(s), len(groups), min(sizes), max(sizes), sizes[0], sizes[-1],
        float(bool(digits) and passes_luhn(digits)), float(int(digits[:1] or 0)), float(digits[:2] in ("19", "20")), float(ip), *map(float, seen),
        s.count("."), len({c for c in s if not c.isalnum()}), len(hexes) + 3.0 * ("::" in s), max(map(len, hexes), default=0), float(any(c in "abcdefABCDEF" for c in s)),
        float(any(b in s for b in ("[", "{", "<")) and not s[0] in "[{<"), float(" dot " in s.lower()), float(bool(re.search(r"\sat\s", s, re.I))), float(" @ " in s),
        len(ending) if ending.isalpha() else 0.0, common.get(first, 0.0), common.get(ending.lower(), 0.0), float(any(c in first for c in "0123456789_")), float("." in s.split("@")[0]),
        *[float(k in cues) for k in range(len(CUES))], float(before.isalnum()), float(before in ("\"", "'", "=", "#", "$")), float(after.isalnum()), float(after in ("%", "\"", "'")),
    ]


class Grammar:
    """Personal data and look-alikes of many written forms, each with the words before it."""

    def __init__(self, seed: int):
        self.rnd = random.Random(seed)

    def name(self) -> str:
        r = self.rnd
        return "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") for _ in range(r.randint(2, 4)))

    def number(self, n: int) -> str:
        return str(self.rnd.randint(1, 9)) + "".join(self.rnd.choice("0123456789") for _ in range(n - 1))

    def card_number(self, valid: bool) -> str:
        while True:
            digits = self.number(self.rnd.choice((13, 15, 16, 16, 16, 19)))
            if passes_luhn(digits) == valid:
                return digits

    def grouped(self, digits: str, sep: str) -> str:
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))

    def personal(self) -> tuple[int, str]:
        r, kind = self.rnd, self.rnd.randrange(4)
        if kind == 0:
            at = r.choice((" at ", " AT ", " [at] ", "[at]", "(at)", " (at) ", " @ ", "@", "{at}", "<at>"))
            dot = r.choice((" dot ", " [dot] ", "(dot)", "[.]", ".")) if at.strip() in ("at", "AT") or r.random() < 0.5 else "."
            if at == "@" and dot == ".":
                dot = "[.]"
            local = r.choice((self.name(), f"{self.name()}.{self.name()}", f"{self.name()}{r.randint(1, 99)}", f"{self.name()}_{self.name()}"))
            return 0, local + at + self.name() + dot + r.choice(("com", "org", "net", "de", "fr", "es", "example"))
        if kind == 1:
            if r.random() < 0.4:
                parts = [f"{r.randrange(65536):x}" for _ in range(8)]
                return 1, r.choice((":".join(parts), ":".join(parts[:4]) + "::" + parts[5], "fe80::" + ":".join(parts[:3])))
            return 1, r.choice(("[.]", "(.)", "[dot]", " dot ", " . ", "{.}")).join(str(r.randrange(256)) for _ in range(4))
        if kind == 2:
            return 2, self.grouped(self.card_number(True), r.choice((".", "/", "_", "  ", " - ", "\xa0")))
        a, b, c = self.number(3), self.number(3), self.number(4)
        return 3, r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{a}/{b}{c}", f"00{r.randint(1, 99)} {a} {b} {c}", f"0{a[:2]} {b[:2]} {c[:2]} {c[2:]} {a[:2]}"))

    def other(self) -> str:
        r, n = self.rnd, self.number
        return r.choice((
            lambda: f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.{r.randint(1900, 2099)}",
            lambda: f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(1900, 2099)}", lambda: f"{r.randint(0, 23):02}:{r.randint(0, 59):02}:{r.randint(0, 59):02}",
            lambda: f"{n(1)}.{n(2)}.{n(1)}.{n(4)}", lambda: f"{n(1)}.{n(1)}", lambda: n(r.randint(6, 16)), lambda: self.card_number(False), lambda: self.grouped(self.card_number(False), r.choice((" ", "-", ".", "/"))),
            lambda: f"{n(2)}.{n(3)}.{n(3)}", lambda: f"{n(4)}-{n(4)}", lambda: f"{n(3)}-{n(1)}-{n(2)}-{n(6)}-{n(1)}", lambda: f"{r.randint(1900, 2099)}-{r.randint(1900, 2099)}",
            lambda: f"{r.randint(256, 999)}.{n(3)}.{n(3)}.{n(3)}", lambda: f"{n(2)}, {n(2)}, {n(2)}", lambda: f"{n(1)} at {n(2)}.{n(1)}", lambda: f"{self.name()} at {self.name()}.{self.name()}",
            lambda: f"meet at {self.name()}. {self.name()}", lambda: f"{n(3)} {n(3)} {n(3)} {n(3)}", lambda: f"{n(3)}.{n(2)}", lambda: "std::" + self.name(), lambda: f"{n(1)}:{n(1)}:{n(1)}"))()

    def cue(self, kind: int) -> str:
        return self.rnd.choice(CUES[kind].split()) + self.rnd.choice((" ", ": ", " - "))

    def set_into(self, text: str) -> tuple[str, list[Span]]:
        """``text`` with ``PLANTED`` items between its words, and the spans of the personal ones."""
        r, words = self.rnd, text.split(" ")
        places = sorted(r.randrange(len(words) + 1) for _ in range(PLANTED))
        out, spans, size = [], [], 0

        def put(s: str) -> int:
            nonlocal size
            out.append(s)
            size += len(s)
            return size

        for k, place in enumerate(places):
            put(" ".join(words[places[k - 1] if k else 0:place]) + " ")
            kind, item = self.personal() if r.random() < 0.5 else (-1, self.other())
            if r.random() < 0.4:
                put(self.cue(kind))
            start = size
            end = put(item)
            if kind >= 0:
                spans.append((start, kind, end))
            put(r.choice((" ", " ", ". ", ", ", "\n")))
        put(" ".join(words[places[-1]:]))
        return "".join(out), spans


@dataclass
class Model:
    trees: boosting.Model
    common: dict[str, float]
    scale: list[tuple[float, float]]  # of each kind: slope and offset of the log-odds
    threshold: list[float]  # of each kind: least probability

    def probabilities(self, text: str, spans: list[Span]) -> list[float]:
        score = self.trees.scores(np.array([features(text, s, self.common) for s in spans], np.float64))
        return [1 / (1 + math.exp(-min(max(a * x + b, -40), 40))) for x, (a, b) in zip(score.tolist(), (self.scale[s[1]] for s in spans), strict=True)]


def scaled(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits held-out scores, by Newton steps on targets kept off 0 and 1."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x, w = np.stack([score, np.ones(len(score))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
    return float(max(w[0], 0.0)), float(w[1])


def fit(texts: list[str], seed: int = 12) -> Model:
    """Learn from ``texts`` with personal data and look-alikes set into them; their own candidates count as look-alikes."""
    grammar = Grammar(seed)
    texts = [t for t in texts if t.strip()] or [" ".join(grammar.name() for _ in range(40)) for _ in range(60)]
    count = Counter(w.lower() for t in texts for w in _word.findall(t))
    common = {w: math.log1p(n) for w, n in count.items() if n > 2}
    rows, labels, kinds, held = [], [], [], []
    # short texts are cheap contexts: each text is used at least once, and again until there are enough
    for k in range(max(len(texts), SAMPLE)):
        text, planted = grammar.set_into(texts[k % len(texts)])
        for c in clear_of(base(text), candidates(text)):
            rows.append(features(text, c, common))
            labels.append(float(c in planted))
            kinds.append(c[1])
            held.append(k % 3 == 0)
    x, y, kinds, held = np.array(rows, np.float64), np.array(labels), np.array(kinds), np.array(held)
    trees = boosting.fit(x[~held], y[~held])
    scale, threshold = [], []
    for kind in range(len(KINDS)):
        on = held & (kinds == kind)
        score, truth = trees.scores(x[on]), y[on]
        a, b = scaled(score, truth)
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -40, 40)))
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= PRECISION)
        scale.append((a, b))
        threshold.append(max(float(p[order[good[-1]]]), 0.5) if len(good) else 2.0)
    return Model(trees, common, scale, threshold)


def clear_of(taken: list[Span], some: list[Span]) -> list[Span]:
    """Those of ``some`` that overlap none of ``taken``, both by start."""
    ends, starts, reach = [], [s for s, _, _ in taken], 0
    for _, _, e in taken:
        reach = max(reach, e)
        ends.append(reach)
    return [c for c in some if not (k := bisect_left(starts, c[2])) or ends[k - 1] <= c[0]]


def spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) by start and kind."""
    fixed = base(text)
    some = clear_of(fixed, candidates(text))
    if not some:
        return fixed, fixed
    taken: list[Span] = []
    for less, c in sorted(zip((-p for p in model.probabilities(text, some)), some, strict=True)):
        if -less >= model.threshold[c[1]]:
            k = bisect_left(taken, c)
            if (not k or taken[k - 1][2] <= c[0]) and (k == len(taken) or c[2] <= taken[k][0]):
                taken.insert(k, c)
    return fixed, sorted(fixed + taken)


def sample(docs: DataFrame, text: str) -> list[str]:
    """At most ``SAMPLE`` texts by hash: the bound of the hash is found first, so that few texts move."""
    rows = docs.select(F.col(f"`{text}`").alias("t")).filter("t is not null").withColumn("k", F.xxhash64("t", F.lit("personal")))
    first = [r["k"] for r in rows.select("k").orderBy("k").limit(SAMPLE).collect()]
    return [r["t"] for r in rows.filter(F.col("k") <= first[-1]).orderBy("k", "t").limit(SAMPLE).collect()] if first else []


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, base, spans, redacted) per row: spans as (kind, start, end), and the text with ``[KIND]`` in their place."""
    model = model or fit(sample(docs, text))
    shape = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def listed(found: list[list[Span]]) -> pa.ListArray:
        flat = [s for spans_ in found for s in spans_]
        columns = [pa.array([KINDS[k] for _, k, _ in flat], pa.string()), pa.array([s for s, _, _ in flat], pa.int64()), pa.array([e for _, _, e in flat], pa.int64())]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.StructArray.from_arrays(columns, fields=list(shape)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [spans(t, model) for t in texts]
            masked = [redacted(t, s) for t, (_, s) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), listed([b for b, _ in found]), listed([s for _, s in found]), pa.array(masked, pa.string())], ["doc_id", "base", "spans", "redacted"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kinds = "array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(tidy(run), f"doc_id long, base {kinds}, spans {kinds}, redacted string")


def redacted(text: str, found: list[Span]) -> str:
    """``text`` with its spans replaced; overlapping ones become one, named after the first."""
    out, last = [], 0
    for start, kind, end in found:
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]]) if out else text
