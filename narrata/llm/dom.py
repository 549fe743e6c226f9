"""A tolerant HTML parser to blocks, with the features of each block.

Blocks are block-level elements and runs of text beside them; inline elements belong to their block. Element nesting
is mended as browsers do in the common cases: void elements, implied ends of paragraphs, list items, table parts and
options, end tags without a start, missing end tags, raw text of scripts and the like, comments and declarations.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np

# Fixed values of the format: element names by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template select svg object xmp noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
GROUPS = ("p", "h1 h2 h3 h4 h5 h6", "li", "ul ol menu dl", "div section", "article", "main", "nav", "header", "footer", "aside", "form fieldset", "table tbody tr td th", "blockquote pre figure figcaption", "#run", "body html")

#: One scan: a tag ends at the first ``>`` outside a quoted value, and a value is quoted only right after its equals sign; what
#: does not end before the page does is a tag all the same.
TAG = re.compile(r"<!--(.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
ENDED = re.compile(r"[\s/>]|\Z")
NAMED = frozenset("class id role itemprop data-y".split())
TOKENS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")
GROUP_OF = {tag: k for k, tags in enumerate(GROUPS) for tag in tags.split()}
SEMANTIC = tuple(GROUP_OF[t] for t in ("article", "main", "nav", "header", "footer", "aside", "form"))
FEATURES = 26 + len(GROUPS) + 2 * len(SEMANTIC)


class Page:
    """Blocks in document order: ``parent``, ``tag``, ``tokens``, ``label`` and, for blocks with text, ``texts``.

    Pages of the training grammar carry labels in ``data-y``; on a ``given`` page that attribute means nothing.
    """

    def __init__(self, source: str, given: bool = False):
        self.given = given
        self.parent, self.tag, self.tokens, self.label = [-1], ["#root"], [()], [None]
        self.runs: list[tuple[int, list[str], int]] = []  # block, text parts, characters in links
        self._parse(source)
        self._settle()

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]
        opened: Counter[str] = Counter()  # how many of a name are on the stack
        parts: list[str] = []
        linked = links = 0
        lower = None
        at = 0

        def cut(k: int) -> None:
            for tag, _ in stack[k:]:
                opened[tag] -= 1
            del stack[k:]

        def end_run() -> None:
            nonlocal parts, linked
            if parts:
                self.runs.append((stack[-1][1], parts, linked))
                parts, linked = [], 0

        while True:
            m = TAG.search(source, at)
            text = source[at:m.start() if m else len(source)]
            if text:
                text = html.unescape(text) if "&" in text else text
                parts.append(text)
                if links:
                    linked += len(text)
            if not m:
                break
            at = m.end()
            name = m.group(3)
            if name is None:
                continue
            name = name.lower()
            if m.group(2):
                if name == "a":
                    links = max(0, links - 1)
                if name in INLINE:
                    continue
                if opened[name]:
                    end_run()
                    cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
                elif name == "p":
                    end_run()
                continue
            if name in RAW:
                lower = lower or source.lower()
                if name != "svg" or not m.group(4).endswith("/"):  # elsewhere a slash closes nothing
                    stop = lower.find(f"</{name}", at)
                    while stop >= 0 and not ENDED.match(lower, stop + 2 + len(name)):
                        stop = lower.find(f"</{name}", stop + 2)
                    close = source.find(">", stop) if stop >= 0 else -1
                    at = close + 1 if close >= 0 else len(source)
                continue
            if name in ("br", "hr"):
                parts.append(" ")
            if name in VOID or name in INLINE:
                links += name == "a"
                continue
            end_run()
            links = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    cut(k)
                    break
                if stack[k][0] not in ("#run",) and k < len(stack) - 1:
                    break
            if name in SELF_CLOSING:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in SELF_CLOSING[name]:
                        cut(k)
                        break
                    if stack[k][0] in LIST_SCOPE[name]:
                        break
            tokens, label = (), None
            if m.group(4):
                found = []
                for key, *values in ATTRIBUTE.findall(m.group(4)):
                    key, value = key.lower(), next((v for v in values if v), "")
                    if key not in NAMED:
                        continue
                    if key == "data-y":
                        label = label if self.given else int(value)
                    else:
                        found += TOKENS.findall(CAMEL.sub(r"\1 \2", value).lower())
                tokens = tuple(dict.fromkeys(found))
            if name == "head":
                label = 0
            self.parent.append(stack[-1][1])
            self.tag.append(name)
            self.tokens.append(tokens)
            self.label.append(label)
            if name not in ("html", "body") or len(stack) < 3:
                stack.append((name, len(self.tag) - 1))
                opened[name] += 1
        end_run()

    def _settle(self) -> None:
        """Give every run a block of its own where its element has other blocks or runs, and put blocks in order."""
        busy = np.bincount(self.parent[1:], minlength=len(self.tag)) if len(self.tag) > 1 else np.zeros(1, int)
        kept = []
        for node, parts, linked in self.runs:
            text = " ".join("".join(parts).split())
            if text:
                kept.append((node, text, linked))
        runs_of: dict[int, int] = {}
        for node, _, _ in kept:
            runs_of[node] = runs_of.get(node, 0) + 1
        self.texts: dict[int, str] = {}
        self.linked: dict[int, int] = {}
        self.order: list[int] = []
        for node, text, linked in kept:
            if busy[node] or runs_of[node] > 1:
                self.parent.append(node)
                self.tag.append("#run")
                self.tokens.append(())
                self.label.append(None)
                node = len(self.tag) - 1
            self.texts[node] = text
            self.linked[node] = linked
            self.order.append(node)

    def sums(self) -> None:
        """Per block: characters, characters in links, punctuation, blocks below, place of its first character."""
        n = len(self.tag)
        self.chars, self.link_chars, self.marks, self.below, self.start = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.full(n, np.inf)
        before = 0
        for node in self.order:
            text = self.texts[node]
            self.chars[node], self.link_chars[node] = len(text), min(self.linked[node], len(text))
            self.marks[node] = text.count(".") + text.count(",") + text.count("?") + text.count("!") + text.count(";")
            self.start[node] = before
            before += len(text)
        up = self.parent
        self.depth = np.zeros(n)
        # runs come last but their parents are real elements, so that two sweeps suffice
        for i in range(1, n):
            self.depth[i] = self.depth[up[i]] + 1
        for i in range(n - 1, 0, -1):
            p = up[i]
            self.chars[p] += self.chars[i]
            self.link_chars[p] += self.link_chars[i]
            self.marks[p] += self.marks[i]
            self.below[p] += self.below[i] + 1
            if self.start[i] < self.start[p]:
                self.start[p] = self.start[i]

    def features(self, odds: dict[str, float], blind: bool = False) -> np.ndarray:
        """(block, feature). ``odds`` holds what is known of attribute tokens; ``blind`` hides element names and tokens."""
        self.sums()
        n = len(self.tag)
        out = np.zeros((n, FEATURES), np.float32)
        total = max(1.0, self.chars[0])
        children: dict[int, list[int]] = {}
        for i in np.argsort(self.start, kind="stable").tolist():
            if i and self.chars[i]:
                children.setdefault(self.parent[i], []).append(i)
        chars = np.maximum(self.chars, 1)
        link, mark = self.link_chars / chars, self.marks / chars
        group = [-1 if blind else GROUP_OF.get(t, -1) for t in self.tag]
        low, high = np.zeros(n), np.zeros(n)
        above_low, above_high = np.zeros(n), np.zeros(n)
        inside = np.zeros((n, len(SEMANTIC)), np.float32)
        paragraphs = np.zeros(n)
        for i in range(1, n):
            p = self.parent[i]
            if not blind and self.tokens[i]:
                known = [odds.get(t, 0.0) for t in self.tokens[i]]
                low[i], high[i] = min(0.0, *known), max(0.0, *known)
            above_low[i], above_high[i] = min(above_low[p], low[p]), max(above_high[p], high[p])
            inside[i] = inside[p]
            if group[p] in SEMANTIC:
                inside[i, SEMANTIC.index(group[p])] = 1
            paragraphs[p] += self.tag[i] == "p"
            if group[i] >= 0:
                out[i, 26 + group[i]] = 1
        for p, kids in children.items():
            m = len(kids)
            for k, i in enumerate(kids):
                before, after = kids[k - 1] if k else -1, kids[k + 1] if k + 1 < m else -1
                out[i, 10:20] = (
                    k, m, k / m, self.chars[i] / chars[p], link[before] if before >= 0 else -1, link[after] if after >= 0 else -1,
                    math.log1p(self.chars[before]) if before >= 0 else -1, math.log1p(self.chars[after]) if after >= 0 else -1, link[p], paragraphs[p])
        out[:, 0], out[:, 1], out[:, 2], out[:, 3] = np.log1p(self.chars), link, mark, self.chars / total
        out[:, 4], out[:, 5], out[:, 6] = np.log1p(self.below), np.log1p(self.chars / (1 + self.below)), self.depth
        out[:, 7] = np.where(np.isfinite(self.start), self.start, 0) / total
        out[:, 8], out[:, 9] = paragraphs, np.array([len(t) for t in self.tokens])
        out[:, 20], out[:, 21], out[:, 22], out[:, 23] = low, high, above_low, above_high
        out[:, 24], out[:, 25] = self.marks > 0, math.log1p(n)
        k = 26 + len(GROUPS)
        out[:, k:k + len(SEMANTIC)] = inside
        out[:, k + len(SEMANTIC):] = inside.any(1)[:, None] * 0 + np.array([[g == s for s in SEMANTIC] for g in group], np.float32)
        return out

    def truth(self) -> np.ndarray:
        """Labels of blocks with text below: 1 or 0 where all text agrees, -1 for mixed ones and those without text."""
        n = len(self.tag)
        own = np.zeros(n, np.int64)
        for i in range(1, n):
            own[i] = own[self.parent[i]] if self.label[i] is None else self.label[i]
        seen = np.zeros((n, 2), bool)
        for node in self.order:
            seen[node, own[node]] = True
        for i in range(n - 1, 0, -1):
            seen[self.parent[i]] |= seen[i]
        return np.where(seen.all(1) | ~seen.any(1), -1, seen[:, 1].astype(int))
