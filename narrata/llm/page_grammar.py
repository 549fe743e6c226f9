"""Random labelled pages: a small grammar of page layouts, for training the block classifier.

Blocks of the article carry ``data-y="1"``, others inside it ``data-y="0"``; unlabelled ones inherit.
"""

from __future__ import annotations

import numpy as np

# Words of attributes that site templates use, by what the block is.
CLASSES = {
    "main": "article content post entry story body main text article-body post-content entry-content story-body page-content blog",
    "nav": "nav menu navbar navigation main-menu breadcrumb breadcrumbs topnav pagination toc skip-links",
    "header": "header masthead site-header top-bar banner logo branding",
    "footer": "footer site-footer bottom copyright legal colophon footer-links",
    "side": "sidebar aside widget related related-posts recommended trending most-read tags categories rail",
    "ad": "ad ads advert advertisement sponsored promo promotion ad-slot banner-ad partner",
    "notice": "notice cookie cookies cookie-banner consent gdpr alert popup modal overlay paywall message",
    "form": "form newsletter subscribe signup search login contact-form subscription",
    "comments": "comments comment comment-list discussion replies responses disqus reader-comments",
    "share": "share social sharing follow social-links meta byline-links",
}


class Grammar:
    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        syllables = ["".join(p) for p in self.rng.choice(list("aeioubcdlmnprst"), (60, 3))]
        self.words = ["".join(self.rng.choice(syllables, k)) for k in self.rng.integers(1, 4, 400)]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, low: int, high: int) -> range:
        return range(int(self.rng.integers(low, high + 1)))

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.rng.choice(self.words, int(self.rng.integers(low, high + 1)))).capitalize()

    def prose(self, low: int, high: int) -> str:
        parts = []
        for _ in self.some(low, high):
            parts.append(self.phrase(2, 9) + (", " + self.phrase(2, 8).lower() if self.chance(0.5) else "") + str(self.rng.choice([".", ".", ".", "?", "!"])))
        text = " ".join(parts)
        if self.chance(0.2):
            text += f' <a href="/{self.rng.integers(99)}">{self.phrase(1, 4)}</a> {self.phrase(2, 6).lower()}.'
        return f"<b>{text}<br>" if self.chance(0.05) else text

    def attribute(self, kind: str) -> str:
        if self.chance(0.25):
            return ""
        name = str(self.rng.choice(CLASSES[kind].split()))
        return f' {self.rng.choice(["class", "class", "id"])}="{name}"'

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.rng.integers(999)}">{self.phrase(1, 4)}</a></li>' for _ in self.some(low, high))

    def other(self, kind: str) -> str:
        a = self.attribute(kind)
        div = str(self.rng.choice(["div", "section"]))
        if kind == "nav":
            tag = str(self.rng.choice(["nav", "div", "nav"]))
            return f'<{tag}{a} data-y="0"><ul>{self.links(2, 9)}</ul></{tag}>'
        if kind == "header":
            return f'<header{a} data-y="0"><div>{self.phrase(1, 4)}</div>{f"<p>{self.phrase(3, 8)}</p>" if self.chance(0.5) else ""}</header>'
        if kind == "footer":
            tag = str(self.rng.choice(["footer", "footer", "div"]))
            a = a or (' class="footer"' if tag == "div" else "")
            return f'<{tag}{a} data-y="0">{self.chance(0.5) * "<p>"}&copy; {self.phrase(1, 4)} &middot; {self.prose(1, 2)}</{tag}>'
        if kind == "side":
            tag = str(self.rng.choice(["aside", "div"]))
            a = a or (' class="sidebar"' if tag == "div" else "")
            body = f"<ul>{self.links(2, 7)}</ul>" if self.chance(0.6) else "".join(f"<p>{self.prose(1, 2)}</p>" for _ in self.some(1, 3))
            return f'<{tag}{a} data-y="0"><h3>{self.phrase(1, 3)}</h3>{body}</{tag}>'
        if kind == "form":
            return f'<form{a} data-y="0"><label>{self.phrase(1, 5)}</label><input name="q"><p>{self.prose(1, 1)}</p><button>{self.phrase(1, 2)}</button></form>'
        if kind == "comments":
            a = a or ' id="comments"'
            items = "".join(f'<{t}{self.attribute("comments")}><p>{self.phrase(1, 2)}</p><p>{self.prose(1, 4)}</p></{t}>' for t in [str(self.rng.choice(["div", "li", "article"]))] for _ in self.some(1, 5))
            return f'<{div}{a} data-y="0"><h3>{self.phrase(1, 2)}</h3>{items}</{div}>'
        a = a or f' class="{self.rng.choice(CLASSES[kind].split())}"'
        return f'<{div}{a} data-y="0">{self.prose(1, 2) if self.chance(0.6) else f"<p>{self.prose(1, 2)}</p>"}</{div}>'

    def article(self) -> str:
        parts = [f"<h1>{self.phrase(3, 12)}{'.' if self.chance(0.3) else ''}</h1>"] if self.chance(0.9) else []
        for _ in self.some(1, 12):
            kind = self.rng.random()
            if kind < 0.75:
                parts.append(f"<p>{self.prose(1, 7)}{'</p>' if self.chance(0.9) else ''}")
            elif kind < 0.83:
                parts.append(f"<h2>{self.phrase(2, 6)}</h2>")
            elif kind < 0.9:
                parts.append(f"<ul>{''.join(f'<li>{self.prose(1, 1)}</li>' for _ in self.some(2, 5))}</ul>")
            elif kind < 0.95:
                parts.append(f"<blockquote><p>{self.prose(1, 3)}</p></blockquote>")
            else:
                parts.append(self.other(str(self.rng.choice(["ad", "share", "side", "form", "notice"]))))
        tag = str(self.rng.choice(["article", "article", "div", "main", "section"]))
        a = self.attribute("main") or (' class="content"' if tag in ("div", "section") else "")
        return f'<{tag}{a} data-y="1">{"".join(parts)}</{tag}>'

    def page(self) -> str:
        before = [self.other(k) for k in ("header", "nav", "ad", "notice", "nav") if self.chance(0.45)]
        after = [self.other(k) for k in ("share", "comments", "side", "ad", "form", "footer") if self.chance(0.45)]
        article = self.article()
        if self.chance(0.4):
            side = self.other("side")
            article = f'<div class="{self.rng.choice(["wrapper", "container", "row", "layout"])}">{side + article if self.chance(0.3) else article + side}</div>'
        return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{self.phrase(2, 8)}</title></head><body data-y="0">{"".join(before)}{article}{"".join(after)}</body></html>'
