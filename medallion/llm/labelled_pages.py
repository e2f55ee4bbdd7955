"""Labelled pages to train the page model on.

Pages are put together from the ways in which sites mark their parts: an
article in one of several containers, some with names that no other site has
or none, and menus, headers, footers, sidebars,
notices, adverts, forms and reader comments around and inside it.  The
attribute ``CONTENT`` labels an element and what is in it.
"""

from __future__ import annotations

import random
import re

CONTENT = "data-content"

_ARTICLE = ("article", "article", "article", "main", "div class=content", "div id=article-body", "div class='post entry-content'", "section class=story", "div role=main", "div class='article text'")
_ROOT = ("", "", "div id=page", "div class=wrapper", "div class=container", "main")
_BEFORE = (
    "nav", "header", "div class=menu", "div id=navigation role=navigation", "div class='site-header banner' role=banner", "ul class=breadcrumb",
    "div class=cookie-notice", "div class='notice alert'", "div id=consent", "div class=ad", "div class='advert sponsored'", "div id=banner-ad", "form class=search", "div class=topbar",
    "noscript",
)
_AFTER = (
    "footer", "footer", "aside", "div class=sidebar", "div id=sidebar role=complementary", "section class=comments", "div id=comments", "ol class=comment-list", "div class='comment reply'",
    "div class=related", "div class=share", "div class=social", "form class=newsletter", "form", "div class=subscribe", "div class=footer role=contentinfo", "div class=copyright",
    "div class='discussion thread'", "div id=disqus-thread", "section class='responses replies'",
    "div class=ads", "div class=promo", "div class=widget", "div class=popup", "div class='legal disclaimer'", "div class=tags", "div class=recommended",
)
_INSIDE = ("aside", "div class=ad", "div class=advertisement", "nav class=toc", "form", "div class=share", "div class=newsletter", "section class=comments", "div class=related", "div class=notice", "footer")


def _labelled(parts: list[str]) -> bool:
    return any(CONTENT in p for p in parts)


def labelled_pages(n: int = 1200, seed: int = 0) -> list[str]:
    rnd = random.Random(seed)

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(lo, hi)))

    def name() -> str:
        return "".join(rnd.choice("bcdfghjkmpqvwxyz") for _ in range(rnd.randint(2, 5)))

    def prose(lo: int, hi: int) -> str:
        """Sentences, most with their marks."""
        out = []
        for w in words(lo, hi).split():
            out.append(w.capitalize() if not out or out[-1][-1] in ".!?" else w)
            if rnd.random() < 0.17:
                out[-1] += rnd.choice(".....,,,!?")
        return " ".join(out) + "."

    def box(spec: str, inner: str, label: int | None = None) -> str:
        mark = "" if label is None else f" {CONTENT}={label}"
        return f"<{spec}{mark}>{inner}</{spec.split()[0]}>"

    def links(lo: int, hi: int) -> str:
        return "".join(f"<li><a href=/x>{words(1, 3)}</a></li>" for _ in range(rnd.randint(lo, hi)))

    def inline() -> str:
        kind = rnd.choice(("b", "i", "em", "strong", "a href=/y", "span", "code", "u", "sup"))
        return box(kind, words(1, 4))

    def paragraph() -> str:
        said = prose if rnd.random() < 0.85 else words
        text = said(1, 60)
        while rnd.random() < 0.4:
            text += f" {inline()} {said(1, 20)}"
        odd = rnd.random()
        if odd < 0.07:  # long, repeated, or shouted
            text = said(100, 500)
        elif odd < 0.14:
            text = " ".join([words(1, 2)] * rnd.randint(30, 600))
        elif odd < 0.18:
            text = words(5, 200).upper().replace(" ", rnd.choice((" ", "!! ", " | ", ", ", " ... ")))
        kind = rnd.random()
        if kind < 0.05:
            fallback = rnd.choice((text, f"<p>{text}</p>", words(1, 4), f"{words(1, 3)}<object>{words(1, 3)}</object>{words(1, 3)}"))
            return box(rnd.choice(("noscript", "object", "object", "xmp")), fallback)
        if kind < 0.7:
            return f"<p>{text}" + ("</p>" if rnd.random() < 0.9 else "")
        if kind < 0.75:
            return f"<p><b>{text}<br>"
        if kind < 0.8:
            return box(rnd.choice(("ul", "ol")), "".join(f"<li>{words(1, 12)}" for _ in range(3)))
        if kind < 0.85:
            return box("blockquote", f"<p>{text}</p>")
        if kind < 0.9:
            return box(rnd.choice(("h2", "h3", "h4")), words(1, 9))
        if kind < 0.93:
            return box("table", f"<tr><th>{words(1, 2)}<td>{words(1, 4)}<tr><td>{words(1, 2)}<td>{words(1, 3)}")
        if kind < 0.96:
            return box("figure", f"<img src=x><figcaption>{words(1, 9)}</figcaption>")
        return box(rnd.choice(("div", "section", "pre", "div class=text", "div class=paragraph")), text)

    def other(spec: str) -> str:
        tag = spec.split()[0]
        if tag in ("ul", "ol"):
            return box(spec, links(1, 6), 0)
        if tag == "form":
            return box(spec, f"<label>{words(1, 3)}</label><input name=q><select><option>{words(1, 2)}</select><button>{words(1, 2)}</button>", 0)
        inner = rnd.choice((
            lambda: f"<ul>{links(1, 8)}</ul>", lambda: words(1, 40), lambda: f"<p>{prose(1, 40)}</p>", lambda: prose(1, 20), lambda: f"<a href=/z>{words(1, 3)}</a> {words(1, 9)}",
            lambda: f"<h3>{words(1, 3)}</h3><ul>{links(1, 5)}</ul>", lambda: f"<div><p>{prose(3, 30)}</p><p>{prose(3, 30)}</p></div>", lambda: f"<span>{words(1, 8)}</span>",
            lambda: f"<h1>{words(1, 4)}</h1><p>{words(1, 6)}</p>", lambda: f"&copy; {words(1, 3)} &middot; {words(1, 20)}",
        ))()
        for _ in range(rnd.choice((0, 0, 0, 0, 0, 1, 2, 6, 20))):
            inner = box(rnd.choice(("div", "div", "section", "div class=inner", "span")), inner)
        return box(spec, inner, 0)

    def page() -> str:
        parts = [f"<h1>{words(1, 9)}</h1>"] if rnd.random() < 0.9 else []
        for _ in range(rnd.choice((0, 1, 2, 3, 6, 12))):
            parts.append(paragraph())
            if rnd.random() < 0.08:
                parts.append(other(rnd.choice(_INSIDE)))
        inner = "".join(parts)
        for _ in range(rnd.choice((0, 0, 0, 0, 1, 2, 4, 8, 16))):
            inner = box(rnd.choice(("div", "div", "section", "div class=inner", "span")), inner)
        before = "".join(other(rnd.choice(_BEFORE)) for _ in range(rnd.randint(0, 3)))
        after = "".join(other(rnd.choice(_AFTER)) for _ in range(rnd.randint(0, 3)))
        layout = rnd.random()
        if layout < 0.55:
            article = box(rnd.choice(_ARTICLE), inner, 1)
        elif layout < 0.76:  # a name that says nothing
            article = box(rnd.choice((f"div class={name()}", f"div id={name()}", f"section class='{name()} {name()}'", "div", "section")), inner, 1)
        elif layout < 0.88:  # no container
            tags = "p h1 h2 h3 h4 ul ol table figure blockquote div section pre"
            article = re.sub(rf"<({tags.replace(' ', '|')})\b(?![^>]*{CONTENT})", rf"<\1 {CONTENT}=1", "".join(parts)) if not _labelled(parts) else box("article", inner, 1)
        else:  # a table that lays the page out
            menu = rnd.choice((f"<ul>{links(1, 8)}</ul>", "".join(f"<a href=/x>{words(1, 2)}</a><br>" for _ in range(rnd.randint(2, 8))), links(2, 6)))
            cells = [f"<td {CONTENT}=0>{menu}</td>", f"<td {CONTENT}=1>{inner}</td>"]
            if rnd.random() < 0.3:
                cells.append(f"<td {CONTENT}=0>{words(1, 12)}")
            head = f"<tr><td colspan=2>{words(1, 5)}" if rnd.random() < 0.4 else ""
            article = f"<table>{head}<tr>{''.join(cells)}</table>"
        if rnd.random() < 0.06:  # nothing but what surrounds an article
            article = ""
            before = before or other(rnd.choice(_BEFORE))
        if rnd.random() < 0.15:  # links in a box whose name says nothing
            before += box(f"div class={name()}", f"<ul>{links(2, 8)}</ul>", 0)
        body = before + article + after
        root = rnd.choice(_ROOT)
        if root and layout < 0.76:
            body = before + box(root, article, 0) + after if rnd.random() < 0.5 else box(root, body, 0)
        return f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title></head><body {CONTENT}=0>{body}" + ("</body></html>" if rnd.random() < 0.8 else "")

    return [page() for _ in range(n)]
