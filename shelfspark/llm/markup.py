"""A scanner of web pages that goes from left to right once, whatever the markup is like.

Marks that end a construct are looked for from where the last search for them ended, and one that is missing is looked for
once a page. So unclosed comments, tags, quotes and elements cost no more than closed ones.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

_NAME = re.compile(r"/?\w+")
_ATTRIBUTE = re.compile(r"""\s*(?:([^\s=<>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s<>"']*))?|([<>])|(["'=]))""", re.S)
_END = re.compile(r"\s*>")
# Elements whose content is no text, and those that begin a line.
HIDDEN = frozenset({"script", "style", "noscript", "template", "head"})
CODE = frozenset({"script", "style"})
BLOCKS = frozenset("p div br hr li ul ol tr td th table h1 h2 h3 h4 h5 h6 nav article section header footer main aside form pre blockquote body html".split())


class _Finder:
    """The next place of fixed strings in one text; places must be asked for in rising order."""

    def __init__(self, text: str):
        self.text = text
        self.next: dict[str, int] = {}

    def __call__(self, what: str, at: int) -> int:
        """The first place at or after ``at``, or -1."""
        place = self.next.get(what, -2)
        if place == -2 or -1 < place < at:
            place = self.next[what] = self.text.find(what, at)
        return place


def _element_end(find: _Finder, name: str, at: int) -> int:
    """Where the element's end tag ends, or -1."""
    while (at := find(f"</{name}", at)) >= 0:
        at += len(name) + 2
        if end := _END.match(find.text, at):
            return end.end()
    return -1


def parts(page: str, hidden: frozenset[str] = HIDDEN) -> Iterator[tuple[int, int, str | None]]:
    """(start, end, what) from left to right: text (None), a tag ("p", "/p", "" if it has no name), or what is left out ("!").

    Left out are comments and whole ``hidden`` elements. A tag ends at the next ``>``. A ``<`` that another one follows before
    any ``>`` is text, but for tags that begin a line; so is one that nothing closes. What is not closed is a tag alone.
    """
    lower = page.lower()
    if len(lower) != len(page):  # a few letters grow in lower case
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), page)
    find = _Finder(lower)
    at = 0
    while (begin := find("<", at)) >= 0:
        name = m[0] if (m := _NAME.match(lower, begin + 1)) else ""
        end = -1
        if lower.startswith("<!--", begin):
            end = find("-->", begin + 4)
            end += 3 if end >= 0 else 0
        elif name in hidden:
            end = _element_end(find, name, begin + 1 + len(name))
        what = "!"
        if end < 0:
            what, close = name, find(">", begin)
            other = lower.find("<", begin + 1, close) if close >= 0 else -1
            if close < 0 or (other >= 0 and name.lstrip("/") not in BLOCKS):
                stop = other if other >= 0 else len(page)
                yield at, stop, None
                at = stop
                continue
            end = close + 1
        if begin > at:
            yield at, begin, None
        yield begin, end, what
        at = end
    if at < len(page):
        yield at, len(page), None


def plain_text(page: str) -> str:
    """Visible text: a line a block, white space in a line made one space."""
    out = []
    for begin, end, what in parts(page):
        out.append(page[begin:end] if what is None else " " if what == "!" else "\n" if what.lstrip("/") in BLOCKS else "")
    lines = (" ".join(line.split()) for line in entities.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line)


def bare_text(page: str) -> str:
    """The page with a space for each comment, tag, script and style; entities stay."""
    return "".join(page[begin:end] if what is None else " " for begin, end, what in parts(page, CODE))


def attributes(page: str, at: int) -> dict[str, str]:
    """Attributes of the tag whose name ends at ``at``; of equal names the first. Quoted values may hold ``>``."""
    out: dict[str, str] = {}
    while m := _ATTRIBUTE.match(page, at):
        at = m.end()
        if m[3]:
            break
        if m[1]:
            value = m[2] or ""
            out.setdefault(m[1].lower(), entities.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return out


def facts(page: str) -> dict:
    """Title, declared language, named metas and links; what stands in comments, scripts and styles does not count."""
    title = lang = None
    metas, links = [], []
    titled = -1
    for begin, end, what in parts(page, CODE):
        if what == "title" and titled < 0:
            titled = end
        elif what == "/title" and titled >= 0 and title is None:
            title = " ".join(entities.unescape(page[titled:begin]).split())
        elif what == "html" and lang is None:
            declared = re.match(r"[\w-]+", attributes(page, begin + 5).get("lang", "").strip())
            lang = declared[0] if declared else None
        elif what == "meta":
            own = attributes(page, begin + 5)
            if "name" in own and "content" in own:
                metas.append({"name": own["name"], "content": own["content"]})
        elif what == "a":
            own = attributes(page, begin + 2)
            if "href" in own:
                links.append(own["href"])
    return {"title": title, "lang": lang, "metas": metas, "links": links}
