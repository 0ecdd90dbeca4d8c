"""Per-page HTML helper run inside ``mapInPandas`` (standard library only).

Builds a light element index (tag, attributes, source offsets, parent) with
``html.parser``, then answers selectors of a tag with any number of classes
(``div.a.b``, ``.a``, ``h2``), any number of descendant steps (``A B C``) and
comma-separated groups.  Content is returned as the
source slice of the chosen element with the stripped descendants cut out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
JS_WS = "\t\n\x0b\f\r \xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


class _Index(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.line_starts = [0] + [m.end() for m in re.finditer("\n", html)]
        self.els: list[dict] = []
        self.stack: list[int] = []
        self.text_parts: list[tuple[int, str]] = []   # (innermost open element, text)

    def _off(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def handle_starttag(self, tag, attrs):
        start = self._off()
        if tag == "p" and self.stack and self.els[self.stack[-1]]["tag"] == "p":
            self._close(self.stack[-1], start, start)
        text = self.get_starttag_text() or ""
        el = {"tag": tag, "attrs": dict(attrs), "start": start, "inner_start": start + len(text),
              "inner_end": None, "end": None, "parent": self.stack[-1] if self.stack else None,
              "depth": len(self.stack)}
        self.els.append(el)
        idx = len(self.els) - 1
        if tag in VOID:
            el["inner_end"] = el["end"] = el["inner_start"]
        else:
            self.stack.append(idx)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        el = self.els[-1]
        if tag not in VOID:
            self.stack.pop()
            el["inner_end"] = el["end"] = el["inner_start"]

    def _close(self, idx, inner_end, end):
        while self.stack:
            top = self.stack.pop()
            self.els[top]["inner_end"] = inner_end
            self.els[top]["end"] = end
            if top == idx:
                break

    def handle_endtag(self, tag):
        pos = self._off()
        close = self.html.find(">", pos)
        end = len(self.html) if close < 0 else close + 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.els[self.stack[i]]["tag"] == tag:
                self._close(self.stack[i], pos, end)
                return

    def handle_data(self, data):
        self.text_parts.append((self.stack[-1] if self.stack else -1, data))

    def finish(self):
        self.close()
        return self.seal()

    def seal(self):
        n = len(self.html)
        while self.stack:
            top = self.stack.pop()
            self.els[top]["inner_end"] = self.els[top]["end"] = n
        return self


_SIMPLE = re.compile(r"[A-Za-z][\w-]*(\.[\w-]+)*|(\.[\w-]+)+")


class UnknownSelector(Exception):
    """A selector of a profile row that would silently match nothing."""


def check_selector(selector: str) -> None:
    """Raise ``UnknownSelector`` for a form that ``Page.select`` doesn't know."""
    for part in selector.split(","):
        if not all(_SIMPLE.fullmatch(step) for step in part.split()):
            raise UnknownSelector(f"only tags, classes and descendants are known: {part.strip()!r}")


def _simple_match(el, simple: str) -> bool:
    tag, *classes = simple.split(".")
    if tag and el["tag"] != tag:
        return False
    have = (el["attrs"].get("class") or "").split() if classes else ()
    return all(c in have for c in classes)


class Page:
    def __init__(self, html: str):
        self.html = html or ""
        self.ix = _Index(self.html)
        self.error: str | None = None
        try:
            self.ix.feed(self.html)
            self.ix.finish()
        except (AssertionError, ValueError, IndexError) as e:     # what the parser raises on broken markup
            self.error = f"{type(e).__name__}: {e}"
            self.ix.seal()
        self.els = self.ix.els

    def _ancestors(self, i):
        p = self.els[i]["parent"]
        while p is not None:
            yield p
            p = self.els[p]["parent"]

    def select(self, selector: str) -> list[int]:
        """Indices of elements matching ``selector`` in document order; a
        comma-separated group matches the union of its members."""
        if "," in selector:
            hits = set()
            for part in selector.split(","):
                if part.strip():
                    hits.update(self.select(part.strip()))
            return sorted(hits)
        check_selector(selector)
        *outer, last = selector.split()
        return [i for i, el in enumerate(self.els) if _simple_match(el, last) and self._within(i, outer)]

    def _within(self, i, steps: list[str]) -> bool:
        """Whether ancestors of ``i``, from the inside out, match the steps
        (taking the nearest match of each step loses nothing)."""
        left = len(steps)
        for a in self._ancestors(i):
            if not left:
                break
            if _simple_match(self.els[a], steps[left - 1]):
                left -= 1
        return not left

    def _descendant(self, i, root) -> bool:
        return any(a == root for a in self._ancestors(i))

    def text(self, i: int) -> str:
        el = self.els[i]
        return "".join(t for owner, t in self.ix.text_parts
                       if owner == i or (owner >= 0 and self._descendant(owner, i)))

    def inner_html(self, i: int, strip: list[str]) -> str:
        el = self.els[i]
        cut = []
        for sel in strip:
            for j in self.select(sel):
                if self._descendant(j, i):
                    cut.append((self.els[j]["start"], self.els[j]["end"]))
        cut.sort()
        out, pos = [], el["inner_start"]
        for a, b in cut:
            if b <= pos:
                continue
            out.append(self.html[pos:max(pos, a)])
            pos = max(pos, b)
        out.append(self.html[pos:el["inner_end"]])
        return "".join(out)

    def meta_content(self, prop: str):
        for el in self.els:
            if el["tag"] == "meta" and el["attrs"].get("property") == prop:
                return el["attrs"].get("content")
        return None


def page_title(page: Page, selectors: list[str], scope: str | None = None) -> str | None:
    """First non-empty trimmed text among the selectors, then og:title.  With
    a ``scope``, the selectors are first tried inside its first match."""
    roots = page.select(scope)[:1] if scope else []
    for root in [*roots, None]:
        for sel in selectors:
            hits = [i for i in page.select(sel) if root is None or page._descendant(i, root)]
            if hits:
                t = page.text(hits[0]).strip(JS_WS)
                if t:
                    return t
    og = page.meta_content("og:title")
    og = og.strip(JS_WS) if og else None
    return og or None


def main_content(page: Page, selectors: list[str], strip: list[str], fallback: list[str],
                 fallback_strip: list[str]) -> str | None:
    """The inside of the first container found; an empty one, or none, hands
    over to the fallback containers."""
    for group, cut in ((selectors, strip), (fallback, fallback_strip)):
        for sel in group:
            hits = page.select(sel)
            if hits:
                html = page.inner_html(hits[0], cut)
                if html:
                    return html
                break
    return None


def all_links(page: Page) -> list[str]:
    """Every ``a[href]``."""
    return [page.els[i]["attrs"]["href"] for i in page.select("a") if page.els[i]["attrs"].get("href") is not None]


def heading_links(page: Page, heading: str) -> list[str]:
    """Links that contain a ``heading`` element (``a:has(h3)`` form)."""
    holders = {a for h in page.select(heading) for a in page._ancestors(h)}
    return [page.els[i]["attrs"]["href"] for i in page.select("a") if i in holders and page.els[i]["attrs"].get("href") is not None]


def links_under(page: Page, selector: str) -> list[str]:
    """``selector a`` form: anchors inside the matched elements."""
    roots = set(page.select(selector))
    return [page.els[i]["attrs"]["href"] for i in page.select("a")
            if page.els[i]["attrs"].get("href") is not None and any(a in roots for a in page._ancestors(i))]
