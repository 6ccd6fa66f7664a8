"""Texts of a page's elements, read with the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

WANTED = frozenset("a p li td th h1 h2 h3 h4 i center".split())
SKIPPED = frozenset("script style nav noscript".split())


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[list] = []
        self.out: list[tuple[str, str]] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SKIPPED:
            self.skip += 1
        elif tag in WANTED or tag == "div" and any(k == "class" and v == "author" for k, v in attrs):
            if self.open and self.open[-1][0] == tag and tag in ("p", "li", "td", "th"):
                self._close()
            self.open.append(["author" if tag == "div" else tag, tag, []])

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif any(o[1] == tag for o in self.open):
            while self.open:
                last = self.open[-1][1]
                self._close()
                if last == tag:
                    break

    def handle_data(self, data: str) -> None:
        if not self.skip:
            for o in self.open:
                o[2].append(data)

    def _close(self) -> None:
        kind, _, text = self.open.pop()
        said = " ".join("".join(text).split())
        if said:
            self.out.append((kind, said))


def elements(html: str | None) -> list[tuple[str, str]]:
    """(kind, text) of links, paragraphs, items, cells, headings and author lines; unreadable pages give what was read."""
    r = _Reader()
    try:
        r.feed(html or "")
        r.close()
    except (AssertionError, ValueError):
        pass
    while r.open:
        r._close()
    return r.out
