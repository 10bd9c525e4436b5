"""HTML pages to rows, with the standard library's parser in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from canonlake.functions.scalars import MONEY_PATTERN, MONEY_UNITS

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: What an end tag of the key closes on the way, and what a new one closes: cells and rows without end tags.
_CLOSES = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "li": {"li"}, "p": {"p"}}
_MONEY = re.compile(MONEY_PATTERN, re.IGNORECASE)


class Node:
    """An element: tag, attributes, and children that are nodes or text."""

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        """All elements below, in the order of the page; with a stack, as pages may be nested to any depth."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, tag: str, cls: str | None = None, **attrs: str) -> list[Node]:
        """Descendants of a tag whose class list matches ``cls`` (a pattern of a whole class) and whose attributes match their patterns."""
        return [n for n in self.walk() if n.tag == tag and (cls is None or any(re.fullmatch(cls, c) for c in n.attrs.get("class", "").split())) and all(re.search(p, n.attrs.get(k, "")) for k, p in attrs.items())]

    def one(self, tag: str, cls: str | None = None, **attrs: str) -> Node | None:
        found = self.all(tag, cls, **attrs)
        return found[0] if found else None

    def parts(self, skip: str | None = None) -> list[str]:
        out, stack = [], list(reversed(self.children))
        while stack:
            child = stack.pop()
            if isinstance(child, str):
                out.append(child.strip())
            elif not (skip and skip in child.attrs.get("class", "")):
                stack += reversed(child.children)
        return [p for p in out if p]

    def text(self, between: str = "", skip: str | None = None) -> str:
        return between.join(self.parts(skip))

    def rows(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.tag == "tr"]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        closes = _CLOSES.get(tag, set())
        while self.open[-1].tag in closes:
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break
            if self.open[k].tag == "table":
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


class FormatError(ValueError):
    """A page lacks what its contract requires."""


def _body(root: Node) -> Node | None:
    table = root.one("table", "items")
    return table.one("tbody") if table else None


def _amount(text: str) -> int | None:
    """The first amount in euros; null without one, or where its number cannot be read."""
    match = _MONEY.search(text)
    try:
        return round(float(match[1].replace(",", "")) * MONEY_UNITS[(match[2] or "").lower()]) if match else None
    except ValueError:
        return None


def _number(text: str) -> int | None:
    match = re.search(r"\d+", text)
    return int(match[0]) if match else None


def competition_clubs(html: str) -> list[dict]:
    """Clubs of a competition page; a club's value is the last amount of its row."""
    body = _body(tree(html))
    if body is None:
        raise FormatError("no table of clubs")
    clubs: dict[int, dict] = {}
    for row in body.rows():
        cell = row.one("td", "hauptlink")
        link = cell.one("a", href=r"/verein/\d+") if cell else None
        if link is None:
            continue
        club = int(re.search(r"/verein/(\d+)", link.attrs["href"])[1])
        amounts = [a for c in row.all("td") if (a := _amount(c.text()))]
        clubs.setdefault(club, {"club_id": club, "club_name": link.text() or link.attrs.get("title", ""), "squad_value": amounts[-1] if amounts else None})
    if not clubs:
        raise FormatError("no club on the page")
    return list(clubs.values())


def squad_page(html: str) -> list[dict]:
    """Members of a squad page."""
    body = _body(tree(html))
    if body is None:
        raise FormatError("no table of players")
    out = []
    for row in body.rows():
        link = row.one("a", href=r"/spieler/\d+")
        if link is None:
            continue
        href = link.attrs["href"]
        slug = re.match(r"/([^/]+)/profil/spieler/", href)
        inline = row.one("table", "inline-table")
        lines = inline.all("tr") if inline else []
        shirt = row.one("div", "rn_nummer")
        digits = shirt.text() if shirt else ""
        out.append({"player_id": int(re.search(r"/spieler/(\d+)", href)[1]), "slug": slug[1] if slug else "", "name": link.text(), "position": (lines[1].text() or None) if len(lines) > 1 else None, "shirt_number": int(digits) if digits.isdigit() else None})
    if not out:
        raise FormatError("no player on the page")
    return out


def profile_page(html: str) -> list[dict]:
    """Name without shirt number, birth date as dd/MM/yyyy, position."""
    root = tree(html)
    head = root.one("h1", r"data-header__headline.*")
    if head is None:
        raise FormatError("no headline")
    born = root.one("span", itemprop="^birthDate$")
    position = None
    for label in root.all("li", "data-header__label"):
        if "Position" in label.text(" "):
            content = label.one("span", "data-header__content")
            position = content.text() if content else None
            break
    return [{"name": head.text(" ", skip="shirt-number"), "birth_date": born.text().split()[0] if born and born.text() else None, "position": position}]


def injuries_page(html: str) -> list[dict]:
    """Injuries; a page without a table has none, rows of fewer than six cells are left out."""
    body = _body(tree(html))
    out = []
    for row in body.rows() if body else []:
        cells = [c.text() for c in row.all("td")]
        if len(cells) >= 6:
            out.append({"season": cells[0], "injury": cells[1], "from_date": cells[2], "until_date": cells[3], "days": _number(cells[4]), "games_missed": _number(cells[5])})
    return out


def links(html: str) -> list[dict]:
    """Title and first heading of any page, and how many links and paragraphs it has; ``title_source`` is the title with all references but ``&amp;`` as the page writes them."""
    root = tree(html)
    title, head = root.one("title"), root.one("h1")
    source = tree(re.sub("&(?!amp;)", "&amp;", html)).one("title") if title and "&" in html else title
    return [{"title": title.text(" ") if title else None, "title_source": source.text(" ") if source else None, "heading": head.text(" ") if head else None, "n_links": len(root.all("a", href=".")), "n_paragraphs": len(root.all("p"))}]


#: Page kinds: their parser and the columns of its rows.
PAGES = {
    "competition-clubs": (competition_clubs, "club_id long, club_name string, squad_value long"),
    "kader": (squad_page, "player_id long, slug string, name string, position string, shirt_number int"),
    "profile": (profile_page, "name string, birth_date string, position string"),
    "injuries": (injuries_page, "season string, injury string, from_date string, until_date string, days long, games_missed long"),
    "links": (links, "title string, title_source string, heading string, n_links long, n_paragraphs long"),
}


def parse_pages(pages: DataFrame, kind: str) -> DataFrame:
    """(page, error, columns of the kind) for pages with columns page and html.

    A page that breaks its contract gives one row with ``error``, for callers to fail on or to count; null pages too.
    """
    parser, columns = PAGES[kind]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([("page", pa.string()), ("error", pa.string()), *((c.split()[0], types[c.split()[1]]) for c in columns.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    out += [{"page": page, **r} for r in parser(html or "")]
                except FormatError as e:
                    out.append({"page": page, "error": str(e)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return pages.select("page", "html").mapInArrow(run, f"page string, error string, {columns}")
