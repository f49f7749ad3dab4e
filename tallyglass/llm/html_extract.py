"""Main text of web pages by differencing each page with its nearest neighbour by URL.

1. A page becomes a list of text lines, one per block, each with its place (path of block elements) and role.
2. Pages of a host with the same lines are one page from then on, so that no page is compared with a copy of itself.
   They are sorted by host and URL path; a page's partner is the neighbour of the same host whose path shares the longer
   beginning. A neighbour that shares nearly all text is another copy (a recrawl, a mirror) and no partner.
3. The line sequences of both are aligned by their longest common subsequence. Shared lines are template and are deleted, all but those
   inside an explicit article, since a neighbour may carry a copy of the same article.
4. Of what is left, lines of menus, headers, footers, sidebars, notices, adverts, forms and comments go as well, since a
   site may vary their wording from page to page, and a page alone on its host has no partner.

The sort is a range partition, so a hot host spreads over many tasks; only the two outermost rows of each partition
are passed on to the next one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, stored

#: Part of the text outside template elements, of either page, from which on two pages that share it are copies.
COPY = 0.9

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol option p pre"
    " search section select summary table tbody td textarea tfoot th thead title tr ul video".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea title".split())
TEMPLATE = frozenset("nav header footer aside form menu dialog button select fieldset head search".split())
#: What ends an open paragraph, what stays in the head, and what an element left open cannot reach out of.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li dd dt main menu nav ol p pre search section summary table ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_P_SCOPE = frozenset("button caption html marquee object table td th".split())
_ITEM_SCOPE = BLOCKS - {"address", "div", "p"}
#: By start tag: the elements it ends if their end tag was left out, and where the search for them ends.
_TABLE = frozenset({"table"})
_ROWS = frozenset("caption colgroup tbody thead tfoot tr td th".split())
_ENDS = {
    **dict.fromkeys(_ENDS_P, (frozenset({"p"}), _P_SCOPE)),
    **dict.fromkeys(("td", "th"), (frozenset({"caption", "td", "th"}), _TABLE | {"tr"})),
    "tr": (frozenset({"caption", "colgroup", "tr", "td", "th"}), _TABLE | {"tbody", "thead", "tfoot"}),
    **dict.fromkeys(("tbody", "thead", "tfoot", "caption", "colgroup"), (_ROWS, _TABLE)),
    "option": (frozenset({"option"}), frozenset({"select", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
}
_ITEMS = {"li": frozenset({"li"}), "dd": frozenset({"dd", "dt"}), "dt": frozenset({"dd", "dt"})}
#: Words of class, id and role attributes that mark template blocks.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|header|footer|masthead|sidebar|aside|"
    r"cookies?|consent|notices?|newsletter|subscri\w+|popup|modal|comments?|replies|disqus|share|sharing|social|related|"
    r"widgets?|login|signup|search|complementary|contentinfo|navigation|dialog|alert)(?:$|[\s_-])",
    re.I,
)
#: An attribute by the rules of HTML: a quote delimits a value right after the equals sign only; anywhere else it is a character like others.
_NAME = r"(?:=[^\s/>=]*+|[^\s/>=]++)"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![A-Za-z])[^>]*(?:>|\Z)|"
    rf"<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|{_NAME}(?:\s*+=\s*+(?:{_VALUE}|(?=>))|(?!\s*+=)))*+)>|"
    # No end before that of the page, or a value whose quote is never closed.
    r"<[/A-Za-z].*\Z|[^<]+|<",
    re.S,
)
FORM, MARKED = 1, 2
#: The same inside an article, whose own headings are content: there a whole class must say so, not a part of a compound name.
_MARKED_INSIDE = re.compile(
    _MARKED.pattern.replace("header|", "").replace("masthead|", "").replace(r"[\s_-]", r"\s"), re.I
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?")


class Line:
    """Text of a block, where it stands, whether template elements hold it, and whether an article does."""

    __slots__ = ("article", "place", "template", "text")

    def __init__(self, text: str, place: str, template: bool, article: bool):
        self.text, self.place, self.template, self.article = text, place, template, article

    @property
    def key(self) -> int:
        return xxhash.xxh3_64_intdigest(f"{self.place}\0{self.text}") - (1 << 63)


def _template(name: str, attributes: str, in_article: bool) -> int:
    """0, or MARKED if the element is template; FORM if nothing but its name says so of a form."""
    if _is_marked(name, attributes, in_article):
        return MARKED
    return FORM if name == "form" else 0


def _is_marked(name: str, attributes: str, in_article: bool) -> bool:
    if name in TEMPLATE and name != "form":
        # An article's own header holds its headline.
        return not (name == "header" and in_article)
    marked = _MARKED_INSIDE if in_article else _MARKED
    for kind, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        kind, value = kind.lower(), next((v for v in values if v), "")
        if kind == "hidden" or (kind == "aria-hidden" and value.lower() == "true"):
            return True
        if kind in ("class", "id", "role") and name not in ("html", "body", "article", "main") and marked.search(value):
            return True
    return False


def _close(stack: list[tuple[str, int, bool]], names: frozenset[str], scope: frozenset[str]) -> None:
    """End the outermost of the open elements of these names that stands inside ``scope``, with all it holds."""
    at = None
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in names:
            at = i
        elif stack[i][0] in scope:
            break
    if at is not None:
        del stack[at:]


def _close_left_open(stack: list[tuple[str, int, bool]], name: str) -> None:
    """End the elements whose end tag may be left out before the start tag of ``name``."""
    if stack and stack[-1][0] == "head" and name not in _IN_HEAD:
        stack.pop()
    if name in _ITEMS:
        _close(stack, _ITEMS[name], _ITEM_SCOPE - _ITEMS[name])
    if name in _ENDS:
        _close(stack, *_ENDS[name])
    if name in _HEADINGS and stack and stack[-1][0] in _HEADINGS:
        stack.pop()


def _in_template(stack: list[tuple[str, int, bool]]) -> bool:
    """Whether an open element is template. A form round the page is not for the article it holds."""
    state = 0
    for _, template, article in stack:
        state = max(0 if article and state == FORM else state, template)
    return state > 0


def lines_of(page: str) -> list[Line]:
    """The text lines of a page, in page order; markup, scripts and styles are gone, references decoded."""
    out: list[Line] = []
    parts: list[str] = []
    # Open elements: name, template, article.
    stack: list[tuple[str, int, bool]] = []

    def close_line() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            place = "/".join(name for name, _, _ in stack if name in BLOCKS)
            out.append(Line(text, place, _in_template(stack), any(a for _, _, a in stack)))

    position = 0
    while position < len(page):
        found = _TOKEN.match(page, position)
        position, token, name = found.end(), found.group(), found.group(2)
        if name is None:
            # What is not text is a comment, a declaration or a tag that the end of the page cuts off.
            if not re.match(r"<[!?/A-Za-z]", token):
                if stack and stack[-1][0] == "head" and not token.isspace():
                    stack.pop()
                parts.append(token)
            continue
        name, attributes = name.lower(), found.group(3)
        if name in RAW and not found.group(1):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, position)
            position = end.end() if end else len(page)
            close_line() if name in BLOCKS else None
            continue
        if name in BLOCKS:
            close_line()
        if name == "hr":
            _close_left_open(stack, name)
        if name in EMPTY or attributes.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if not found.group(1):
            _close_left_open(stack, name)
            article = name in ("article", "main")
            inside = article or any(a for _, _, a in stack)
            stack.append((name, _template(name, attributes, inside), article))
        elif any(open_[0] == name for open_ in stack):
            while stack.pop()[0] != name:
                pass
    close_line()
    return out


def common(a: list[int], b: list[int]) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``.

    Rows of the table are bit strings, so a row costs as many machine words as ``a`` has 64 lines.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared = {*range(head), *range(len(a) - tail, len(a))}
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not a or not b or not set(a) & set(b):
        return shared
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    # A zero at bit i of a row: the subsequence of a[: i + 1] is one longer than that of a[: i].
    row, rows = full, [full]
    for x in b:
        match = row & where.get(x, 0)
        row = ((row + match) | (row - match)) & full
        rows.append(row)
    i, j = len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            shared.add(head + i)
        elif _zeros(rows[j - 1], i) == _zeros(rows[j], i):
            j -= 1
        else:
            i -= 1
    return shared


def _zeros(row: int, n: int) -> int:
    return n - (row & (1 << n) - 1).bit_count()


def _where(url: str | None) -> tuple[str, str]:
    """Host and path. A URL that cannot be read is a host of its own."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return url or "", ""


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "html"):
        places = [_where(u) for u in batch.column("url").to_pylist()]
        lines = [lines_of((h or b"").decode("utf-8", "replace")) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("html_hash"), pa.array([h for h, _ in places], pa.string()),
                pa.array([p for _, p in places], pa.string()),
                pa.array([[x.key for x in page] for page in lines], pa.list_(pa.int64())),
                # Sharing decides about every line outside articles.
                pa.array([[i for i, x in enumerate(page) if not x.article] for page in lines], pa.list_(pa.int32())),
                pa.array([[0 if x.template else len(x.text) for x in page] for page in lines], pa.list_(pa.int32())),
            ],
            names=["page_id", "html_hash", "host", "path", "keys", "open", "sizes"],
        )


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _shared_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each row, outside articles, that its nearer neighbour shares. Rows come sorted; borrowed rows lend only themselves."""
    before, now = None, None
    names = ("host", "lines", "lines2", "path", "keys", "open", "sizes", "borrowed")

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)
        yield None

    found = []

    def out():
        host, lines, lines2, shared = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(lines, pa.int64()), pa.array(lines2, pa.int64()), pa.array(shared, pa.list_(pa.int32()))],
            names=["host", "lines", "lines2", "shared"],
        )

    for after in rows():
        if now and not now[7]:
            near = [x for x in (before, after) if x and x[0] == now[0]]
            for partner in sorted(near, key=lambda x: -_alike(x[3], now[3])):
                shared = common(now[4], partner[4])
                size = sum(now[6][i] for i in shared)
                if size and size >= COPY * max(sum(now[6]), sum(partner[6])):
                    continue
                if shared := shared.intersection(now[5]):
                    found.append((*now[:3], sorted(shared)))
                break
        before, now = now, after
        if len(found) >= 1000:
            yield out()
            found.clear()
    if found:
        yield out()


def _main_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "html"):
        texts = []
        for page, shared in zip(batch.column("html").to_pylist(), batch.column("shared").to_pylist(), strict=True):
            gone = set(shared or ())
            texts.append(
                " ".join(
                    x.text
                    for i, x in enumerate(lines_of((page or b"").decode("utf-8", "replace")))
                    if not x.template and i not in gone
                )
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def shared_lines(pages: DataFrame) -> DataFrame:
    """``page_id, html_hash, shared``: numbers of the lines a page shares with its partner, outside articles, for pages that have any."""
    same = ["host", "lines", "lines2"]
    order = ["host", "path", "lines", "lines2"]
    columns = [*order, "keys", "open", "sizes"]
    # Stored first: the rows are read several times, and the pages should be parsed for it once. Equal lists of lines have equal hashes.
    lines = stored(
        pages.mapInArrow(
            _keys, "page_id long, html_hash long, host string, path string, keys array<long>, open array<int>, sizes array<int>"
        ).withColumns({"lines": F.xxhash64("keys", "open"), "lines2": F.xxhash64(F.lit(1), "keys", "open")}),
        "lines",
    )
    # Copies on a host stand where the first of them stands.
    distinct = (
        lines.groupBy(*same).agg(F.min(F.struct("path", "keys", "open", "sizes")).alias("page")).select(*same, "page.*")
    )
    keyed = stored(
        distinct.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()),
        "page-lines",
    )
    # Each partition borrows the last row of the one before it and the first of the one after: two rows a partition.
    row = F.struct(*columns)
    edges = stored(keyed.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last")), "edges")
    # A number per partition; the rows themselves stay where they are.
    by_part = Window.orderBy("part")
    places = edges.select("part", F.lead("part").over(by_part).alias("next"), F.lag("part").over(by_part).alias("previous"))
    lent = edges.join(F.broadcast(places), "part")
    borrowed = (
        lent.select(F.col("next").alias("part"), F.col("last").alias("row"))
        .unionByName(lent.select(F.col("previous").alias("part"), F.col("first").alias("row")))
        .where("part is not null")
        .select("row.*", "part", F.lit(True).alias("borrowed"))
    )
    shared = (
        keyed.select(*columns, "part", F.lit(False).alias("borrowed"))
        .unionByName(borrowed)
        .repartition("part")
        .sortWithinPartitions("part", *order)
        .select(*columns, "borrowed")
        .mapInArrow(_shared_lines, "host string, lines long, lines2 long, shared array<int>")
    )
    return lines.select("page_id", "html_hash", *same).join(shared, same).select("page_id", "html_hash", "shared")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of each page, one row per row of ``pages``.

    White space inside a block is one space; blocks follow in page order, one space apart. Null and empty pages have the empty
    text. A page without a neighbour on its host, or with copies of itself only, loses template blocks only. A null URL is an empty host and path. Pages
    that repeat an id and html get equal texts. Extra columns are ignored; an empty table gives an empty result.
    """
    text = F.col("html").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("html_hash"),
        text.cast("binary").alias("html"),
    )
    shared = stored(shared_lines(rows), "shared-lines").groupBy("page_id", "html_hash").agg(F.first("shared").alias("shared"))
    shared = shared.withColumnsRenamed({"page_id": "__page_id", "html_hash": "__html_hash"})
    same = F.col("page_id").eqNullSafe(F.col("__page_id")) & (F.col("html_hash") == F.col("__html_hash"))
    return rows.join(shared, same, "left").select("page_id", "url", "html", "shared").mapInArrow(
        _main_text, "page_id long, url string, text string, n_chars long"
    )
