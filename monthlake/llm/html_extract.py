"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of tags and of text runs. Words score positive and tags negative; the best
contiguous run of tokens, found by one linear scan, is the content region. The weights come from
labelled pages, those that mark their content with an ``article`` element: a tag costs the more
the less of its occurrences lie inside the content, and a word scores by how much likelier words
are inside than outside. Menus, headers, adverts and the like (by element name, or by class, id
or role) count nothing and are left out wherever they stand, so one amid an article does not end
it. Block elements separate the blocks of the result; left-out scripts, buttons and the like
inside a line, and unknown elements, do not. Inside an article a class names a role by any of its
parts on containers, but only by its last part (``cookie-notice``, not ``comment-style``) on
headings, paragraphs, items and cells; an id only by its last part, and never on those and on
sections. A ``header`` element is left out in an article too, as the page's own is.

Reading is linear in a page's tokens: open elements are looked up by name, so unclosed ones cost
nothing.

Fitting counts a bounded sample of labelled pages (``FIT_PAGES``, chosen by url hash) and brings
back one row per kind of token; kinds come from fixed lists. Extraction is row-local: pages are
never shuffled.

Defined cases: null and blank html give an empty text; a page without words outside left-out
elements gives an empty text; broken html is read as far as it goes (an unfinished tag at the
end is markup); null urls and ids are kept; repeated rows give equal texts; pages are read whole
at any length; without labelled pages a word scores 1 and a tag -0.5; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.common import bounded_sample, ship_code

FIT_PAGES = 2000
PLAIN = "text"
# Element names by their role.
RAW = frozenset("script style noscript template textarea title svg iframe object canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = RAW | frozenset("nav header footer aside form button menu head".split())
OPTIONAL_END = frozenset("p li dt dd option tr td th thead tbody tfoot".split())
# A formula stands in its paragraph; its parts are no markup that speaks against content.
MATH = frozenset("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts "
                 "mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
                 "annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                   "span strike strong sub sup time tt u var wbr label input ruby rt rp".split()) | MATH
BLOCK = frozenset("address article blockquote body caption center dd details dialog div dl dt fieldset figcaption figure h1 h2 h3 "
                  "h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
# What an opening tag closes that was left open, and the elements that it does not reach out of.
SCOPE = frozenset("table td th caption html object template button".split())
P_CLOSERS = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure "
                      "footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul".split())
ITEMS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
         "option": frozenset(["option"])}
PARTS = frozenset("thead tbody tfoot".split())
CELLS = {"td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["td", "th", "tr"]),
         **{x: PARTS | {"td", "th", "tr"} for x in PARTS}}
# An end tag of these does not reach out of such elements.
_END_WALLS = {"p": SCOPE, "li": SCOPE | {"ul", "ol", "menu"}, "dt": SCOPE | {"dl"}, "dd": SCOPE | {"dl"},
              **{x: frozenset(["table"]) for x in CELLS}}
_CELL_WALLS, _TABLE, _PARAGRAPH = frozenset(["table", "tr"]), frozenset(["table"]), frozenset(["p"])
KNOWN = RAW | VOID | LEFT_OUT | OPTIONAL_END | INLINE | BLOCK
# What separates blocks, beside the block elements: left-out ones that stand in lines of their own.
CUTS = BLOCK | frozenset("article nav header footer aside form menu dir hgroup head title search legend".split())
# Left-out elements that stand in a line of text; nothing inside them separates blocks.
IN_LINE = (RAW - {"title"}) | {"button"}
ROLES = (r"(ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|login|menu|modal|"
         r"nav|navbar|navigation|newsletter|notice|pagination|popup|promo\w*|related|replies|share|sharing|sidebar|social|"
         r"sponsor\w*|subscribe|toolbar|widget)")
ROLE = re.compile(rf"(?:^|[\s_-]){ROLES}(?:$|[\s_-])", re.I)
LAST_ROLE = re.compile(rf"(?:^|[\s_-]){ROLES}(?:$|\s)", re.I)
# Words that also name parts of an article: on a heading, paragraph or cell they are no role there.
PART = re.compile(r"(?:header|footer|related|share|sharing|widget)\Z", re.I)
HEADING = frozenset("h1 h2 h3 h4 h5 h6 caption figcaption blockquote pre summary code".split())
TABLE_PART = frozenset("td th tr thead tbody tfoot".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?:/?[a-zA-Z][^>]*)(?:>|\Z)", re.S)
CLASS = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")


def _is_left_out(name: str, attributes: str, article: bool) -> str | None:
    """The role for which an element is left out, or None."""
    if name in LEFT_OUT:
        return name
    if not attributes or name in ("html", "body", "article", "main"):
        return None
    text = name in HEADING or name in OPTIONAL_END
    part = name in TABLE_PART or (article and text)
    for m in CLASS.finditer(attributes):
        is_id = m[1].lower() == "id"
        if article and is_id and (text or name == "section"):
            continue
        found = LAST_ROLE if article and (is_id or text) else ROLE
        value, at = m[2] or m[3] or m[4] or "", 0
        while r := found.search(value, at):
            if not (part and PART.match(r[1])):
                return "role"
            at = r.end(1)  # the separator after it may begin the next word
    return None


class _Open:
    """The open elements: name and left-out role that holds, from the outside in.

    Their places are kept by name, so that none is walked over."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str | None]] = []
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []  # what a list item does not reach out of, items themselves included

    def push(self, name: str, role: str | None) -> None:
        if name not in INLINE and name not in ("p", "div", "address"):
            self.walls.append(len(self.stack))
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, role))

    def cut(self, at: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.stack) > at:
            name, _ = self.stack.pop()
            self.places[name].pop()
            if self.walls and self.walls[-1] == len(self.stack):
                self.walls.pop()

    def last(self, names: frozenset[str]) -> int:
        """Place of the innermost open element among ``names``, or -1."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=-1)

    def first_within(self, names: frozenset[str], walls: frozenset[str]) -> int | None:
        """Place of the outermost one among ``names`` that no wall parts from the top."""
        wall, at = self.last(walls), None
        for n in names:
            places = self.places.get(n)
            if places and places[-1] > wall:
                place = places[bisect.bisect_right(places, wall)]
                at = place if at is None else min(at, place)
        return at

    def state(self) -> tuple[str, bool]:
        return (self.stack[-1][1] if self.stack else None) or PLAIN, bool(self.places.get("article"))

    def close(self, name: str) -> str | None:
        """Close by an end tag; the surroundings of the element it ends, if it ends one."""
        places = self.places.get(name)
        if not places or places[-1] < self.last(_END_WALLS.get(name, frozenset())):
            return None
        around = self.stack[places[-1]][1] or PLAIN
        self.cut(places[-1])
        return around

    def close_implied(self, name: str) -> None:
        """Close what an opening ``name`` ends: paragraphs, and siblings of the same kind."""
        at = None
        if name in ITEMS:
            # As browsers do: out of paragraphs, div and inline elements, not out of another list or block.
            if self.walls and self.stack[self.walls[-1]][0] in ITEMS[name]:
                at = self.walls[-1]
        elif name in CELLS:
            at = self.first_within(CELLS[name], _CELL_WALLS if name in ("td", "th") else _TABLE)
        if at is not None:
            self.cut(at)
        if name in P_CLOSERS and (at := self.first_within(_PARAGRAPH, SCOPE)) is not None:
            self.cut(at)


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """``(kind, text or tag name, surroundings, inside article)`` in page order.

    ``kind`` is "text", "open" or "close"; the surroundings are the left-out element that holds
    the token (or that the tag itself opens or closes), else PLAIN."""
    opened = _Open()
    state = opened.state
    at, end = 0, len(page)

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            yield "text", page[at:], *state()
            return
        if m.start() > at:
            yield "text", page[at:m.start()], *state()
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            around, article = state()
            yield "close", name, opened.close(name) or around, article
            continue
        if name in OPTIONAL_END or name in P_CLOSERS:
            opened.close_implied(name)
        held, article = state()
        role = held if held != PLAIN else _is_left_out(name, m["attributes"], article)
        yield "open", name, role or PLAIN, article
        if name in RAW and not m["attributes"].endswith("/"):
            close = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
            stop, after = (close.start(), close.end()) if close else (end, end)
            if stop > at:
                yield "text", page[at:stop], role or name, article
            at = after
            yield "close", name, role or PLAIN, article
        elif name not in VOID and not m["attributes"].endswith("/"):
            if name not in INLINE or role:
                opened.push(name, role)


def n_words(text: str) -> int:
    return len(text.split())


def token_kind(kind: str, value: str) -> str:
    if kind == "text":
        return "word"
    return f"tag:{value if value in KNOWN else 'other'}"


def count_tokens(page: str) -> Counter:
    """``(kind, inside the article)`` counts of a labelled page, left-out elements aside."""
    found: Counter = Counter()
    for kind, value, around, article in tokens(page):
        n = n_words(value) if kind == "text" else 1
        if n and around == PLAIN:
            found[token_kind(kind, value), article and value != "article"] += n
    return found


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """A positive word score and negative tag scores."""
    out = {}
    for kind in {k for k, _ in counts}:
        inside, outside = counts.get((kind, True), 0) + 0.5, counts.get((kind, False), 0) + 0.5
        if kind == "word":
            out[kind] = max(0.1, min(1.0, math.log(inside / outside)))
        else:
            out[kind] = math.log(inside / (inside + outside))  # never above 0
    return out


def score(kind: str, value: str, around: str, weights: dict[str, float]) -> float:
    if around != PLAIN:
        return 0.0
    if kind == "text":
        return n_words(value) * weights.get("word", 1.0)
    if value in MATH:
        return 0.0
    return weights.get(token_kind(kind, value), -0.5)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum (the first of equals)."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text: blocks of the best region, joined by an empty line."""
    found = list(tokens(page or ""))
    start, end = best_region([score(k, v, around, weights) for k, v, around, _ in found])
    blocks, run = [], []
    for kind, value, around, _ in found[start:end]:
        if kind == "text":
            if around == PLAIN:
                run.append(value)
        elif value == "br":
            run.append(" ")
        elif value in CUTS and around not in IN_LINE:
            blocks.append("".join(run))
            run = []
    blocks.append("".join(run))
    texts = (SPACE.sub(" ", html.unescape(b)).strip() for b in blocks)
    return "\n\n".join(t for t in texts if t)


def fit_weights(pages: DataFrame, at_most: int = FIT_PAGES) -> dict[str, float]:
    """Weights from labelled pages (those with an ``article`` element)."""
    ship_code(pages.sparkSession)
    p = pages.select("url", "html").where(F.lower("html").contains("<article"))
    p = bounded_sample(p, F.coalesce("url", F.lit("")), at_most).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: Counter = Counter()
            for page in b.column(0):
                total.update(count_tokens(page.as_py() or ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_()),
                 pa.array(list(total.values()), pa.int64())], ["kind", "inside", "n"])

    counts = p.mapInArrow(run, "kind string, inside boolean, n bigint").groupBy("kind", "inside").sum("n").collect()
    return weights_of({(k, i): n for k, i, n in counts})


def extract_pages(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    ship_code(pages.sparkSession)
    p = pages.select("page_id", "url", "html")
    if weights is None:
        weights = fit_weights(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(x.as_py(), weights) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = dict(p.dtypes)
    return p.mapInArrow(run, f"page_id {kind['page_id']}, url string, text string, n_chars bigint")
