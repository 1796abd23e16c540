"""Main text of web pages by template deduction over equivalence classes.

Tokens of a page are its tags, each with the path of elements around it, and
its text blocks. Tokens of one host that occur equally often on each of its
pages have the same occurrence vector and form an equivalence class. Classes of
enough tokens on enough pages are valid. The class that stands once on every
page is the frame of the host's template; the other valid classes are nested
into its slots, the places between two of its tokens, as parts that repeat or
may be missing. Text that belongs to a class is boilerplate; what is left are
the contents of the slots. Those inside the article stay, and those of menus,
footers, adverts and the like go. Where no article is marked, the slot with the
most text names the element directly in the body that holds the main text, and
all slots in it stay, as do headings, paragraphs and sections beside it.

Occurrence vectors are never gathered: a token's vector is summed up as the
exclusive or of a hash of (page, count) over its pages, so a host with a third
of all pages is one partial aggregate per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import stored
from panelwright.llm.base import corpus_query, table
from panelwright.llm.html import Element, Token, tokens

LEAST_CLASS = 2  # tokens of a class
LEAST_SUPPORT = 0.5  # share of the host's pages with a class
# Different pages of a host from which on a text block that stands on every one
# is taken for template text, outside a marked article; inside, all text stays.
# Copies of a page count once.
LEAST_PAGES = 10

# Elements and words of class, id or role of what is not main text.
ASIDE = frozenset(
    "nav header footer aside form button select menu dialog head fieldset figure.ad".split()
)
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "header footer masthead comment comments reply replies respond disqus share sharing social related "
    "recommended newsletter subscribe subscription login signup search form widget pagination pager copyright "
    "hidden contentinfo complementary".split()
)
# What may stand beside such a word in a name with hyphens. Other names, such as
# comments-open or header-fixed, tell of a state and not of what the element is.
ASIDE_PARTS = frozenset(
    "area bar block bottom box btn button buttons container content footer global group holder icons inner item items "
    "left link links list main nav outer page panel post posts primary right secondary section site slot social sub "
    "thread top unit wrap wrapper".split()
)
MAIN, MAIN_WORDS = frozenset(["article", "main"]), frozenset(["main", "article"])

STATS = "host string, token long, is_text boolean, n long, place double, page long"


def host_of(url: Column) -> Column:
    """The address's host in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def token_key(token: Token) -> int:
    """A signed 64-bit hash of a token."""
    raw = f"{token.kind}\n{token.element.key}\n{token.text}"
    return int(np.uint64(xxhash.xxh64_intdigest(raw.encode("utf-8", "replace"))).view(np.int64))


def _page_stats(found: list[Token]) -> dict[int, list]:
    """Per distinct token whether it is text, how often and where it first is."""
    stats: dict[int, list] = {}
    for place, token in enumerate(found):
        entry = stats.setdefault(token_key(token), [token.kind == "text", 0, place / len(found)])
        entry[1] += 1
    return stats


def occurrences(pages: DataFrame) -> DataFrame:
    """One row per different page of a host and distinct token of it, see STATS;
    token 0 stands for the page itself. Pages with equal html are one page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in STATS.split(", ")]
        for batch in batches:
            rows = []
            for host, page, html in zip(batch["host"], batch["page"], batch["html"]):
                rows.append((host, 0, False, 1, -1.0, page))
                for key, (is_text, n, place) in _page_stats(tokens(html)).items():
                    rows.append((host, key, is_text, n, place, page))
                if len(rows) > 200_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        host_of(F.col("url")).alias("host"), F.xxhash64(html).alias("page"), html.alias("html")
    )
    return rows.mapInPandas(run, STATS).distinct()


def templates(pages: DataFrame) -> DataFrame:
    """One row per host: host, template (array of token, class, root), its valid
    classes in page order. A class is valid if it has enough tokens and occurs
    on enough pages; the root class has the vector of the page itself."""
    of_token = (
        occurrences(pages)
        .groupBy("host", "token")
        .agg(
            F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
            F.count("*").alias("pages"),
            F.sum("n").alias("n"),
            F.avg("place").alias("place"),
            F.first("is_text").alias("is_text"),
        )
    )
    # Written, for it is read twice and costs a pass over all pages.
    of_token = stored(of_token, "tokens")
    of_host = of_token.where("token = 0").select(
        "host", F.col("pages").alias("host_pages"), F.col("vector").alias("host_vector")
    )
    # Text on too few pages for any host that learns texts need not be joined.
    frequent = ~F.col("is_text") | (F.col("pages") >= LEAST_PAGES * LEAST_SUPPORT)
    known = of_token.where("token <> 0").where(frequent).join(of_host, "host")
    known = known.where(F.col("pages") >= F.col("host_pages") * LEAST_SUPPORT).where(
        ~F.col("is_text") | (F.col("host_pages") >= LEAST_PAGES)
    )
    classes = known.groupBy("host", "vector", "pages", "n").agg(
        F.count("*").alias("size"),
        F.first(F.col("vector") == F.col("host_vector")).alias("root"),
        F.min("is_text").alias("only_text"),
        # At most 1 / LEAST_SUPPORT times the tokens of a page, over all classes.
        F.sort_array(F.collect_list(F.struct("place", "token"))).alias("tokens"),
    )
    # Blocks that no tag goes along with are copies, not a template.
    valid = classes.where(~F.col("only_text") & (F.col("root") | (F.col("size") >= LEAST_CLASS)))
    return valid.groupBy("host").agg(
        F.sort_array(
            F.collect_list(F.struct((~F.col("root")).alias("inner"), "vector", F.col("tokens.token").alias("tokens")))
        ).alias("template")
    )


class Template:
    """The valid classes of a host: the frame, and the classes nested in it."""

    def __init__(self, classes) -> None:
        classes = [] if classes is None else list(classes)
        self.frame = {t for c in classes if not c["inner"] for t in c["tokens"]}
        self.nested = {t for c in classes if c["inner"] for t in c["tokens"]}

    def slots(self, found: list[Token]) -> list[Block]:
        """The text blocks that belong to no class, and all that are in a marked
        article. A slot ends at a token of the frame; nested classes part no
        slot, so a list that repeats is one content."""
        out, slot, around, places = [], 0, [found[0].element if found else None], {}
        for token in found:
            key, element = token_key(token), token.element
            if key in self.frame:
                slot += 1
                if token.kind == "open":
                    places[element.key] = len(around)
                    around.append(element)
                elif token.kind == "close" and places.get(element.key, len(around)) < len(around):
                    del around[places.pop(element.key) :]
            if token.kind == "text":
                out.append(Block(token.text, element, slot, around[-1].key if len(around) > 1 else 0, key in self.frame or key in self.nested))
        return out


class Block(NamedTuple):
    text: str
    element: Element
    slot: int  # number of the slot
    around: int  # key of the slot's element, 0 if there is none
    known: bool  # whether it belongs to a class


class Marks:
    """What the elements of a page are, carried down from each to what it holds;
    all lists go by the element's number."""

    def __init__(self, found: list[Token]) -> None:
        first = found[0].element if found else None
        root = first.parent if first and found[0].kind == "open" else first
        self.elements = [root, *(t.element for t in found if t.kind == "open")] if root else []
        # The outermost article or main element around, and the element around
        # that stands directly in the body.
        self.main: list[Element | None] = []
        self.top: list[str] = []
        for e in self.elements:
            main, top = (self.main[e.parent.number], self.top[e.parent.number]) if e.parent else (None, "")
            if e.parent and main is None and (e.name in MAIN or not MAIN_WORDS.isdisjoint("-".join(e.words).split("-"))):
                main = e
            if e.parent and not top and e.name not in ("html", "body"):
                top = e.label
            self.main.append(main)
            self.top.append(top)

    def asides(self, wraps: Callable[[Element], bool] = lambda e: False, forms: bool = True) -> list[bool]:
        """Whether an element is in what is not main text. A header inside an
        article is the article's own. The names of main and of an article that
        is in no other tell nothing of it. Forms and names of elements that wrap
        the page tell nothing either; without `forms` no form does."""
        out, in_article = [], []
        for e in self.elements:
            if not e.parent:
                out.append(False)
                in_article.append(False)
                continue
            aside, inside, name = out[e.parent.number], in_article[e.parent.number], e.name
            if not aside and (forms or name != "form"):
                wrap = wraps(e)
                own = name in ("html", "body", "main") or name == "article" and not inside
                aside = (
                    name in ASIDE and not (name == "header" and inside) and not (name == "form" and wrap)
                ) or (not own and not wrap and any(map(_is_aside_name, e.words)))
            out.append(aside)
            in_article.append(inside or name in MAIN)
        return out

    def wrapped_by(self, root: Element) -> list[bool]:
        """`asides` of a page that the elements around `root` wrap."""
        keys, at = set(), root
        while at and at.parent:
            keys.add(at.key)
            at = at.parent
        return self.asides(lambda e: e.key in keys)


def _is_aside_name(name: str) -> bool:
    """Whether a class, id or role is a word of ASIDE_WORDS, or made of such and
    of ASIDE_PARTS."""
    if name in ASIDE_WORDS:
        return True
    runs = name.split("-")
    return not ASIDE_WORDS.isdisjoint(runs) and all(r in ASIDE_WORDS or r in ASIDE_PARTS for r in runs)


def is_aside(path: str) -> bool:
    """`Marks.asides` for the last element of a path."""
    found = [Element(None, "", 0)]
    for i, name in enumerate(path.split("/")[1:]):
        found.append(Element(found[-1], name, i + 1))
    return Marks([Token("open", e, "") for e in found[1:]]).asides()[-1]


def _heaviest(blocks: list[Block], framed: bool) -> tuple[int, int, Element]:
    """The slot with the most text: its number, the key of its element and the
    element of a block in it. Without a frame every element that holds the
    elements of texts is a slot."""
    mass: Counter = Counter()
    holder: dict = {}
    for i, block in enumerate(blocks):
        parent = block.element.parent
        at = (block.slot, block.around) if framed else (0, parent.key if parent else 0)
        mass[at] += len(block.text)
        holder.setdefault(at, (i, block.element))
    number, key = max(mass, key=lambda s: (mass[s], -s[0], holder[s][0]))
    return number, key, holder[number, key][1]


def _above(element: Element, key: int) -> Element:
    """The element with a key that holds `element`, or else the outermost."""
    while element.parent and element.key != key:
        element = element.parent
    return element


def _unmarked(blocks: list[Block], framed: bool, marks: Marks) -> list[Block]:
    """The main blocks of a page without an article: all but those in a div of
    another kind that stands in the body behind the heaviest slot's element."""
    number, key, inside = _heaviest(blocks, framed)
    top = marks.top[_above(inside, key).number]
    if not top:
        return blocks
    below: list[bool] = []
    for e in marks.elements:
        below.append(bool(e.parent) and (below[e.parent.number] or e.parent.key == key))
    out, behind = [], False
    for block in blocks:
        mine = marks.top[block.element.number]
        behind |= (block.slot, block.around) == (number, key) if framed else below[block.element.number]
        if mine == top or not behind or mine.split(".")[0] != "div":
            out.append(block)
    return out


def _wrapped(blocks: list[Block], clear: list[Block], framed: bool, marks: Marks) -> Element | None:
    """The element whose forms and names around are wrappers of the page, if
    no main or article is clear of them: a main or article with more text than
    what is clear, else the heaviest slot if it is in a form or nothing is clear."""
    # Forms and names at and above the article itself wrap it.
    above = [main is None or main is e for e, main in zip(marks.elements, marks.main)]
    within = marks.asides(lambda e: above[e.number])
    roots: Counter = Counter()
    first: dict = {}
    for block in blocks:
        root = marks.main[block.element.number]
        if root is None or within[block.element.number]:
            continue
        if root.name == "main" or not any(map(_is_aside_name, root.words)):
            first.setdefault(root.key, root)
            roots[root.key] += len(block.text)
    if roots:
        key, size = max(roots.items(), key=lambda r: (r[1], first[r[0]].number))
        if size > sum(len(b.text) for b in clear):
            return first[key]
    # With nothing clear names may wrap as well; else only forms may.
    hard = marks.asides(lambda e: True)
    loose = [b for b in blocks if not hard[b.element.number]]
    if clear:
        formless = marks.asides(forms=False)
        loose = [b for b in loose if not formless[b.element.number]]
    if not loose:
        return None
    _, key, inside = _heaviest(loose, framed)
    return _above(inside, key)


def main_text(html: str, template: Template) -> str:
    """The blocks of the main slots, joined by an empty line."""
    found, framed = tokens(html), bool(template.frame)
    marks = Marks(found)
    slots = [b for b in template.slots(found) if not b.known or marks.main[b.element.number]]
    aside = marks.asides()
    blocks = [b for b in slots if not aside[b.element.number]]
    inside = [b for b in blocks if marks.main[b.element.number]]
    if not inside and len(blocks) < len(slots):
        wrapped = _wrapped(slots, blocks, framed, marks)
        if wrapped is not None and wrapped.parent:
            aside = marks.wrapped_by(wrapped)
            blocks = [b for b in slots if not aside[b.element.number]]
            inside = [b for b in blocks if marks.main[b.element.number]]
    if not inside and blocks:
        inside = _unmarked(blocks, framed, marks)
    return "\n\n".join(b.text for b in inside)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page (page_id, url, html): page_id, url, text, n_chars.

    Whole pages are read. A null html gives an empty text; pages without a host
    share one template; repeated rows each give a row; a host of few pages has
    a template of tags only. An empty table gives an empty result. The work is
    linear in a page, also where elements nest without end; a task holds a
    page's tokens, some 300 bytes each."""
    known = stored(templates(pages), "templates")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, Template] = {}
        for batch in batches:
            texts = []
            for host, classes, html in zip(batch["host"], batch["template"], batch["html"]):
                if host not in cache:
                    if len(cache) >= 1000:
                        cache.clear()
                    cache[host] = Template(classes)
                texts.append(main_text(html or "", cache[host]))
            yield pd.DataFrame(
                {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": list(map(len, texts))}
            )

    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    # Templates are broadcast while they are few, by Spark's own threshold;
    # else pages meet them by host, a hot host dealt out by adaptive skew join.
    return rows.join(known, "host", "left").mapInPandas(
        run, "page_id long, url string, text string, n_chars long"
    )


@corpus_query("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
