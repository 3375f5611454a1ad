"""Main text of web pages by two passes over their blocks.

The first pass decides blocks by where they stand and by link density, length and stop-word density.
Short blocks stay open; in the second pass they take the label of the nearest decided neighbour.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent words of the four languages.
STOP_WORDS = frozenset(
    "a about after all also an and any are as at be because been but by can could do for from had has have he her here his "
    "how i if in into is it its like more most my no not now of on one only or other our out over she so some such than "
    "that the their them then there these they this to up was we were what when which who will with would you your "
    "au aux avec ce ces cette comme dans de des donc du elle en est et être il ils je la le les leur lui mais ne nous on "
    "ou où par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "aber als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr "
    "im ist kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn werden wie "
    "wir wird zu zum zur "
    "al algo como con cual cuando del desde donde dos el ella ellos entre era eres esa ese eso esta este esto está ha hay "
    "las lo los más me mi muy nada ni nos o para pero por porque quien ser si sin sobre su sus también te tiene toda todo "
    "tu unos y ya".split()
)
# Elements and attribute words of HTML pages.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe math noembed noframes noscript object script select style svg template textarea title".split())
RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
SELF_ENDING = frozenset("dd dt li option td th tr".split())
ITEMS = frozenset("dd dt li option".split())
BOILERPLATE = frozenset("aside button dialog footer menu nav".split())  # whatever they hold
MAYBE_BOILERPLATE = frozenset("form header".split())  # unless an article lies in or around them
MAIN = frozenset("article main".split())
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice pagination popup "
    "promo promotion related respond share sharing sidebar skip social sponsor sponsored subscribe subscription tags "
    "teaser toolbar widget".split()
)
# A bad word behind or before one of these tells a state or a layout: has-sidebar, layout-sidebar-right, comments-open.
STATE_BEFORE = frozenset("no not has have with without hide is layout".split())
STATE_AFTER = frozenset("open opened closed off on enabled disabled active inactive visible".split())
NEVER_NAMED = frozenset("html body main article".split())  # not judged by their names
BAD_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

# A quote opens a value right after an equals sign only, so a stray one does not swallow the end of the tag.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>", re.S
)
UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+/\Z")  # the slash belongs to a value: <a href=/tag/1/>
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MAIN_TAG = re.compile(r"<(?:article|main)\b", re.I)
SPACE = re.compile(r"\s+")


@dataclass
class Rules:
    link_density: float = 0.33
    list_density: float = 0.9  # share of linked text from which a block is a list of links
    list_links: int = 3
    short: int = 70
    stop_words_high: float = 0.30
    stop_words_low: float = 0.15
    words: frozenset[str] = STOP_WORDS


@dataclass
class Block:
    main: int  # number of the article the block lies in, 0 for none
    bad: bool
    item: bool = False  # in a list
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    links: set[int] = field(default_factory=set)
    text: str = ""

    def close(self) -> None:
        self.text = SPACE.sub(" ", "".join(self.pieces)).strip()


@dataclass
class Open:
    """An open element."""

    name: str
    main: int
    bad: bool
    soft: bool  # bad only as long as no article begins inside
    link: int  # number of the link around it, 0 for none
    item: bool


def _bad_name(name: str) -> bool:
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    return any(
        p in BAD_NAMES and STATE_BEFORE.isdisjoint(parts[:i]) and STATE_AFTER.isdisjoint(parts[i + 1 :])
        for i, p in enumerate(parts)
    )


def _marked(attributes: str) -> tuple[bool, bool]:
    """Do the attributes tell that the element is no part of the main text: by role or visibility, by its names?"""
    named = False
    for m in ATTRIBUTE.finditer(attributes):
        name = m.group(1).lower()
        value = m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id"):
            named = named or any(map(_bad_name, value.split()))
        elif name == "role":
            if value.lower() in BAD_ROLES:
                return True, named
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, named
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, named
    return False, named


def _end_implied(stack: list[Open], name: str) -> None:
    """A block ends an open paragraph, and an item ends the item before it, with all inline elements inside."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == "p" or stack[i].name == name and name in SELF_ENDING:
            del stack[i:]
        elif stack[i].name in BLOCKS:
            return


def blocks(page: str, strict: bool = True) -> list[Block]:
    """The blocks of a page in page order, with the text, its linked share and its place.

    `strict`: an article inside an element with a bad name is none. If not, bad names outside of articles only hold
    for what lies in no article.
    """
    out: list[Block] = []
    stack = [Open("", 0, False, False, 0, False)]
    current: Block | None = None
    mains, at, breaks, links = 0, 0, 0, 0

    def close() -> None:
        nonlocal current
        if current is not None:
            current.close()
            if current.text:
                out.append(current)
        current = None

    def add(raw: str) -> None:
        nonlocal current, breaks
        if not raw:
            return
        text = references.unescape(raw) if "&" in raw else raw
        if text.strip():
            breaks = 0
        top = stack[-1]
        if current is not None and current.bad != (top.bad or top.soft):
            close()
        if current is None:
            current = Block(top.main, top.bad or top.soft, top.item)
        current.pieces.append(text)
        if top.link:
            current.linked += len(SPACE.sub("", text))
            current.links.add(top.link)

    while m := TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:  # a comment or a declaration
            continue
        name = m.group(2).lower()
        if m.group(1):
            if name in BLOCKS:
                close()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        if name == "br":
            breaks += 1
            close() if breaks > 1 else add(" ")
            continue
        if name in BLOCKS:
            close()
            breaks = 0
            _end_implied(stack, name)
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        if name in VOID or m.group(3).endswith("/") and not UNQUOTED_END.search(m.group(3)):
            continue
        top = stack[-1]
        hard, named = _marked(m.group(3)) if m.group(3).strip() else (False, False)
        named = named and name not in NEVER_NAMED
        bad = top.bad or name in BOILERPLATE or hard or named and (strict or top.main > 0)
        soft = top.soft or not top.main and (name in MAYBE_BOILERPLATE or named)
        main = top.main
        if name in MAIN and not bad:
            if not main:
                mains += 1
                main = mains
            soft = False
        links += name == "a"
        link = top.link or (links if name == "a" else 0)
        stack.append(Open(name, main, bad, soft, link, top.item or name in ITEMS))
    add(page[at:])
    close()
    return out


def first_pass(block: Block, marked: bool, rules: Rules) -> bool | None:
    """True: main text, False: boilerplate, None: open. `marked`: the page says where its article is."""
    if block.bad or marked and not block.main:
        return False
    size = len(block.text)
    solid = len(block.text.replace(" ", ""))
    if block.main:  # of an article only lists of links go, not a paragraph or a heading with links
        if block.linked > rules.list_density * solid and (block.item or len(block.links) >= rules.list_links):
            return False
        return True if size >= rules.short else None
    if block.linked > rules.link_density * solid:
        return False
    if "©" in block.text:
        return False
    if size < rules.short:
        return None
    words = [w.strip(".,;:!?\"'()").lower() for w in block.text.split()]
    density = sum(w in rules.words for w in words) / len(words)
    if density >= rules.stop_words_high:
        return True
    return None if density >= rules.stop_words_low else False


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest block of the same article that its text decided; of two at one
    distance, main text wins. With none, they stay inside an article and go outside."""

    def nearest(order: range) -> list[int | None]:
        last: dict[int, int] = {}
        out: list[int | None] = [None] * len(labels)
        for i in order:
            if labels[i] is None:
                out[i] = last.get(found[i].main)
            elif not found[i].bad:
                last[found[i].main] = i
        return out

    before, after = nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1))
    out = []
    for i, label in enumerate(labels):
        if label is None:
            near = [j for j in (before[i], after[i]) if j is not None]
            least = min((abs(i - j) for j in near), default=0)
            label = any(labels[j] for j in near if abs(i - j) == least) if near else found[i].main > 0
        out.append(label)
    return out


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The main text of a page: one line per block. Null, empty and text-free pages have none."""
    found = blocks(page or "")
    marked = any(b.main and not b.bad for b in found)
    if not marked and page and MAIN_TAG.search(page):  # all articles may lie in wrappers with bad names
        again = blocks(page, strict=False)
        if any(b.main and not b.bad for b in again):
            found, marked = again, True
    labels = second_pass(found, [first_pass(b, marked, rules) for b in found])
    return "\n".join(b.text for b, good in zip(found, labels) if good)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row. Other columns are ignored, nothing is shuffled."""
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = source.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules()
        for batch in batches:
            text = [main_text(h.as_py(), rules) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
