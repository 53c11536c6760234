"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require

# A tag from its "<" to its ">". No part can begin again where it has been, so a match costs what it reads; an unquoted
# "<" ends the attempt.
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/><]*+)"
    r"((?:\s++|/|=|[^\s/>=<]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'<][^\s><]*+))?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s/>=<]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'<][^\s><]*+)))?+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")

# Elements whose content is data, not markup.
_RAW_END = {t: re.compile(rf"</{t}\b[^<>]*+>", re.I) for t in ("script", "style", "textarea", "title", "iframe", "xmp")}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements that are never read.
_UNREAD = {"head", "template", "noscript", "svg", "math", "object", "audio", "video", "canvas", "select", "button", "datalist"}
# Elements that stand around an article.
_BESIDE = {"nav", "footer", "aside", "form", "menu", "dialog"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# A new one ends an open one of these, up to the element that holds them.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",)}
_HOLDS = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "tbody", "thead"}
# Parts of a text, whose headings stand beside them.
_PIECES = {"p", "pre", "li", "blockquote", "ul", "ol", "dl", "dt", "dd", "tr", "td", "tbody", "thead", "tfoot", "table"}
# Words in names of parts that surround an article.
_AROUND = (
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner comment comments "
    "reply replies disqus respond sidebar sidebars menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations pagination pager widget copyright search "
    "complementary contentinfo").split()
_NOT_BEFORE = "(?<!no-)(?<!no_)(?<!has-)(?<!has_)(?<!with-)(?<!with_)(?<!without-)"
_AROUND_NAME = re.compile(rf"(?:^|[\s_-]){_NOT_BEFORE}(?:{'|'.join(_AROUND)})(?=$|[\s_-]|\d)", re.I)
_HEADER_NAME = re.compile(r"(?:^|\s)(?:site-|page-)?(?:header|banner)(?=$|\s)", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: A path is content from this share of the largest value on; of a page without an article element, a block beside content from the lower one.
SHARE, LOWER_SHARE = 0.6, 0.35
#: What text counts inside an element that stands around articles, inside an article in an article (a reader's word, as a
#: rule), and outside the article or main elements of a page that has any.
BESIDE, NESTED, OUTSIDE = 0.002, 0.4, 0.3


@dataclass
class _Block:
    path: int
    element: int
    tag: str
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class _Page:
    """Text blocks in page order, and the tree of elements: 0 is the page, children follow their parents.

    ``last`` is the largest number inside an element. ``beside`` lists elements that by tag, name or style stand around an
    article, ``unread`` those that are never read.
    """

    blocks: list[_Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: [""])
    last: list[int] = field(default_factory=lambda: [0])
    beside: list[int] = field(default_factory=list)
    paths: list[str] = field(default_factory=lambda: [""])


def _attributes(rest: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), a or b or c)
    return found


def read_page(page: str) -> _Page:
    """Blocks and elements of a page in one pass; every step costs what it reads, closes or opens."""
    out = _Page()
    known_paths: dict[tuple[int, str], int] = {}
    # Open elements: (tag, number, path, place of the nearest one here that isn't inline, unread).
    stack: list[tuple[str, int, int, int, bool]] = [("", 0, 0, 0, False)]
    n_open: Counter = Counter()
    current: _Block | None = None

    def add(text: str) -> None:
        nonlocal current
        if not text or stack[-1][4]:
            return
        if current is None:
            if text.isspace():
                return
            outer = stack[stack[-1][3]]
            current = _Block(outer[2], outer[1], outer[0])
            out.blocks.append(current)
        current.parts.append(text)
        if n_open["a"]:
            current.linked += len(text.strip())

    def close(down_to: int) -> None:
        nonlocal current
        while len(stack) > down_to:
            tag, number, _, _, _ = stack.pop()
            n_open[tag] -= 1
            out.last[number] = len(out.parents) - 1
            if tag not in _INLINE:
                current = None

    at, n = 0, len(page)
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        add(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else n
            continue
        if page.startswith("<![CDATA[", begin):
            end = page.find("]]>", begin)
            at = end + 3 if end >= 0 else n
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = end + 1 if end >= 0 else n
            continue
        found = _TAG.match(page, begin)
        if found is None:
            # Words with a "<" among them, or a tag that the next one cuts off.
            at = begin + 1
            name = re.match(r"/?([a-zA-Z][a-zA-Z0-9]*+)", page[at:at + 40])
            if name and (name[1].lower() in _INLINE or name[1].lower() in _VOID or name[1].lower() in _HOLDS or name[1].lower() in _PIECES):
                end = page.find("<", at)
                at = end if end >= 0 else n
            else:
                add("<")
            continue
        at = found.end()
        tag, rest = found[2].lower(), found[3]
        if found[1]:
            if n_open[tag] > 0:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close(depth)
            elif tag not in _INLINE:
                current = None
            continue
        if tag == "br":
            add(" ")
            continue
        if tag not in _INLINE:
            current = None
        if tag in _VOID:
            continue
        if tag in _RAW_END:
            if not rest.endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else n
            continue
        if tag not in _INLINE and n_open["p"]:
            # A block ends an open paragraph, as browsers do; nothing but inline elements is open inside it.
            depth = len(stack) - 1
            while depth and stack[depth][0] in _INLINE:
                depth -= 1
            if stack[depth][0] == "p":
                close(depth)
        if tag in _ENDS and any(n_open[t] for t in _ENDS[tag]):
            depth = len(stack) - 1
            while depth and stack[depth][0] not in _ENDS[tag] and stack[depth][0] not in _HOLDS:
                depth -= 1
            if stack[depth][0] in _ENDS[tag]:
                close(depth)
        if rest.endswith("/") and tag not in _INLINE:
            continue
        attributes = _attributes(rest) if rest and not rest.isspace() else {}
        name = " ".join(filter(None, (attributes.get(k) for k in ("class", "id", "role"))))
        inside = n_open["article"] + n_open["main"]
        number = len(out.parents)
        if tag not in ("html", "body", "main", "article"):
            hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(attributes.get("style", ""))
            named = name and (_AROUND_NAME.search(name) or (not inside and _HEADER_NAME.search(name)))
            if hidden or named or tag in _BESIDE or (tag == "header" and not inside):
                out.beside.append(number)
        elif tag == "article" and name and _AROUND_NAME.search(name):
            out.beside.append(number)
        top = stack[-1]
        if tag in _INLINE:
            path = top[2]
        else:
            # What stands around an article has paths of its own.
            aside = "~" if out.beside and out.beside[-1] == number else ""
            step = aside + tag + ("." + name.split()[0].lower() if name else "")
            path = known_paths.get((top[2], step))
            if path is None:
                path = known_paths[top[2], step] = len(out.paths)
                out.paths.append(step)
        out.parents.append(top[1])
        out.tags.append(tag)
        out.last.append(number)
        n_open[tag] += 1
        stack.append((tag, number, path, top[3] if tag in _INLINE else len(stack), top[4] or tag in _UNREAD))
    close(1)
    out.last[0] = len(out.parents) - 1
    for block in out.blocks:
        raw = "".join(block.parts)
        block.text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
    out.blocks = [b for b in out.blocks if b.text]
    return out


def element_weights(page: _Page) -> list[float]:
    """What text inside each element counts: less around an article than in it.

    An element that stands around an article by its tag or name, but holds most of the text and leaves no heading,
    article or main element outside, is the page's own frame and counts in full.
    """
    n = len(page.parents)
    size = [0] * n
    for b in page.blocks:
        size[b.element] += len(b.text)
    for i in range(n - 1, 0, -1):
        size[page.parents[i]] += size[i]
    beside = set(page.beside)
    heavy = {i for i in beside if 2 * size[i] > size[0]}
    light = [False] * n
    marks = [0] * (n + 1)
    for i in range(n):
        light[i] = (i in beside and i not in heavy) or (i > 0 and light[page.parents[i]])
        marks[i + 1] = marks[i] + (page.tags[i] in ("h1", "article", "main") and not light[i])
    frames = {i for i in heavy if marks[n] == marks[page.last[i] + 1] - marks[i]}
    told = [page.tags[i] in ("article", "main") and not light[i] for i in range(n)]
    inside = [False] * n
    for i in range(1, n):
        inside[i] = told[i] or inside[page.parents[i]]
    weight, articles = [1.0] * n, [0] * n
    for i in range(1, n):
        up = page.parents[i]
        articles[i] = articles[up] + (page.tags[i] == "article")
        weight[i] = weight[up] * (BESIDE if i in beside and i not in frames else 1.0)
        if page.tags[i] == "article" and articles[i] > 1:
            weight[i] *= NESTED
    return [w if within else w * OUTSIDE for w, within in zip(weight, inside, strict=True)] if any(told) else weight


def path_values(blocks: list[_Block], weight: list[float]) -> dict[int, float]:
    """Each path's value: the logarithm of text times punctuation per block, without linked text, smoothed along the page."""
    length, marks, linked, held, number = (Counter() for _ in range(5))
    for b in blocks:
        length[b.path] += len(b.text)
        marks[b.path] += len(_PUNCTUATION.findall(b.text))
        linked[b.path] += min(b.linked, len(b.text))
        held[b.path] += weight[b.element]
        number[b.path] += 1
    fused = {p: math.log1p((length[p] - linked[p]) / n * math.log(1.1 + marks[p] / n) * held[p] / n) for p, n in number.items()}
    raw = [fused[b.path] for b in blocks]
    total: Counter = Counter()
    for i, b in enumerate(blocks):
        around = raw[max(0, i - 1):i + 2]
        total[b.path] += (1.5 * raw[i] + 0.25 * sum(around)) / (1.5 + 0.25 * len(around))
    return {p: total[p] / n for p, n in number.items()}


def content_paths(values: dict[int, float]) -> set[int]:
    """Paths whose value is near the largest."""
    most = max(values.values())
    return {p for p, v in values.items() if v >= SHARE * most and v > 0}


def _scope(page: _Page, selected: list[bool]) -> tuple[int, bool]:
    """The element around all selected blocks, and whether it is (in) an article or main element."""
    n = len(page.parents)
    held, own = [0] * n, set()
    for b, s in zip(page.blocks, selected, strict=True):
        if s:
            held[b.element] += 1
            own.add(b.element)
    for i in range(n - 1, 0, -1):
        held[page.parents[i]] += held[i]
    scope = max(i for i in range(n) if held[i] == held[0])
    at = scope
    while at > 0:
        if page.tags[at] in ("article", "main"):
            return at, True
        at = page.parents[at]
    # Headings and short blocks stand beside an element that is itself the text.
    leaf = own == {scope}
    while scope > 0 and (leaf or page.tags[scope] in _INLINE or page.tags[scope] in _HEADING or page.tags[scope] in _PIECES):
        scope, leaf = page.parents[scope], False
    return scope, False


def main_text(page: str, by_ratio: bool = True) -> str:
    """The article of a page, a line per block; empty if there is none. ``by_ratio`` off takes all paths for content."""
    read = read_page(page)
    blocks = read.blocks
    if not blocks:
        return ""
    weight = element_weights(read)
    values = path_values(blocks, weight)
    paths = content_paths(values) if by_ratio else set(values)
    selected = [b.path in paths for b in blocks]
    if not any(selected):
        return ""
    scope, article = _scope(read, selected)
    most = max(values.values())

    def full(b: _Block) -> bool:
        return scope <= b.element <= read.last[scope] and weight[b.element] == 1.0

    def spoken(b: _Block) -> bool:
        return 2 * b.linked < len(b.text)

    if article:
        # The element says what belongs to the article: all of it that isn't around it or mainly links.
        kept = [s or (full(b) and (b.tag in _HEADING or spoken(b))) for b, s in zip(blocks, selected, strict=True)]
        return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)
    first, last = selected.index(True), len(selected) - 1 - selected[::-1].index(True)
    kept = list(selected)
    for i in range(first, len(blocks)):
        b = blocks[i]
        if not full(b) or kept[i]:
            continue
        if i < last:
            # Between content: headings, parts of lists and tables, and what comes near content.
            kept[i] = b.tag in _HEADING or (spoken(b) and (b.tag in _PIECES or values[b.path] >= LOWER_SHARE * most))
        else:
            # After it: what goes on with a list, a table or a lesser paragraph.
            kept[i] = kept[i - 1] and spoken(b) and b.tag in _PIECES and values[b.path] >= LOWER_SHARE * most
    # Before it: its headings, which may stand beside the element that holds it.
    near = max(0, read.parents[scope])
    for i in range(first - 1, -1, -1):
        b = blocks[i]
        if b.tag not in _HEADING or weight[b.element] != 1.0 or not near <= b.element <= read.last[near]:
            break
        kept[i] = True
    return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with text (string) and n_chars (long, code points) of the whole html.

    A page is cut into blocks at block-level elements. Per root-to-leaf tag path, text length and punctuation
    per block are fused, without linked text, and smoothed along the page; paths near the largest value hold
    the content. Menus, forms, adverts, comments and the like, by their elements or names, let text
    count for little; but an element that holds most of the page with all its headings is a frame, whatever
    its name. Where an article or main element is around the content, its other blocks are kept too, unless they
    stand around it or are mainly links; elsewhere headings, and short blocks among the content.

    A null or empty html, and one without text, gives an empty text. Broken markup ends nothing
    early: an open element ends with the page. The time grows with the length of the page, however it is nested or cut
    off. Extra columns stay; text and n_chars are refused. Repeated rows are read each; an empty table gives no rows.
    """
    if clash := [c for c in pages.columns if c.lower() in {"text", "n_chars"}]:
        raise ValueError(f"columns clash with the result: {clash}")

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "") for p in column], pa.string())

    made = pages.withColumn("text", text_of(F.col(html_column)))
    return made.withColumn("n_chars", F.length("text").cast("long"))


def op3_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages: page_id, url, text, n_chars."""
    pages = require(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "url", "html"])
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
