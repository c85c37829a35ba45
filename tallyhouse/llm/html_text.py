"""Main text of web pages by tag-path ratios.

A page is read as text blocks, each with the path of block elements above it.
Blocks with the same path are taken together: the logarithms of their mean text
length and mean punctuation, less what is link text, make the path's ratio. Ratios are smoothed
over neighbouring blocks and fused with them, and paths above a threshold are
content: they show the core, the innermost element that holds nearly all text
of such paths (an article or main around it takes its place), in which every block is kept, however
short, and the title before it. Link text counts there as any other. Elements that are never article text (menus, forms,
page headers and the like, by tag or by class and id words) are left out before,
unless they are wrappers around the page's article or most of its text.

Defined cases: null or empty html gives an empty text; unclosed elements end
where a parent or a like element ends; an unclosed comment, script, style or textarea
runs to the end of the page, any other unclosed element without text (a video or
select, say) to the end of its parent or the next block; one that closes itself
with "/>" holds nothing; repeated rows are extracted one by one; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch_of, slices

OUTSIDE = 0.6  # threshold, as a share of the best path's ratio
NEARLY_ALL = 0.9  # share of the content paths' text that the core holds at least

# Element names by role.
RAW = set("script style textarea title noscript template iframe svg annotation select object canvas audio video".split())
TO_THE_END = {"script", "style", "textarea"}  # their content is no markup, whatever it holds
LITERAL = {name: re.compile(rf"</?(?:{name}|head|body)\b[^>]*>?" if name not in TO_THE_END else rf"</?{name}\b[^>]*>?", re.I) for name in (*TO_THE_END, "title", "iframe")}
NEVER = set("head nav footer aside form button menu dialog fieldset label".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption article section main header hgroup figure "
    "figcaption blockquote pre address details summary center".split()
) | NEVER
ENDS = {  # an opening element ends these open ones
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
HOLDERS = {"ul", "ol", "dl", "table", "tr", "tbody"}
# Words in a class or id that mark what is not the article.
SIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar side aside footer header masthead topbar cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended comment comments reply replies respond disqus widget toolbar pagination pager search".split()
)
HEADER_WORDS = {"header", "masthead"}  # content inside an article
MAYBE, SIDE = 1, 2  # marks: a side word within a class or id, or a form; a class or id that is a side word, or another element of NEVER
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
TITLE = re.compile(r"(?:^|/)h[1-6]\b[^/]*$|\.(?:title|headline)\b[^/]*(?:/[^/]*)?$")
UNQUOTED_END = re.compile(r"""=\s*[^\s"'>]*/$""")
SPACE = re.compile(r"\s+")


def _labels(attributes: str) -> list[str]:
    return [w for m in NAMES.findall(attributes) for w in re.split(r"[^a-z0-9]+", "".join(m).lower()) if w] if attributes else []


def _mark(name: str, attributes: str, in_article: bool) -> int:
    """How surely an element is not article text, by its tag, classes, id and role."""
    if name == "form":
        return MAYBE
    if name in NEVER or (name == "header" and not in_article):
        return SIDE
    if name in ("html", "body") or not attributes:
        return 0
    words = SIDE_WORDS - HEADER_WORDS if in_article else SIDE_WORDS
    values = [v for m in NAMES.findall(attributes) for v in "".join(m).lower().split()]
    if not words.isdisjoint(values):
        return SIDE
    return MAYBE if any(not words.isdisjoint(re.split(r"[^a-z0-9]+", v)) for v in values) else 0


class Block:
    __slots__ = ("text", "path", "chain", "links")

    def __init__(self, text: str, path: str, chain: tuple[int, ...], links: int):
        self.text, self.path, self.chain, self.links = text, path, chain, links


def _tags(html: str) -> list[tuple[int, int, str, bool, str]]:
    """Tags of a page (start, end, name, closing, attributes); an element of RAW is one nameless tag over all its content.

    What stands between the end of a tag and the start of the next is text.
    """
    tags: list[tuple[int, int, str, bool, str]] = []
    ends: dict[int, int] = {}  # place of an opening tag of RAW, place of the tag that ends it
    opened: list[tuple[str, int]] = []
    count: dict[str, int] = defaultdict(int)
    at = 0
    while m := TAG.search(html, at):
        at = m.end()
        name, closing, attributes = (m[2] or "").lower(), bool(m[1]), m[3] or ""
        place = len(tags)
        tags.append((m.start(), at, name, closing, attributes))
        if not name or name in VOID:
            continue
        if closing:
            while count[name]:
                top, where = opened.pop()
                count[top] -= 1
                if top == name:
                    ends[where] = place
                    break
            continue
        if attributes.rstrip().endswith("/") and not UNQUOTED_END.search(attributes.rstrip()) and name not in TO_THE_END:
            ends[place] = place
            continue
        if name in LITERAL:
            end = LITERAL[name].search(html, at)
            own = end and end[0].lower().startswith(f"</{name}")
            if own or (name in TO_THE_END and not attributes.rstrip().endswith("/")):
                while end and not end[0].startswith("</"):
                    end = LITERAL[name].search(html, end.end())
                at = end.end() if end else len(html)
                tags[-1] = (m.start(), at, name, closing, attributes)
                ends[place] = place
                continue
            if name in TO_THE_END:  # closes itself, and no end tag comes before the next of its kind
                ends[place] = place
                continue
        opened.append((name, place))
        count[name] += 1
    out, k = [], 0
    while k < len(tags):
        start, end, name, closing, attributes = tags[k]
        if closing or name not in RAW:
            out.append(tags[k])
            k += 1
        elif k in ends:
            out.append((start, tags[ends[k]][1], "", False, ""))
            k = ends[k] + 1
        else:
            upto = k + 1
            inner: dict[str, int] = defaultdict(int)
            while upto < len(tags):
                other, shut = tags[upto][2], tags[upto][3]
                if other in BLOCKS or (shut and not inner[other]):
                    break
                if upto in ends and (other in RAW or ends[upto] == upto):
                    upto = ends[upto] + 1
                    continue
                if other and other not in VOID:
                    inner[other] += -1 if shut else 1
                upto += 1
            out.append((start, tags[upto][0] if upto < len(tags) else len(html), "", False, ""))
            k = upto
    return out


def _left_out(found: list[Block], elements: list[tuple[str, int, tuple[int, ...]]]) -> set[int]:
    """Numbers of the marked elements (tag, mark, chain) that are no wrappers.

    The page's article is the article element with the most text that is neither
    marked SIDE nor in such an element, or else main. A marked element stays where it
    holds that or main; one marked MAYBE also with more than half of the text of the
    article around it or of the page, one marked SIDE on a page without an article
    with more than 0.8 of it.
    """
    marked = {k for k, (tag, mark, _) in enumerate(elements) if mark and tag not in ("article", "main")}
    if not marked:
        return marked
    held, total = defaultdict(int), 0
    for b in found:
        w = max(len(b.text) - b.links, 0)
        total += w
        for e in b.chain:
            held[e] += w
    named = [k for k, (tag, _, _) in enumerate(elements) if tag in ("article", "main") and held[k]]
    clean = [k for k in named if elements[k][0] == "article" and not any(elements[e][1] == SIDE for e in elements[k][2])]
    mains = [k for k in named if elements[k][0] == "main"]
    article = max(clean or mains, key=lambda k: held[k], default=None)
    kept = {e for k in [*mains, *([] if article is None else [article])] for e in elements[k][2]}
    for e in marked:
        around = held[article] if article in elements[e][2] else total
        if elements[e][1] == MAYBE:
            wrapper = held[e] > 0.5 * around
        else:
            wrapper = article is None and held[e] > 0.8 * total
        if wrapper:
            kept.add(e)
    return marked - kept


def blocks(html: str) -> list[Block]:
    """Text blocks of a page in order, without what lies in elements that are never article text."""
    found: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # tag, path step, element number
    elements: list[tuple[str, int, tuple[int, ...]]] = []  # tag, mark, element numbers down to it
    parts: list[str] = []
    state = {"links": 0}
    link = False

    def close() -> None:
        text = SPACE.sub(" ", unescape("".join(parts))).strip()
        if text:
            found.append(Block(text, "/".join(x[1] for x in stack), tuple(x[2] for x in stack), state["links"]))
        parts.clear()
        state["links"] = 0

    def write(text: str) -> None:
        if text:
            parts.append(text)
            if link:
                state["links"] += len(text.strip())

    at = 0
    for start, end, name, closing, attributes in _tags(html):
        write(html[at:start])
        at = end
        if not name:
            continue
        if name == "a":
            link = not closing
        elif name == "br":
            write(" ")
        if name not in BLOCKS or name in VOID:
            continue
        close()
        link = False
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        ended = ENDS.get(name, set()) | {"p"}
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ended:
                del stack[k:]
            elif stack[k][0] in HOLDERS or stack[k][0] not in ended:
                break
        labels = _labels(attributes)
        in_article = any(x[0] in ("article", "main") for x in stack)
        if not attributes.rstrip().endswith("/"):
            stack.append((name, ".".join([name, *labels[:2]]), len(elements)))
            elements.append((name, _mark(name, attributes, in_article), tuple(x[2] for x in stack)))
    write(html[at:])
    close()
    out = _left_out(found, elements)
    return [b for b in found if out.isdisjoint(b.chain)] if out else found


def _core(found: list[Block], content: list[bool]) -> tuple[list[int], list[int]]:
    """Places of the blocks in the core, and of those whose links are text as any other.

    The core is the innermost element of several blocks with NEARLY_ALL of the text of
    content blocks, widened until it holds all blocks of the content paths in it, and on
    to an article or main element around it. Links are text everywhere in an article
    and where content blocks are the core's own children; in html, body and elements that
    hold the article in parts, only from the first part to the last.
    """
    weight = [max(len(b.text) - b.links, 0) * c for b, c in zip(found, content)]
    held, size, total = defaultdict(int), defaultdict(int), sum(weight)
    for b, w in zip(found, weight):
        for e in b.chain:
            held[e] += w
            size[e] += 1
    if not total:
        return list(range(len(found))), []
    # Elements that hold nearly all lie within each other; `deep` of them are around the innermost, the page itself at 0.
    depth = [sum(held[e] >= NEARLY_ALL * total for e in b.chain) for b in found]
    heavy = found[max(range(len(found)), key=depth.__getitem__)]
    chain, tags, deep = heavy.chain, [step.split(".")[0] for step in heavy.path.split("/")], max(depth)
    while deep and size[chain[deep - 1]] == 1 < len(found):
        deep -= 1
    paths = {b.path for b, c in zip(found, content) if c and b.chain[:deep] == chain[:deep]}
    first = deep
    for b in found:
        while deep and b.path in paths and chain[deep - 1] not in b.chain:
            deep -= 1
    named = [k + 1 for k in range(deep) if tags[k] in ("article", "main")]
    deep = named[-1] if named else deep
    page = not deep or tags[deep - 1] in ("html", "body")
    within = [k for k, b in enumerate(found) if b.chain[:deep] == chain[:deep]]
    parts = [k for k in within if content[k]]
    direct = any(len(found[k].chain) <= deep + 1 for k in parts)
    run = [k for k in within if parts[0] <= k <= parts[-1]]
    if named or (direct and not page):
        return within, within
    if not direct:
        holders = {found[k].chain[deep] for k in parts}
        whole = [k for k in within if len(found[k].chain) > deep and found[k].chain[deep] in holders]
        run = [k for k in within if whole[0] <= k <= whole[-1]]
        if page:  # between the parts there may be menus
            return (run if deep < first else within), whole
    return within, run


def _title(found: list[Block], first: int) -> int:
    """Where the text begins: at a title shortly before it, if it has none of its own."""
    if TITLE.search(found[first].path):
        return first
    for k in range(first - 1, max(first - 5, -1), -1):
        if 2 * found[k].links > len(found[k].text):
            break
        if TITLE.search(found[k].path):
            return k
    return first


def main_text(html: str) -> str:
    """Content blocks of a page, one to a line."""
    found = blocks(html)
    if not found:
        return ""
    length, points, links, count = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    for b in found:
        length[b.path] += len(b.text)
        points[b.path] += len(PUNCTUATION.findall(b.text))
        links[b.path] += min(b.links, len(b.text))
        count[b.path] += 1
    # Logarithms: one very long paragraph must not make all others look like noise.
    ratio = {p: log1p(length[p] / n) * (1 + log1p(points[p] / n)) * (1 - links[p] / length[p]) for p, n in count.items()}
    raw = [ratio[b.path] for b in found]
    smooth = [(raw[max(k - 1, 0)] + 2 * raw[k] + raw[min(k + 1, len(raw) - 1)]) / 4 for k in range(len(raw))]
    # Fuse: the mean of a path's own ratio and its blocks' smoothed ones.
    fused = defaultdict(float)
    for b, s in zip(found, smooth):
        fused[b.path] += (ratio[b.path] + s) / 2 / count[b.path]
    best = max(fused.values())
    content = [ratio[b.path] > 0 and fused[b.path] >= OUTSIDE * best for b in found]
    core, text = (set(x) for x in _core(found, content))
    if text:
        title = range(_title(found, min(text)), min(text))
        core.update(title)
        text.update(title)
    # All of the text; beside it in the core what is not links alone; elsewhere what reads like the best path.
    return "\n".join(b.text for k, b in enumerate(found) if k in text or ratio[b.path] > 0 and (k in core or fused[b.path] >= OUTSIDE * best))


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and its code points."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "html"):
            texts = [main_text(h) for h in s.texts()]
            yield batch_of(schema, s.batch.column("page_id"), s.batch.column("url"), texts, [len(t) for t in texts])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
