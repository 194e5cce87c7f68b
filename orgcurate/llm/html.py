"""Main text of web pages by two passes of block rules.

The first pass decides blocks by where they stand (menus, footers, notices, forms,
comments and the like are boilerplate; where the page has an article or main element,
so is all outside) and by stop-word density, length and link density. Blocks that these
leave open inherit, in the second pass, the label of the nearest decided block; of two as
near the good one counts. Open are short blocks and, within an article or main element,
long ones with few stop words (lists of names, figures, code), which elsewhere are bad.

Both passes take time in proportion to the page, whatever its markup.

Defined results: null and empty pages give empty text; markup left open at the end
of a page counts as closed there, and an end tag without a beginning counts for nothing;
a tag with a quote that is never closed ends at its first >, as does every tag after ODD
of these; repeated pages are extracted each.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ._spark import arrow_type, ship

# Elements and words of the HTML standard and of common page templates.
RAW = ["script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "object", "canvas", "math", "audio", "video"]
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul option select button".split())
#: Elements that end the last open one of their kind.
SELF_ENDING = set("p li td tr dd dt option".split())
APART = set("nav footer aside form menu dialog button select head fieldset".split())
WORDS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices outbrain popup promo promoted promotion recommended related respond sharing share sidebar signup social sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets".split())
ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
STOP = set("the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so what up".split()) | set("de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se il ce".split()) | set("der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei".split()) | set("el que y los del se las por con no una su para es al lo como o pero sus le ha me si sin sobre este ya entre cuando".split())
NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
INSIDE = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
ODD = 16
ATTRIBUTE = re.compile(r"([\w:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SHORT, LINKS, DENSE = 70, 0.66, 0.2


def apart(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's content is boilerplate by its name or attributes."""
    if name in APART or name == "header" and not inside:
        return True
    if attributes.strip():
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id") and name not in ("html", "body", "article", "main") and not WORDS.isdisjoint(re.split(r"[\s_-]+", value)):
                return True
            if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return True
    return False


class Block:
    __slots__ = ("article", "links", "parts", "structure")

    def __init__(self, structure: bool, article: bool):
        self.parts, self.links, self.structure, self.article = [], 0, structure, article


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it is an end tag, attributes) of what is no text, in order;
    the name of comments, declarations, raw elements and broken tags is empty."""
    pos, odd, n = 0, 0, len(page)
    while (start := page.find("<", pos)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            pos = n if end < 0 else end + 3
            yield start, pos, "", False, ""
            continue
        m = NAME.match(page, start)
        if not m and page[start + 1 : start + 2] not in ("!", "?", "/"):
            pos = start + 1
            continue
        inside = INSIDE.match(page, m.end()) if m and odd < ODD else None
        if not inside:
            odd += bool(m)
            end = page.find(">", start)
            if end < 0:  # no tag begins here or later, but a comment may
                start = page.find("<!--", start)
                if start >= 0:
                    yield start, n, "", False, ""
                return
            pos = end + 1
            whole = m and odd > ODD
            yield start, pos, m[2].lower() if whole else "", bool(m and m[1]), page[m.end() : end] if whole else ""
            continue
        name, pos = m[2].lower(), inside.end()
        if name in RAW_END and not m[1]:
            if not (name in ("svg", "math") and inside[1].rstrip().endswith("/")):
                close = RAW_END[name].search(page, pos)
                pos = close.end() if close else n
            name = ""
        yield start, pos, name, bool(m[1]), inside[1]


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with what their surroundings say."""
    stack: list[tuple[str, bool]] = []  # (name, boilerplate here)
    outer: list[int] = []  # places of block elements in it
    opened: dict[str, int] = {}
    out: list[Block] = []
    links = bodies = at = 0
    current: Block | None = None

    def text(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        if current is None:
            if not raw.strip():
                return
            current = Block(bool(stack) and stack[-1][1], bodies > 0)
            out.append(current)
        current.parts.append(raw)
        if links:
            current.links += len(raw.strip())

    def close(k: int) -> None:
        nonlocal links, bodies
        for name, _ in stack[k:]:
            links -= name == "a"
            bodies -= name in ("article", "main")
            opened[name] -= 1
        del stack[k:]
        while outer and outer[-1] >= k:
            outer.pop()

    for start, end, name, ends, attributes in tags(page):
        text(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            text(" ")
            continue
        if name in BLOCKS:
            current = None
        if ends:
            if opened.get(name):
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                close(k)
            continue
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        if name in SELF_ENDING and opened.get(name):  # ends the last of its kind, unless another block is open within
            for k in reversed(outer):
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] != "p":
                    break
        if name in BLOCKS:
            outer.append(len(stack))
        stack.append((name, bool(stack) and stack[-1][1] or apart(name, attributes, bodies > 0)))
        opened[name] = opened.get(name, 0) + 1
        links += name == "a"
        bodies += name in ("article", "main")
    text(page[at:])
    return out


def inherited(labels: list[str], default: str) -> list[str]:
    """Labels with those left open taken from the nearest decided one, the good one of two as
    near; `default` where none is decided."""
    far = len(labels) + 1
    before: list[tuple[int, str]] = []
    gap, last = far, ""
    for x in labels:
        gap, last = (0, x) if x else (gap + 1, last)
        before.append((gap if last else far, last))
    out, gap, last = list(labels), far, ""
    for i in range(len(labels) - 1, -1, -1):
        gap, last = (0, labels[i]) if labels[i] else (gap + 1, last)
        after = gap if last else far
        if not labels[i]:
            d, x = before[i]
            if not x and not last:
                out[i] = default
            elif d == after:
                out[i] = "good" if "good" in (x, last) else "bad"
            else:
                out[i] = x if d < after else last
    return out


def extracted(page: str | None) -> str:
    found = [(b, t) for b in blocks(page or "") if (t := " ".join(html.unescape("".join(b.parts)).split()))]
    framed = any(b.article and not b.structure for b, _ in found)
    kept = [(b, t) for b, t in found if not (b.structure or framed and not b.article)]
    labels = []
    for b, t in kept:
        if b.links > LINKS * len(t):
            labels.append("bad")
        elif len(t) < SHORT:
            labels.append("")
        else:
            words = t.lower().split()
            dense = sum(w.strip(".,;:!?") in STOP for w in words) >= DENSE * len(words)
            labels.append("good" if dense else "" if framed else "bad")
    return " ".join(t for (_, t), x in zip(kept, inherited(labels, "good" if framed else "bad"), strict=True) if x == "good")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    schema = pa.schema([("page_id", arrow_type(pages, "page_id")), ("url", arrow_type(pages, "url")), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.slice(i, 500)
                texts = [extracted(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema)

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
