"""Main text of web pages by union-free wrapper inference.

Pages of one host share a template.  Each page's token stream is balanced
into elements and text slots (inline markup dropped) and folded: neighbours
of one signature (tag, class, id, role) are a repeated group.  The streams of
a host are aligned one after the other into a wrapper, a regular expression
without unions: what aligns is merged, a repeat against a single stays a
repeated group, what one side lacks becomes optional, and texts that differ
become text slots.  The content root is then chosen page by page, along the
page's alignment with its host's wrapper: the element that holds most of the
text that varies between pages, among those that the page has.  Elements whose
tag, class, id or role names a menu, header, footer, sidebar, notice, advert,
form or comment list are boilerplate.  The text under the root is returned; a
text is left out as template where it is outside a main block and the same on
nearly all of enough distinct pages of the host, all of which are counted.
Hosts of fewer than TELLING distinct pages tell nothing of that kind; there
article and main elements are the roots.

Wrappers of pages are merged by (host, page), map-side and then where a page's
copies meet, so that copies count as one; then by (host, salt), then by host,
always streaming: a task holds one wrapper of the host it is reading, never a
host's pages.  Null or empty pages have an empty text; pages without a url form
a group of their own; repeated rows each get their own row.
"""

from __future__ import annotations

import functools
import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick, stage

SALTS = 32
HELD = 1 << 21  # characters of pages whose wrappers a map task holds before it hands them on
READ_HOSTS = 16  # wrappers a reading task keeps unpacked
TELLING = 5  # distinct pages of a host from which on a text can be told as template
EVERYWHERE = 0.9  # of a host's distinct pages hold a template text
MAX_DEPTH = 150  # elements nested deeper add their text to the one at this depth
WIDE = 64  # children of one element beyond which their order is no longer kept

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?P<end>>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Elements of the HTML standard, by their part here.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em",
          "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var"}
NOT_CONTENT = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head",
               "object", "canvas", "audio", "video", "map"} | RAW
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
          "section", "table", "ul"}
SCOPES = {"ul", "ol", "dl", "table", "div", "article", "section", "body", "html", "main", "td", "li"}
# A class, id or role is boilerplate if all of its parts are such words, or they
# are with a place or kind beside them: "cookie-notice", "left-sidebar", not
# "no-sidebar" or "content-sidebar-wrap".
WORDS = (r"(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner"
         r"|nav(?:bar|igation)?|menu|breadcrumbs?|footer|masthead|site-?header|page-?header|sidebar|aside"
         r"|cookies?|consent|notices?|popup|modal|overlay|newsletter|subscribe|signup|login|search(?:box)?"
         r"|share|sharing|social|related|recommended|widget|comments?|commentlist|disqus|replies|respond"
         r"|pagination|pager|complementary|contentinfo|alert(?:dialog)?)")
BESIDE = (r"(?:left|right|top|bottom|main|primary|secondary|site|post|article|list|box|bar|block|area"
          r"|section|container|item|slot|unit|form|links?|buttons?|icons?|posts|articles)")
BOILERPLATE = re.compile(rf"(?:{BESIDE}[_-])*{WORDS}(?:[_-](?:{WORDS}|{BESIDE}))*", re.I)
ROOTS = {"article", "main"}
PAGE = {"html", "body", "main"}  # never boilerplate, whatever their class
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = {"html", "body", "div", "section", "center"}  # each a main block of its own or none
TEXT_LEVEL = {"p", "pre", "blockquote", "li", "dt", "dd"} | HEADINGS  # part of a content, never a root

# A page element or text: [signature, tag, children] or [text, link characters].


def parse(source: str) -> list:
    """The page's root element, balanced; text nodes keep their decoded text
    and how much of it is inside links."""
    root = ["", "", []]
    stack, links, at = [root], 0, 0
    is_open: Counter[str] = Counter()
    texts: list[list] = []  # text nodes, whose pieces are joined at the end
    while at < len(source):
        m = TOKEN.match(source, at)
        at = m.end()
        if m["text"]:
            _add_text(stack[-1][2], entities.unescape(m["text"]), links, texts)
            continue
        if not m["name"] or not m["end"]:  # comment, doctype, or cut off inside a tag
            continue
        name = m["name"].lower()
        if m["close"]:
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE and is_open[name]:
                while True:
                    ended = stack.pop()[1]
                    is_open[ended] -= 1
                    if ended == name:
                        break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name == "br":
            _add_text(stack[-1][2], " ", 0, texts)
        if name == "a":
            links += 1
        if name in VOID or name in INLINE:
            continue
        closes = CLOSES.get(name, set()) | ({"p"} if name in ENDS_P else set())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][1] in closes:
                is_open.subtract(e[1] for e in stack[i:])
                del stack[i:]
                break
            if stack[i][1] in SCOPES:
                break
        marks = sorted({w for a in ATTR.finditer(m["attrs"]) for w in
                        (a[2] or a[3] or a[4] or "").lower().split() if not re.search(r"\d{2}", w)})
        element = [name + "".join("." + w for w in marks), name, []]
        if len(stack) > MAX_DEPTH:
            element[2] = stack[-1][2]
        else:
            stack[-1][2].append(element)
        if not m["attrs"].endswith("/"):
            stack.append(element)
            is_open[name] += 1
    for node in texts:
        node[0] = "".join(node[0])
    return root


def _add_text(children: list, text: str, links: int, texts: list[list]) -> None:
    if children and len(children[-1]) == 2:
        children[-1][0].append(text)
        children[-1][1] += len(text) * (links > 0)
    else:
        texts.append([[text], len(text) * (links > 0)])
        children.append(texts[-1])


def excluded(signature: str, tag: str) -> bool:
    if tag in PAGE:
        return False
    return tag in NOT_CONTENT or any(map(BOILERPLATE.fullmatch, signature[len(tag) + 1:].split(".")))


# A wrapper node is a dictionary: s signature, t tag, k children, r repeated,
# o optional, n pages, and for text slots (s "#"): c the text if it is the
# same everywhere, v its characters, l those in links.  The root and slots
# with a c have d, the number of distinct pages that hold them.


def shape(element: list) -> dict:
    """A page element as a folded wrapper."""
    return _shape(element) | {"d": 1}


def _shape(element: list) -> dict:
    kids: list[dict] = []
    for child in element[2]:
        if len(child) == 2:
            text = " ".join(child[0].split())
            if not text:
                continue
            node = {"s": "#", "c": hash_of(text), "v": len(text), "l": child[1], "n": 1, "d": 1}
        else:
            node = _shape(child)
        if kids and kids[-1]["s"] == node["s"]:
            kids[-1] = merge(kids[-1], node, inside=True) | {"r": 1}
        else:
            kids.append(node)
    return {"s": element[0], "t": element[1], "k": fold_pairs(kids), "n": 1}


def hash_of(text: str) -> int:
    import xxhash
    return xxhash.xxh32_intdigest(text)


def page_of(element: list) -> bytes:
    """What copies of a page have in common."""
    import xxhash
    return xxhash.xxh3_128_digest("\n".join(_texts(element)))


def _texts(element: list) -> Iterator[str]:
    """The texts of a page outside boilerplate: pages that differ elsewhere
    only are copies."""
    for child in element[2]:
        if len(child) == 2:
            if child[0].strip():
                yield " ".join(child[0].split())
        elif not excluded(child[0], child[1]):
            yield from _texts(child)


def fold_pairs(kids: list[dict]) -> list[dict]:
    """Fold alternating groups ``(a b)(a b)...`` into one repeated pair."""
    out: list[dict] = []
    for node in kids:
        if len(out) >= 3 and out[-2]["s"] == node["s"] and out[-3]["s"] == out[-1]["s"]:
            last = out.pop()
            out[-2] = merge(out[-2], last, inside=True) | {"r": 1}
            out[-1] = merge(out[-1], node, inside=True) | {"r": 1}
        else:
            out.append(node)
    return out


def merge(a: dict, b: dict, inside: bool = False, copies: bool = False) -> dict:
    """Two aligned nodes as one; ``inside``: both are of one page; ``copies``:
    of copies of one page, which are one distinct page."""
    node = {"s": a["s"], "n": max(a["n"], b["n"]) if inside else a["n"] + b["n"]}
    node |= {f: 1 for f in ("r", "o") if a.get(f) or b.get(f)}
    if a["s"] == "#":
        node |= {"c": a["c"] if a["c"] == b["c"] else None, "v": a["v"] + b["v"], "l": a["l"] + b["l"]}
    else:
        node |= {"t": a["t"], "k": align(a["k"], b["k"], inside, copies)}
    if "d" in a and "d" in b and node.get("c", 0) is not None:
        node["d"] = max(a["d"], b["d"]) if inside or copies else a["d"] + b["d"]
    return node


def align(a: list[dict], b: list[dict], inside: bool = False, copies: bool = False) -> list[dict]:
    """Align two sequences by signature; what only one has is optional."""
    sa, sb = [x["s"] for x in a], [x["s"] for x in b]
    if sa == sb:
        return [merge(x, y, inside, copies) for x, y in zip(a, b)]
    if max(len(a), len(b)) > WIDE:  # a bag: each signature once, repeated
        bag: dict[str, dict] = {}
        for side in (a, b):  # one side's nodes are of the same pages
            of_side: dict[str, dict] = {}
            for x in side:
                of_side[x["s"]] = merge(of_side[x["s"]], x, inside, True) if x["s"] in of_side else x
            for sig, x in of_side.items():
                bag[sig] = (merge(bag[sig], x, inside, copies) if sig in bag else x) | {"r": 1, "o": 1}
        return list(bag.values())
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if sa[i] == sb[j]
                          else max(best[i + 1][j], best[i][j + 1]))
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and sa[i] == sb[j]:
            out.append(merge(a[i], b[j], inside, copies))
            i, j = i + 1, j + 1
        elif j >= len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append(a[i] | {"o": 1})
            i += 1
        else:
            out.append(b[j] | {"o": 1})
            j += 1
    return out


def expression(node: dict) -> str:
    """The wrapper as a readable union-free regular expression."""
    inner = "#text" if node["s"] == "#" else (
        f"<{node['s']}>" + "".join(map(expression, node["k"])) + f"</{node['t']}>")
    mark = "*" if node.get("r") and node.get("o") else "+" if node.get("r") else "?" if node.get("o") else ""
    return f"({inner}){mark}" if mark else inner


def weigh(node: dict, pages: int | None = None) -> dict:
    """Note at every node how much text varies under it (key ``w``), whether
    a text is template (``x``), and whether an element holds varying text
    itself or in text-level children, so that it is a main block (``b``)."""
    pages = node.get("d", 0) if pages is None else pages
    if node["s"] == "#":
        if node["c"] is not None and TELLING <= pages and node.get("d", 0) >= EVERYWHERE * pages:
            node["x"] = 1
    else:
        for k in node["k"]:
            weigh(k, pages)
    if node["s"] == "#":
        node["w"] = 0 if node.get("x") else max(0, node["v"] - 2 * node["l"])
    elif excluded(node["s"], node["t"]) or node["t"] == "header":
        node["w"] = 0
    else:
        node["w"] = sum(k["w"] for k in node["k"])
        if any(k["w"] and k.get("t") not in BLOCKS for k in node["k"]):
            node["b"] = 1
    return node


def extract(element: list, wrapper: dict | None) -> str:
    """Text of a page under its content roots, one block a line.  The wrapper
    decides where its host has enough distinct pages to tell varying text from
    template.  On other hosts, and where it finds nothing, tags do: what holds
    an article or main element is no boilerplate, whatever its name; without
    one outside of boilerplate, those inside count if they hold more than the
    rest."""
    text = found(element, wrapper)
    if text and wrapper and wrapper["w"] and wrapper["d"] >= TELLING:
        return text
    return explicit(element) or max(text, explicit(element, inside=True), key=len)


def explicit(element: list, inside: bool = False) -> str:
    """Text under the roots in the fewest boilerplate elements (``inside``
    false: in none), articles before main elements."""
    texts: dict[tuple[int, int], list[str]] = {}
    for kind, is_root in enumerate((lambda e: e[1] == "article", lambda e: e[1] == "main" or ".main" in e[0])):
        for depth, root in _roots(element, is_root, 0):
            if inside or not depth:
                _walk(root, None, 1, texts.setdefault((depth, kind), []))
        if not inside and texts.get((0, kind)):
            break
    return next(("\n".join(texts[key]) for key in sorted(texts) if texts[key]), "")


def _roots(element: list, is_root: Callable[[list], bool], depth: int) -> Iterator[tuple[int, list]]:
    """The outermost roots, each with the boilerplate elements around it."""
    for child in element[2]:
        if len(child) == 3:
            barred = excluded(child[0], child[1])
            if is_root(child) and (child[1] in ROOTS or not barred):
                yield depth + barred, child
            else:
                yield from _roots(child, is_root, depth + barred)


def found(element: list, wrapper: dict | None) -> str:
    """Text of a page without an explicit root: of the elements that it has,
    the one with most of the text that varies on its host."""
    blocks: list[str] = []
    mode = 2 if wrapper and wrapper["w"] else 1  # nothing varies: nothing tells template from content
    node = wrapper
    while node:
        seen: dict[int, tuple[dict, list]] = {}
        for child, slot in _aligned(element, node):
            if slot and not (len(child) == 3 and excluded(child[0], child[1])):
                seen.setdefault(id(slot), (slot, []))[1].append(child)
        if not seen:
            break
        best, same = max(seen.values(), key=lambda x: (x[0]["s"] != "#", _mean(x[0])))
        if (best["s"] == "#" or best["t"] in TEXT_LEVEL or best["t"] == "header" or len(same) > 1
                or not best["w"] or _mean(best) < 0.6 * sum(_mean(x) for x, _ in seen.values())
                or any(x["w"] and x is not best and x.get("t") in HEADINGS for x, _ in seen.values())):
            break
        element, node = same[0], best
    _walk(element, node, mode, blocks)
    return "\n".join(blocks)


def _mean(node: dict) -> float:
    """Varying text a page."""
    return node["w"] / node["n"]


def _aligned(element: list, node: dict | None) -> Iterator[tuple[list, dict | None]]:
    """An element's children, each with the wrapper node that it aligns with."""
    at, kids = 0, node["k"] if node else []
    for child in element[2]:
        sig = "#" if len(child) == 2 else child[0]
        if sig == "#" and not child[0].strip():
            continue
        place = next((i for i in range(at, len(kids)) if kids[i]["s"] == sig), None)
        if place is None:  # a bag or a fold: order is free
            place = next((i for i in range(len(kids)) if kids[i]["s"] == sig), None)
        if place is not None:
            at = place
        yield child, kids[place] if place is not None else None


def _walk(element: list, node: dict | None, mode: int, blocks: list[str]) -> None:
    """``mode``: 1 all text is content, 2 template texts outside the main
    blocks are not."""
    inner = 1 if node and node.get("b") else mode  # in a main block all is content
    for child, slot in _aligned(element, node):
        if len(child) == 2:
            if not (inner == 2 and slot and slot.get("x")):
                blocks.append(" ".join(child[0].split()))
        elif excluded(child[0], child[1]):
            continue
        elif child[1] == "header":  # an article's own header: its headings belong to it
            for part, heading in _aligned(child, slot):
                if len(part) == 3 and part[1] in HEADINGS:
                    _walk(part, heading, mode, blocks)
        else:
            _walk(child, slot, mode if child[1] in BLOCKS else inner, blocks)


def _merge_stream(rows: Iterator[tuple[tuple, dict]], copies: bool = False) -> Iterator[tuple[tuple, dict]]:
    """Rows sorted by key: one merged wrapper per key."""
    last, held = None, None
    for key, node in rows:
        if held is not None and key == last:
            held = merge(held, node, copies=copies)
        else:
            if held is not None:
                yield last, held
            last, held = key, node
    if held is not None:
        yield last, held


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, html`` -> ``host, wrapper`` (JSON), one per host."""
    def shapes(batches):
        held: dict[tuple[str, bytes], dict] = {}
        size = 0
        for b in batches:
            for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                tree = parse(source or "")
                key, node = (host, page_of(tree)), shape(tree)
                held[key] = merge(held[key], node, copies=True) if key in held else node
                size += len(source or "") + 1
                if size > HELD:
                    yield packed(held)
                    held, size = {}, 0
        if held:
            yield packed(held)

    def packed(held):
        return pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in held], pa.string()), pa.array([p for _, p in held], pa.binary()),
             pa.array([json.dumps(w, separators=(",", ":")) for w in held.values()], pa.string())],
            names=["host", "page", "wrapper"])

    def fold(batches, keys, last):
        rows = ((tuple(b.column(k)[i].as_py() for k in keys), json.loads(b.column("wrapper")[i].as_py()))
                for b in batches for i in range(b.num_rows))
        if "page" in keys:
            rows = ((key[:1], node) for key, node in _merge_stream(rows, copies=True))
        for key, node in _merge_stream(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.string()),
                 pa.array([json.dumps(weigh(node) if last else node)])],
                names=["host", "wrapper"])
    kind = "host string, wrapper string"
    each = pages.select("host", "html").mapInArrow(shapes, "host string, page binary, wrapper string")
    parts = (each.repartition("host", "page").sortWithinPartitions("host", "page")
             .mapInArrow(lambda bs: fold(bs, ["host", "page"], False), kind))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = (salted.repartition("host", "salt").sortWithinPartitions("host", "salt")
            .mapInArrow(lambda bs: fold(bs, ["host", "salt"], False), kind))
    return (some.repartition("host").sortWithinPartitions("host")
            .mapInArrow(lambda bs: fold(bs, ["host"], True), kind))


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    pages = pick(df, page_id=id_col, url=url_col, html=html_col).withColumn(
        "host", F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)),
                           F.lit("")))
    known = stage(wrappers(pages))
    both = pages.join(known, "host", "left").select("page_id", "url", "html", "wrapper")
    schema = T.StructType([both.schema["page_id"], T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        unpacked = functools.lru_cache(maxsize=READ_HOSTS)(json.loads)
        for b in batches:
            texts = []
            for source, w in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist()):
                page = parse(source or "")
                texts.append(extract(page, unpacked(w) if w else None))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)
    return both.mapInArrow(run, schema)
