"""Main text of web pages by consensus on container paths per host.

1. Each page is cut into blocks. A block's text counts for its container: the nearest article or
   main element, else its parent. A container is named by its generalised path, the tags and classes
   from the body down with numbers masked, so that all pages of a template agree on it.
2. A page splits one vote over its paths by text outside links. Votes are summed per host in Spark;
   the best path of a host and those close to it win.
3. Pages are read again. A page keeps its winning containers, and its own best one where those hold
   little of it. An article or main element bounds the article; without one, the article may be
   spread over siblings, and all under the lowest common ancestor of what holds a part of it is kept.
   Left out are the parts that are no article text wherever they stand, and the containers that have
   the same words on every page of the host while the pages differ.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import text as T
from tidewatch.session import cut_lineage

#: A path wins with at least so much of the best path's votes.
WINNING_SHARE = 0.3
#: A container with at least so much of the text of the page's best one holds a part of the article, as one with an h1 does.
PART_SHARE = 0.05
#: A container has the words of the site, and no article, if they are the same on at least so many pages that differ.
FIXED_PAGES = 5

RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "title", "select", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
DROPPED = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "head", "header", "label", "input", "option"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
DROPPED_NAMES = {"ad", "ads", "adbox", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
                 "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "aside", "rail", "widget",
                 "footer", "masthead", "topbar", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal",
                 "overlay", "newsletter", "subscribe", "signup", "login", "comment", "comments", "commentlist", "disqus", "respond",
                 "reply", "replies", "share", "sharing", "social", "related", "recommended", "recirc", "pagination", "pager", "toolbar", "skip",
                 "hidden", "legal", "copyright", "disclaimer", "search", "form", "header", "tags", "taglist"}
#: Dropped wherever they stand in a name, as in comment-body or ad-slot; the others only as its last part, as in main-menu.
STRONG_NAMES = {"comment", "comments", "commentlist", "sidebar", "footer", "ad", "ads", "advert", "adverts", "cookie", "cookies",
                "newsletter", "nav", "navbar", "menu", "sponsored", "promo"}
#: A name that begins so tells of the layout, as in no-sidebar.
MODIFIERS = {"no", "has", "with", "without", "is", "not"}
KEPT_NAMES = {"article", "content", "main", "post", "entry", "story", "body", "text", "page"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3",
            "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
SAME_CLOSES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
               "option": {"select"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                  # quotes delimit a value directly after = only; elsewhere they are characters like others
                  r"|<([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?)*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NUMBER = re.compile(r"\d+")
NAME_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Node:
    tag: str
    path: str
    parent: Node | None
    dropped: bool
    container: Node | None = None
    dropped_tag: bool = False


@dataclass(slots=True)
class Block:
    node: Node
    parts: list = field(default_factory=list)
    link_chars: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text.strip(" /\n\t") else {}


def _is_dropped(tag: str, attributes: dict[str, str]) -> bool:
    if tag in DROPPED or attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return any(_is_dropped_name(name) for a in ("class", "id") for name in CAMEL.sub("-", attributes.get(a, "")).lower().split())


def _is_dropped_name(name: str) -> bool:
    parts = [p for p in NAME_PARTS.split(name) if p]
    if not parts or parts[0] in MODIFIERS:
        return False
    if parts[-1] == "header":  # the header of an article holds its heading
        return parts[0] not in KEPT_NAMES or len(parts) == 1
    return bool(STRONG_NAMES & set(parts) or parts[-1] in DROPPED_NAMES or parts[0] in DROPPED_NAMES and not KEPT_NAMES & set(parts))


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted({NUMBER.sub("#", c) for c in attributes.get("class", "").split()})
    return tag + "".join(f".{c}" for c in classes)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order. Unclosed and stray tags are put up with as browsers do."""
    root = Node("", "", None, False)
    stack, out, links, depth_of_raw, at = [root], [], 0, None, 0
    now: Block | None = None

    def text(value: str) -> None:
        nonlocal now
        if not value:
            return
        if now is None:
            node = stack[-1]
            while node.tag in INLINE:
                node = node.parent
            now = Block(node)
            out.append(now)
        value = unescape(value)
        now.parts.append(value)
        if links:
            now.link_chars += len(value.strip())

    def close(to: int) -> None:
        nonlocal now, links
        for node in stack[to:]:
            if node.tag == "a":
                links -= 1
            if node.tag not in INLINE:
                now = None
        del stack[to:]

    while at <= len(page):
        if depth_of_raw:  # nothing but its own end tag ends a raw element
            end = re.compile(rf"</{depth_of_raw}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at, depth_of_raw = (end.end() if end else len(page) + 1), None
            continue
        m = PART.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = max(m.end(), at + 1)
        if m[1]:
            tag = m[1].lower()
            if tag in ("br", "p") and not any(n.tag == tag for n in stack):
                now = None
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
        elif m[2]:
            tag, attribute_text = m[2].lower(), m[3]
            if tag in RAW:
                if not attribute_text.rstrip().endswith("/"):
                    depth_of_raw = tag
                if tag not in INLINE:
                    now = None
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    text(" ")
                    now = now if tag == "br" else None
                continue
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag not in INLINE:
                        break
            elif tag in SAME_CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
                    if stack[i].tag in SAME_CLOSES[tag]:
                        break
            attributes = _attributes(attribute_text)
            parent = stack[-1]
            if tag in INLINE:
                node = Node(tag, parent.path, parent, parent.dropped, parent.container, parent.dropped_tag)
                links += tag == "a"
            else:
                path = "" if tag in ("html", "body") else f"{parent.path}>{_step(tag, attributes)}"
                node = Node(tag, path, parent, parent.dropped or _is_dropped(tag, attributes), parent.container, parent.dropped_tag or tag in DROPPED)
                if tag in ("article", "main") or attributes.get("role") == "main":
                    node.container = node
                if tag in HEADINGS and parent.container and parent.tag == "header" and parent.parent is not None and not parent.parent.dropped:
                    node.dropped = node.dropped_tag = False  # the article's own heading
                now = None
            stack.append(node)
    found = [b for b in out if b.text()]
    # where all text is in dropped parts, names misled: the tags alone decide
    return [b for b in found if not b.node.dropped] or [b for b in found if not b.node.dropped_tag]


def _container(node: Node) -> str:
    if node.container:
        return node.container.path
    while node.parent is not None and node.tag in HEADINGS | {"p", "li", "dd", "dt", "td", "th", "tr", "tbody", "ul", "ol", "dl", "table",
                                                              "blockquote", "pre", "figure", "figcaption", "center"}:
        node = node.parent
    return node.path


def path_scores(found: list[Block]) -> dict[str, float]:
    """The share of the page's text outside links that each container path has."""
    scores: dict[str, float] = {}
    for b in found:
        n = len(b.text())
        scores[_container(b.node)] = scores.get(_container(b.node), 0.0) + max(n - b.link_chars, 0)
    total = sum(scores.values())
    return {p: s / total for p, s in scores.items()} if total else {}


def _inside(path: str, winners: list[str]) -> bool:
    return any(path == w or path.startswith(w + ">") for w in winners)


def _mark(value: str) -> int:
    return int.from_bytes(blake2b(NUMBER.sub("#", value).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def path_marks(found: list[Block]) -> dict[str, int]:
    """A hash of the text that each container path has, with numbers masked."""
    texts: dict[str, list[str]] = {}
    for b in found:
        texts.setdefault(_container(b.node), []).append(b.text())
    return {p: _mark(" ".join(t)) for p, t in texts.items()}


def _common(paths: list[str]) -> str:
    """The lowest path that all are inside of."""
    steps = [p.split(">") for p in (min(paths), max(paths))]
    same = next((i for i, (x, y) in enumerate(zip(*steps)) if x != y), min(map(len, steps)))
    return ">".join(steps[0][:same])


def main_text(page: str, winners: list[str], fixed: list[str] = ()) -> str:
    found = blocks(page)
    scores = path_scores(found)
    fixed = set(fixed)
    own = {p: s for p, s in scores.items() if p not in fixed} or scores
    if not own:
        return " ".join(b.text() for b in found if _inside(_container(b.node), winners))
    best = max(own, key=lambda p: (own[p], p))
    seeds = [p for p in scores if _inside(p, winners)]
    if max((scores[p] for p in seeds), default=0.0) < WINNING_SHARE * own[best] or not seeds:
        seeds.append(best)  # a page of another make, with at most a stray block in the host's containers
    marked = {_container(b.node) for b in found if b.node.container}
    roots = [p for p in seeds if p in marked]
    if len(roots) < len(seeds):
        parts = {p for p, s in own.items() if s >= PART_SHARE * own[best]} | {_container(b.node) for b in found if b.node.tag == "h1"} - fixed
        roots.append(_common([p for p in seeds if p not in marked] + list(parts - marked)))
    kept = [b for b in found if (p := _container(b.node)) in seeds or p not in fixed and _inside(p, roots)]
    return " ".join(b.text() for b in kept)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winners, fixed) from (host, html): the winning container paths of every host, and those with the same text on all its pages."""
    names = ("votes", "pages", "least", "most", "least_page", "most_page")
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.float64()), *[(n, pa.int64()) for n in names[1:]]])

    def run(batches):
        for batch in batches:
            paths: dict[tuple[str, str], tuple] = {}
            hosts = batch.column(0).to_pylist()
            for at, texts in T.chunks(batch.column(1)):
                for j, value in enumerate(texts):
                    found = blocks((value or b"").decode())
                    if not (scores := path_scores(found)):
                        continue
                    whole = _mark(" ".join(b.text() for b in found))
                    for path, mark in path_marks(found).items():
                        v, n, low, high, low_page, high_page = paths.get((hosts[at + j], path), (0.0, 0, mark, mark, whole, whole))
                        paths[hosts[at + j], path] = (v + scores[path], n + 1, min(low, mark), max(high, mark), min(low_page, whole), max(high_page, whole))
            columns = zip(*paths.values()) if paths else [[]] * len(names)
            yield T.arrow_batch(schema, {"host": [k[0] for k in paths], "path": [k[1] for k in paths], **{n: list(c) for n, c in zip(names, columns)}})

    votes = pages.select("host", "html").mapInArrow(run, "host string, path string, votes double, " + ", ".join(f"{n} long" for n in names[1:]))
    votes = votes.groupBy("host", "path").agg(
        F.round(F.sum("votes"), 6).alias("votes"),  # free of the order of sums
        ((F.sum("pages") >= FIXED_PAGES) & (F.min("least") == F.max("most")) & (F.min("least_page") < F.max("most_page"))).alias("same"))
    best = votes.groupBy("host").agg(F.max("votes").alias("best")).withColumnRenamed("host", "best_host")
    wins = votes["votes"] >= WINNING_SHARE * best["best"]
    known = votes.join(best, votes["host"] == best["best_host"]).where(wins | votes["same"]).withColumn("wins", wins)
    return known.groupBy("host").agg(*[F.array_sort(F.collect_list(F.when(c, F.col("path")))).alias(name)
                                       for name, c in (("winners", F.col("wins")), ("fixed", ~F.col("wins")))])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of `pages`.

    Character references are decoded, white space within a block becomes one space, blocks are joined
    by one space. Null and empty pages, and pages without text, give an empty text. A null or broken
    url counts as the host "". Repeated rows and ids each get their own row. An empty table gives an
    empty result.
    """
    url = F.col(f"`{url_col}`").cast("string")
    pages = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"),
                         F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))).alias("host"))
    # written, so that Spark knows its size: broadcast if small, else a join that splits large hosts
    winners = cut_lineage(host_paths(pages), "host-paths").withColumnRenamed("host", "of_host")
    joined = pages.join(winners, pages["host"] == winners["of_host"], "left").select("page_id", "url", "html", "winners", "fixed")

    def run(batches):
        for batch in batches:
            paths, fixed = batch.column(3), batch.column(4)
            for at, texts in T.chunks(batch.column(2)):
                found = [main_text((v or b"").decode(), paths[at + j].as_py() or [], fixed[at + j].as_py() or []) for j, v in enumerate(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), pa.array(found, pa.string()),
                     pa.array([len(f) for f in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
