"""Main text of web pages by consensus of each host's pages.

Every page scores its containers by the text they hold.  Scores are votes for
generalised tag-class paths; Spark adds them up per host.  Pages are then read
again and give the text under their host's winning path, or under their own
best container where that path is not on the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.session import written

# Kinds of elements, and names that mark what is no article.
CONTAINERS = frozenset("article main section div td body center".split())
BLOCKS = CONTAINERS | frozenset(
    "address blockquote caption dd details dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr"
    " html legend li menu nav ol p pre summary table tbody tfoot th thead tr ul aside".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset(
    "head title nav header footer aside form button select option datalist textarea input label iframe svg math canvas object"
    " noscript template dialog menu audio video map script style".split()
)
NO_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie"
    " cookies consent gdpr banner alert popup modal overlay newsletter subscribe signup ad ads advert adverts advertisement"
    " advertising sponsor sponsored promo promotion related recommended recommendations share sharing social comment comments"
    " disqus respond replies reply login search pagination pager toolbar skip hidden".split()
)
NO_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
# An article may be about sharing or have a header style; these names say that it is none.
NO_ARTICLES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion related recommended recommendations"
    " comment comments disqus respond replies reply".split()
)
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.I | re.S,
)
RAW_END = re.compile(r"</(?:script|style)\s*>\Z", re.I)
DEEP = 60  # containers inside each other
ATTR = re.compile(r"""([a-z][\w:-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[a-z]+", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Container:
    parent: int
    path: str
    tag: str
    depth: int
    text: int = 0  # characters in all blocks inside
    linked: int = 0  # of these, in links


@dataclass
class Page:
    containers: list[Container] = field(default_factory=lambda: [Container(-1, "body", "body", 0)])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # container, text, characters in links

    def inside(self, wanted: set[int]) -> str:
        """The blocks in or under the wanted containers, one a line."""
        good: dict[int, bool] = {-1: False}
        for i, c in enumerate(self.containers):
            good[i] = i in wanted or good[c.parent]
        return "\n".join(text for i, text, _ in self.blocks if good[i])

    def scores(self) -> list[float]:
        """Share of the page's text, without links; articles and inner containers win over small losses."""
        whole = max(1, self.containers[0].text)
        return [
            (c.text - c.linked) / whole
            + (0.2 if c.depth else 0)
            + (0.1 if c.tag in ("article", "main") else 0)
            + 0.02 * min(c.depth, 10)
            for c in self.containers
        ]


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(text)} if text.strip(" /") else {}


def _unwanted(tag: str, attrs: dict[str, str]) -> bool:
    if tag in NO_TEXT:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in NO_ROLES:
        return True
    if "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    named = CAMEL.sub(" ", f"{attrs.get('class', '')} {attrs.get('id', '')}")
    names = NO_ARTICLES if tag == "article" else NO_NAMES
    return not names.isdisjoint(x.lower() for x in NAME.findall(named))


def _step(tag: str, attrs: dict[str, str]) -> str:
    """A tag with its classes, in order, numbers and long codes made alike."""
    classes = {re.sub(r"\d+", "#", c) for c in attrs.get("class", "").lower().split()}
    return ".".join([tag, *sorted("*" if len(c) > 24 else c for c in classes)])


def _path(above: Container, step: str) -> str:
    """The path of a container inside ``above``; very deep ones begin with a digest, so that they stay short."""
    start = above.path if above.depth < DEEP else "#" + xxhash.xxh3_64_hexdigest(above.path.encode())
    return f"{start}/{step}"


def parse(html: str) -> Page:
    """Containers and text blocks of a page, outside of what is no article; any text can be read."""
    page = Page()
    stack: list[tuple[str, int, bool]] = []  # tag, container, unwanted
    opened: Counter = Counter()  # tags on the stack
    current, hidden, links = 0, 0, 0
    parts: list[str] = []
    linked: list[str] = []

    def close_block():
        text = " ".join("".join(parts).split())
        if text:
            in_links = min(len(text), len(" ".join("".join(linked).split())))
            page.blocks.append((current, text, in_links))
            page.containers[current].text += len(text)
            page.containers[current].linked += in_links
        parts.clear()
        linked.clear()

    def pop():
        nonlocal current, hidden, links
        tag, container, unwanted = stack.pop()
        opened[tag] -= 1
        if tag in BLOCKS:
            close_block()
        current = container
        hidden -= unwanted
        links -= tag == "a"

    def add(text: str):
        if text and not hidden:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked.append(text)

    # Nothing behind the last ">" is a tag, so unclosed ones are looked at once, as text.
    end_of_last, tags_end = 0, html.rfind(">") + 1
    tail = html[tags_end:].partition("<!--")[0]
    for m in TOKEN.finditer(html, 0, tags_end):
        add(html[end_of_last : m.start()])
        end_of_last = m.end()
        if end_of_last == tags_end and (m["raw"] and not RAW_END.search(m[0]) or m[0].startswith("<!--") and not m[0].endswith("-->")):
            tail = ""  # it is inside a comment or script that never ends
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCKS:
                close_block()
            continue
        if tag == "br":
            add(" ")
        text_of = m["attrs"] if m["tag"] else m["attrs2"]
        if tag in VOID:
            if tag == "hr":
                close_block()
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            pop()
        if tag in BLOCKS:
            # an open paragraph ends at any block, whatever inline elements are still open in it
            for depth in range(len(stack) - 1, -1, -1):
                name = stack[depth][0]
                if name == "p" or (name == tag and tag in ("li", "tr", "td", "th", "dt", "dd")):
                    while len(stack) > depth:
                        pop()
                    break
                if name in BLOCKS:
                    break
            close_block()
        if text_of.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        attrs = _attributes(text_of)
        unwanted = _unwanted(tag, attrs)
        stack.append((tag, current, unwanted))
        opened[tag] += 1
        hidden += unwanted
        links += tag == "a"
        if tag in CONTAINERS and not hidden and not (tag == "body" and current == 0 and len(page.containers) == 1):
            here = page.containers[current]
            page.containers.append(Container(current, _path(here, _step(tag, attrs)), tag, here.depth + 1))
            current = len(page.containers) - 1
    add(html[end_of_last:tags_end] + tail)
    while stack:
        pop()
    close_block()
    for c in reversed(page.containers[1:]):  # parents stand before their children
        page.containers[c.parent].text += c.text
        page.containers[c.parent].linked += c.linked
    return page


def host_of(url: str) -> str:
    rest = url.split("://", 1)[-1]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rsplit("@", 1)[-1].split(":")[0].lower()


LEAST_SHARE = 0.3  # containers with less of a page's text are no candidates


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, scores = [], [], []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            page = parse(html or "")
            best: dict[str, float] = {}
            for c, score in zip(page.containers, page.scores()):
                if c.text >= LEAST_SHARE * max(1, page.containers[0].text):
                    best[c.path] = max(score, best.get(c.path, 0.0))
            hosts += [host_of(url or "")] * len(best)
            paths += best
            scores += best.values()
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
            names=["host", "path", "score"],
        )


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: the path with the highest sum of scores, the lesser path on a tie.

    Votes are added up inside each partition first, so a host that holds a
    third of all pages is a few rows per task.
    """
    votes = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(
        _votes, "host string, path string, score double"
    )
    sums = votes.groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"))
    best = sums.groupBy("host").agg(F.min(F.struct((-F.col("score")).alias("minus"), "path")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"))


def page_text(html: str, path: str | None) -> str:
    page = parse(html)
    wanted = {i for i, c in enumerate(page.containers) if c.path == path}
    if not wanted:
        scores = page.scores()
        wanted = {scores.index(max(scores))}
    return page.inside(wanted)


def _texts(batches: Iterator[pa.RecordBatch], html: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [page_text(h or "", p) for h, p in zip(batch.column(html).to_pylist(), batch.column("__path").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "__text"])


HOST = r"^(?:[\s\S]*?://)?(?:[^/?#]*@)?([^/?#:]*)"


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``__text``, all other columns as they are.

    Null or empty HTML has an empty text; pages with a null URL, or without a
    host in it, vote together.  Repeated rows get equal texts.
    """
    best = written(winning_paths(pages, url, html), "paths").withColumnsRenamed({"host": "__host", "path": "__path"})
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))
    found = pages.withColumn("__host", host).join(best, "__host", "left").select(*[pages[f"`{c}`"] for c in pages.columns], "__path")
    schema = T.StructType([*found.schema.fields, T.StructField("__text", T.StringType())])
    return found.mapInArrow(lambda batches: _texts(batches, html), schema).drop("__path")
