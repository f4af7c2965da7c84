"""HTML extraction (5): wrappers inferred as union-free regular expressions.

A page is a stream of structural tags (name and classes; inline markup belongs to the text)
and text slots "#".  Neighbouring equal runs fold into repeated groups, so most pages of
a host have one of a few signatures; these are counted by a grouped sum.  The signatures of
a host are aligned with its wrapper one after the other: runs that only one side has
become optional groups, plain runs that the other side repeats become that repeated group.
Signatures are merged a few at a time, wrappers again, until a host has one: no group
grows with the host's pages.

The wrapper names the host's main region: the element that holds the article.  A page's
text is what stands in that region, whole, without navigation, headers and footers of the
page, sidebars, notices, adverts, forms, scripts, styles and reader comments.  A page
without the region falls back to its body under the same exclusions.  A region other
than the default is the only thing that the second pass needs, so it is broadcast
while there are at most ``HOSTS`` of them and joined beyond.

A block ends where a block element starts or ends; <br> is white space.  Cases: null or empty
html gives an empty text; broken markup is read as browsers do, roughly: unknown end tags
are ignored, a block start ends an open paragraph, unclosed elements end with their
parent; a null url is a host of its own; rows that repeat a page_id are extracted each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import difflib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table

#: Signatures or wrappers merged by one task call, about; folded runs' length; hosts broadcast.
FAN_IN, RUN, HOSTS = 16, 12, 50_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th"
    " thead title tr ul".split()
)
#: Elements, roles and class words that never hold the article.
DROPPED = frozenset("aside button footer form head iframe menu nav noscript script select style svg template textarea title".split())
ROLES = frozenset("alert banner complementary contentinfo form navigation search".split())
WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr"
    " menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related share sharing sidebar"
    " signup social sponsor sponsored subscribe".split()
)
MAIN_WORDS = frozenset("article content entry main post story".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def events(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("start" | "end" | "text", name or raw text, attributes) in page order."""
    at, n = 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if m is None:
            yield "text", page[at:], {}
            return
        if m.start() > at:
            yield "text", page[at : m.start()], {}
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            yield "end", name, {}
            continue
        found = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        yield "start", name, found
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = close.start() if close else n
        elif m[3].rstrip().endswith("/") and name not in BLOCK and name not in VOID:
            yield "end", name, {}


def excluded(name: str, attributes: dict[str, str], inside_main: bool) -> bool:
    if name in DROPPED or (name == "header" and not inside_main):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return True
    words = set(re.split(r"[\s_-]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))
    if name in ("body", "html", "article", "main"):
        return False
    return bool(words & WORDS) or (not inside_main and "header" in words)


def label(name: str, attributes: dict[str, str]) -> str:
    """An element in signatures: its name and sorted classes."""
    classes = sorted(attributes.get("class", "").split())
    return ".".join([name, *classes])


class Stack:
    """Open elements; ends what HTML ends implicitly."""

    def __init__(self) -> None:
        self.open: list[tuple[str, object]] = []

    def start(self, name: str, value: object) -> list[tuple[str, object]]:
        """Elements that this start tag closes, innermost first."""
        closed = []
        if name in BLOCK and any(n == "p" for n, _ in self.open[-8:]):
            closed = self.end("p")
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and self.open and self.open[-1][0] == name:
            closed += self.end(name)
        if name not in VOID:
            self.open.append((name, value))
        return closed

    def end(self, name: str) -> list[tuple[str, object]]:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                closed = self.open[k:][::-1]
                del self.open[k:]
                return closed
        return []


# ------------------------------------------------------------------ signatures and wrappers
# A node is a tag or "#", ("+", nodes) for a repeated group or ("?", nodes) for an optional one.


def push(out: list, node) -> None:
    """Append ``node`` and fold the last run into a repeated group where it repeats."""
    out.append(node)
    for size in range(1, min(RUN, len(out) - 1) + 1):
        run = tuple(out[-size:])
        if out[-size - 1] == ("+", run):
            del out[-size:]
            return
        if 2 * size <= len(out) and out[-size - 1] == node and tuple(out[-2 * size : -size]) == run and run[0][:1] != "/":
            del out[-2 * size :]
            push(out, ("+", run))
            return


def signature(page: str) -> tuple:
    out: list = []
    stack, text = Stack(), False
    for kind, name, attributes in events(page):
        if kind == "text":
            text = text or bool(name.strip())
            continue
        if name not in BLOCK:
            if kind == "start" and name not in VOID and name not in RAW:
                stack.start(name, None)
            elif kind == "end":
                stack.end(name)
            continue
        if text:
            push(out, "#")
            text = False
        closed = stack.start(name, label(name, attributes)) if kind == "start" else stack.end(name)
        for n, own in closed:
            if n in BLOCK:
                push(out, f"/{own}")
        if kind == "start":
            push(out, label(name, attributes))
    if text:
        push(out, "#")
    for n, own in reversed(stack.open):
        if n in BLOCK:
            push(out, f"/{own}")
    return tuple(out)


def adopt(nodes: tuple, groups: list[tuple]) -> tuple:
    """``nodes`` with the plain runs that ``groups`` (the other side's groups) hold written as these groups."""
    out = list(nodes)
    for group in groups:
        run, k = list(group[1]), 0
        while k + len(run) <= len(out):
            if out[k : k + len(run)] == run:
                out[k : k + len(run)] = [group]
            k += 1
    folded: list = []
    for node in out:
        if not (folded and folded[-1] == node and isinstance(node, tuple)):
            folded.append(node)
    return tuple(folded)


def align(wrapper: tuple, other: tuple) -> tuple:
    """The wrapper generalised to match ``other`` as well."""
    if wrapper == other:
        return wrapper
    wrapper = adopt(wrapper, [x for x in other if isinstance(x, tuple) and x[0] == "+"])
    other = adopt(other, [x for x in wrapper if isinstance(x, tuple)])
    out: list = []

    def optional(nodes: tuple) -> None:
        if nodes:
            out.append(nodes[0] if len(nodes) == 1 and isinstance(nodes[0], tuple) and nodes[0][0] == "?" else ("?", nodes))

    match = difflib.SequenceMatcher(None, wrapper, other, autojunk=False)
    for kind, a, b, c, d in match.get_opcodes():
        if kind == "equal":
            out.extend(wrapper[a:b])
        else:
            optional(wrapper[a:b])
            optional(other[c:d])
    return tuple(out)


def freeze(x):
    return tuple(freeze(y) for y in x) if isinstance(x, list) else x


def flat(nodes: tuple) -> Iterator[str]:
    for node in nodes:
        if isinstance(node, tuple):
            yield from flat(node[1])
        else:
            yield node


def main_region(wrapper: tuple) -> str:
    """Label of the element that holds the article in pages of this wrapper."""
    open_: list[str] = []
    rank: dict[str, tuple] = {}
    slots: Counter = Counter()
    for token in flat(wrapper):
        if token == "#":
            inside = [x for x in open_ if not excluded(x.split(".")[0], {"class": " ".join(x.split(".")[1:])}, False)]
            if len(inside) == len(open_) and len(open_) > 1:
                for depth, x in enumerate(open_[:-1]):
                    slots[x] += 1
                    name, *classes = x.split(".")
                    words = {w for c in classes for w in re.split(r"[_-]+", c.lower())}
                    kind = 3 if name == "article" else 2 if name == "main" else 1 if words & MAIN_WORDS else 0
                    rank.setdefault(x, (kind, depth))
        elif token.startswith("/"):
            if token[1:] in open_:
                del open_[len(open_) - 1 - open_[::-1].index(token[1:]) :]
        elif token.split(".")[0] not in VOID:
            open_.append(token)
    if not slots:
        return "body"
    named = [x for x in slots if rank[x][0]]
    if named:
        return max(named, key=lambda x: (rank[x][0], slots[x], -rank[x][1]))
    return max(slots, key=lambda x: (slots[x], rank[x][1]))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)``: one wrapper (JSON) for each host of ``pages`` (host, html), written."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[host, json.dumps(signature(page or ""))] += 1
            if len(found) > 50_000:
                yield table(found)
                found = Counter()
        yield table(found)

    def table(found: Counter) -> pa.RecordBatch:
        rows = [(h, w, n) for (h, w), n in found.items()]
        columns = list(zip(*rows)) if rows else [[], [], []]
        types = pa.string(), pa.string(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["host", "wrapper", "n"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n", "wrapper"], ascending=[False, True])
        own = [freeze(json.loads(w)) for w in part["wrapper"]]
        wrapper = own[0]
        for other in own[1:]:
            wrapper = align(wrapper, other)
        return pd.DataFrame({"host": [part["host"].iloc[0]], "wrapper": [json.dumps(wrapper)], "n": [int(part["n"].sum())]})

    signed = pages.mapInArrow(sign, "host string, wrapper string, n long")
    out = cut(signed.groupBy("host", "wrapper").agg(F.sum("n").alias("n")), "signatures")
    while True:
        sizes = cut(out.groupBy(F.col("host").alias("s_host")).agg(F.count("*").alias("size")).filter("size > 1"), "host-sizes")
        if sizes.isEmpty():
            return out.select("host", "wrapper")
        many = out.join(sizes, F.col("host") == F.col("s_host"))
        part = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("size") / FAN_IN).cast("long"))
        merged = many.select("host", "wrapper", "n", part.alias("part")).groupBy("host", "part")
        merged = merged.applyInPandas(merge, "host string, wrapper string, n long")
        out = cut(out.join(sizes, F.col("host") == F.col("s_host"), "left_anti").unionByName(merged), "wrappers")


def regions(hosts: DataFrame) -> DataFrame:
    """``(host, region)`` of ``hosts`` (host, wrapper) whose region is not the default "article"; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_region(freeze(json.loads(w))) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["r_host", "region"])

    found = hosts.mapInArrow(run, "r_host string, region string")
    return cut(found.filter("region <> 'article'"), "regions")


def extract(page: str, region: str = "article") -> str:
    """Main text of a page: the blocks of ``region``, or of the body where there is none."""
    inside, outside = _blocks(page, region)
    return "\n".join(inside if inside else outside)


def _blocks(page: str, region: str) -> tuple[list[str], list[str]]:
    stack, text = Stack(), []
    parts: tuple[list[str], list[str]] = [], []
    main = dropped = 0  # open elements that are the region, or excluded

    def close(elements) -> None:
        nonlocal main, dropped
        for _, value in elements:
            is_main, is_dropped = value
            main -= is_main
            dropped -= is_dropped

    def flush() -> None:
        if text:
            block = " ".join("".join(text).split())
            if block and not dropped:
                parts[0 if main else 1].append(block)
            text.clear()

    for kind, name, attributes in events(page):
        if kind == "text":
            if not dropped:
                text.append(html.unescape(name))
        elif kind == "start":
            if name == "br":
                text.append("\n")
            drop = name not in VOID and excluded(name, attributes, main > 0)
            is_main = name not in VOID and (label(name, attributes) == region or (region == "article" and name == "article"))
            if name in BLOCK or drop or is_main:
                flush()
            close(stack.start(name, (is_main, drop)))
            if name not in VOID:
                main, dropped = main + is_main, dropped + drop
        else:
            found = next((v for n, v in reversed(stack.open) if n == name), None)
            if name in BLOCK or (found and any(found)):
                flush()
            close(stack.end(name))
    flush()
    return parts


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    other = regions(wrappers(rows.select("host", "html")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, region = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            texts = [extract(p or "", r or "article") for p, r in zip(page, region)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    if other.isEmpty():
        rows = rows.withColumn("region", F.lit(None).cast("string"))
    else:
        small = other.count() <= HOSTS
        rows = rows.join(F.broadcast(other) if small else other, F.col("host") == F.col("r_host"), "left")
    kept = rows.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "region")
    return kept.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
