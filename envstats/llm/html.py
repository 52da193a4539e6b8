"""Main text of web pages (operator 5): markup, and a host suffix array.

A page with an ``article`` or ``main`` element has its main text there, as
parsed: one in a comment or script, or that holds reader comments, is none.
Names mark boilerplate as whole class tokens or ids, or as compounds of such a
name with words of layout ("ad-slot", "site-nav"; not "has-sidebar"), never on
``html``, ``body``, headings' ids or the article itself, and not around a
``main`` or the page's only article when the page has no other.  Marked inline
elements leave their block, the rest of the block stays together.

For a page without an unmarked article, everything in the body outside marked
boilerplate (menus, forms, adverts, ...) is a candidate, and the host decides.
The token streams of all pages of a host, outside their articles, are
concatenated, and a run of tokens is boilerplate when it stands in at least
``MIN_PAGES`` and a share of ``SHARE`` of the host's distinct pages.  A block
goes if such runs cover ``COVERED`` of its tokens; all other blocks stay whole,
also if a sentence or a half of them recurs elsewhere.  Pages are distinct when
their texts are not near copies of each other (operator 7, from 0.8 on): ten
versions of a story do not make the story boilerplate.

The suffix array (``suffixarray``) holds every suffix of every distinct stream
in order, with the tokens it shares with its predecessor.  Neighbours that share
``RUN`` tokens or more are an interval; the distinct pages of an interval are
counted, and each of its suffixes begins a run.  The union of these covers is
that of all longer repeats, too.  No task holds a large host: its suffixes are
sorted into ranges, and pages with equal streams are one stream with many pages.

The method alone does not give the contract's result: it would drop a
passage that many articles of a host share and keep a menu that stands in one
page only.  Hence the marked elements decide first.  Pages are parsed once, and
the array of every host is built and its intervals are judged; a page with an
article has no block left that the verdict could drop.

Defined results: null html is the empty page with empty text; pages with
equal streams count as one page (a repeated row does not make its own text
boilerplate); repeated rows give repeated results; a page without a host
forms a host with all such pages; an empty table gives an empty table.
Unclosed elements end with their parent, text after an open quote or tag at
the end of the page is dropped, as browsers do.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common, neardup, suffixarray
from envstats.operators.joins import sized_broadcast

RUN = 6                      # tokens of a run
MIN_PAGES, SHARE = 3, 0.3    # distinct pages of the host, and share of them, that hold boilerplate
COVERED = 0.8                # share of a block's tokens from which it goes
ALIKE = 80                   # hundredths of similarity from which pages are copies of one

# Elements and name parts that mark text outside the article.
_RAW = "script|style|noscript|template|svg|textarea|iframe|select|canvas|object|math"
_BOILER_TAGS = frozenset("nav footer aside form button menu dialog head title".split())
_BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer menu modal nav navbar navigation newsletter "
    "notice notices pagination popup promo related share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split())
_LAYOUT = frozenset(
    "site page main global primary secondary top bottom left right inner outer header bar box block "
    "area section container wrapper wrap slot unit list item items link links button buttons icon "
    "icons text title heading body content posts articles stories article post entry holder row "
    "column col panel group form field message popover overlay close".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SELF_CLOSING = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^<>]*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][\w:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*+)([^<>]*+)>|[^<]++|<", re.S | re.I)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_READER = re.compile(r"comments?(?![a-z])")            # of an article with a reader's comment
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())     # their ids are anchors


@dataclass
class Block:
    """Text of one block: in the article, in marked boilerplate, or neither."""

    text: str
    article: bool
    marked: bool


def _boiler_name(name: str) -> bool:
    """A name of boilerplate, or a compound of one with words of layout."""
    if name in _BOILER_NAMES:
        return True
    parts = re.split("[-_]+", name.strip("-_"))
    return (len(parts) > 1 and not _BOILER_NAMES.isdisjoint(parts)
            and all(p in _BOILER_NAMES or p in _LAYOUT or p.isdecimal() for p in parts))


def _kind(tag: str, attributes: str, in_article: bool) -> str:
    """article, boiler, named (boilerplate that may be around an article) or plain."""
    names, role = set(), ""
    if "=" in attributes:
        for name, *values in _NAMED.findall(attributes):
            value, name = "".join(values).lower(), name.lower()
            if name == "role":
                role = value.strip()
            elif name == "class" or tag not in _HEADINGS:
                names.update(value.split())
    if tag in ("html", "body"):
        return "plain"
    if tag in ("article", "main") or role == "main":
        reader = tag == "article" and any(map(_READER.match, names))
        return "boiler" if reader else "article"
    whole = not names.isdisjoint(_BOILER_NAMES)
    if tag == "form" or role == "form" or whole or (
            tag not in _HEADINGS and any(map(_boiler_name, names))):
        return "boiler" if tag in _BOILER_TAGS - {"form"} else "named"
    if tag in _BOILER_TAGS or role in _BOILER_ROLES:
        return "boiler"
    return "boiler" if tag == "header" and not in_article else "plain"


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, white space folded, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    article = boiler = named = articles = 0
    around: list[tuple[int, bool]] = []     # of open articles: named elements, whether a main
    lifted: list[tuple[Block, bool]] = []   # marked by named elements around their article only
    buffer: list[tuple[str, int, int]] = []  # text, and the marked elements around it

    def flush() -> None:
        marks = [x[1:] for x in buffer if not x[0].isspace()]
        if not marks:
            buffer.clear()
            return
        least = min(marks, key=sum)             # inline elements with more marks leave the block
        text = " ".join(entities.unescape("".join(
            t if m == least else " " for t, *x in buffer for m in [tuple(x)])).split())
        buffer.clear()
        if text:
            out.append(Block(text, article > 0, sum(least) > 0))
            if around and least[1] and not least[0] and around[-1][0] == least[1]:
                lifted.append((out[-1], around[-1][1]))

    def pop() -> str:
        nonlocal article, boiler, named
        name, kind = stack.pop()
        if kind == "article":
            article -= 1
            around.pop()
        boiler -= kind == "boiler"
        named -= kind == "named"
        return name

    for m in _TOKEN.finditer(page):
        s = m.group()
        if s[0] != "<":
            buffer.append((s, boiler, named))
            continue
        name = m.group(3) or m.group(6)
        if name is None:
            if s == "<":
                if re.match(r"/?[a-zA-Z]", page[m.end():m.end() + 2]) and page.find(">", m.end()) < 0:
                    break
                buffer.append((s, boiler, named))
            continue
        name, closing = name.lower(), bool(m.group(2) or m.group(5))
        block = name in _BLOCK
        if name == "br":
            buffer.append((" ", boiler, named))
        if closing:
            if block:
                flush()
            if any(n == name for n, _ in stack):
                while pop() != name:
                    pass
            continue
        attributes = m.group(4) or m.group(7) or ""
        kind = _kind(name, attributes, article > 0)
        if block:
            flush()
            if stack and stack[-1][0] == "p":
                pop()
            ends = _SELF_CLOSING.get(name, ())
            while stack and stack[-1][0] in ends:
                pop()
        if name not in _VOID and not attributes.endswith("/") and (block or kind != "plain"):
            stack.append((name, kind))
            if kind == "article":
                article += 1
                articles += 1
                around.append((named, name != "article"))
            boiler += kind == "boiler"
            named += kind == "named"
    flush()
    if lifted and not has_article(out):
        for b, whole in lifted:
            b.marked = not whole and articles > 1
    return out


def has_article(parts: list[Block]) -> bool:
    return any(b.article and not b.marked for b in parts)


def _ids(host: str, outside) -> bytes:
    """Token ids of a page's stream: hashes of host and token, so that hosts share none."""
    tokens = [t for b in outside for t in b["text"].split()]
    seed = xxhash.xxh64_intdigest(host)
    return np.array([xxhash.xxh64_intdigest(t, seed) for t in tokens], np.uint64).astype(">u8").tobytes()


def article_text(parts: list[Block]) -> str:
    return "\n".join(b.text for b in parts if b.article and not b.marked)


def kept_text(outside: list[tuple[str, bool]], covered: set[int]) -> str:
    """The unmarked blocks (text, marked) of which ``covered`` runs, named by
    their first token in the page, cover less than COVERED."""
    sizes = [len(text.split()) for text, _ in outside]
    gone = np.zeros(sum(sizes) + RUN, bool)
    for at in covered:
        gone[at:at + RUN] = True
    ends = np.cumsum(sizes)
    return "\n".join(text for (text, marked), n, end in zip(outside, sizes, ends)
                     if not marked and gone[end - n:end].sum() < COVERED * n)


def parse(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, host, text, outside) of every row, written: the article's text
    (null without one) and the blocks outside articles in page order."""
    rows = common.pick(pages, key=key, url=url, html=html).withColumn(
        "html", common.text_of(F.col("html")))
    rows = rows.withColumn("host", F.lower(F.coalesce(
        F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1), F.lit(""))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parsed = [blocks(h) for h in b["html"]]
            yield pd.DataFrame({
                "key": b["key"], "url": b["url"], "host": b["host"],
                "text": [article_text(p) if has_article(p) else None for p in parsed],
                "outside": [[{"text": x.text, "marked": x.marked} for x in p if not x.article]
                            for p in parsed]})

    return common.written(common.through_python(
        rows, run, "url string, host string, text string, "
                   "outside array<struct<text: string, marked: boolean>>"), "pages", "zstd")


def repeated_runs(parsed: DataFrame) -> DataFrame:
    """(stream, at), written: where runs of boilerplate of the hosts begin; a stream
    is the hash of (host, outside)."""
    free = F.filter("outside", lambda b: ~b["marked"])
    content = F.coalesce("text", F.array_join(F.transform(free, lambda b: b["text"]), "\n"))
    pages = parsed.select("host", content.alias("content"), F.xxhash64("host", content).alias("page"),
                          F.xxhash64("host", "outside").alias("stream"))
    with common.passing(parsed.sparkSession):
        copies = (neardup.group(pages.select("page", "content"), "page", "content", ALIKE)
                  .select(F.col("key").alias("page"), F.col("component_id").alias("copy")))
        held = common.written(pages.select("page", "host", "stream").join(copies.dropDuplicates(["page"]), "page")
                              .select("host", "copy", "stream").distinct(), "copies")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"host": b["host"], "stream": b["stream"], "ids": [
                _ids(h, o) for h, o in zip(b["host"], b["outside"])]})

    with common.passing(parsed.sparkSession):
        streams = common.written(
            parsed.select(F.xxhash64("host", "outside").alias("stream"), "host", "outside")
            .dropDuplicates(["stream"]).mapInPandas(run, "host string, stream long, ids binary"), "streams")
        suffixes = common.written(
            suffixarray.group_intervals(streams, RUN, "host").where(F.col("rest") >= RUN)
            .select("stream", "at", "interval"), "suffixes")
        return common.written(_boilerplate(suffixes, held), "runs")


def _boilerplate(suffixes: DataFrame, held: DataFrame) -> DataFrame:
    """(stream, at) of the suffixes whose interval is in enough distinct pages of its host."""
    # an interval with few pages in all its streams, told apart or not, is no candidate
    weights = held.groupBy("stream").agg(F.count("*").alias("weight"))
    members = suffixes.select("interval", "stream").distinct()
    enough = (members.join(weights, "stream").groupBy("interval").agg(F.sum("weight").alias("most"))
              .where(F.col("most") >= MIN_PAGES).select("interval"))
    counted = (members.join(enough, "interval", "left_semi").join(held, "stream")
               .select("host", "interval", "copy").distinct()
               .groupBy("host", "interval").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES))
    of_host = held.select("host", "copy").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    runs = (counted.join(sized_broadcast(of_host), "host")
            .where(F.col("n") >= SHARE * F.col("pages")).select("interval"))
    return suffixes.join(runs, "interval", "left_semi").select("stream", "at")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""
    parsed = parse(pages, key, url, html)
    covers = repeated_runs(parsed).groupBy("stream").agg(F.collect_list("at").alias("covered"))
    done = parsed.where("text IS NOT NULL").select("key", "url", "text")
    bare = parsed.where("text IS NULL").withColumn("stream", F.xxhash64("host", "outside"))

    def from_covers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "url": b["url"], "text": [
                kept_text([(x["text"], x["marked"]) for x in o], set() if c is None else set(c))
                for o, c in zip(b["outside"], b["covered"])]})

    joined = bare.join(covers, "stream", "left").select("key", "url", "outside", "covered")
    rest = common.through_python(joined, from_covers, "url string, text string")
    return done.union(rest).withColumnRenamed("key", "page_id")


def with_lengths(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
