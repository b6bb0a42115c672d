"""Main text of web pages by site style trees: what varies from page to page is content.

Each page is cut into blocks of text, each at a path of block elements (tag with class and
id). The pages of a host, merged, form its style tree: a node is a path, with the texts and
the sequences of inline tags that its pages have there. A node's importance is their entropy
over its pages, relative to the largest possible: near 1 where every page differs, near 0 for
a menu or a notice that repeats. The host's tree and that of all hosts together count by their
pages, up to ``WEIGHT`` each, so that a host with few pages leans on the others. What tags
and class names declare counts like a number of pages below that of both trees, so that it
decides where pages are few, and trees of many pages can overcome it. In a declared article
``CONTENT_WEIGHT`` lets go what hardly varies, a notice on every page. What is declared to be
a menu or an advert counts more, ``FURNITURE_WEIGHT``, since adverts differ from page to page
too; it stays only where texts and inline tags differ on nearly all pages. A class or id is
compared as a whole (``related-work`` is not ``related``). Blocks at nodes below ``LEAST`` are
removed. Blocks of a page at one path are one node, and stay or go together.

Copies of a page count once in the trees. Everything is grouped by node or by page, never by
host, and each page is joined to the decisions on its own nodes.

Edge cases. A null or empty html gives an empty text. A null or malformed url belongs to one
nameless host. Pages cut off in the middle end there; unclosed elements are closed by what
follows. Script, style, head and similar elements never give text. Repeated rows each give a
row. Only the named columns are looked at, and only they are returned.
"""

from __future__ import annotations

import hashlib
import html as html_module
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wxengine.session import shared_dir

LEAST = 0.5
WEIGHT = 50
# Both below twice WEIGHT, what the trees of a site and of all sites have together.
CONTENT_WEIGHT = 50
FURNITURE_WEIGHT = 90
CONTENT_SHARE = 0.9

# Elements by their part in a page, from the HTML standard.
_VOID = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = set("script style noscript template iframe textarea title svg math object".split())
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend"
    " li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr"
    " ul".split()
)
# An opening tag that ends an open element of its own kind, and what bounds the search.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Names by which pages declare what is not their content, and what is.
_FURNITURE_TAGS = set("nav footer aside form menu dialog button select fieldset head".split())
_FURNITURE_NAMES = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs footer cookie cookies consent notice popup modal"
    " newsletter subscribe signup share sharing social comment comments related recommended"
    " widget toolbar pager pagination login search disqus replies respond complementary"
    " contentinfo".split()
)
_CONTENT_TAGS = {"article", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)|[^<]+|<",
    re.DOTALL,
)
_NAMES = re.compile(
    r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE
)
# A name without its numbers, which differ from page to page.
_NAME = re.compile(r"[a-z]+(?:[^a-z\s]+[a-z]+)*")
_NOT_LETTERS = re.compile(r"[^a-z]+")


class Page:
    """Blocks of one page in order: (path, inline tags, text)."""

    def __init__(self, source: str | None) -> None:
        self.blocks: list[tuple[str, str, str]] = []
        self._open: list[tuple[str, str]] = []
        self._text: list[str] = []
        self._style: list[str] = []
        if source:
            self._read(source)
            self._flush()

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = _TOKEN.match(source, at)
            at = m.end()
            tag = m.group(2)
            if tag is None:
                token = m.group()
                if token[0] != "<" or token == "<":
                    self._text.append(html_module.unescape(token))
                continue
            tag = tag.lower()
            if m.group(1):
                self._end(tag)
                continue
            attributes = m.group(3)
            if tag in _RAW and not attributes.endswith("/"):
                # Its content is not markup; it goes as far as its own closing tag.
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|$)", re.IGNORECASE)
                end = close.search(source, at)
                at = end.end() if end else size
                continue
            self._start(tag, attributes)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in _VOID:
            if tag == "br":
                self._text.append("\n")
            elif tag == "hr":
                self._flush()
            self._style.append(tag)
            return
        if tag not in _BLOCK:
            self._open.append((tag, ""))
            self._style.append(tag)
            return
        self._flush()
        same, bounds = _SIBLINGS.get(tag, (set(), set()))
        self._close_up_to({"p"}, _BLOCK - {"p"})
        self._close_up_to(same, bounds)
        names = ""
        if attributes:
            found = (" ".join(filter(None, groups)) for groups in _NAMES.findall(attributes))
            whole = _NAME.findall(" ".join(found).lower())
            names = ".".join(sorted({_NOT_LETTERS.sub("-", name) for name in whole}))
        self._open.append((tag, f"{tag}.{names}" if names else tag))

    def _close_up_to(self, tags: set[str], bounds: set[str]) -> None:
        for i in range(len(self._open) - 1, -1, -1):
            tag = self._open[i][0]
            if tag in tags:
                del self._open[i:]
                return
            if tag in bounds:
                return

    def _end(self, tag: str) -> None:
        block = tag in _BLOCK
        if block:
            self._flush()
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                return
            if not block and self._open[i][0] in _BLOCK:
                return

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            path = "/".join(label for _, label in self._open if label)
            self.blocks.append((path, ",".join(self._style), text))
        self._text.clear()
        self._style.clear()


def declared(path: str) -> float | None:
    """1 inside what is declared content, 0 inside what is declared not to be, else None."""
    content = False
    for label in path.split("/"):
        tag, _, names = label.partition(".")
        if tag in _CONTENT_TAGS:
            content = True
        words = set(names.split("."))
        header = not content and (tag == "header" or "header" in words)
        if header or tag in _FURNITURE_TAGS or (words & _FURNITURE_NAMES and tag not in ("html", "body")):
            return 0.0
    return 1.0 if content else None


_NODES = "array<struct<path:string,style:bigint,text:bigint,prior:double>>"
_ARROW_NODES = pa.list_(
    pa.struct(
        [("path", pa.string()), ("style", pa.int64()), ("text", pa.int64()), ("prior", pa.float64())]
    )
)


def _number(text: str) -> int:
    """64 bits of a digest; entropies only need to tell texts apart, not to know them."""
    digest = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def nodes(source: Column) -> Column:
    """The text-bearing nodes of a page: path, inline tags, digest of all its text, prior."""

    @F.arrow_udf(_NODES)
    def found(pages: pa.Array) -> pa.Array:
        out = []
        for page in pages:
            merged: dict[str, tuple[list[str], list[str]]] = {}
            for path, style, text in Page(page.as_py()).blocks:
                styles, texts = merged.setdefault(path, ([], []))
                styles.append(style)
                texts.append(text)
            out.append(
                [
                    {
                        "path": path,
                        "style": _number(";".join(sorted(set(styles)))),
                        "text": _number("\n".join(texts)),
                        "prior": declared(path),
                    }
                    for path, (styles, texts) in merged.items()
                ]
            )
        return pa.array(out, type=_ARROW_NODES)

    return found(source)


def _entropy(rows: DataFrame, node: list[str], value: str) -> DataFrame:
    """Entropy of ``value`` over the pages of each node, relative to that of all different."""
    counts = rows.groupBy(*node, value).agg(F.count("*").alias("c"))
    sums = counts.groupBy(*node).agg(
        F.sum("c").alias("pages"), F.sum(F.col("c") * F.log(F.col("c"))).alias("clogc")
    )
    share = (F.log("pages") - F.col("clogc") / F.col("pages")) / F.log("pages")
    return sums.select(*node, "pages", F.when(F.col("pages") > 1, share).otherwise(1.0).alias("h"))


def _tree(rows: DataFrame, node: list[str]) -> DataFrame:
    content = _entropy(rows, node, "text")
    style = _entropy(rows, node, "style").drop("pages").withColumnRenamed("h", "s")
    mixed = F.lit(CONTENT_SHARE) * F.col("h") + F.lit(1 - CONTENT_SHARE) * F.col("s")
    return content.join(style, node).select(
        *node, F.least("pages", F.lit(WEIGHT)).alias("weight"), mixed.alias("importance")
    )


def importance(rows: DataFrame) -> DataFrame:
    """(host, path, importance) of every node of every site, from (host, page, node) rows."""
    site = _tree(rows, ["host", "path"])
    whole = _tree(rows, ["path"]).select(
        "path", F.col("weight").alias("_w"), F.col("importance").alias("_i")
    )
    priors = rows.groupBy("path").agg(F.first("prior").alias("prior"))
    joined = site.join(whole.join(priors, "path"), "path")
    prior_weight = (
        F.when(F.col("prior") > 0, F.lit(CONTENT_WEIGHT))
        .when(F.col("prior").isNotNull(), F.lit(FURNITURE_WEIGHT))
        .otherwise(0)
    )
    mean = (
        F.col("weight") * F.col("importance")
        + F.col("_w") * F.col("_i")
        + prior_weight * F.coalesce("prior", F.lit(0.0))
    ) / (F.col("weight") + F.col("_w") + prior_weight)
    return joined.select("host", "path", mean.alias("importance"))


def main_text(source: Column, removed: Column) -> Column:
    """The text of a page without the blocks at the paths in ``removed``."""

    @F.arrow_udf("string")
    def text(pages: pa.Array, paths: pa.Array) -> pa.Array:
        out = []
        for page, own in zip(pages, paths, strict=True):
            gone = set(own.as_py() or ())
            blocks = Page(page.as_py()).blocks
            out.append(" ".join(text for path, _, text in blocks if path not in gone))
        return pa.array(out, type=pa.string())

    return text(source, removed)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: float = LEAST,
) -> DataFrame:
    """One row per page: id, url, ``text``."""
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
        F.lower(F.coalesce(F.try_parse_url(F.col(url_col), F.lit("HOST")), F.lit(""))).alias("host"),
    ).withColumn("page", F.unhex(F.md5("_html")))
    found = (
        rows.select("host", "page", F.explode(nodes(F.col("_html"))).alias("n"))
        .select("host", "page", "n.path", "n.style", "n.text", "n.prior")
        .distinct()
    )
    path = shared_dir(pages.sparkSession, "page-nodes")
    found.write.parquet(path)
    found = pages.sparkSession.read.schema(found.schema).parquet(path)
    low = importance(found).where(F.col("importance") < least)
    removed = (
        found.select("host", "page", "path")
        .join(low, ["host", "path"])
        .groupBy("host", "page")
        .agg(F.collect_set("path").alias("removed"))
    )
    joined = rows.join(removed, ["host", "page"], "left")
    return joined.select(
        F.col("_id").alias(id_col),
        F.col("_url").alias(url_col),
        main_text(F.col("_html"), F.col("removed")).alias("text"),
    )
