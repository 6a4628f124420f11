"""Main text of HTML pages with removal of site templates.

Method: each page is parsed to a tree and every container subtree is hashed.  Spark counts the hashes per
host over pages of different content, so copies of one page count once, and subtrees that recur on many
pages of their host are templates: on `many_pages`, however large the host, or, on smaller hosts, on `min_pages`
and `min_share` of them.  A second pass parses again, deletes the
templates, then menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments by element, role and name (a name alone rarely says so, see `is_boilerplate`), and reads the blocks of the articles that are left (of `main` or the
body where no article is).  Text-level blocks (paragraphs, headings, list items) and whatever holds an
article are never templates, so passages that many pages share stay.

The table of templates goes to all tasks only if its counted rows are few; otherwise each page is joined with the
templates among its own subtrees, by host and content, so that no row carries all templates of its host.

Edge cases: null and empty html give an empty text; unclosed and misnested tags are closed as browsers do
in the common cases; a null url or one without a host belongs to the host ''; repeated rows give repeated
results; other columns are kept.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boundaryspark.llm.common import BROADCAST_ROWS, append_columns, table
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize

MIN_PAGES = 5
MIN_SHARE = 0.5
MANY_PAGES = 20
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td
tfoot th thead tr ul caption""".split())
CONTAINERS = frozenset("aside center details dialog div dl figure footer form header menu nav ol search section table ul".split())
DROPPED = frozenset("""nav header footer aside form script style noscript template iframe object svg canvas button select input
textarea dialog menu head title audio video search embed map datalist label xmp noembed noframes""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Class names that say what a subtree is: adverts, notices about cookies, reader comments, menus.
PLAIN_NAMES = frozenset("""ad ads advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos
cookie cookies consent gdpr newsletter sidebar menu navbar nav navigation breadcrumb breadcrumbs comments commentlist disqus
pagination pager paywall""".split())
#: Names that articles use for their own parts too; they count only with links or form controls, or outside articles.
DOUBTFUL_NAMES = frozenset("""promotion banner notice notices notification popup modal overlay subscribe subscription signup aside
footer header masthead topbar comment respond share sharing social related recommended widget widgets toolbar login search""".split())
CONTROLS = frozenset("form button input select textarea".split())
#: Share of a subtree's words that stand in links from which on it is a list of links.
LINK_SHARE = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = frozenset("ul ol dl table article section div main body html menu".split())


@dataclass(slots=True)
class Node:
    tag: str
    attrs: str = ""
    children: list = field(default_factory=list)
    holds_main: bool = False
    digest: int = 0
    words: int = 0
    linked: int = 0
    controls: bool = False
    heading: bool = False


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _finish(node: Node) -> None:
    """Hash of a subtree: element, class and id, and what it holds; numbers count, white space does not."""
    seen = xxhash.xxh3_64(f"{node.tag}\x00{' '.join(node.attrs.split())}")
    for child in node.children:
        if isinstance(child, Node):
            node.holds_main |= child.holds_main
            node.controls |= child.controls
            node.heading |= child.heading
            node.words += child.words
            node.linked += child.linked
            seen.update(child.digest.to_bytes(8, "little"))
        else:
            words = child.split()
            node.words += len(words)
            seen.update(" ".join(words).encode("utf-8", "replace"))
    if node.tag == "a":
        node.linked = node.words
    node.controls |= node.tag in CONTROLS
    node.heading |= node.tag in HEADINGS
    node.holds_main |= node.tag in ("article", "main")
    node.digest = seen.intdigest()


def parse(page: str) -> Node:
    root = Node("html")
    stack = [root]

    def close(depth: int) -> None:
        while len(stack) > depth:
            _finish(stack.pop())

    def close_within(tags: set[str], scopes: frozenset[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in tags:
                close(depth)
                return
            if tag in scopes:
                return

    at = 0
    while found := TAG.search(page, at):
        if found.start() > at:
            stack[-1].children.append(html.unescape(page[at:found.start()]))
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        attrs = found[3] if found[2] else found[6]
        if found[1] or found[4]:
            scopes = frozenset() if name in BLOCKS else BLOCKS
            close_within({name}, scopes)
        elif name in ("html", "body"):
            if name == "body" and not any(n.tag == "body" for n in stack):
                close_within({"head"}, frozenset())
                stack[-1].children.append(node := Node("body", attrs))
                stack.append(node)
        else:
            if name in BLOCKS:
                close_within({"p"}, SCOPES)
            if name in CLOSES:
                close_within(CLOSES[name], SCOPES)
            node = Node(name, attrs)
            stack[-1].children.append(node)
            if name in RAW and not attrs.endswith("/"):
                end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(page, at)
                if name not in DROPPED:
                    node.children.append(html.unescape(page[at:end.start() if end else len(page)]))
                at = end.end() if end else len(page)
                _finish(node)
            elif name in VOID or (attrs.endswith("/") and name not in BLOCKS):
                _finish(node)
            else:
                stack.append(node)
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    close(1)
    _finish(root)
    return root


def subtrees(node: Node) -> set[int]:
    """Hashes of the container subtrees that may be templates."""
    found, todo = set(), [node]
    while todo:
        x = todo.pop()
        if x.tag in CONTAINERS and not x.holds_main:
            found.add(x.digest)
        todo += [c for c in x.children if isinstance(c, Node)]
    return found


def is_boilerplate(node: Node, whole: Node | None = None) -> bool:
    """Is a subtree a menu, header, footer, sidebar, notice, advert, form or comments?  `whole` is the article that it is in, if any.

    An element or role of these kinds says so, but the header of an article that holds its heading is a part of it.  A name has to be a whole
    class: `search-engines` is no search.  Plain names say what the subtree is, others and parts of compound names want
    evidence: mostly links, form controls, or a place outside articles.  Ids are targets of links and want it too.  No name counts
    against a subtree that holds most of its article's words.
    """
    if node.tag == "header" and whole is not None and node.heading and 2 * node.linked < node.words:
        return False
    if node.tag in DROPPED:
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main"):
        return False
    attrs = attributes(node.attrs)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if whole is not None and 2 * node.words > whole.words:
        return False
    classes, ids = ({re.sub(r"[-_]+", "", w) for w in attrs.get(a, "").lower().split()} for a in ("class", "id"))
    if not PLAIN_NAMES.isdisjoint(classes):
        return True
    parts = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{attrs.get('class', '')} {attrs.get('id', '')}").lower()))
    named = not (PLAIN_NAMES | DOUBTFUL_NAMES).isdisjoint(parts | classes | ids)
    links = node.words > 0 and node.linked >= LINK_SHARE * node.words
    # outside articles a whole name is enough, a part of one isn't
    alone = whole is None and not DOUBTFUL_NAMES.isdisjoint(classes | ids) or whole is None and not PLAIN_NAMES.isdisjoint(ids)
    return named and (links or node.controls or node.words == 0 or alone)


def main_text(root: Node, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """Blocks of the main content, joined by line breaks."""
    def gone(x: Node, whole: Node | None = None) -> bool:
        return is_boilerplate(x, whole) or (x.tag in CONTAINERS and not x.holds_main and x.digest in templates)

    def outermost(tags: tuple[str, ...], role: str | None = None) -> list[Node]:
        out, todo = [], [root]
        while todo:
            x = todo.pop()
            if x is not root and gone(x):
                continue
            if x.tag in tags or (role and x.attrs and attributes(x.attrs).get("role", "") == role):
                out.append(x)
                continue
            todo += [c for c in reversed(x.children) if isinstance(c, Node)]
        return out

    starts = outermost(("article",)) or outermost(("main",), "main") or outermost(("body",)) or [root]
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    for start in starts:
        flush()
        todo: list = [start]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif x is start or not gone(x, start if start.tag in ("article", "main") else None):
                if x.tag == "br":
                    line.append("\n")
                block = x.tag in BLOCKS
                if block:
                    flush()
                    todo.append(None)
                todo += reversed(x.children)
    flush()
    return "\n".join(blocks)


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), "://([^/?#]*)", 1)), F.lit(""))


def content_of(page_html: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(page_html), F.lit("")))


def page_subtrees(pages: DataFrame, url: str = "url", page_html: str = "html") -> DataFrame:
    """(host, content, digests) of the pages of different content."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        pages_of_batch = [x.as_py() or "" for x in batch.column(batch.schema.get_field_index("_html"))]
        return [pa.array([sorted(d - (1 << 63) for d in subtrees(parse(p))) for p in pages_of_batch], pa.list_(pa.int64()))]
    fields = [T.StructField("digests", T.ArrayType(T.LongType()))]
    rows = pages.select(host_of(url).alias("host"), content_of(page_html).alias("content"), F.col(page_html).alias("_html"))
    hashed = append_columns(rows, fields, run, ("_html",))
    return materialize(hashed.groupBy("host", "content").agg(F.first("digests").alias("digests")), "subtrees")


def site_templates(once: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """(host, digest) of the subtrees that recur on many pages of their host."""
    hosts = once.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = once.select("host", F.explode("digests").alias("digest")).groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where(F.col("n") >= min_pages)
    enough = F.least(min_share * F.col("pages"), F.lit(float(many_pages)))
    return counts.join(hosts, "host").where(F.col("n") >= enough).select("host", "digest")


def extract_text(pages: DataFrame, url: str = "url", page_html: str = "html", keep_html: bool = True, min_pages: int = MIN_PAGES,
                 min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES, few: int = BROADCAST_ROWS) -> DataFrame:
    """Add `text`, the main text of each page; up to `few` templates are sent to all tasks."""
    once = page_subtrees(pages, url, page_html)
    templates = materialize(site_templates(once, min_pages, min_share, many_pages), "templates")
    rows, sent = pages.withColumn("_host", host_of(url)), None
    if templates.limit(few + 1).count() <= few:
        sent = {}
        for host, digest in templates.collect():
            sent.setdefault(host, set()).add(digest + (1 << 63))
    else:
        own = once.select("host", "content", F.explode("digests").alias("digest")).join(templates, ["host", "digest"]).groupBy(
            F.col("host").alias("_host"), F.col("content").alias("_content")).agg(F.collect_list("digest").alias("_templates"))
        rows = rows.withColumn("_content", content_of(page_html)).join(own, ["_host", "_content"], "left")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        if sent is None:
            found = ({d + (1 << 63) for d in t.as_py() or ()} for t in column("_templates"))
        else:
            found = (sent.get(h.as_py(), frozenset()) for h in column("_host"))
        texts = [main_text(parse(p.as_py() or ""), t) for p, t in zip(column(page_html), found, strict=True)]
        return [pa.array(texts, pa.string())]
    dropped = ("_host", "_content", "_templates") if keep_html else ("_host", "_content", "_templates", page_html)
    return append_columns(rows, [T.StructField("text", T.StringType())], run, dropped)


@query("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, keep_html=False).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
