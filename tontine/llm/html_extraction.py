"""HTML main text by site template removal.

Every page is parsed into elements; each subtree gets a hash of its tag, classes, text
and children.  Spark counts the pages of a host that hold each hash, and subtrees on
``MANY`` pages or more, and on half of the host's, are that site's template: menus,
footers, adverts and the like.  Only the outermost are kept (a list's items go with
it), as one set a host (no larger than twice a page's subtrees), which is joined to the host's pages; there the template
subtrees are deleted and the blocks of the rest are put out.

Paragraphs and headings of the article are never deleted for recurring, and any other
block in it (list items, table cells, bare divs) only if it is on half of the site's
pages, so articles that share such blocks, and copies of an article, stay whole.
Elements that say themselves what they are are deleted on any page, for sites of which too
few pages are known: by tag or role, and by a class or id that is one of a few words as a
whole (``sidebar``, not ``has-sidebar``).  Such a name says nothing of a page, of an element
that holds the article, of a heading, paragraph or table part; inside an article only the
names of adverts, comments and the like count; and if nothing else is left, none does.

The text is taken from a page's articles, else its main element, else its body.
Results for odd input: null html is empty; a page without a host is one of the
host ""; rows with one id are extracted each and count as pages; broken or
cut-off markup is closed where browsers would; whole pages of any length are read, in time
that grows with their length; other columns are not looked at, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.batches import map_batches, small_batches
from tontine.sources.sinks import materialize

#: Pages of a host on which a subtree is the site's template at least; in the article it has to be on half of them.
MANY = 3

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
BLOCKS = TEXT_BLOCKS | frozenset("""address article aside body br caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form head header hgroup hr html li main menu nav ol option section summary table tbody td tfoot th thead tr ul""".split())
NO_TEXT = frozenset("""audio button canvas form head iframe input label map noscript object script select style svg template
    textarea title video""".split())
SITE_PARTS = frozenset("aside dialog footer menu nav".split())
SITE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form navigation search".split())
SITE_NAMES = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disclaimer footer header menu modal nav navbar navigation newsletter notice notices popup promo promotion related reply replies
    share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split())
COMMENT_NAMES = frozenset("comment comments reply replies".split())
#: Names that count inside an article too.
INNER_NAMES = COMMENT_NAMES | frozenset("""ad ads advert advertisement adverts cookie cookies newsletter promo promotion related share sharing
    sidebar sponsor sponsored subscribe""".split())
#: These count with what they belong to: site-footer, page-header.
OWNERS = ("site-", "page-")
#: A name says nothing about these.
UNNAMED = TEXT_BLOCKS | frozenset("html body table caption thead tbody tfoot tr td th li dt dd".split())
#: An opening tag closes an open one of these before it, up to the scope.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}
CLOSE_P = BLOCKS - {"br", "body", "html", "head", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}

_WORD = re.compile(r"[a-z0-9]+")


class _Element:
    __slots__ = ("key", "lead", "names", "parent", "parts", "site", "tag")

    def __init__(self, tag: str, lead: str, parent: int, site: bool, names: frozenset[str]):
        self.tag, self.lead, self.parent, self.site, self.names, self.parts, self.key = tag, lead, parent, site, names, [], 0


def _site_names(tag: str, given: dict[str, str | None]) -> frozenset[str]:
    """The whole classes and the id of an element that name a part of the site."""
    if tag in UNNAMED:
        return frozenset()
    names = f"{given.get('class') or ''} {given.get('id') or ''}".lower().split()
    return frozenset(n for name in names if (n := next((name[len(o):] for o in OWNERS if name.startswith(o)), name)) in SITE_NAMES)


class Page(HTMLParser):
    """Elements of a page in order, and its text as (element, text); None is a break between blocks."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements = [_Element("html", "html", -1, False, frozenset())]
        self.open = [0]
        self.depths: dict[str, list[int]] = {}             # where each tag is open
        self.text: list[tuple[int, str | None]] = []
        self.feed(html)
        self.close()
        for k in range(len(self.elements) - 1, -1, -1):    # children come after their parents
            e = self.elements[k]
            body = "\x01".join([e.lead, *[p if isinstance(p, str) else f"\x02{self.elements[p].key}" for p in e.parts]])
            e.key = xxhash.xxh64_intdigest(body.encode("utf-8", "surrogatepass")) - 2**63
        self.roots = self._roots()
        self.inside = self._inside_roots()

    def _deepest(self, tags: tuple[str, ...] | frozenset) -> int:
        return max((at[-1] for t in tags if (at := self.depths.get(t))), default=0)

    def _shut(self, tags: tuple[str, ...] | frozenset, scope: tuple[str, ...]) -> None:
        """Close the innermost of ``tags`` that is open, and all in it, unless one of ``scope`` is open in it."""
        depth = self._deepest(tags)
        if depth and depth >= self._deepest(scope):
            for k in self.open[depth:]:
                self.depths[self.elements[k].lead.split(" ", 1)[0]].pop()
            del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSE_P:
            self._shut(("p",), ("article", "section", "div", "li", "td", "th", "main", "body", "button", "object"))
        if tag in CLOSES:
            self._shut(*CLOSES[tag])
        given = dict(attrs)
        words = _WORD.findall(f"{given.get('class') or ''} {given.get('id') or ''}".lower())
        site = tag in SITE_PARTS or (given.get("role") or "").lower() in SITE_ROLES or "hidden" in given
        parent = self.open[-1]
        k = len(self.elements)
        main = tag == "main" or (given.get("role") or "").lower() == "main"
        self.elements.append(_Element("main" if main else tag, " ".join([tag, *words]), parent, site, _site_names(tag, given)))
        self.elements[parent].parts.append(k)
        if tag in BLOCKS:
            self.text.append((k, None))
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(k)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)                   # "/>" closes nothing but void elements

    def handle_endtag(self, tag: str) -> None:
        if tag not in ("html", "body"):
            self._shut((tag,), ())
        if tag in BLOCKS:
            self.text.append((self.open[-1], None))

    def handle_data(self, data: str) -> None:
        self.text.append((self.open[-1], data))
        words = " ".join(data.split())
        if words:
            self.elements[self.open[-1]].parts.append(words)

    def _roots(self) -> list[int]:
        """The outermost articles that are no part of the site, else the main element, else the page.  If all
        articles lie in elements with a site part's name, those names say nothing but of comments."""
        for tag in ("article", "main"):
            for names in (SITE_NAMES, COMMENT_NAMES):
                shut = self.marks(lambda e: e.site or e.tag in NO_TEXT or not names.isdisjoint(e.names))  # noqa: B023
                held: list[bool] = []                      # lies in a root
                found = []
                for k, e in enumerate(self.elements):
                    within = e.parent >= 0 and held[e.parent]
                    root = not within and e.tag == tag and not shut[k]
                    if root:
                        found.append(k)
                    held.append(within or root)
                if found:
                    return found
        return [0]

    def marks(self, test) -> list[bool]:
        """Elements that pass a test or lie in one that does."""
        out = []
        for e in self.elements:
            out.append((e.parent >= 0 and out[e.parent]) or bool(test(e)))
        return out

    def candidates(self) -> set[tuple[int, int, bool]]:
        """(hash, parent's hash, in the roots) of the subtrees that may be template; 0 for a parent
        that may not."""
        within = self.marks(lambda e: e.tag in TEXT_BLOCKS)
        fit = [e.parent >= 0 and bool(e.parts) and e.tag not in NO_TEXT and e.tag not in ("body", "article", "main")
               and not (self.inside[k] and (within[k] or e.tag not in BLOCKS))
               for k, e in enumerate(self.elements)]
        for r in self.holders():                           # what holds the article is no template
            fit[r] = False
        return {(e.key, self.elements[e.parent].key if fit[e.parent] else 0, self.inside[k])
                for k, e in enumerate(self.elements) if fit[k]}

    def holders(self) -> set[int]:
        """The roots and what they lie in."""
        out: set[int] = set()
        for r in self.roots:
            while r >= 0 and r not in out:
                out.add(r)
                r = self.elements[r].parent
        return out

    def _inside_roots(self) -> list[bool]:
        roots = set(self.roots)
        out: list[bool] = []
        for k, e in enumerate(self.elements):
            out.append(k in roots or (e.parent >= 0 and out[e.parent]))
        return out

    def main_text(self, template: set[int]) -> str:
        """Blocks of the roots without site parts and template subtrees, joined by one space."""
        names = INNER_NAMES if self.elements[self.roots[0]].tag == "article" else SITE_NAMES
        return self._text(template, names) or self._text(template, frozenset())

    def _text(self, template: set[int], names: frozenset[str]) -> str:
        allowed = {k for k, *_ in self.candidates()} & template
        held = {id(self.elements[k]) for k in self.holders()}
        whole = self.roots == [0]
        gone = self.marks(lambda e: id(e) not in held and (
            e.site or e.tag in NO_TEXT or e.key in allowed or not names.isdisjoint(e.names) or (whole and e.tag == "header")))
        blocks, now = [], []
        for k, data in self.text:
            if data is None:
                blocks.append("".join(now))
                now = []
            elif self.inside[k] and not gone[k]:
                now.append(data)
        words = (" ".join(b.split()) for b in [*blocks, "".join(now)])
        return " ".join(w for w in words if w)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               many: int = MANY) -> DataFrame:
    """One row a page: ``id``, ``url`` and ``text``."""
    small_batches(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def subtrees(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hosts, keys, parents, insides, firsts = [], [], [], [], []
        for name, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            found = sorted(Page(html).candidates())
            hosts += [name] * len(found)
            keys += [k for k, _, _ in found]
            parents += [p for _, p, _ in found]
            insides += [i for _, _, i in found]
            firsts += [int(k == 0 or found[k - 1][0] != f[0]) for k, f in enumerate(found)]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(parents, pa.int64()),
                                          pa.array(insides, pa.bool_()), pa.array(firsts, pa.int64())],
                                         names=["host", "key", "parent", "inside", "first"])

    # one row of a subtree in each page is its first, so they count pages (a cell is in many rows of a table)
    seen = (map_batches(rows.select("host", "html"), subtrees, "host string, key long, parent long, inside boolean, first long")
            .groupBy("host", "key", "parent").agg(F.sum("first").alias("pages"), F.max("inside").alias("inside")))
    seen = materialize(seen, name="subtrees")
    half = rows.groupBy("host").agg((F.count("*") / 2).alias("half"))
    # text outside the roots is never put out, so only what is somewhere in them counts: on half of the pages, a
    # host has at most twice as many of these as a page has subtrees, whatever the number of its pages
    template = (seen.groupBy("host", "key").agg(F.sum("pages").alias("pages"), F.max("inside").alias("inside")).join(half, "host")
                .filter(F.col("inside") & (F.col("pages") >= many) & (F.col("pages") >= F.col("half"))).select("host", "key"))
    inner = template.select("host", F.col("key").alias("parent"))
    outermost = (seen.join(template, ["host", "key"], "left_semi").join(inner, ["host", "parent"], "left_anti")
                 .groupBy("host").agg(F.collect_set("key").alias("template")))
    outermost = materialize(outermost, name="templates")   # a written table: its size decides how it is joined

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, set[int]] = {}
        for b in batches:
            texts = []
            template = b.column("template")
            for k, (name, html) in enumerate(zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True)):
                if name not in sets:
                    sets = {name: set(template[k].as_py() or ())} if len(sets) > 64 else sets | {name: set(template[k].as_py() or ())}
                texts.append(Page(html).main_text(sets[name]).encode("utf-8", "replace").decode())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    joined = rows.join(outermost, "host", "left")
    return joined.mapInArrow(extract, f"id {dict(rows.dtypes)['id']}, url string, text string")
