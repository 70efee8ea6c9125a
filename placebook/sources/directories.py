"""Saved pages of business directories: page_no, url, html -> listings -> records.

Reading the two page layouts needs a parser for broken-tolerant HTML, so that one step runs as Python
over Arrow batches, page by page; everything before and after it is expressions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placebook.functions.text import clean_phones, column, first_of, month_label, number, street_of, strip

# fixed values: the two sites
SITES = {"finelib": ("Finelib", "https://www.finelib.com"),
         "businesslist": ("BusinessList.com.ng", "https://www.businesslist.com.ng")}
LISTING = ("site string, page_no int, page string, pos int, name string, listing_id string, url string, addr string, "
           "phone string, lat string, lng string, desc string, sponsored boolean")
# tags that a new tag of their kind, or the end of what holds them, closes
_SIBLINGS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
_HOLDS = {"ul", "ol", "table", "tbody", "thead", "select", "div", "section", "article", "body", "html"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    """The page as nested [tag, attributes, children] nodes; a closing tag closes what is open inside it."""

    def __init__(self, html: str):
        super().__init__()
        self.root = ["", {}, []]
        self.open = [self.root]
        self.inside: Counter[str] = Counter()                    # open tags by name
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = [tag, {k: v or "" for k, v in attrs}, []]
        closes = _SIBLINGS.get(tag, {"p"} if tag in _HOLDS else set())
        depth = len(self.open) - 1
        while depth > 0 and closes and self.open[depth][0] not in _HOLDS:
            if self.open[depth][0] in closes:
                self._close(depth)
            depth -= 1
        self.open[-1][2].append(node)
        if tag not in _VOID:
            self.open.append(node)
            self.inside[tag] += 1

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.inside[node[0]] -= 1
        del self.open[depth:]

    def handle_startendtag(self, tag, attrs):
        self.open[-1][2].append([tag, {k: v or "" for k, v in attrs}, []])

    def handle_endtag(self, tag):
        if self.inside[tag]:                                     # looked for only where there is one: closing tags stay cheap on deep pages
            depth = len(self.open) - 1
            while self.open[depth][0] != tag:
                depth -= 1
            self._close(depth)

    def handle_data(self, data):
        self.open[-1][2].append(data)


def _walk(node, skip: tuple[str, ...] = ()) -> Iterator:
    """Descendants in page order, however deep; what lies in skipped tags is left out."""
    todo = [iter(node[2])]
    while todo:
        child = next(todo[-1], None)
        if child is None:
            todo.pop()
        elif isinstance(child, str):
            yield child
        elif child[0] not in skip:
            yield child
            todo.append(iter(child[2]))


def _find(node, tag: str, classes: str = "", test=None) -> Iterator[list]:
    """Descendants with a tag, all the classes, and the test, in page order."""
    for child in _walk(node):
        if not isinstance(child, str) and child[0] == tag:
            have = child[1].get("class", "").split()
            if all(c in have for c in classes.split()) and (test is None or test(child)):
                yield child


def _strings(node) -> Iterator[str]:
    for child in _walk(node, ("script", "style")):
        if isinstance(child, str) and child.strip():
            yield child.strip()


def _first(nodes: Iterator[list]):
    return next(nodes, None)


def _text(node, sep: str = " ") -> str:
    return sep.join(_strings(node)) if node else ""


def _with_image(part: str):
    return lambda n: _first(_find(n, "img", test=lambda i: part in i[1].get("src", ""))) is not None


def _inside(root, *path):
    """First match of a descendant path, such as (div.header, h3, a)."""
    if len(path) == 1:
        return _first(_find(root, *path[0]))
    for node in _find(root, *path[0]):
        found = _inside(node, *path[1:])
        if found:
            return found
    return None


def _layout_boxes(html: str) -> Iterator[dict]:
    """Layout A: one box per listing, address and phone told apart by their icons."""
    for box in _find(_Page(html).root, "div", "box-682 bg-none"):
        link = _inside(box, ("div", "box-headings"), ("a", "", lambda a: "/listing/" in a[1].get("href", "")))
        if link:
            yield {"name": _text(link, ""), "url": link[1]["href"],
                   "addr": _text(_first(_find(box, "div", "cmpny-lstng-1", _with_image("bldng")))),
                   "phone": _text(_first(_find(box, "div", "cmpny-lstng-1", _with_image("phone")))),
                   "desc": _text(_first(_find(box, "div", "listing-desc")))}


def _layout_companies(html: str) -> Iterator[dict]:
    """Layout B: one company block per listing, place and id in data attributes."""
    for block in _find(_Page(html).root, "div", "company"):
        link = _inside(block, ("div", "company_header"), ("h3",), ("a",))
        if not link:
            continue
        marker = (_first(_find(block, "div", "mapmarker")) or ["", {}, []])[1]
        row = _inside(block, ("div", "cont"),
                      ("div", "s", lambda n: _first(_find(n, "i", "fa-phone")) is not None), ("span",))
        yield {"name": _text(link, ""), "listing_id": block[1].get("data-cmpid", ""), "url": link[1].get("href", ""),
               "addr": _text(_inside(block, ("div", "company_header"), ("div", "address"))),
               "phone": _text(row), "lat": marker.get("data-ltd", ""), "lng": marker.get("data-lng", ""),
               "desc": _text(_inside(block, ("div", "company_header"), ("div", "tagline"))),
               "sponsored": _first(_find(block, "i", test=lambda n: n[2] == ["Sponsored"])) is not None}


_LAYOUTS = {"finelib": _layout_boxes, "businesslist": _layout_companies}


#: Listings or links that a task holds as Python objects before it hands them on, beside those of one page.
BATCH_ROWS = 2_000


def _page_by_page(rows: Iterator[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of pages as batches of some BATCH_ROWS, however many pages come in at once."""
    ready: list[tuple] = []
    for found in rows:
        ready += found
        if len(ready) >= BATCH_ROWS:
            yield _batch(ready, schema)
            ready = []
    if ready:
        yield _batch(ready, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches, one at a time: a batch of pages is never turned into Python strings as a whole."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _read_pages(pages: DataFrame) -> DataFrame:
    """Listings as they stand on the pages; a page that can't be read gives one row with the error."""
    columns = [f.split()[0] for f in (LISTING + ", error string").split(", ")]
    types = {"page_no": pa.int32(), "pos": pa.int32(), "sponsored": pa.bool_()}
    schema = pa.schema([(c, types.get(c, pa.string())) for c in columns])

    def listings(site: str, page_no: int, url: str, html: str) -> list[tuple]:
        own = dict.fromkeys(columns, "") | {"site": site, "page_no": page_no, "page": url, "pos": 0, "sponsored": False, "error": None}
        try:
            found = list(_LAYOUTS[site](html or ""))
        except Exception as e:  # one page must not stop the job: `unreadable_pages` shows it
            return [tuple((own | {"error": f"{type(e).__name__}: {e}"}).values())]
        return [tuple((own | item | {"pos": pos}).values()) for pos, item in enumerate(found)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _page_by_page((listings(*page) for page in _each(batches)), schema)

    return pages.select("site", "page_no", "url", "html").mapInArrow(read, LISTING + ", error string")


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Pages whose reading failed: site, page_no, url, error. Empty means all is well."""
    return _read_pages(pages).filter("error is not null").select("site", "page_no", F.col("page").alias("url"), "error")


def parse_listings(pages: DataFrame) -> DataFrame:
    """Listings of directory pages (site, page_no, url, html), before any clean-up."""
    raw = _read_pages(pages).filter("error is null")
    base = F.when(F.col("site") == "finelib", SITES["finelib"][1]).otherwise(SITES["businesslist"][1])
    number_in_url = F.regexp_extract("url", r"/listing/[^/]+/(\d+)", 1)
    parts = F.split(F.regexp_replace("page", "^[a-z]+://[^/]*|[?#].*$", ""), "/")
    trail = F.slice(parts, F.lit(6), F.size(parts))
    return raw.select(
        "site", "page_no", "page", "pos", "name",
        F.when(F.col("site") == "finelib", number_in_url).otherwise(F.col("listing_id")).alias("listing_id"),
        F.when(F.col("url").rlike("^[a-z]+://"), F.col("url")).otherwise(F.concat(base, "url")).alias("url"),
        "addr", "phone", "lat", "lng", "desc", "sponsored",
        F.when(F.col("site") == "finelib",
               F.array_join(F.transform(trail, lambda p: F.replace(p, F.lit("-"), F.lit(" "))), " > "))
        .otherwise("").alias("category"))


def _read_links(pages: DataFrame) -> DataFrame:
    """url, pos, href of the links in category lists; a page that can't be read gives one row with its error."""
    schema = pa.schema([("url", pa.string()), ("pos", pa.int32()), ("href", pa.string()), ("error", pa.string())])

    def links(url: str, html: str) -> list[tuple]:
        try:
            found = [a[1]["href"] for box in _find(_Page(html or "").root, "div", "category-list")
                     for a in _find(box, "a", test=lambda a: "href" in a[1])]
        except Exception as e:                                   # one page's markup must not stop a crawl's worth of them
            return [(url, None, None, f"{type(e).__name__}: {e}"[:300])]
        return [(url, pos, href, None) for pos, href in enumerate(dict.fromkeys(found))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _page_by_page((links(*page) for page in _each(batches)), schema)

    marked = pages.filter(F.contains("html", F.lit("category-list"))).select("url", "html")
    return marked.mapInArrow(read, "url string, pos int, href string, error string")


def unreadable_links(pages: DataFrame) -> DataFrame:
    """Pages whose category lists could not be read: url, error. Empty means all is well."""
    return _read_links(pages).filter("error is not null").select("url", "error")


def category_links(pages: DataFrame) -> DataFrame:
    """Links of the category lists that lead below the page's own path: url, pos, link."""
    found = _read_links(pages).filter("error is null")
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]*|[?#].*$", ""), "/+$", "")
    below = F.startswith(F.regexp_replace("href", "/+$", ""), F.concat(path, F.lit("/")))
    return found.filter(below).select("url", "pos", F.concat(F.lit(SITES["finelib"][1]), "href").alias("link"))


def broken_pages(pages: DataFrame, listings: DataFrame) -> DataFrame:
    """Pages that hold listings but gave none: the layout has changed. Empty means all is well."""
    marked = pages.filter((F.col("site") == "businesslist") & F.contains("html", F.lit("company_header")))
    return marked.select("site", "url").join(
        listings.select(F.col("page").alias("url")).distinct(), "url", "left_anti")


def drop_sponsored(listings: DataFrame) -> DataFrame:
    """Paid rows repeat on every page; they count on the first."""
    return listings.filter(~F.col("sponsored") | (F.col("page_no") == 1))


def unique_in_crawl(listings: DataFrame, crawl: list[str], order: list[str]) -> DataFrame:
    """One row per listing id (else name) of a crawl: the last version, at the first position."""
    key = F.coalesce(F.nullif("listing_id", F.lit("")), "name")
    at = F.struct(*order)
    row = F.struct(*[c for c in listings.columns if c not in crawl])
    return (listings.groupBy(*crawl, key.alias("_key"))
            .agg(F.max_by(row, at).alias("r"), F.min(at).alias("first_at"))
            .select(*crawl, "r.*", "first_at"))


def latest_listing(raw: DataFrame) -> DataFrame:
    """A listing crawled again supersedes its earlier row (by site and listing id); rows without an id stay.

    An aggregation, not a window: the latest row is found before the shuffle as well as after it. Rows without an id
    go through it as groups of their own, so that what `raw` is worked out from (pages, parsed) is read once, not per kind.
    """
    row = F.struct(*[c for c in raw.columns if c not in ("site", "listing_id")])
    no_id = (F.coalesce("site", F.lit("")) == "") | (F.coalesce("listing_id", F.lit("")) == "")
    numbered = raw.withColumn("_own", F.when(no_id, F.monotonically_increasing_id()))
    alone = F.col("_own").isNotNull()
    latest = F.coalesce(F.max_by(row, F.when(~alone, F.col("ord"))), F.first(F.when(alone, row), ignorenulls=True))
    return numbered.groupBy("site", "listing_id", "_own").agg(latest.alias("r")).select("site", "listing_id", "r.*")


def map_listings(listings: DataFrame) -> DataFrame:
    label = F.when(F.col("category") != "", F.element_at(F.split("category", " > "), -1)).otherwise("")
    phones = F.col("_phones")
    site = column("site")
    name = F.when(site == "finelib", SITES["finelib"][0]).when(site == "businesslist", SITES["businesslist"][0])
    source = F.concat(F.coalesce(name, site), F.lit(" ("), month_label("_fetched"), F.lit(")"))
    keep = ["ord"] if "ord" in listings.columns else []
    return listings.withColumn("_phones", clean_phones(F.split("phone", "[,/;]| or "))).select(
        *keep, strip("name").alias("name"), "addr", street_of("addr").alias("street"), label.alias("label"),
        first_of(phones).alias("phone"), phones.alias("phones_all"), number("lat").alias("lat"),
        number("lng").alias("lng"), F.col("url").alias("maps"), F.substring("desc", 1, 300).alias("notes"),
        source.alias("source"), F.array(source).alias("sources_all"), F.col("_fetched").alias("added"),
    ).filter("name != ''")


