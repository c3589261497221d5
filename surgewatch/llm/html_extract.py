"""Main-text extraction by template deduction from same-host pages.

A page is read as tokens: each tag with its path of open tags and their classes, and
each text node with its path.  Tokens that occur equally often on the same pages of a
host share an occurrence vector and form an equivalence class (found by one grouping:
the vector is summed up as a checksum over pages, so no host is gathered).  A class is
valid if it covers enough pages and tokens; the valid classes' tokens, nested by their
paths, are the host's template, and what stands between them fills its slots.

A slot belongs to the main text unless it lies in a tag or class of menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or comments.  Pages with an
``article`` (else ``main``) element take its slots, and the texts right in a ``main``
around it; template texts go, unless little else is in it.  On other pages template texts are dropped, and the slots are those under
the page's main paths: the deepest containers that hold most of the remaining text of the host's
pages that have them, as long as no container around them holds text itself.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from surgewatch.llm.common import broadcast_if_small, cut

#: A class is valid with this many pages, share of the host's pages, and tokens.
MIN_PAGES, MIN_SHARE, MIN_TOKENS = 4, 0.8, 4
#: Share of the remaining text, of the host's pages that have it, that a main path holds.
MAIN_SHARE = 0.6
#: Rows of templates (about 1 kB each) up to which they are broadcast.
BROADCAST_HOSTS = 20_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
OUTSIDE = frozenset("head nav header footer aside form script style noscript iframe template button select option "
                    "textarea input svg canvas object embed audio video map menu dialog title".split())
#: Words of class, id and role names that mark what isn't main text (fixed values).
MARKED = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
                   "navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies "
                   "consent gdpr notice notices alert popup modal overlay toast newsletter subscribe subscription signup login form "
                   "search share sharing social related recommended comment comments reply replies disqus pagination "
                   "pager toolbar widget copyright contentinfo complementary hidden".split())
#: Words that names of such elements have beside them (fixed values).
STRUCTURE = frozenset("area bar block box btn button buttons col column container content group holder icon icons inner item items "
                      "left links list module outer panel posts region right row section site top bottom wrap wrapper zone".split())
#: Inside an article these name texts, too: a menu of dishes.
TEXTS = frozenset("menu menus".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Marked by these words, an element stays marked however much it holds.
ANSWERS = frozenset("comment comments reply replies disqus hidden".split())
#: Tags that main paths are made of; other blocks, and the block that holds a text, belong to what is in the container.
CONTAINERS = frozenset("html body div section".split())
#: Tags that divide a page; what lies in none of them but ``main`` is its text, beside its article.
SECTIONS = CONTAINERS | frozenset("article main nav aside header footer".split())
#: A tag closes open ones of its row, up to the nearest tag that holds such (fixed by the HTML standard).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody")}
HOLDS = frozenset("ul ol dl table select body article main section div nav aside footer header form".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"""
                    r"""<(/?)([A-Za-z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z)|[^<]+|<""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[A-Za-z]+")
_HUMP = re.compile("([a-z])([A-Z])")
_HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_P_CLOSERS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                       "h6 header hr main menu nav ol p pre section table ul".split())


def _marks(names: tuple[str, ...], inside: bool) -> set[str]:
    """The marking words of names that hold nothing else but words of structure: of a longer name one word says
    nothing (``share-price``, ``comments-open``)."""
    found: set[str] = set()
    for n in names:
        words = {w.lower() for w in _NAME.findall(_HUMP.sub(r"\1 \2", n))}
        known = (words & MARKED) - (TEXTS if inside else frozenset())
        if known and words <= MARKED | STRUCTURE:
            found |= known
    return found


class Open:
    """An open tag: its name, its path with classes (a hash), and whether it is outside of, or the root of, main text.

    ``box`` is the container of text directly in it, ``room`` the deepest container here (itself, if it is one) and
    ``up`` the container around that.  ``at`` is its number in the page, ``firm`` whether a tag or attribute puts it
    outside, ``mark`` the outermost open tag whose name does (its number, whether it may be lifted), ``held`` its
    article and main tags, marked or not, and ``part`` the nearest container or sectioning tag.
    """

    __slots__ = ("tag", "path", "out", "root", "room", "box", "up", "flow", "firm", "mark", "held", "part")

    def __init__(self, tag: str, names: tuple[str, ...], above: "Open | None", inside: bool, at: int = 0,
                 unseen: bool = False, plain: frozenset[int] = frozenset()):
        self.tag = tag
        around = above.room if above else None
        self.box = above.box if tag in INLINE and above else around
        self.flow = tag in CONTAINERS and (above is None or above.flow)
        self.room, self.up = (self, around) if self.flow else (around, around and around.up)
        own = tag + "".join(f".{n}" for n in names)
        self.path = _hash(f"{above.path if above else ''}/{own}")
        self.part = tag if tag in SECTIONS or above is None else above.part
        words = _marks(names, bool(above and above.root)) if tag not in HEADINGS else frozenset()
        # an article's own header holds its headings
        self.firm = bool(above and above.firm) or unseen or tag in OUTSIDE and not (tag == "header" and inside)
        self.mark = above.mark if above else None
        if self.mark is None and at not in plain and tag not in ("html", "body") and words:
            self.mark = at, words.isdisjoint(ANSWERS)
        self.out = self.firm or self.mark is not None
        kind = tag if tag in ("article", "main") else "main" if "role=main" in names else ""
        self.held = (above.held if above else frozenset()) | ({kind} if kind else frozenset())
        self.root = (above.root if above else frozenset()) | ({kind} if kind and not self.out else frozenset())


def nodes(page: str) -> list[tuple[str, Open | None, bool]]:
    """``(text, where, False)`` of each text node, and ``("", tag, starts a block)`` of each tag or end tag.

    Names mark what is outside, but not the main text itself: marks of elements found to hold it are lifted.
    """
    plain: frozenset[int] = frozenset()
    while True:
        found = list(_read(page, plain))
        more = _misjudged(found)
        if not more:
            return found
        plain |= more


def _misjudged(found: list[tuple[str, Open | None, bool]]) -> frozenset[int]:
    """Numbers of elements whose names mark them, but which hold most of the page's text, where no article is unmarked;
    with an unmarked main, or articles only in marked elements, just those that hold an article or main."""
    if not any(w and w.mark for _, w, _ in found):
        return frozenset()
    texts = [(len(t), w) for t, w, _ in found if t and not t.isspace() and w and not w.firm]
    if any("article" in w.root for _, w in texts):
        return frozenset()
    total, mass, holding = sum(n for n, _ in texts), Counter(), set()
    main = any(w.root for _, w in texts)
    for n, w in texts:
        if w.mark and w.mark[1]:
            mass[w.mark[0]] += n
            if "article" in w.held or not main and w.held:
                holding.add(w.mark[0])
    heavy = frozenset(k for k, n in mass.items() if 2 * n > total and (k in holding or not main))
    if heavy or main:
        return heavy
    return frozenset(holding) if 2 * sum(mass[k] for k in holding) > total else frozenset()


def _read(page: str, plain: frozenset[int]) -> Iterator[tuple[str, Open | None, bool]]:
    stack: list[Open] = []
    open_tags: Counter = Counter()  # of the stack
    at, end = 0, len(page)

    def close(tag: str) -> None:
        """Up to the innermost open one of ``tag``."""
        while True:
            gone = stack.pop().tag
            open_tags[gone] -= 1
            if gone == tag:
                return
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                yield m[0], stack[-1] if stack else None, False
            elif m[0].startswith("<![CDATA["):
                yield m[0][9:].removesuffix("]]>").replace("&", "&amp;"), stack[-1] if stack else None, False
            continue
        tag = tag.lower()
        block = tag not in INLINE
        if m[1]:
            if open_tags[tag]:
                close(tag)
            elif tag == "p":
                block = True
            yield "", stack[-1] if stack else None, block
            continue
        if tag in _P_CLOSERS and open_tags["p"]:
            close("p")
        elif tag in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in CLOSES[tag]:
                    open_tags.subtract(o.tag for o in stack[k:])
                    del stack[k:]
                elif stack[k].tag in HOLDS:
                    break
        names, unseen = (), False
        if m[3] and "=" in m[3]:
            attrs = {a.lower(): b or c or d or "" for a, b, c, d in reversed(_ATTR.findall(m[3]))}
            names = tuple(re.sub(r"\d+", "0", x) for a in ("class", "id") for x in attrs.get(a, "").split())
            names += ("role=main",) if attrs.get("role", "").lower() == "main" else \
                tuple(attrs.get("role", "").split())
            unseen = "hidden" in attrs or attrs.get("aria-hidden") == "true" or \
                "display:none" in attrs.get("style", "").replace(" ", "")
        if m[3] and "hidden" in m[3].lower():
            unseen = unseen or bool(re.search(r"(?:^|\s)hidden(?:\s|/|$)", _ATTR.sub(" ", m[3]), re.I))
        if unseen:
            names += ("hidden",)
        own = Open(tag, names, stack[-1] if stack else None, bool(stack and stack[-1].root), m.start(), unseen, plain)
        yield " " if tag == "br" else "", own, block
        if tag in RAW:  # their content is text up to the end tag
            ending = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            stop = ending.start() if ending else end
            if stop > at:
                yield page[at:stop], own, False
            at = ending.end() if ending else end
            yield "", stack[-1] if stack else None, block
        elif tag not in VOID and not (m[3] or "").endswith("/") or tag in ("p", "div"):
            stack.append(own)
            open_tags[tag] += 1


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 0) - (1 << 63)


def _host(url_col: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), _HOST, 1), F.lit("")))


def _text_token(path: int, text: str) -> int:
    return _hash(f"{path}\n{' '.join(text.split())}")


def tokens(page: str) -> tuple[Counter, bool]:
    """Token hash -> occurrences; and whether the page has an article or main."""
    seen, rooted = Counter(), False
    for text, where, _ in nodes(page):
        path = where.path if where else 0
        rooted = rooted or bool(where and where.root)
        if not text:
            seen[_hash(f"<{path}")] += 1
        elif not text.isspace():
            seen[_text_token(path, text)] += 1
    return seen, rooted


def containers(page: str, template: frozenset[int] = frozenset()) -> tuple[int, dict[int, int]]:
    """Characters of the page's remaining text, and of each container without text directly in one around it
    (none for pages with article or main)."""
    own: dict[int, list] = {}
    for text, where, _ in nodes(page):
        if where and where.root:
            return 0, {}
        if text and not text.isspace() and where and not where.out and _text_token(where.path, text) not in template:
            own.setdefault(where.box.path if where.box else 0, [where.box, 0])[1] += len(text)
    held: Counter = Counter()
    for box, n in own.values():
        chain = []
        while box:
            chain.append(box.path)
            box = box.up
        if 0 not in own:
            for path in reversed(chain):
                held[path] += n
                if path in own:
                    break
    return sum(n for _, n in own.values()), held


def main_text(page: str, template: frozenset[int] = frozenset(), main_paths: frozenset[int] = frozenset()) -> str:
    """The page's main text: blocks joined by newlines."""
    found, roots = [], set()
    blocks: list[list[tuple[Open | None, str]]] = []
    fresh = True
    for text, where, starts in nodes(page):
        fresh = fresh or starts
        if text:
            if fresh:
                blocks.append([])
                fresh = False
            blocks[-1].append((where, text))
            roots |= where.root if where else set()
    kind = "article" if "article" in roots else "main" if "main" in roots else None

    def remains(w: Open | None, text: str) -> bool:
        return w is None or not w.out and _text_token(w.path, text) not in template

    def around(w: Open | None) -> Iterator[int]:
        """The host's main paths that hold ``w``, the deepest first."""
        box = w.box if w else None
        while box:
            if box.path in main_paths:
                yield box.path
            box = box.up

    deepest: set[int] = set()  # main paths of this page without another one below
    if main_paths and not kind:
        chains = {tuple(around(w)) for pieces in blocks for w, t in pieces if w and not t.isspace() and remains(w, t)}
        deepest = {c[0] for c in chains if c} - {above for c in chains for above in c[1:]}

    rooted = [(len(t), remains(w, t)) for pieces in blocks for w, t in pieces
              if kind and w and not w.out and kind in w.root and not t.isspace()]
    # an article that is mostly template is the same page again, not boilerplate
    whole = sum(n for n, left in rooted if left) < MAIN_SHARE * sum(n for n, _ in rooted)

    def taken(w: Open | None, text: str) -> bool:
        if kind:
            own_text = w is not None and (kind in w.root or "main" in w.root and w.part == "main")
            return own_text and not w.out and (whole or remains(w, text))
        return remains(w, text) and (not deepest or any(p in deepest for p in around(w)))

    for pieces in blocks:
        own = " ".join(_html.unescape("".join(t for w, t in pieces if taken(w, t))).split())
        if own:
            found.append(own)
    return "\n".join(found)


def deduce_templates(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, template array<long>, main_paths array<long>)`` of the hosts with a valid class or a main path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, host, page in zip(*(c.to_pylist() for c in b.columns)):
                seen, rooted = tokens(page or "")
                rows += [(host, t, key, n) for t, n in seen.items()]
                if not rooted:
                    rows.append((host, None, key, 1))
            cols = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["host", "token", "key", "n"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, page, template in zip(*(c.to_pylist() for c in b.columns)):
                whole, held = containers(page or "", frozenset(template or ()))
                rows += [(host, p, n, whole) for p, n in held.items()]
            cols = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["host", "path", "n", "whole"])
    own = pages.select(F.xxhash64(id_col, url_col).alias("key"), _host(url_col).alias("host"),
                       F.col(html_col).cast("string").alias("html"))
    seen = own.mapInArrow(run, "host string, token long, key long, n long")
    vector = F.sum(F.xxhash64("key", "n").cast("decimal(38,0)"))
    summed = cut(seen.groupBy("host", "token").agg(F.count("*").alias("pages"), vector.alias("vector")))
    n_pages = own.groupBy("host").agg(F.count("*").alias("host_pages"))
    size = summed.filter("token is not null").groupBy("host", "pages", "vector").agg(F.count("*").alias("tokens"))
    valid = (size.join(n_pages, "host").filter((F.col("pages") >= MIN_PAGES) & (F.col("tokens") >= MIN_TOKENS)
                                               & (F.col("pages") >= MIN_SHARE * F.col("host_pages")))
             .select("host", "pages", "vector"))
    # a template's tokens occur on most pages of the host: no more of them than one page has
    template = cut(summed.filter("token is not null").join(valid, ["host", "pages", "vector"]).groupBy("host").agg(
        F.sort_array(F.collect_set("token")).alias("template")))
    bare = summed.filter("token is null").select("host")  # hosts of pages without article or main
    n_bare = bare.count()
    if not n_bare:
        return template.withColumn("main_paths", F.lit(None).cast("array<long>"))
    weighed = (own.select("host", "html").join(broadcast_if_small(bare, n_bare, BROADCAST_HOSTS), "host", "left_semi")
               .join(broadcast_if_small(template, template.count(), BROADCAST_HOSTS), "host", "left")
               .mapInArrow(weigh, "host string, path long, n long, whole long"))
    # a path is judged by the pages that have it, so layouts of a host don't touch each other
    main = weighed.groupBy("host", "path").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n"), F.sum("whole").alias("whole")).filter(
        (F.col("pages") >= MIN_PAGES) & (F.col("n") >= MAIN_SHARE * F.col("whole"))).groupBy("host").agg(
        F.sort_array(F.collect_set("path")).alias("main_paths"))
    return template.join(main, "host", "full")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url``, ``text`` (empty if none), ``n_chars``.

    Null and empty html: empty text.  Pages of a null url, or one without a host, are
    the pages of host ''.  Repeated rows keep their rows.  Hosts of few pages have no template: their
    pages go by their own tags.  Empty table: no rows.  Other columns are not read.
    """
    found = cut(deduce_templates(pages, id_col, url_col, html_col))
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
                       _host(url_col).alias("host"))
    own = own.join(broadcast_if_small(found, found.count(), BROADCAST_HOSTS), "host", "left").select(
        "page_id", "url", "html", "template", "main_paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h or "", frozenset(t or ()), frozenset(p or ()))
                    for h, t, p in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()),
                                              pa.array(map(len, text), pa.int64())], ["page_id", "url", "text", "n_chars"])
    kinds = own.select("page_id", "url").schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
    return own.mapInArrow(run, f"{schema}, text string, n_chars long")


__all__ = ["nodes", "main_text", "deduce_templates", "extract_text"]
