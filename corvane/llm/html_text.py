"""Main text of web pages: site template removal, then the article of what is left.

A page is parsed into a tree, and every element's subtree is hashed (tag, class, id, text). Spark counts exactly on how many pages of a
host, and in how many different articles, each hash occurs. Subtrees that recur across many of them are deleted; then the article is
looked for in what is left: every <main>, else the <article> elements, else those named content, else the body. Of the article go
elements that never hold its text (by tag or role), hidden ones, and those whose whole names mark adverts, notices, forms and comments.

What recurs is judged by where it stands. Beside an element marked up as the article, a subtree is template if it recurs in
`LEAST` different articles. On pages without such an element it must also be in `OPEN` of the host's articles or hold nothing but
links. Within an article only what stands in nearly all of the host's articles (`INSIDE`, of `LEAST_INSIDE` at least) is template, as
documents quote each other. Recurrence in copies of one article counts once, and a subtree of several blocks that holds most of a
page's text stays: it is an article that was copied into other surroundings.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import free_name, written

#: Element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
NEVER = frozenset("script style noscript template head title nav footer aside form button select textarea input iframe object embed svg canvas audio video map menu dialog fieldset label option noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag closes an open element of these kinds, up to the next that holds such children.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
ENDS_P = BLOCK - {"html", "body", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: Parts of names that mark what is not the article, and parts that add nothing to a name. A name marks an element if all its
#: parts, between hyphens and underscores, are of these and one is a mark: "ad-slot", "post-comments", but not "has-sidebar".
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner billboard breadcrumb breadcrumbs comment comments commentlist commenting consent cookie cookies cookiebar copyright discussion disqus footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud toc toolbar topbar tracking widget widgets complementary contentinfo alert alertdialog".split())
NEUTRAL = frozenset("area article bar block blog body bottom box button buttons container content entry footer group holder header inner item items left line link links list main message middle module outer page panel post posts right row section site slot strip text the top unit user visitor wrap wrapper".split())
CONTENT = frozenset("content main article post entry story body-text article-body articlebody post-content entry-content main-content maincontent story-body".split())
#: Words of names of what only goes with a content element.
META = frozenset("title heading headline header meta info date time author byline category categories tags thumbnail image caption footer links nav".split())
#: Elements with less than this part of the page's text are not its main text.
LEAST_PART = 0.25

_VALUE = r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++|(?=>)))?+"
_TAG = re.compile(rf"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++{_VALUE}|=)*+)(?:>|\Z)|/[^>]*(?:>|\Z))", re.DOTALL)
_ATTRIBUTE = re.compile(r"(=?[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_NAMED = ("class", "id", "role", "hidden", "aria-hidden", "style")

LEAST, OPEN, INSIDE, LEAST_INSIDE = 3, 0.25, 0.9, 8
#: Where a subtree stands: beside the article, in it, or on a page whose article isn't marked up.
BESIDE, WITHIN, UNMARKED = 0, 1, 2
#: Hashes of template that are broadcast at most; beyond, each page is joined with those of its own that are template.
MOST_BROADCAST = 200_000


class Element:
    """An element of a page; `at` is its place in page order, so that whatever stands in it comes later."""

    __slots__ = ("at", "children", "gone", "named", "parent", "spared", "tag")

    def __init__(self, tag: str, named: dict[str, str], at: int, parent: int) -> None:
        self.tag, self.named, self.at, self.parent, self.children, self.spared, self.gone = tag, named, at, parent, [], False, False

    def names(self) -> list[str]:
        return " ".join(self.named.get(k, "") for k in ("class", "id", "role")).lower().split() if self.named else []


class Open:
    """The open elements, and for each tag, and for all blocks, where in the stack they are: each step costs what it opens or closes."""

    def __init__(self, root: Element) -> None:
        self.stack, self.of, self.blocks, self.blocks_but_p = [root], {}, [], []

    def push(self, e: Element) -> None:
        k = len(self.stack)
        self.stack.append(e)
        self.of.setdefault(e.tag, []).append(k)
        if e.tag in BLOCK:
            self.blocks.append(k)
            if e.tag != "p":
                self.blocks_but_p.append(k)

    def close(self, k: int) -> None:
        for e in self.stack[k:]:
            self.of[e.tag].pop()
            if e.tag in BLOCK:
                self.blocks.pop()
                if e.tag != "p":
                    self.blocks_but_p.pop()
        del self.stack[k:]

    def deepest(self, kinds) -> int:
        return max((self.of[t][-1] for t in kinds if self.of.get(t)), default=0)

    def end_tag(self, tag: str) -> None:
        k = self.deepest((tag,))
        if k and (tag in BLOCK or not self.blocks or self.blocks[-1] < k):  # an inline end tag doesn't end the block it stands in
            self.close(k)

    def close_within(self, kinds: set[str], within: set[str]) -> bool:
        k = self.deepest(kinds)
        if k and self.deepest(within) < k:
            self.close(k)
            return True
        return False


def parse(page: str) -> list[Element]:
    """The elements in page order, the root first; their children are elements and texts (character references decoded). Open elements
    end with the page; stray end tags are passed over."""
    root = Element("html", {}, 0, -1)
    order, opened, at, n = [root], Open(root), 0, len(page)
    low = None
    while at < n:
        found = _TAG.search(page, at)
        stop = found.start() if found else n
        if stop > at:
            opened.stack[-1].children.append(html.unescape(page[at:stop]))
        if not found:
            break
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            opened.end_tag(tag)
            continue
        if tag in ("html", "body", "head") and opened.of.get(tag):
            continue
        if tag in ENDS_P:
            k = opened.deepest(("p",))
            if k and (not opened.blocks_but_p or opened.blocks_but_p[-1] < k):
                opened.close(k)
            if tag in HEADING and opened.stack[-1].tag in HEADING:
                opened.close(len(opened.stack) - 1)
        if tag in CLOSES:
            while opened.close_within(CLOSES[tag], HOLDS[tag]):
                pass
        parent = opened.stack[-1]
        element = Element(tag, _attributes(found[3]) if found[3].strip() else {}, len(order), parent.at)
        parent.children.append(element)
        order.append(element)
        if tag in VOID or found[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            low = low if low is not None else page.lower()
            end = low.find(f"</{tag}", at)
            end = n if end < 0 else end
            if tag not in NEVER:
                element.children.append(page[at:end])
            at = n if end == n else (page.find(">", end) + 1 or n)
            continue
        opened.push(element)
    return order


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        key = name.lower()
        if key in _NAMED and key not in out:
            out[key] = html.unescape(a or b or c)
    return out


def hidden(element: Element) -> bool:
    named = element.named
    return bool(named) and ("hidden" in named or named.get("aria-hidden", "").lower() == "true" or "display:none" in named.get("style", "").replace(" ", "").lower())


def marks(name: str, of: frozenset[str] = MARKS) -> bool:
    """Whether a whole name marks an element: every part of it is a mark or neutral, and one is a mark."""
    if name in of:
        return True
    parts = [x for x in re.split(r"[_-]+", name) if x]
    return len(parts) > 1 and not of.isdisjoint(parts) and all(x in of or x in NEUTRAL for x in parts)


def dropped(element: Element, in_article: bool) -> bool:
    """Whether an element is no part of the article: deleted as template, or by its own tag and names."""
    tag = element.tag
    if element.gone or tag in NEVER or tag == "header" and not in_article:
        return True
    if not element.named:
        return False
    if hidden(element):
        return True
    if tag in ("html", "body", "main") or element.spared:
        return False
    return any(marks(x) for x in element.names())


def is_main(e: Element) -> bool:
    return e.tag == "main" or bool(e.named) and e.named.get("role", "").lower() == "main"


def is_named_content(e: Element) -> bool:
    """Whether a block that is no heading is named content; the title or meta line of an entry is not."""
    if not e.named or e.tag not in BLOCK or e.tag in HEADING or e.tag in ("html", "body", "p"):
        return False
    for name in e.names():
        parts = re.split(r"[_-]+", name)
        if name in CONTENT or not META.intersection(parts) and (parts[0] in CONTENT or parts[-1] in CONTENT):
            return True
    return False


def own_size(e: Element) -> int:
    """Characters of the element's own text, without white space."""
    return sum(len("".join(c.split())) for c in e.children if isinstance(c, str))


def spare(order: list[Element]) -> list[int]:
    """Marks the elements that names must not drop: what is or holds a <main> or the page's largest article, and what holds most of the
    page's text. Returns the size of each element's text, without elements that never hold the article's."""
    sizes = [0] * len(order)
    shown = [True] * len(order)
    for e in order[1:]:
        shown[e.at] = shown[e.parent] and not (e.gone or e.tag in NEVER or hidden(e))
    for e in reversed(order):
        if shown[e.at]:
            sizes[e.at] += own_size(e)
            if e.parent >= 0:
                sizes[e.parent] += sizes[e.at]
    articles = [e for e in order if e.tag == "article" and shown[e.at] and not any(x in MARKS for x in e.names())]
    kept = [e for e in order if is_main(e) and shown[e.at]] + ([max(articles, key=lambda e: sizes[e.at])] if articles else [])
    for e in order:
        e.spared = 2 * sizes[e.at] > sizes[0]
    for e in kept:
        while not e.spared:
            e.spared = True
            if e.parent < 0:
                break
            e = order[e.parent]
    return sizes


def content(order: list[Element]) -> tuple[list[Element], bool]:
    """The elements that hold the main text, in page order, and whether they are marked up as such.

    Every <main> with all that stands in it, and every article outside if those hold more text; without <main> the articles, or
    the elements named content if these hold more text outside the articles. The whole page, if that is under LEAST_PART of its text.
    """
    spare(order)
    n = len(order)
    inside, named, out = [""] * n, [False] * n, [False] * n  # of each element: the kind of root it is or stands in
    sizes, marked, called = [0] * n, [], []
    for e in order:
        k, up = e.at, e.parent
        above = inside[up] if up >= 0 else ""
        out[k] = up >= 0 and out[up] or dropped(e, bool(above))
        if out[k]:
            continue
        kind = "main" if is_main(e) else "article" if e.tag == "article" else ""
        inside[k], named[k] = above or kind, up >= 0 and named[up]
        if kind and not above:
            marked.append((e, kind))
        if not above and not kind and not named[k] and is_named_content(e):
            called.append(e)
            named[k] = True
    for e in reversed(order):
        if not out[e.at]:
            sizes[e.at] += own_size(e)
            if e.parent >= 0:
                sizes[e.parent] += sizes[e.at]
    of = lambda kind: sum(sizes[e.at] for e, x in marked if x == kind)
    mains, articles, total = of("main"), of("article"), sizes[0]
    both, names = sum(sizes[e.at] for e, _ in marked if named[e.at]), sum(sizes[e.at] for e in called)
    if mains and mains >= articles:
        roots, held, is_marked = [e for e, kind in marked if kind == "main"], mains, True
    elif marked and articles + mains >= names - both:
        roots, held, is_marked = [e for e, _ in marked], articles + mains, True
    else:
        roots, held, is_marked = called, names, False
    return (roots, is_marked) if roots and held >= LEAST_PART * total else ([order[0]], False)


def blocks_of(roots: list[Element]) -> list[str]:
    """The texts of the blocks in page order, white space made one space; without dropped elements. Of a header, only headings stay."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            joined = " ".join("".join(held).split())
            if joined:
                out.append(joined)
            held.clear()

    todo: list = [(r, False) for r in reversed(roots)]
    while todo:
        e, in_header = todo.pop()
        if e is None:
            flush()
        elif isinstance(e, str):
            held.append(e)
        elif not e.gone:
            block = e.tag in BLOCK
            if block:
                flush()
                todo.append((None, False))
            elif e.tag == "br":
                held.append(" ")
            for c in reversed(e.children):
                if isinstance(c, str):
                    if not in_header:
                        todo.append((c, False))
                elif c.tag in HEADING and in_header:
                    todo.append((c, False))
                elif not dropped(c, True):
                    todo.append((c, in_header or c.tag == "header" or any(marks(x, HEADER) for x in c.names())))
    flush()
    return out


HEADER = frozenset(["header"])


def subtree_hashes(order: list[Element]) -> tuple[list[int], list[bool]]:
    """For each element a 63-bit hash of its tag, class, id and children, -1 if it has no text; and whether links hold all of its text."""
    n = len(order)
    digests, hashes, linked = [b""] * n, [-1] * n, [True] * n
    for e in reversed(order):
        parts, full, all_linked = [e.tag, e.named.get("class", ""), e.named.get("id", "")], False, e.tag == "a"
        bare = True
        for c in e.children:
            if isinstance(c, str):
                joined = " ".join(c.split())
                if joined:
                    parts.append("t" + joined)
                    full, bare = True, False
            elif hashes[c.at] >= 0:
                parts.append(digests[c.at])
                full = True
                bare = bare and linked[c.at]
        digests[e.at] = digest = hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
        linked[e.at] = all_linked or bare
        if full:
            hashes[e.at] = int(digest, 16) >> 1
    return hashes, linked


def places(order: list[Element], roots: list[Element], marked: bool) -> list[int]:
    """Where each element stands: UNMARKED, or WITHIN or BESIDE the article. Roots of the article and what holds them are -1: they are the page's own."""
    if not marked:
        return [-1] + [UNMARKED] * (len(order) - 1)
    out = [BESIDE] * len(order)
    for r in roots:
        k = r.at
        while k >= 0 and out[k] != -1:
            out[k] = -1
            k = order[k].parent
    tops = {r.at for r in roots}
    for e in order[1:]:
        if out[e.at] != -1 and (e.parent in tops or out[e.parent] == WITHIN):
            out[e.at] = WITHIN
    return out


def joined_text(roots: list[Element]) -> str:
    return "\n".join(blocks_of(roots))


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1


def without_template(order: list[Element], hashes: list[int], place: list[int], template) -> int:
    """Deletes the subtrees whose (place, hash) is template, the outermost first; returns how many. One of several blocks that holds most
    of the page's text stays, with all in it."""
    deleted, sizes, texts = 0, [0] * len(order), [0] * len(order)
    for e in reversed(order):
        k = e.at
        if e.tag not in NEVER:
            own = own_size(e)
            sizes[k] += own
            texts[k] += own > 0 and e.tag in BLOCK
            if e.parent >= 0:
                sizes[e.parent] += sizes[k]
                texts[e.parent] += texts[k]
    done = [False] * len(order)
    for e in order[1:]:
        k = e.at
        if done[e.parent]:
            done[k] = True
        elif place[k] >= 0 and (place[k], hashes[k]) in template:
            done[k] = True
            if texts[k] < 2 or 2 * sizes[k] <= sizes[0]:
                e.gone = True
                deleted += 1
    return deleted


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].translate({c: c + 32 for c in range(65, 91)})


def read(page: str | None) -> tuple[list[Element], list[Element], list[int], list[int], list[bool]]:
    """Of a page: its elements, the roots of its article, where each element stands, their hashes, and which hold only links."""
    order = parse(page or "")
    roots, marked = content(order)
    hashes, linked = subtree_hashes(order)
    return order, roots, places(order, roots, marked), hashes, linked


def counted_subtrees(order: list[Element], place: list[int], hashes: list[int], linked: list[bool]) -> set[tuple[int, int, bool]]:
    """(place, hash, only links) of each block and each element that NEVER names; inline elements go with the block they stand in."""
    return {(place[e.at], hashes[e.at], linked[e.at]) for e in order if hashes[e.at] >= 0 and place[e.at] >= 0 and (e.tag in BLOCK or e.tag in NEVER)}


def subtrees(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, place, subtree, linked, article, page): the distinct subtrees of each page, and -1 once for each place there is, to count
    pages by; article: a hash of the main text; page: a hash of the html."""
    kinds = {"host": pa.string(), "place": pa.int32(), "subtree": pa.int64(), "linked": pa.bool_(), "article": pa.int64(), "page": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = page.as_py() or ""
                order, roots, place, hashes, linked = read(text)
                host, article, whole = host_of(url), hash_of(joined_text(roots)), hash_of(text)
                own = counted_subtrees(order, place, hashes, linked)
                rows += [(host, p, h, only, article, whole) for p, h, only in own | {(p, -1, False) for p in ({UNMARKED} if UNMARKED in place else {BESIDE, WITHIN})}]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds.values(), strict=True)], list(kinds))

    return pages.select(url_col, html_col).mapInArrow(run, "host string, place int, subtree long, linked boolean, article long, page long")


def templates(found: DataFrame) -> DataFrame:
    """(host, place, subtree): of subtrees, those that are template on their host, by exact counts of the different articles they stand in.

    Articles are made distinct before they are counted, so no host and no subtree gathers its pages in one task.
    """
    once = found.groupBy("host", "place", "subtree", "article").agg(F.max("linked").alias("linked"))
    each = written(once.groupBy("host", "place", "subtree").agg(F.count("*").alias("articles"), F.max("linked").alias("linked")), "subtrees")
    of_host = each.where("subtree = -1").select("host", "place", F.col("articles").alias("all_articles"))
    often = each.where(f"subtree >= 0 AND articles >= {LEAST}").join(of_host, ["host", "place"])
    least = F.when(F.col("place") == WITHIN, F.greatest(F.lit(float(LEAST_INSIDE)), INSIDE * F.col("all_articles")))
    least = least.when((F.col("place") == UNMARKED) & ~F.col("linked"), OPEN * F.col("all_articles")).otherwise(0.0)
    return often.where(F.col("articles") >= least).select("host", "place", "subtree")


def main_text(page: str | None, template) -> str:
    order, roots, place, hashes, _ = read(page)
    if template and without_template(order, hashes, place, template):
        roots, _ = content(order)
    return joined_text(roots)


def extracted(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages with __text: the main text, blocks joined by one line feed; "" for null, empty or textless html.

    A null url has the empty host. Rows are counted and read each by itself, so repeated rows get equal texts, and copies of a page
    count as one article. An empty table gives no rows. Template hashes are broadcast up to MOST_BROADCAST; beyond, each
    page's own subtrees are joined with them, so that no host's template is ever gathered. Columns of pages are kept; one named __text is replaced.
    """
    each = subtrees(pages, url_col, html_col)
    found = written(templates(each), "templates")

    if found.count() <= MOST_BROADCAST:
        site: dict[str, set[tuple[int, int]]] = {}
        for r in found.collect():
            site.setdefault(r["host"], set()).add((r["place"], r["subtree"]))
        known = pages.sparkSession.sparkContext.broadcast(site)

        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for page, url in batches:
                yield pa.array([main_text(text.as_py(), known.value.get(host_of(x))) for text, x in zip(page, url.to_pylist(), strict=True)], pa.string())

        return pages.withColumn("__text", F.arrow_udf(run, "string")(F.col(html_col), F.col(url_col)))

    def run_joined(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for page, own in batches:
            yield pa.array([main_text(text.as_py(), {(r["place"], r["subtree"]) for r in x or ()}) for text, x in zip(page, own.to_pylist(), strict=True)], pa.string())

    def keyed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for page, url in batches:
            yield pa.array([{"host": host_of(x), "page": hash_of(text.as_py() or "")} for text, x in zip(page, url.to_pylist(), strict=True)], pa.struct([("host", pa.string()), ("page", pa.int64())]))

    # Pages of one host and one html have the same template, so that the key need not tell them apart.
    own = each.join(found, ["host", "place", "subtree"]).groupBy("host", "page").agg(F.collect_set(F.struct("place", "subtree")).alias("__site"))
    key, of_page = free_name("page", pages), free_name("site", pages)
    own = own.select(F.struct("host", "page").alias(key), F.col("__site").alias(of_page))
    keys = pages.withColumn(key, F.arrow_udf(keyed, "struct<host:string,page:bigint>")(F.col(html_col), F.col(url_col)))
    joined = keys.join(own, key, "left").drop(key)
    return joined.withColumn("__text", F.arrow_udf(run_joined, "string")(F.col(html_col), F.col(of_page))).drop(of_page)


def report(pages: DataFrame) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars."""
    return extracted(pages.select("page_id", "url", "html")).select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))
