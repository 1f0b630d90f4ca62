"""Main text of HTML pages by equivalence-class template deduction.

A page is a run of tokens: its opening tags, told apart by their role (the path of enclosing elements with their ids,
classes and ARIA roles; numbers that tell pages apart and state classes are left out).  For the pages of one host, tokens
with the same occurrence vector (how often they occur on each page) form an equivalence class; the vector is kept as two
64-bit fingerprints, a commutative sum over pages, so no list of pages is ever gathered.  A class is valid if it has
``MIN_SIZE`` tokens and occurs on ``MIN_SUPPORT`` of the host's pages.  Classes nest by their tokens' paths; a token's slot
is what stands below it.

The host's own evidence decides about the slots of valid classes: a slot of a named block element whose text is one of
at most ``SAME`` times as many texts as the host has different pages with it (one at least; ``MIN_PAGES`` such pages at
least) is template, with all slots nested in it, whatever its name; unless it holds ``DOMINANT`` of the text and is not
mostly links.  The distinct texts are counted by a sketch, a partial aggregate.  Paragraphs, headings, articles and
elements without a name are no slots of their own, so a passage in them that repeats on all pages of a host is kept.

A container is a content slot with ``ASIDE`` of its pages' text, once a page; of several of one class the name decides
(`article`, `main`, known ids and classes, `body`), then the text.  A page's text is what its best container holds, without
the template slots.  Where text differs from page to page the evidence cannot tell an article from a reader's comment or
a list of related pages: there names decide, and elements named as menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles or comments are left out.  One that is excluded by such a name is kept all the same if it holds
``DOMINANT`` of its page's text, mostly not links, and no main container outside it holds ``ASIDE`` of it: a page-wide
form, or an article filed under `legal`.

Defined results: null and empty html give the empty text; a page that has none of its
host's containers is judged by its own tokens; repeated rows count once for each; null and odd URLs share the empty host;
unclosed and deeply nested tags cost no more than others; white space inside a block is
one space, blocks are joined by one space; every row gives one row; other columns are not read.
"""

from __future__ import annotations

import functools
import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import per_row, prepare, stored, table
from shelfmatch.llm.url_filter import host_and_path

MIN_SUPPORT = 0.3
#: Tokens of a valid class.
MIN_SIZE = 2
#: Shares of a page's text: an element that holds the first is not excluded, a main container with the second counts.
DOMINANT, ASIDE = 0.5, 0.2
#: Texts of a template slot per different page of the host, and the least number of such pages.
SAME, MIN_PAGES = 0.05, 4
#: A host with more pages is dealt out in parts of so many; where that made more than ``LARGE_HOSTS`` hosts large, in larger parts.
TASK_PAGES, LARGE_HOSTS = 5_000, 100_000
#: Base and modulus of the hash of a run of texts.
_BASE, _PRIME = 0x2545F4914F6CDD1D % ((1 << 61) - 1), (1 << 61) - 1

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>?", re.S)
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_NAMES = re.compile(r"""\s(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
#: Elements whose content is text, up to their own end tag.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
           "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: An opening tag of the left ends open elements of the right, up to the nearest element that bounds them.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4",
           "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
_BOUNDS = {"ul", "ol", "dl", "table", "select", "div", "article", "section", "main", "body", "td", "th", "aside", "nav", "header", "footer", "blockquote", "form"}
#: Elements and words of ids, classes and roles that hold no main text.
_OUT_TAGS = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "input", "object", "audio", "video", "canvas"} | _RAW
_OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|footer|masthead|(?:site|page|top|global)[_-]header|topbar|"
    r"cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|signup|login|search|comments?|commentlist|disqus|replies|reply|respond|discussion|"
    r"related|recommend\w*|share|sharing|social|widget|toolbar|pagination|pager|copyright|legal|complementary|contentinfo|alert|hidden|skip\w*)(?:$|[\s_-])|"
    r"(?:^|\s)header(?:$|\s)", re.I)
#: Elements that are never the text, whatever they hold.
_NEVER = _OUT_TAGS - {"header", "aside", "form"}
#: Class names that wrap the text whatever else the element is called.
_SURE_NAMES = re.compile(r"(?:^|\s)(?!\S*(?:comment|repl|sidebar|footer|related))(?:\S*[_-])?(?:hentry|(?:post|entry|article|story|main|page)[_-](?:content|body|text))(?:$|\s)", re.I)
#: Class names that tell a state of the element, not what it is; the filing ones only beside a main name.
_STATES = re.compile(r"(?:no|has|with|without)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled)", re.I)
_FILED = re.compile(r"(?:category|cat|tag|format|type|status|term)[_-].*", re.I)
#: Numbers in ids and classes that tell pages apart.
_NUMBERS = re.compile(r"\d{3,}|(?<![0-9a-f])(?=[a-f]*\d)[0-9a-f]{8,}|(?<=^post-)\d+|(?<=^postid-)\d+|(?<=^page-id-)\d+|(?<=^node-)\d+|(?<=^entry-)\d+|(?<=^article-)\d+|(?<=^comment-)\d+")
#: Elements that the opening tags above may end, or that bound what they end.
_MARKS = _BOUNDS | {"p"} | set().union(*_CLOSES.values())
#: Named elements of other tags are slots of the template.
_FLOW = {"html", "body", "article", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figure"} | _INLINE | _VOID | _RAW
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text)(?:$|[\s_-])", re.I)


def _role(tag: str, raw: str) -> str:
    names = " ".join("".join(m) for m in _NAMES.findall(raw)) if "=" in raw else ""
    return _named(tag, names) if names.strip() else tag


@functools.lru_cache(maxsize=100_000)
def _named(tag: str, names: str) -> str:
    kept = [n for n in {_NUMBERS.sub("#", n) for n in names.split()} if not _STATES.fullmatch(n)]
    if any(_FILED.fullmatch(n) for n in kept):
        other = [n for n in kept if not _FILED.fullmatch(n)]
        kept = other if tag in ("article", "main") or _MAIN_NAMES.search(" ".join(other)) else kept
    return f"{tag}.{'.'.join(sorted(kept))}" if kept else tag


def _out(role: str) -> bool:
    tag, _, names = role.partition(".")
    if tag in _OUT_TAGS or not names or tag in ("html", "body"):
        return tag in _OUT_TAGS
    names = names.replace(".", " ")
    return bool(_OUT_NAMES.search(names)) and not _SURE_NAMES.search(names)


_out = functools.lru_cache(maxsize=100_000)(_out)


def _rank(role: str) -> int:
    """How likely an element is the main text's container by its name; 0: not at all."""
    tag, _, names = role.partition(".")
    if tag == "article":
        return 4
    if tag == "main":
        return 3
    if names and tag in ("div", "section", "td") and _MAIN_NAMES.search(names.replace(".", " ")):
        return 2
    return int(tag == "body")


class Page:
    """A page's events and the role paths of its elements, as numbered nodes.

    A node is a role path: elements whose open elements have the same roles share it.  A parent has a smaller number than its
    children, so sums over what a node holds go once through the nodes from the last to the first, and what a node passes down
    once from the first to the last; a page costs time and memory in proportion to its length, however deep it nests.

    ``events`` are (kind, node, what): "text" with the text, "break" where a block element begins or ends.
    """

    def __init__(self, text: str | None):
        self.parent, self.role, self.depth, self.print = [0], [""], [0], [0]
        self.count, self.own = [0], [0]  # elements, and text characters right inside
        self.checksum = [0]  # of the text inside, in order
        self._child: dict[tuple[int, str], int] = {}
        self.events: list[tuple[str, int, str]] = []
        self._walk(text or "")
        self._judge()

    def _node(self, parent: int, role: str) -> int:
        node = self._child.get((parent, role))
        if node is None:
            node = self._child[parent, role] = len(self.parent)
            self.parent.append(parent)
            self.role.append(role)
            self.depth.append(self.depth[parent] + 1)
            self.print.append(xxhash.xxh3_64_intdigest(role, seed=self.print[parent]))
            self.count.append(0)
            self.own.append(0)
            self.checksum.append(0)
        return node

    def _walk(self, text: str) -> None:
        """Events of the page.  End tags that HTML lets pages leave out are put in."""
        stack: list[tuple[str, int, int, int]] = []  # tag, node, and the texts and their hash before it
        open_tags: dict[str, int] = {}
        marks: list[int] = []  # places in the stack that may end where a tag opens, or that bound that
        hashes, powers = 0, [1]  # hash of the texts so far; powers of the base
        texts = [0]

        def note(node: int, what: str) -> None:
            nonlocal hashes
            if data := what.strip():
                self.own[node] += len(data)
                hashes = (hashes * _BASE + xxhash.xxh3_64_intdigest(data)) % _PRIME
                texts[0] += 1
                powers.append(powers[-1] * _BASE % _PRIME)
            self.events.append(("text", node, what))

        def close() -> str:
            tag, node, before, was = stack.pop()
            open_tags[tag] -= 1
            if marks and marks[-1] == len(stack):
                marks.pop()
            inside = (hashes - was * powers[texts[0] - before]) % _PRIME
            self.checksum[node] = (self.checksum[node] * _BASE + inside + 1) % _PRIME
            if tag not in _INLINE:
                self.events.append(("break", node, tag))
            return tag

        at, size = 0, len(text)
        while at < size:
            m = _TOKEN.search(text, at)
            if not m:
                break
            here = stack[-1][1] if stack else 0
            if m.start() > at:
                note(here, text[at:m.start()])
            raw, at = m.group(), m.end()
            tag = _TAG.match(raw)
            if not tag:
                continue
            name = tag.group(1).lower()
            if raw[1] == "/":
                if open_tags.get(name):
                    while close() != name:
                        pass
                elif name in ("p", "br"):
                    self.events.append(("break", here, name))
                continue
            ends = _CLOSES.get(name, ())
            if name in _ENDS_P or ends:
                for i in reversed(marks):
                    t = stack[i][0]
                    if t in ends or name in _ENDS_P and t == "p":
                        while len(stack) > i:
                            close()
                        here = stack[-1][1] if stack else 0
                        break
                    if t in _BOUNDS:
                        break
            node = self._node(here, _role(name, raw))
            self.count[node] += 1
            if name not in _INLINE:
                self.events.append(("break", here, name))
            if name in _VOID or raw.endswith("/>") and name not in _RAW and name not in _ENDS_P:
                if name not in _INLINE or name == "br":
                    self.events.append(("break", here, name))
            elif name in _RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(text, at)
                at = end.end() if end else size
            else:
                if name in _MARKS:
                    marks.append(len(stack))
                stack.append((name, node, texts[0], hashes))
                open_tags[name] = open_tags.get(name, 0) + 1
        if at < size:
            note(stack[-1][1] if stack else 0, text[at:])
        while stack:
            close()
        self.whole = hashes

    def _up(self, own: list[int]) -> list[int]:
        """For each node the sum over it and all below it."""
        held = list(own)
        for k in range(len(held) - 1, 0, -1):
            held[self.parent[k]] += held[k]
        return held

    def _judge(self) -> None:
        nodes, parent, role = range(1, len(self.parent)), self.parent, self.role
        tag = [r.partition(".")[0] for r in role]
        link, never, top_never, excluded = [False], [False], [], [False]
        for k in nodes:
            link.append(link[parent[k]] or tag[k] == "a")
            never.append(never[parent[k]] or tag[k] in _NEVER)
            if never[k] and not never[parent[k]]:
                top_never.append(k)
            excluded.append(excluded[parent[k]] or _out(role[k]))
        self.tag = tag
        self.held = held = self._up(self.own)
        self.links = self._up([n if link[k] else 0 for k, n in enumerate(self.own)])
        total = held[0] - sum(held[k] for k in top_never)
        able = [k for k in nodes if held[k] and held[k] >= DOMINANT * total and 2 * self.links[k] < held[k] and _out(role[k]) and tag[k] not in _NEVER]
        #: Excluded by name, yet the page's text: all main containers stand around it and hold little else.
        self.clear = set()
        if able:
            main = {k for k in nodes if held[k] and held[k] >= ASIDE * total and not excluded[k] and _rank(role[k]) > 1}
            most = max((held[k] for k in main), default=0)
            around = [0]
            for k in nodes:
                around.append(around[parent[k]] + (k in main))
            self.clear = {k for k in able if around[k] == len(main) and (not main or most - held[k] < ASIDE * total)}
        self.out = [False]
        for k in nodes:
            self.out.append(self.out[parent[k]] or _out(role[k]) and k not in self.clear)

    def tokens(self) -> list[tuple]:
        """(print of the role path, its depth, occurrences, text characters below it that no excluded element holds, rank, link
        characters, the page's characters, and for slots checksums of the text and of the page's) of the opening tags."""
        chars = self._up([0 if k == 0 or self.out[k] else n for k, n in enumerate(self.own)])
        rows = []
        for k in range(1, len(self.parent)):
            slot = "." in self.role[k] and self.tag[k] not in _FLOW and not self.out[k]
            rows.append((self.print[k] - (1 << 63), self.depth[k], self.count[k], chars[k], 0 if self.out[k] else _rank(self.role[k]), self.links[k], chars[0],
                         self.checksum[k] if slot else None, self.whole if slot else None))
        return rows

    def own_container(self) -> int | None:
        """The page's best container by its own tokens: by name, then by text, then the outermost."""
        able = [(rank, n == 1, chars, -depth, path) for path, depth, n, chars, rank, _, total, *_ in self.tokens() if rank and chars >= ASIDE * total]
        return max(able)[-1] if able else None

    def kept(self, container: int | None, repeated: set[int]) -> list[bool]:
        """For each node whether text right inside it is main text: below the container, in no excluded or repeated element; the
        container's own header is its headline."""
        inside = [container is None]
        for k in range(1, len(self.parent)):
            path, up = self.print[k] - (1 << 63), self.parent[k]
            own = self.tag[k] == "header" and (self.print[up] - (1 << 63) == container if up else container is None)
            below = inside[up] and path not in repeated and (own or not _out(self.role[k]) or k in self.clear)
            inside.append(path == container or below)
        return inside


def extract(text: str | None, containers: list[int] | None, repeated: list[int] | None = None) -> str:
    """What the first of ``containers`` that the page has (else the page's own best one) holds outside of the ``repeated`` slots."""
    if not text:
        return ""
    page = Page(text)
    have = {p - (1 << 63) for p in page.print[1:]}
    container = next((c for c in containers or [] if c in have), None)
    kept, out = page.kept(page.own_container() if container is None else container, set(repeated or ())), []
    for kind, node, what in page.events:
        if kept[node]:
            out.append(entities.unescape(what) if kind == "text" else " ")
    return " ".join("".join(out).split())


def _page_tokens(batches):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4)
    for batch in batches:
        rows = [(host, page, *t) for host, page, text in zip(*(c.to_pylist() for c in batch.columns)) for t in Page(text).tokens()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                         ["host", "page", "role", "depth", "n", "chars", "rank", "links", "total", "slot", "whole"])


def templates(pages: DataFrame) -> DataFrame:
    """host, containers (role paths of the template's main slots, best first), repeated (those of its template slots)."""
    keyed = pages.select(host_and_path(F.col("url"))["host"].alias("host"), F.xxhash64("page_id", "url", "html").alias("page"), "html")
    found = keyed.mapInArrow(_page_tokens, "host string, page long, role long, depth int, n long, chars long, rank int, links long, total long, slot long, whole long")
    # the occurrence vector as two fingerprints: sums over hashes of page and count
    per_token = found.groupBy("host", "role").agg(
        F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("v1"), F.sum(F.xxhash64("n", "page", F.lit(1)).cast("decimal(20,0)")).alias("v2"),
        F.max("depth").alias("depth"), (F.min("slot") == F.max("slot")).alias("one_text"),
        F.count("*").alias("support"), F.max("n").alias("most"), F.sum("chars").alias("chars"), F.max("rank").alias("rank"),
        F.sum("links").alias("links"), F.sum("total").alias("total"),
        F.approx_count_distinct("slot", 0.1).alias("texts"), F.approx_count_distinct("whole", 0.1).alias("different"))
    few = F.col("one_text") | (F.greatest(F.col("texts"), F.lit(2)) <= SAME * F.col("different"))  # the sketch alone may take two texts for one
    repeated = ((F.col("different") >= MIN_PAGES) & few
                & ((F.col("chars") < DOMINANT * F.col("total")) | (2 * F.col("links") >= F.col("chars"))))
    per_token = per_token.withColumn("repeated", repeated)
    holds = (F.col("rank") > 0) & (F.col("most") == 1) & ~F.col("repeated") & (F.col("chars") >= ASIDE * F.col("total"))
    container = F.struct("rank", "chars", (-F.col("depth")).alias("outer"), "role")
    classes = per_token.groupBy("host", "v1", "v2").agg(
        F.max("support").alias("support"), F.count("*").alias("size"), F.max(F.when(holds, container)).alias("container"),
        F.collect_list(F.when(F.col("repeated"), F.col("role"))).alias("repeated"))
    n_pages = keyed.groupBy("host").agg(F.count("*").alias("n_pages"))
    valid = classes.join(n_pages, "host").where((F.col("support") >= MIN_SUPPORT * F.col("n_pages")) & (F.col("size") >= MIN_SIZE))
    order = F.struct(-F.col("container.rank"), -F.col("support"), -F.col("container.chars"), F.col("container.role").alias("role"))
    return valid.groupBy("host").agg(
        F.array_sort(F.collect_list(F.when(F.col("container").isNotNull(), order))).alias("c"), F.flatten(F.collect_list("repeated")).alias("repeated"),
    ).select("host", F.col("c.role").alias("containers"), "repeated")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of each page."""
    prepare(pages.sparkSession)
    pages = pages.select("page_id", "url", "html").withColumn("host", host_and_path(F.col("url"))["host"])
    # the pages of a large host are dealt out over as many tasks as it needs; there are at most LARGE_HOSTS large hosts
    counts = pages.groupBy("host").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(TASK_PAGES, total // LARGE_HOSTS)
    large = stored(counts.where(F.col("n") > most).select("host", F.ceil(F.col("n") / most).alias("salts")), "large-hosts")
    salts = F.coalesce("salts", F.lit(1).cast("long"))
    spread = templates(pages).join(F.broadcast(large), "host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
    pages = pages.join(F.broadcast(large), "host", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), salts)).drop("salts")
    keyed = pages.join(spread, ["host", "salt"], "left")
    text = per_row(_extract, "text string", F.col("html"), F.struct("containers", "repeated"))
    return keyed.select("page_id", "url", text["text"].alias("text"))


def _extract(pages: list, templates: list) -> list[tuple]:
    return [(extract(p, t["containers"], t["repeated"]),) for p, t in zip(pages, templates)]


def op4_main_text(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
