"""Elements of HTML pages as rows: tags, their matching ends, and containment by position.

``tag_rows`` cuts each page at its tags (script and style blocks and comments removed): a row is a tag with the text
behind it, numbered by ``pos``; a page's rows stand together, in order, where the page was read.  ``with_scopes`` relies on that
(rows that were shuffled go through windows: ``with_scope``) and deals what it keeps to the page's key, once; everything after that is
aggregates on that key, which Spark runs on the same partitioning without another shuffle.

* The end of an element is the end tag of its name on its own level, where the level counts the open elements of that name, so an
  element left open does not disturb others.  An element without an end tag ends at the next opening of its name, else with
  the page.
* ``with_scope`` adds a column that holds, on each row, the position of the outermost matching element around it, else null: an
  as-of assignment of rows to the nearest opening before them, cut off at its end.
* ``with_scopes`` adds many such columns at once, before the shuffle: an Arrow function finds the ends and scopes of whole batches of
  pages.  Rows that lie in no scope, or open none and have no text, are left out, but for the page's first.
* ``tag_rows`` of ``scopes`` whose conditions are data (``Opens``) does both at once: tags are cut by position in whole batches of pages, and
  only rows that are kept leave the Arrow function.
* ``texts`` joins the texts of a scope in page order.

Keys must tell pages apart.  Null html gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.functions.text import py_strip
from shelfmatch.operators import tag_cut
from shelfmatch.operators.extract import decode_entities, strip_blocks

#: Elements that have no end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: A tag's slash, name and attributes, and the text up to the next tag.
_TAG = r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>((?:[^<]++|<(?![a-zA-Z/]))*+)"""
#: The same, up to the tag's end: what stands in its brackets.
_INNER = r"""^<(/?[a-zA-Z][^\s/>]*+(?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>"""
_NO_END = 2_000_000_000


def _quoted(attrs: Column, name: str) -> Column:
    """The value of an attribute with its quotes; empty where the tag lacks it."""
    return F.regexp_extract(attrs, rf"""(?is)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)


def _unquoted(value: Column) -> Column:
    inner = F.when(value.rlike("""^["']"""), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.when(value != "", decode_entities(inner))


def attribute(attrs: Column, name: str) -> Column:
    """The value of an attribute, entities decoded; null where the tag lacks it."""
    return F.get(F.transform(F.array(_quoted(attrs, name)), _unquoted), 0)


def tag_rows(pages: DataFrame, key: str = "page_id", html: str = "html", tags: tuple[str, ...] | None = None, keep: tuple[str, ...] = (),
             scopes: Sequence[Scope] | None = None, carry: Sequence[str] = ("text",)) -> DataFrame:
    """key, the ``keep`` columns, pos, kind (1: opens, -1: ends, 0: has no end), tag, attrs, classes, id, text, end.

    ``tags`` are those the caller asks about: rows of others stay only where text follows them.
    ``scopes``, with conditions of ``Opens``: the rows that lie in them, dealt by key, as ``scoped_rows`` has them.
    """
    if scopes is not None:
        return scoped_rows(pages, scopes, key, html, keep, carry)
    body = strip_blocks(F.col(html))
    # one pass over the page; a tag's parts are taken from its own short text, in steps that are each computed once, and by patterns
    # only where the plain cut at the first ">" does not do: a tag without quotes before it ends there
    cut = pages.select(key, *keep, F.posexplode(F.regexp_extract_all(body, F.lit(_TAG), 0)).alias("pos", "whole"))
    cut = cut.withColumn("head", F.substring_index("whole", ">", 1))
    plain = ~F.col("head").contains('"') & ~F.col("head").contains("'")
    cut = cut.withColumn("inner", F.when(plain, F.substring("head", 2, 1 << 30)).otherwise(F.regexp_extract("whole", _INNER, 1)))
    cut = cut.withColumn("slash", F.substring("inner", 1, 1) == "/")
    bare = F.when(F.col("slash"), F.substring("inner", 2, 1 << 30)).otherwise(F.col("inner"))
    cut = cut.withColumn("bare", bare).withColumn("name", F.when(F.col("bare").rlike(r"[\s/>]"), F.regexp_extract("bare", r"^([a-zA-Z][^\s/>]*+)", 1)).otherwise(F.col("bare")))
    slash, text = F.col("slash"), F.substring("whole", F.length("inner") + 3, F.length("whole"))
    attrs = F.substring("bare", F.length("name") + 1, F.length("bare"))
    rows = cut.select(key, *keep, "pos", F.lower("name").alias("tag"), slash.alias("slash"), attrs.alias("attrs"), decode_entities(text).alias("text"))
    if tags:
        rows = rows.where(F.col("tag").isin(*tags) | ~F.col("text").rlike(r"^\s*$"))
    void = F.col("tag").isin(*VOID) | F.col("attrs").endswith("/")
    rows = rows.withColumn("kind", F.when(F.col("slash"), -1).when(void, 0).otherwise(1)).drop("slash")
    said = lambda name: F.when(F.col("attrs").contains("="), _quoted(F.col("attrs"), name)).otherwise("")
    rows = rows.withColumns({"classes": said("class"), "id": said("id")})
    classes = F.when(F.col("classes") == "", F.array(F.lit(""))).otherwise(F.split(F.coalesce(_unquoted(F.col("classes")), F.lit("")), r"\s+"))
    rows = rows.withColumns({"classes": classes, "id": _unquoted(F.col("id"))})
    return _with_ends(rows, key)


def packed_by_key(rows: DataFrame, key: str) -> DataFrame:
    """The one shuffle: a page's rows meet; packed, so that all readers of the rows want the same columns of it and can share it."""
    columns = [c for c in rows.columns if c != key]
    packed = rows.select(key, F.array(F.struct(*columns)).alias("row")).repartition(key)
    return packed.select(key, *[F.element_at("row", 1)[c].alias(c) for c in columns])


def _with_ends(rows: DataFrame, key: str) -> DataFrame:
    by_tag = Window.partitionBy(key, "tag").orderBy("pos")
    level = F.sum("kind").over(by_tag.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.when(F.col("kind") == -1, 1).otherwise(0)
    by_kind = Window.partitionBy(key, "tag", "kind").orderBy("pos")  # only openings ask for the next one
    rows = rows.withColumn("level", level).withColumn("next_open", F.lead("pos").over(by_kind))
    on_level = Window.partitionBy(key, "tag", "level").orderBy("pos")
    ended = F.when(F.lead("kind").over(on_level) == -1, F.lead("pos").over(on_level))
    end = F.coalesce(ended, "next_open", F.lit(_NO_END))
    return rows.withColumn("end", F.when(F.col("kind") == 1, end).otherwise(F.col("pos") + 1)).drop("level", "next_open")


def is_element(tag: str, *classes: str, id: str | None = None) -> Column:
    """Whether a row opens an element of the tag with all the classes (and the id)."""
    out = (F.col("kind") >= 0) & (F.col("tag") == tag)
    for c in classes:
        out = out & F.array_contains("classes", c)
    return out if id is None else out & (F.coalesce(F.col("id"), F.lit("")) == id)


@dataclass(frozen=True)
class Opens:
    """The elements that a scope is made of: of the tag (None: any) with all the ``classes`` and none of ``without``, the id, and the
    ``text`` right behind the opening tag."""

    tag: str | None
    classes: tuple[str, ...] = ()
    id: str | None = None
    without: tuple[str, ...] = ()
    text: str | None = None

    def column(self) -> Column:
        """The condition on rows of ``tag_rows``."""
        out = has_class(*self.classes) if self.tag is None else is_element(self.tag, *self.classes)
        if self.id is not None:
            out = out & (F.coalesce(F.col("id"), F.lit("")) == self.id)
        for c in self.without:
            out = out & ~F.array_contains("classes", c)
        return out if self.text is None else out & (F.col("text") == self.text)


def with_scope(rows: DataFrame, name: str, opens: Column, key: str = "page_id", inside: str | None = None, first: bool | str = False) -> DataFrame:
    """``rows`` with ``name``: the pos of the outermost element around each row (the opening row included) that ``opens`` selects.

    ``inside``: the scope that the element must lie in; ``first``: only the first one in that scope (in the page without it, or
    if it is "page").
    """
    if inside:
        opens = opens & F.col(inside).isNotNull() & (F.col(inside) < F.col("pos"))
    if first:  # nothing that the condition selects stands around the first one
        least = Window.partitionBy(key, inside) if inside and first != "page" else Window.partitionBy(key)
        at = F.min(F.when(opens, F.struct("pos", "end"))).over(least)
        within = F.col("pos").between(F.col("_at.pos"), F.col("_at.end") - 1)
    else:  # of the elements that have begun the outermost still open is the one that ends last
        so_far = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        at = F.max(F.when(opens, F.struct("end", (-F.col("pos")).alias("back"), "pos"))).over(so_far)
        within = F.col("pos") < F.col("_at.end")
    return rows.withColumn("_at", at).withColumn(name, F.when(within, F.col("_at.pos"))).drop("_at")


@dataclass(frozen=True)
class Scope:
    """A scope for ``with_scopes``: as for ``with_scope``; ``after``: the element begins behind the end of that scope's element;
    ``of``: no element of its own, but the first of these scopes that a row lies in, or, if ``first`` is "page", that its page has."""

    name: str
    opens: Column | Opens | None = None
    inside: str | None = None
    first: bool | str = False
    after: str | None = None
    of: tuple[str, ...] = ()


def with_scopes(rows: DataFrame, scopes: Sequence[Scope], key: str = "page_id", carry: Sequence[str] = ("text",)) -> DataFrame:
    """key, pos, the ``carry`` columns (attrs and classes: of rows that open a scope) and a column per scope, as ``with_scope`` adds
    them one after the other, dealt by key.

    ``rows``: from ``tag_rows``, with their pages together.  Pages are told apart by their place too, so two of one key do not mix elements.
    """
    if len(scopes) > 62:
        raise ValueError("too many scopes for one mask")
    rules = tuple((s.name, s.inside, s.first, s.after, s.of) for s in scopes)
    opened = [s.opens.column() if isinstance(s.opens, Opens) else s.opens for s in scopes]
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, c in enumerate(opened) if c is not None]
    mask = functools.reduce(Column.bitwiseOR, bits)
    sent = rows.select(key, "pos", "text", "tag", "kind", "attrs", "classes", *[c for c in carry if c not in ("text", "attrs", "classes")], mask.alias("_opens"))
    opens = F.col("_opens") != 0
    carried = [F.when(opens, F.col(c)).alias(c) if c in ("attrs", "classes") else F.col(c) for c in carry]
    more = [] if "text" in carry else ["text"]
    kept = sent.select(key, "pos", *carried)
    schema = T.StructType([*kept.schema, *[T.StructField(s.name, T.IntegerType()) for s in scopes]])
    sent = sent.select(key, "pos", *carried, *more, F.col("tag").alias("_tag"), F.col("kind").alias("_kind"), "_opens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pages in _whole_pages(batches):
            found, keep = _scopes_of(rules, pages)
            own = pages.select(kept_names).to_batches()[0] if pages.num_rows else None
            if own is not None:
                arrays = [*own.columns, *[pa.array(np.maximum(c, 0).astype(np.int32), mask=c < 0) for c in found]]
                yield pa.RecordBatch.from_arrays(arrays, [*kept_names, *[r[0] for r in rules]]).filter(pa.array(keep))

    kept_names = kept.columns
    return packed_by_key(sent.mapInArrow(run, schema), key)


def scoped_rows(pages: DataFrame, scopes: Sequence[Scope], key: str = "page_id", html: str = "html", keep: tuple[str, ...] = (), carry: Sequence[str] = ("text",)) -> DataFrame:
    """``with_scopes(tag_rows(pages, key, html, keep=keep), scopes, key, carry)`` of scopes whose conditions are ``Opens``, less the rows without
    text that begin no scope's element: pages are cut and their scopes found by one Arrow function, so only what is kept becomes a row."""
    if len(scopes) > 62:
        raise ValueError("too many scopes for one mask")
    rules, conditions = tuple((s.name, s.inside, s.first, s.after, s.of) for s in scopes), tuple(s.opens for s in scopes)
    types = {"text": T.StringType(), "attrs": T.StringType(), "classes": T.ArrayType(T.StringType()), **{c: pages.schema[c].dataType for c in keep}}
    schema = T.StructType([pages.schema[key], T.StructField("pos", T.IntegerType()), *[T.StructField(c, types[c]) for c in carry],
                           *[T.StructField(s.name, T.IntegerType()) for s in scopes]])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count in tag_cut.groups(batch.column("body")):
                group = batch.slice(first, count)
                tags = tag_cut.cut(group.column("body"), VOID)
                if not len(tags.page):
                    continue
                opens = _opening(conditions, tags)
                rows, found = _kept_scopes(rules, tags, opens)
                of, opening = tags.page[rows], opens[rows] != 0
                made = {key: group.column(key).take(pa.array(of)), "pos": pa.array(tags.pos[rows].astype(np.int32))}
                for c in carry:
                    if c == "text":
                        made[c] = tags.texts(rows)
                    elif c in keep:
                        made[c] = group.column(c).take(pa.array(of))
                    else:
                        attrs = tags.attrs(rows)
                        made[c] = pc.if_else(pa.array(opening), attrs if c == "attrs" else tag_cut.class_lists(tag_cut.value(attrs, "class")), None)
                made |= {r[0]: pa.array(np.maximum(c, 0).astype(np.int32), mask=c < 0) for r, c in zip(rules, found)}
                yield pa.RecordBatch.from_arrays([made[n] for n in names], names)

    sent = pages.select(key, *keep, strip_blocks(F.col(html)).alias("body"))
    return packed_by_key(sent.mapInArrow(run, schema), key)


def _opening(conditions: tuple, tags: tag_cut.Tags) -> np.ndarray:
    """For each tag the bits of the conditions that it fulfils."""
    opens = np.zeros(len(tags.page), dtype=np.int64)
    code = {n: k for k, n in enumerate(tags.names)}
    by_tag: dict = {}
    for bit, c in enumerate(conditions):
        if c is not None and (c.tag is None or c.tag in code):
            by_tag.setdefault(c.tag, []).append((bit, c))
    for tag, own in by_tag.items():
        rows = np.flatnonzero((tags.kind >= 0) if tag is None else (tags.kind >= 0) & (tags.tag == code[tag]))
        said = np.flatnonzero(tags.end[rows] > tags.name_end[rows])  # places of those with attributes
        attrs = tags.attrs(rows[said]) if any(c.classes or c.without or c.id for _, c in own) else None
        classes = ids = None
        if any(c.classes or c.without for _, c in own):  # the names of the class attribute, each between two blanks
            classes = pc.replace_substring_regex(pc.fill_null(tag_cut.value(attrs, "class"), ""), r"[\s\x0b]+", "  ")
            classes = pc.binary_join_element_wise(" ", classes, " ", "")
        if any(c.id for _, c in own):
            ids = tag_cut.value(attrs, "id")

        def where(found: pa.Array) -> np.ndarray:
            out = np.zeros(len(rows), dtype=bool)
            out[said] = pc.fill_null(found, False).to_numpy(zero_copy_only=False)
            return out

        for bit, c in own:
            fits = np.ones(len(rows), dtype=bool)
            for name in c.classes:
                fits &= where(pc.match_substring(classes, f" {name} "))
            for name in c.without:
                fits &= ~where(pc.match_substring(classes, f" {name} "))
            if c.id is not None:
                fits &= where(pc.equal(ids, c.id))
            if c.text is not None:
                fits[fits] = pc.equal(tags.texts(rows[fits]), c.text).to_numpy(zero_copy_only=False)
            opens[rows[fits]] |= 1 << bit
    return opens


def _kept_scopes(rules: tuple, tags: tag_cut.Tags, opens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows to keep, and for each rule the pos of their elements, -1 without."""
    end, opening = tags.pos + 1, opens != 0
    asked = np.zeros(len(tags.names), dtype=bool)
    asked[tags.tag[opening]] = True  # only elements of these tags need their ends
    of = asked[tags.tag]
    end[of] = _ends(tags.page[of], tags.pos[of], tags.tag[of], tags.kind[of])
    says, begins = tags.text_end > tags.end + 1, tags.pos == 0
    rows = np.flatnonzero(says | begins | opening)
    found = _find_scopes(rules, tags.page[rows], tags.pos[rows], end[rows], opens[rows])
    inside, at = np.any([c >= 0 for c in found], axis=0), np.any([c == tags.pos[rows] for c in found], axis=0)
    keep = begins[rows] | at | (says[rows] & inside)
    return rows[keep], [c[keep] for c in found]


def _page_starts(rows: pa.Table) -> np.ndarray:
    """Places at which a row belongs to another page than the row before it: another key, or a pos that does not grow."""
    if rows.num_rows < 2:
        return np.zeros(0, dtype=np.int64)
    pos, keys = rows.column(1).to_numpy(), rows.column(0).combine_chunks()
    now, before = keys.slice(1), keys.slice(0, len(keys) - 1)
    both_null = pc.and_(pc.is_null(now), pc.is_null(before))
    other = pc.fill_null(pc.not_equal(now, before), True)
    changed = pc.and_not(other, both_null).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed | (np.diff(pos) <= 0)) + 1


def _whole_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches cut where pages begin: what follows the last beginning waits for the next batch."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting:  # the last row tells whether the batch begins with another page
            last = waiting[-1].slice(waiting[-1].num_rows - 1)
            starts = _page_starts(pa.Table.from_batches([last, batch])) - 1
        else:
            starts = _page_starts(pa.Table.from_batches([batch]))
        if len(starts):
            yield pa.Table.from_batches([*waiting, batch.slice(0, starts[-1])]).combine_chunks()
            waiting = [batch.slice(starts[-1])]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _scopes_of(rules: tuple, rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """For each rule of ``with_scopes`` the pos of each row's element, -1 without; and which rows to keep."""
    begins = np.zeros(rows.num_rows, dtype=bool)
    begins[:1] = True
    begins[_page_starts(rows)] = True
    pos, kind, opens = (rows.column(c).to_numpy().astype(np.int64) for c in ("pos", "_kind", "_opens"))
    tag = rows.column("_tag").combine_chunks().dictionary_encode().indices.to_numpy()
    page = np.cumsum(begins) - 1
    found = _find_scopes(rules, page, pos, _ends(page, pos, tag, kind), opens)
    says = pc.fill_null(pc.not_equal(rows.column("text"), ""), False).to_numpy()
    inside = np.any([c >= 0 for c in found], axis=0) if found else begins
    return found, begins | (opens != 0) | (says & inside)


def _ends(page: np.ndarray, pos: np.ndarray, tag: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The ends of elements, as ``_with_ends`` has them."""
    if not len(pos):
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((pos, tag, page))
    k, p = kind[order], pos[order]
    begins = np.concatenate([[True], (np.diff(page[order]) != 0) | (np.diff(tag[order]) != 0)])
    own = np.cumsum(begins) - 1  # the page's rows of one tag
    open_before = np.cumsum(k) - k
    level = np.cumsum(k) - open_before[begins][own] + (k == -1)
    last = len(p)
    opening = np.concatenate([np.where(k == 1, np.arange(last), last), [last]])
    following = np.minimum.accumulate(opening[::-1])[::-1][1:]
    p_, own_ = np.concatenate([p, [_NO_END]]), np.concatenate([own, [-1]])
    end = np.where(own_[following] == own, p_[following], _NO_END)
    by_level = np.lexsort((level, own))
    here, then = by_level[:-1], by_level[1:]
    closed = (own[here] == own[then]) & (level[here] == level[then]) & (k[then] == -1)
    end[here[closed]] = p[then[closed]]
    out = np.empty(last, dtype=np.int64)
    out[order] = np.where(k == 1, end, p + 1)
    return out


def _find_scopes(rules: tuple, page: np.ndarray, pos: np.ndarray, end: np.ndarray, opens: np.ndarray) -> list[np.ndarray]:
    """For each rule the pos of each row's element, -1 without; rows in the order of page and pos."""
    new_page = np.concatenate([[True], np.diff(page) != 0])
    made: dict[str, np.ndarray] = {}
    for bit, (name, inside, first, after, of) in enumerate(rules):
        if of:
            made[name] = _first_of(page, [made[x] for x in of], first == "page")
            continue
        begins = (opens >> bit) & 1 == 1
        if inside:
            begins &= (made[inside] >= 0) & (made[inside] < pos)
        if after:
            behind = np.full(page[-1] + 1, -1)
            opening = made[after] == pos
            np.maximum.at(behind, page[opening], end[opening])
            begins &= (behind[page] >= 0) & (pos >= behind[page])
        at = np.flatnonzero(begins)
        if first:
            parts = new_page | np.concatenate([[True], np.diff(made[inside]) != 0]) if inside and first != "page" else new_page
            part = np.cumsum(parts) - 1
            element = np.full(part[-1] + 1, -1)
            element[part[at][::-1]] = at[::-1]  # the first one is written last
            element = element[part]
        else:  # of the elements that have begun the outermost still open is the one that ends last
            element = np.full(len(pos), -1)
            if len(at):
                rank = np.empty(len(at), dtype=np.int64)
                by_end = np.lexsort((-pos[at], end[at]))
                rank[by_end] = np.arange(len(at))
                best = np.maximum.accumulate(page[at] * len(at) + rank)  # pages ascend, so a later page's are greater
                so_far = np.cumsum(begins) - 1
                known = (so_far >= 0) & (best[so_far] // len(at) == page)
                element[known] = at[by_end[best[so_far[known]] % len(at)]]
        within = (element >= 0) & (pos >= pos[element]) & (pos < end[element])
        made[name] = np.where(within, pos[element], -1)
    return [made[r[0]] for r in rules]


def _first_of(page: np.ndarray, scopes: list[np.ndarray], of_page: bool) -> np.ndarray:
    out, open_ = np.full(len(page), -1), np.ones(len(page), dtype=bool)
    for scope in scopes:
        present = scope >= 0
        if of_page:
            present = (np.bincount(page, present) > 0)[page]
        out = np.where(present & open_, scope, out)
        open_ &= ~present
    return out


def has_class(*classes: str) -> Column:
    """Whether a row opens an element of any tag with all the classes."""
    out = F.col("kind") >= 0
    for c in classes:
        out = out & F.array_contains("classes", c)
    return out


def _stripped(text: Column) -> Column:
    """``py_strip``; a text that begins and ends with a printable ASCII character is as it is."""
    bare = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(bare, text).otherwise(py_strip(text))


def texts(where: Column, separator: str = "") -> Column:
    """Aggregate: the texts of the rows where the condition holds, each stripped, blank ones left out, joined in page order."""
    piece = _stripped(F.col("text"))
    found = F.array_sort(F.collect_list(F.when(where & (piece != ""), F.struct("pos", piece.alias("text")))))
    return F.array_join(F.transform(found, lambda t: t["text"]), separator)


def whole_text(where: Column) -> Column:
    """Aggregate: the text as a browser has it: pieces joined as they are, then stripped."""
    found = F.array_sort(F.collect_list(F.when(where, F.struct("pos", "text"))))
    return py_strip(F.array_join(F.transform(found, lambda t: t["text"]), ""))


def later_wins(pairs: Column) -> Column:
    """A map from an array of (pos, key, value) structs: of equal keys the one with the greatest pos."""
    ordered = F.array_sort(pairs, lambda a, b: a["pos"] - b["pos"])
    kept = F.filter(ordered, lambda p: ~F.exists(ordered, lambda q: (q["key"] == p["key"]) & (q["pos"] > p["pos"])))
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["key"], p["value"])))
