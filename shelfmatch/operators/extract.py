"""Page -> record extraction (X1, F5, F6, F10, N5) as native column expressions.

A page is ``(page_id, url, html)``.  Rules are data: ``Rule(field, tag,
cls=None, id=None, mode='text'|'list'|'attr'|'count', attr=None)``.  Each
rule becomes a regular expression over the page with ``<script>``/``<style>``
blocks removed (a ``</p>`` inside a script string must not end a
paragraph), evaluated by ``regexp_extract``/``regexp_extract_all`` inside
whole-stage code generation - no per-row Python, no parser per page.
Element text = inner HTML with tags removed, the basic named and all numeric
entities decoded and whitespace collapsed.  A text rule follows nested elements
of its tag to the end tag that fits; a list rule is for elements that do not
nest (links, list items, paragraphs) and ends each at the next end tag.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.text import collapse_ws, py_strip

# --- fixed values: entity decoding table (entity text -> character) ---------
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)
# Record status values.
STATUS_SUCCESS = "success"
STATUS_NO_NAME = "no_name_found"
STATUS_ERROR_PREFIX = "error: "


@dataclass(frozen=True)
class Rule:
    field: str
    tag: str
    cls: str | None = None
    id: str | None = None
    mode: str = "text"  # text | list | attr | count
    attr: str | None = None
    default: str | None = None

    def open_tag(self) -> str:
        cond = ""
        if self.cls:  # one of the blank-separated names of the class attribute, in either quote or none
            c = re.escape(self.cls)
            cond += rf"""(?=[^>]*\sclass\s*=\s*(?:"(?:[^"]*\s)?{c}(?:\s[^"]*)?"|'(?:[^']*\s)?{c}(?:\s[^']*)?'|{c}[\s>]))"""
        if self.id:
            i = re.escape(self.id)
            cond += rf"""(?=[^>]*\sid\s*=\s*(?:"{i}"|'{i}'|{i}[\s>]))"""
        return rf"<{re.escape(self.tag)}(?=[\s/>]){cond}[^>]*>"

    def element(self) -> str:
        return rf"(?is){self.open_tag()}(.*?)</{re.escape(self.tag)}>"


def strip_blocks(html: Column) -> Column:
    """Remove script and style blocks and comments."""
    no_script = F.regexp_replace(html, r"(?is)<script\b.*?</script>", " ")
    no_style = F.regexp_replace(no_script, r"(?is)<style\b.*?</style>", " ")
    cleaned = F.regexp_replace(no_style, r"(?s)<!--.*?-->", " ")
    lower = F.lower(html)  # the patterns run on the pages that have any of them
    return F.when(lower.contains("<script") | lower.contains("<style") | lower.contains("<!--"), cleaned).otherwise(html)


def html_text(fragment: Column) -> Column:
    """Inner HTML -> text: tags to spaces, entities decoded, blanks collapsed, stripped."""
    return py_strip(collapse_ws(decode_entities(F.regexp_replace(fragment, r"<[^>]*>", " "))))


def decode_entities(text: Column) -> Column:
    """The basic named and all numeric character references as characters; only texts with one are touched."""
    out = F.when(text.contains("&#"), _numeric_references(text)).otherwise(text)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return F.when(text.contains("&"), out).otherwise(text)


def _numeric_references(text: Column) -> Column:
    """`&#233;` and `&#xe9;` as characters; a number that is no character stays as it is."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)&#(x[0-9a-f]{1,6}|[0-9]{1,7});"), 1))

    def replaced(acc: Column, ref: Column) -> Column:
        digits = F.when(F.lower(F.substring(ref, 1, 1)) == "x", F.substring(ref, 2, 9)).otherwise(F.hex(ref.try_cast("bigint")))
        code = F.conv(digits, 16, 10).cast("bigint")
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.replace(acc, F.concat(F.lit("&#"), ref, F.lit(";")), char)).otherwise(acc)

    return F.aggregate(found, text, replaced)


def _balanced(body: Column, rule: Rule) -> Column:
    """Inner HTML of the first element of the rule, up to its own end tag where elements of its tag are nested.

    The text behind the open tag is cut before each tag of that name, and pieces are taken until as many end
    as have begun; an element that never ends gives null.
    """
    tag = re.escape(rule.tag)
    rest = F.regexp_extract(body, rf"(?is){rule.open_tag()}(.*)", 1)
    pieces = F.split(rest, rf"(?i)(?=</?{tag}[\s/>])")
    state = F.aggregate(
        pieces, F.struct(F.lit(1).alias("open"), F.lit("").alias("text")),
        lambda acc, p: F.when(acc["open"] == 0, acc).otherwise(F.struct(
            (acc["open"] + F.when(p.rlike(rf"(?i)^</{tag}[\s/>]"), -1).when(p.rlike(rf"(?i)^<{tag}[\s/>]"), 1).otherwise(0)).alias("open"),
            F.when((acc["open"] == 1) & p.rlike(rf"(?i)^</{tag}[\s/>]"), acc["text"]).otherwise(F.concat(acc["text"], p)).alias("text"))))
    return F.when(state["open"] == 0, state["text"])


def rule_column(body: Column, rule: Rule) -> Column:
    if rule.mode == "text":
        found = F.when(body.rlike(rule.element()), F.regexp_extract(body, rule.element(), 1))
        nested = found.rlike(rf"(?i)<{re.escape(rule.tag)}[\s/>]")
        val = html_text(F.when(nested, _balanced(body, rule)).otherwise(found))
    elif rule.mode == "list":
        val = F.transform(F.regexp_extract_all(body, F.lit(rule.element()), 1), lambda x: html_text(x))
    elif rule.mode == "count":
        val = F.size(F.regexp_extract_all(body, F.lit(r"(?is)" + rule.open_tag()), 0))
    elif rule.mode == "attr":
        tags = F.regexp_extract_all(body, F.lit(rf"(?is){rule.open_tag()}"), 0)
        value = rf"""(?is)\s{re.escape(rule.attr)}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
        with_value = F.filter(tags, lambda t: t.rlike(value))
        val = F.transform(with_value, lambda t: F.concat(*[F.regexp_extract(t, value, k) for k in (1, 2, 3)]))
    else:
        raise ValueError(f"unknown rule mode {rule.mode}")
    if rule.default is not None and rule.mode == "text":
        val = F.coalesce(val, F.lit(rule.default))
    return val.alias(rule.field)


def extract_fields(pages: DataFrame, rules: list[Rule], html: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                   container: Rule | None = None) -> DataFrame:
    """One output row per page, one column per rule; with ``container`` (F6),
    pages lacking it give no row.  Scripts and styles are stripped once per page."""
    body = strip_blocks(F.col(html))
    staged = pages.select(*keep, body.alias("__body"))
    if container is not None:
        staged = staged.where(F.col("__body").rlike(container.element()))
    return staged.select(*keep, *[rule_column(F.col("__body"), r) for r in rules])


def require_container(pages: DataFrame, rule: Rule, html: str = "html") -> DataFrame:
    """a page without the main container yields no record."""
    return pages.where(strip_blocks(F.col(html)).rlike(rule.element()))


def drop_forbidden(pages: DataFrame, status: str = "http_status") -> DataFrame:
    """a page fetched with HTTP 403 yields no record (no-op when the column is absent)."""
    if status not in pages.columns:
        return pages
    return pages.where(F.coalesce(F.col(status) != 403, F.lit(True)))


def record_status(name: Column, error: Column | None = None) -> Column:
    """``error: <msg>`` / ``no_name_found`` / ``success``."""
    st = F.when((name.isNull()) | (name == ""), F.lit(STATUS_NO_NAME)).otherwise(F.lit(STATUS_SUCCESS))
    if error is not None:
        st = F.when(error.isNotNull(), F.concat(F.lit(STATUS_ERROR_PREFIX), error)).otherwise(st)
    return st


def merge_sections(df: DataFrame, sections: list[str], out: str = "product_data") -> DataFrame:
    """merge section structs into one record; a later section wins on a repeated key.

    Field names are known from the schema, so the merge is one ``struct``
    expression built on the driver and evaluated per row in generated code.
    """
    owner: dict[str, str] = {}
    order: list[str] = []
    for sec in sections:
        for f in df.schema[sec].dataType.fields:
            if f.name not in owner:
                order.append(f.name)
            owner[f.name] = sec
    merged = F.struct(*[F.col(f"{owner[n]}.{n}").alias(n) for n in order])
    return df.withColumn(out, merged).drop(*sections)
