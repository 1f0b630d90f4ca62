"""Search in nested JSON documents (A7) and the attribute lists embedded in pages.

A document's rows and nodes are gathered by ``doc``, once per operator, and an Arrow function walks each document in memory, level by level, whatever the
depth: the frontier holds containers (object or array) with their JSON text and their path, the places taken from the root, so paths compare in
depth-first order; what lies behind the first list found so far is not walked.  A reference ``"$k"`` is replaced by node k of its document where
it is met; ``seen`` holds the keys on the way, and a key that is met again gives null, so cycles end.  Where several rows share a ``doc``, a
reference means each of the nodes of its key, and objects of equal paths are one; a null doc's rows are told apart and have no nodes.

Whether a text is JSON and how its numbers and escapes are written is Spark's to say (``try_parse_json``, ``from_json``); the walk only cuts texts.
Names keep the order of the text, as JSON parsers of scripts do.  Null and unparsable documents (those with equal names in one
object too) and scalars hold nothing; documents are told apart by ``doc``.
"""

from __future__ import annotations

import json as json_text
import re
from collections.abc import Callable, Iterator
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from shelfmatch.operators.specs import group_specs
from shelfmatch.session import written

ATTRIBUTE_ITEM = "attributeItem"
ROOT = "__root"
#: Fixed value: how pages push the payload that holds the attribute lists.
PAYLOAD = r"""(?s)self\.__next_f\.push\(\[1,\s*"16:(.*?)"\]\)"""
_PUSHED, _PUSHED_END = re.compile(PAYLOAD.partition("(.*?)")[0], re.ASCII), '"])'
_ATTRIBUTES = "array<struct<displayName:string,value:string>>"


class _Raw(str):
    """JSON as it is written: a number, or marks."""

    __slots__ = ()


_SCAN = json_text.JSONDecoder(parse_int=_Raw, parse_float=_Raw, parse_constant=_Raw).scan_once
_BLANKS = re.compile(r"[ \t\n\r]*")
_ESCAPED = re.compile('["\\\\\x00-\x1f\ud800-\udfff]')
_ESCAPES = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_COMMA = _Raw(",")
_KINDS = {dict: "OBJECT", list: "ARRAY", str: "STRING", type(None): "VOID", bool: "BOOLEAN", _Raw: "NUMBER"}
_WORDS = {None: "null", True: "true", False: "false"}


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING or other, of a variant."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def _written_out(text: Column) -> Column:
    """A container's text as Spark's JSON functions write what lies in a document; one that other text follows stays as it is."""
    return F.coalesce(F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), 0), text)


def _parsed(text: str) -> object:
    """The first value of a text that Spark takes for JSON."""
    return _SCAN(text, _BLANKS.match(text).end())[0]


def _quoted(text: str) -> str:
    if text.isprintable():
        return encode_basestring(text)
    return f'"{_ESCAPED.sub(lambda c: _ESCAPES.get(c[0]) or f"\\u{ord(c[0]):04X}", text)}"'


def _text(value: object) -> str | None:
    """A value as Spark's JSON functions write it as a string: a string's text, other JSON without blanks, null for null."""
    if value is None or isinstance(value, str):
        return value
    out, open_ = [], [value]
    while open_:
        value = open_.pop()
        if type(value) is str:
            out.append(_quoted(value))
        elif type(value) is _Raw:
            out.append(value)
        elif type(value) is dict:
            parts = [x for k, v in value.items() for x in (_COMMA, _Raw(_quoted(k) + ":"), v)]
            open_ += [_Raw("}"), *parts[:0:-1], _Raw("{")]
        elif type(value) is list:
            parts = [x for v in value for x in (_COMMA, v)]
            open_ += [_Raw("]"), *parts[:0:-1], _Raw("[")]
        else:
            out.append(_WORDS[value])
    return "".join(out)


def _values(value: object) -> list[tuple]:
    """(name, value) of what is in a container, in order; no names in arrays."""
    return list(value.items()) if type(value) is dict else [(None, v) for v in value]


def _dereferenced(value: object, seen: tuple, nodes: dict | None) -> list[tuple]:
    """(value, seen) of what stands for a value: itself, or, of a reference, what its nodes hold, until that is no reference; a key on the
    way, or no node: nothing."""
    if nodes is None or type(value) is not str or not value.startswith("$"):
        return [(value, seen)]
    out, open_ = [], [(value, seen)]
    while open_:
        value, seen = open_.pop()
        key = value[1:]
        if key not in seen:
            for held in nodes.get(key, ()):
                (open_ if type(held) is str and held.startswith("$") else out).append((held, (*seen, key)))
    return out


def _strings(values: list) -> pa.Array:
    """As Spark writes strings: half of a pair of surrogates is a question mark."""
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        return pa.array([v and v.encode("utf-8", "replace").decode() for v in values], pa.string())


def _lists(sizes: list, values: pa.Array) -> pa.Array:
    ends = [0]
    for n in sizes:
        ends.append(ends[-1] + n)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _parts(column: pa.Array) -> list[list]:
    """For each row of an array of structs the tuples that it holds."""
    fields = [f.to_pylist() for f in column.values.flatten()]
    rows, ends = list(zip(*fields)), column.offsets.to_pylist()
    return [rows[a:b] for a, b in zip(ends, ends[1:])]


def node_table(documents: DataFrame, doc: str, json: str, packed: bool = False) -> DataFrame:
    """doc, key, json, kind: the named values of each document, which references mean; ``packed``: doc, nodes, a row per document, whose
    text holds them (null if it is no object)."""
    def checked(text: Column) -> Column:
        return F.when(_kind(F.try_parse_json(text)) == "OBJECT", _written_out(text))

    nodes = documents.select(F.col(doc).alias("doc"), _once(F.col(json), checked).alias("nodes"))
    if packed:
        return nodes
    schema = T.StructType([nodes.schema["doc"], *T.DataType.fromDDL("key string, json string, kind string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [_parsed(t) if t is not None else {} for t in batch.column("nodes").to_pylist()]
            flat, of = [v for values in cut for v in values.items()], pa.array([k for k, values in enumerate(cut) for _ in values], pa.int32())
            made = [_strings([k for k, _ in flat]), _strings([_text(v) for _, v in flat]), pa.array([_KINDS[type(v)] for _, v in flat], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(of), *made], schema.fieldNames())

    return nodes.mapInArrow(run, schema)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _by_document(rows: DataFrame, nodes: DataFrame | None, walk: Callable, made: Callable, schema: str) -> DataFrame:
    """doc and what ``made`` builds from the results of ``walk(the document's rows, its nodes by key, whether its doc is null)``, a list per document.

    ``nodes``: a ``node_table``, packed or not; no references without it.
    """
    columns, has_nodes = [c for c in rows.columns if c != "doc"], nodes is not None
    packed = has_nodes and "nodes" in nodes.columns
    own = rows.repartition("doc").withColumn("_apart", F.when(F.col("doc").isNull(), F.monotonically_increasing_id()))
    own = own.groupBy("doc", "_apart").agg(F.collect_list(F.struct(*columns)).alias("rows")).drop("_apart")
    if has_nodes:
        known = nodes.where("nodes IS NOT NULL") if packed else nodes
        known = known.groupBy("doc").agg(F.collect_list(F.struct(*[c for c in nodes.columns if c != "doc"])).alias("nodes"))
        own = own.join(known.hint("merge"), "doc", "left").withColumn("nodes", F.coalesce("nodes", F.array()))  # by sorting: never gathered in the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = batch.column("doc")
            apart, found, of = documents.is_null().to_pylist(), [], []
            nodes_of = _parts(batch.column("nodes")) if has_nodes else None
            for k, rows in enumerate(_parts(batch.column("rows"))):
                nodes = {} if has_nodes else None
                for held in dict.fromkeys(nodes_of[k]) if has_nodes else ():
                    if packed:
                        for key, value in _parsed(held[0]).items():
                            nodes.setdefault(key, []).append(value)
                    else:
                        key, text, kind = held
                        nodes.setdefault(key, []).append(text if kind == "STRING" or text is None else _parsed(text))
                results = walk(rows, nodes, apart[k])
                found += results
                of += [k] * len(results)
            yield pa.RecordBatch.from_arrays([documents.take(pa.array(of, pa.int32())), *made(found)], names)

    out = T.StructType([rows.schema["doc"], *T.DataType.fromDDL(schema).fields])
    names = out.fieldNames()
    return own.mapInArrow(run, out)


def find_attribute_lists(roots: DataFrame, nodes: DataFrame | None = None, name: str = ATTRIBUTE_ITEM) -> DataFrame:
    """Doc, json, seen of the first list that is not empty under ``name``, depth first, per document that has one.

    ``roots``: doc, json.  An object that has a list under the name is not searched further; one whose list is empty holds nothing.
    """
    rows = roots.select("doc", "json").where(_kind(F.try_parse_json("json")).isin("OBJECT", "ARRAY")).select("doc", _written_out(F.col("json")).alias("json"))

    def walk(texts: list, nodes: dict | None, apart: bool) -> list:
        first, rows = None, [((), _parsed(t), ()) for t, in dict.fromkeys(texts)]
        while rows:
            below, listed = [], set()
            for path, container, seen in rows:
                for place, (own, value) in enumerate(_values(container)):
                    for held, way in _dereferenced(value, seen, nodes):
                        if type(held) is not dict and type(held) is not list:
                            continue
                        at = (*path, place)
                        below.append((at, held, way))
                        if own == name and type(held) is list:
                            listed.add(path)
                            if held and (first is None or at <= first[0]):
                                found = (at, _text(held), way)
                                first = min(first or found, found)
            rows = [r for r in below if (apart or r[0][:-1] not in listed) and (first is None or r[0] <= first[0])]
        return [first] if first else []

    def made(found: list) -> list[pa.Array]:
        paths = pa.array([p for f in found for p in f[0]], pa.int32())
        seen = _strings([k for f in found for k in f[2]])
        return [_lists([len(f[0]) for f in found], paths), _strings([f[1] for f in found]), _lists([len(f[2]) for f in found], seen)]

    found = _by_document(rows, nodes, walk, made, "path array<int>, json string, seen array<string>")
    return found.groupBy("doc").agg(F.min(F.struct("path", "json", "seen")).alias("f")).select("doc", "f.json", "f.seen")


def attribute_items(lists: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """The items of each document's list for A6: doc, item_pos, groupName, attributes (displayName, value), references resolved."""
    def walk(lists: list, nodes: dict | None, apart: bool) -> list:
        items: dict = {}  # by item_pos: the group's names, and by place the members of its attributes
        for text, seen in lists:
            for pos, item in enumerate(_parsed(text)):
                for held, way in _dereferenced(item, tuple(seen), nodes):
                    if type(held) is dict:
                        names, attributes = items.setdefault(pos, ({}, {}))
                        if not apart:  # a null doc's parts do not find each other
                            fields(held, way, nodes, names, attributes)
        return [(pos, g, [attributes[k] for k in sorted(attributes)]) for pos, (names, attributes) in sorted(items.items()) for g in names or [None]]

    def fields(item: dict, seen: tuple, nodes: dict | None, names: dict, attributes: dict) -> None:
        for held, _ in _dereferenced(item.get("groupName"), seen, nodes):
            if type(held) is str:
                names[held] = True
        for held, way in _dereferenced(item.get("attributes"), seen, nodes):
            for k, attribute in enumerate(held if type(held) is list else ()):
                for members, on_the_way in _dereferenced(attribute, way, nodes):
                    for name, member in members.items() if type(members) is dict else ():
                        for value, _ in _dereferenced(member, on_the_way, nodes):
                            add(attributes, k, name, value)

    def add(attributes: dict, k: int, name: str, value: object) -> None:
        own = attributes.setdefault(k, [None, None])
        at = 0 if name == "displayName" and type(value) is str else 1 if name == "value" and value is not None else None
        if at is not None:
            own[at] = _text(value) if own[at] is None else max(own[at], _text(value))

    def made(found: list) -> list[pa.Array]:
        flat = [a for f in found for a in f[2]]
        attributes = pa.StructArray.from_arrays([_strings([a[k] for a in flat]) for k in (0, 1)], ["displayName", "value"])
        return [pa.array([f[0] for f in found], pa.int32()), _strings([f[1] for f in found]), _lists([len(f[2]) for f in found], attributes)]

    return written(_by_document(lists.select("doc", "json", "seen"), nodes, walk, made, f"item_pos int, groupName string, attributes {_ATTRIBUTES}"), "items")


@arrow_udf(T.StringType())
def _pushed(html: pa.Array) -> pa.Array:
    """The pushed payload's text as one object: its list under ``ROOT`` and what follows; null where nothing is pushed or it is no string."""
    return _strings([None if h is None else _whole(h) for h in html.to_pylist()])


def _whole(html: str) -> str | None:
    pushed = _PUSHED.search(html)
    end = html.find(_PUSHED_END, pushed.end()) if pushed else -1
    if end < 0:
        return None
    raw = html[pushed.end():end]
    if "\n" in raw or "\r" in raw or "\\n" in raw or "\\r" in raw:
        raw = re.sub(r"[\r\n]|\\[nr]", "", raw)
    if raw.count('"') != raw.count('\\"'):
        raw = re.sub(r'(?<!\\)"', r'\\"', raw)  # a quote that is not escaped, and a backslash that escapes nothing
    if raw.count("\\") != raw.count('\\"'):
        raw = re.sub(r'\\(?![\\/"bfnrtu])', r"\\\\", raw)
    if raw.isprintable() and raw.count("\\") == raw.count('\\"'):  # nothing else is escaped
        text = raw.replace('\\"', '"')
    else:
        try:
            text, _ = _SCAN(f'"{raw}"', 0)
        except ValueError:
            return None
    root = text.find("]") + 1
    rest = text[root:].lstrip(",") if root else ""
    return f'{{"{ROOT}":{text[:root]}{"," if rest else ""}{rest}}}' if raw else None


def payload(html: Column) -> Column:
    """The embedded payload of a page as one JSON object: its list under ``ROOT`` and the named nodes behind it; null where the page
    has none or it is no JSON."""
    whole = _pushed(html)
    return F.when(F.try_parse_json(whole).isNotNull(), whole)


def embedded_specifications(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Key and ``specs`` {group: {name: value}} of each page whose payload holds an attribute list: J8, A7 and A6 in a row."""
    documents = pages.select(F.col(key).alias("doc"), payload(F.col(html)).alias("json"))
    nodes = written(node_table(documents, "doc", "json", packed=True), "nodes")
    roots = nodes.select("doc", F.from_json("nodes", f"{ROOT} string")[ROOT].alias("json"))
    items = attribute_items(find_attribute_lists(roots, nodes), nodes)
    return group_specs(items, doc="doc").withColumnRenamed("doc", key)
