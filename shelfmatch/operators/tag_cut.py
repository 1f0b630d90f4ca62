"""Tags of whole batches of pages, cut by position in their UTF-8 bytes.

``cut`` gives the places of the tags of ``elements.tag_rows`` as arrays.  On a page whose tags all end at their first ">" they follow from the
places of brackets and quotes; a page with any other tag (a bracket in a quoted value, quotes of both kinds or an odd number, a tag that
never ends) goes through the pattern itself.  Texts and attributes are taken only of the rows that are asked for.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfmatch.operators.extract import ENTITIES

#: Pages are cut in groups of so many bytes.
GROUP_BYTES = 4 << 20
_TAG = re.compile(rb"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>((?:[^<]++|<(?![a-zA-Z/]))*+)""")
_REFERENCE = re.compile(r"&#([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});")
_LETTER, _STOP = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_STOP[[*b" \t\n\x0b\f\r/>"]] = True
_LT, _GT, _SLASH, _DOUBLE, _SINGLE = b"<>/\"'"


@dataclass
class Tags:
    """The tags of some pages in order: page, pos, kind as in ``tag_rows``, tag (a place in ``names``), and places in ``data``."""

    data: np.ndarray
    page: np.ndarray
    pos: np.ndarray
    kind: np.ndarray
    tag: np.ndarray
    names: list
    name_end: np.ndarray
    end: np.ndarray
    text_end: np.ndarray

    def texts(self, rows: np.ndarray) -> pa.Array:
        return decoded(strings(self.data, self.end[rows] + 1, self.text_end[rows]))

    def attrs(self, rows: np.ndarray) -> pa.Array:
        return strings(self.data, self.name_end[rows], self.end[rows])


def groups(html: pa.Array) -> list[tuple[int, int]]:
    """First page and number of pages of each group."""
    lengths = pc.fill_null(pc.binary_length(html), 0).to_numpy()
    at = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // GROUP_BYTES, prepend=-1))
    return [(int(a), int(b - a)) for a, b in zip(at, [*at[1:], len(html)])]


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from each start to its end as strings."""
    offsets = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=offsets[1:])
    chars = data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(chars))


def _decode(text: str) -> str:
    """As ``extract.decode_entities``."""
    for ref in dict.fromkeys(_REFERENCE.findall(text)):
        code = int(ref[1:], 16) if ref[0] in "xX" else int(ref)
        if 1 <= code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
            text = text.replace(f"&#{ref};", chr(code))
    for entity, char in ENTITIES:
        text = text.replace(entity, char)
    return text


def decoded(texts: pa.Array) -> pa.Array:
    has = pc.fill_null(pc.match_substring(texts, "&"), False)
    if not pc.any(has).as_py():
        return texts
    return pc.replace_with_mask(texts, has, pa.array([_decode(t) for t in texts.filter(has).to_pylist()], pa.string()))


def value(attrs: pa.Array, name: str) -> pa.Array:
    """The value of an attribute, entities decoded; null where the tag lacks it."""
    pattern = rf"""(?is)(?:^|[\s\x0b]){name}[\s\x0b]*=[\s\x0b]*(?P<v>"[^"]*"|'[^']*'|[^\s\x0b"'>]+)"""
    found = pc.extract_regex(attrs, pattern).field(0) if len(attrs) else pa.array([], pa.string())
    found = pc.if_else(pc.fill_null(pc.equal(found, ""), True), None, found)
    quoted = pc.fill_null(pc.or_(pc.starts_with(found, '"'), pc.starts_with(found, "'")), False)
    return decoded(pc.if_else(quoted, pc.utf8_slice_codeunits(found, 1, -1), found))


def class_lists(values: pa.Array) -> pa.Array:
    return pc.split_pattern_regex(pc.fill_null(values, ""), r"[\s\x0b]+")


def _first_at(places: np.ndarray, start: np.ndarray, none: int) -> np.ndarray:
    """The first of the places at or behind each start."""
    return np.append(places, none)[np.searchsorted(places, start)]


def cut(html: pa.Array, void: tuple[str, ...]) -> Tags:
    """The tags of the pages (null: none)."""
    html = pc.fill_null(html, "")
    if html.offset:
        html = pa.concat_arrays([html])
    bounds = np.frombuffer(html.buffers()[1], dtype=np.int32)[: len(html) + 1].astype(np.int64) if len(html) else np.zeros(1, dtype=np.int64)
    size = int(bounds[-1])
    data = np.zeros(size + 3, dtype=np.uint8)
    if size:
        data[:size] = np.frombuffer(html.buffers()[2], dtype=np.uint8)[:size]

    at = np.flatnonzero(data == _LT)
    page = np.searchsorted(bounds, at, "right") - 1
    begins = (_LETTER[data[at + 1]] | (data[at + 1] == _SLASH)) & (at + 1 < bounds[page + 1])
    at, page = at[begins], page[begins]
    slash = data[at + 1] == _SLASH
    name_at = at + 1 + slash
    last = bounds[page + 1]
    following = np.append(at[1:], size)
    text_end = np.minimum(following, last)
    end = _first_at(np.flatnonzero(data == _GT), at, size)
    name_end = _first_at(np.flatnonzero(_STOP[data]), name_at, size)
    quotes = np.flatnonzero((data == _DOUBLE) | (data == _SINGLE))
    doubles = np.concatenate([[0], np.cumsum(data[quotes] == _DOUBLE)])
    a, b = np.searchsorted(quotes, at), np.searchsorted(quotes, np.maximum(end, at))
    own, double = b - a, doubles[b] - doubles[a]
    even = (own % 2 == 0) & ((double == 0) | (double == own)) & ((own == 0) | (np.append(quotes, size)[a] >= name_end))
    plain = (name_at < last) & _LETTER[data[name_at]] & (end < text_end) & even
    odd = np.unique(page[~plain])
    if len(odd):
        stay = ~np.isin(page, odd)
        found = [[x[stay] for x in (at, page, slash, name_at, name_end, end, text_end)]]
        for p in odd.tolist():
            base = int(bounds[p])
            spans = [(base + m.start(), p, m.end(1) > m.start(1), base + m.start(2), base + m.end(2), base + m.end(3), base + m.end(4))
                     for m in _TAG.finditer(data[base:int(bounds[p + 1])].tobytes())]
            if spans:
                found.append(list(np.array(spans, dtype=np.int64).T))
        at, page, slash, name_at, name_end, end, text_end = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at, kind="stable")
        page, slash, name_at, name_end, end, text_end = (x[order] for x in (page, slash.astype(bool), name_at, name_end, end, text_end))

    coded = strings(data, name_at, name_end).dictionary_encode()
    lower = [n.lower() for n in coded.dictionary.to_pylist()]
    names = list(dict.fromkeys(lower))
    code = {n: k for k, n in enumerate(names)}
    tag = np.array([code[n] for n in lower], dtype=np.int64)[coded.indices.to_numpy()] if len(lower) else np.zeros(0, dtype=np.int64)
    empty = np.array([n in void for n in names], dtype=bool)
    empty = (empty[tag] if len(names) else np.zeros(0, dtype=bool)) | ((end > name_end) & (data[end - 1] == _SLASH))
    first = np.flatnonzero(np.diff(page, prepend=-1))
    pos = np.arange(len(page)) - np.repeat(first, np.diff(np.append(first, len(page))))
    kind = np.where(slash, -1, np.where(empty, 0, 1)).astype(np.int64)
    return Tags(data, page, pos, kind, tag, names, name_end, end, text_end)
