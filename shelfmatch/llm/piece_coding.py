"""SentencePiece encoding by suffix-array matching, and decoding.

The units of a batch of texts that were not met before are joined to one text and its suffix array is built by
doubling, up to the longest piece.  Binary search then finds, for all pieces at once and one character deeper per
round, the range of suffixes that start with the piece: each suffix in it is an occurrence, an edge from its start
to its end.  The edges are sorted by position (distance of the end
from the unit's start, end, longest first) and relaxed: an edge is taken if its start is
reached and the piece may stand after the last piece there (for a BPE model exactly one edge may end at each
position, see ``pieces``); following the taken edges back from a unit's end gives its ids.  Units are
separated by a character of no piece, so no edge leaves its unit.  Characters without a piece fall back to bytes.

Decoding joins the pieces' bytes, turns the space mark into a space and removes the dummy prefix.

Defined results: null and empty texts give no ids and decode to the empty text; a text that holds the space mark
itself decodes with a space in its place, as in the library; every row gives one row, an empty table an empty one; new columns get names that the
table does not have.
"""

from __future__ import annotations

import functools
import zlib
from array import array

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm import pieces
from shelfmatch.llm.common import fresh, per_row, prepare, resident, table
from shelfmatch.llm.pieces import SPACE, Pieces

#: Units whose ids are kept between batches, and characters of them; the table is dropped and filled anew beyond either.
KEPT_UNITS, KEPT_CHARS = 300_000, 8_000_000
#: Pairs of pieces kept likewise.
KEPT_PAIRS = 400_000
#: Texts whose units are held at once.
TEXTS = 400
#: Characters of unit text per suffix array.
INDEX_CHARS = 100_000
SEPARATOR = "\U0010ffff"


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``codes`` sorted by the ``depth`` or more characters from there on."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < depth:
        nxt = np.zeros_like(rank)
        nxt[:-have] = rank[have:] + 1
        rank = np.unique(rank * (len(codes) + 2) + nxt, return_inverse=True)[1]
        have *= 2
    return np.argsort(rank, kind="stable")


class Coder:
    def __init__(self, model: Pieces):
        self.model = model
        self.known: dict[str, bytes] = {}
        self.chars = 0  # of the units in it
        names = sorted(model.id)
        if any(SEPARATOR in n for n in names):
            raise ValueError("a piece holds the separator")
        self.piece_ids = np.array([model.id[n] for n in names])
        self.piece_len = np.array([len(n) for n in names])
        self.piece_codes = np.full((len(names), model.longest), -1, dtype=np.int64)
        for k, n in enumerate(names):
            self.piece_codes[k, :len(n)] = [ord(c) for c in n]
        #: Pairs of pieces looked at, sorted, with the answer; the last key is above all.
        self.pair_keys = np.array([np.iinfo(np.int64).max])
        self.pair_fits = np.array([False])
        back = [(t.replace(SPACE, " ")).encode() for t in model.text]
        for b, i in model.byte_id.items():
            back[i] = bytes([b])
        self.piece_bytes = back

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece number) of every occurrence of every piece."""
        order = suffix_array(codes, self.model.longest)
        low = np.zeros(len(self.piece_ids), dtype=np.int64)
        high = np.full(len(self.piece_ids), len(codes), dtype=np.int64)
        live = np.arange(len(low))
        ended = np.append(codes, -1)
        for depth in range(self.model.longest):
            live = live[(self.piece_len[live] > depth) & (high[live] > low[live])]
            if not len(live):
                break
            want = self.piece_codes[live, depth]
            first, last = low[live], high[live]
            for bound, side in ((low, 0), (high, 1)):
                a, b = first.copy(), last.copy()
                while (open_ := a < b).any():
                    mid = (a + b) // 2
                    at = ended[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, len(codes))]
                    right = open_ & (at < want + side)
                    a = np.where(right, mid + 1, a)
                    b = np.where(open_ & ~right, mid, b)
                bound[live] = a
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return order[low[which] + offset], which

    def may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """For each pair of piece ids whether the model keeps them apart; pairs seen before are looked up."""
        keys = before * len(self.model.text) + piece
        at = np.searchsorted(self.pair_keys, keys)
        new = np.unique(keys[self.pair_keys[at] != keys])
        if len(new):
            text = self.model.text
            first, second = np.divmod(new, len(text))
            fits = [self.model.merged(list(text[a] + text[b])) == [text[a], text[b]] for a, b in zip(first.tolist(), second.tolist())]
            if len(self.pair_keys) > KEPT_PAIRS:
                self.pair_keys, self.pair_fits = self.pair_keys[-1:], self.pair_fits[-1:]
                return self.may_follow(before, piece)
            where = np.searchsorted(self.pair_keys, new)
            self.pair_keys = np.insert(self.pair_keys, where, new)
            self.pair_fits = np.insert(self.pair_fits, where, fits)
            at = np.searchsorted(self.pair_keys, keys)
        return self.pair_fits[at]

    def relax(self, starts: np.ndarray, ends: np.ndarray, pieces_: np.ndarray, offsets: np.ndarray, size: int):
        """The id and the start of the edge that is taken to each position, -1 where none leads.

        All edges that end at the same distance from the start of their unit are relaxed together, longest first.
        """
        order = np.lexsort((starts, ends, offsets))
        starts, ends, pieces_, offsets = starts[order], ends[order], pieces_[order], offsets[order]
        first = np.nonzero(np.diff(ends, prepend=-1))[0]  # the longest edge to each end
        last_of = np.append(first[1:], len(ends))
        taken, came = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        rounds = np.nonzero(np.diff(offsets[first], prepend=-1))[0].tolist() + [len(first)]
        for a, b in zip(rounds, rounds[1:]):
            edge, stop = first[a:b], last_of[a:b]
            while len(edge):
                before = taken[starts[edge]]
                fits = before < 0
                rest = np.nonzero(~fits)[0]
                fits[rest] = self.may_follow(before[rest], pieces_[edge[rest]])
                good = edge[fits]
                taken[ends[good]], came[ends[good]] = pieces_[good], starts[good]
                edge, stop = edge[~fits] + 1, stop[~fits]
                edge, stop = edge[edge < stop], stop[edge < stop]
        return taken, came

    def encode_units(self, units: list[str]) -> None:
        """Ids of ``units``, as little-endian 32-bit integers, into ``known``."""
        self.chars += sum(map(len, units))
        text = SEPARATOR + "".join(u.replace(" ", SPACE) + SEPARATOR for u in units)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        starts, which = self.occurrences(codes)
        ends = starts + self.piece_len[which]
        sizes = np.array([len(u) + 1 for u in units])
        unit_starts = np.cumsum(sizes) - sizes + 1
        offsets = ends - unit_starts[np.searchsorted(unit_starts, starts, side="right") - 1]
        taken, came = (x.tolist() for x in self.relax(starts, ends, self.piece_ids[which], offsets, len(text) + 1))
        for u, begin in zip(units, unit_starts.tolist()):
            at, ids = begin + len(u), []
            while at > begin:
                if taken[at] >= 0:
                    ids.append(taken[at])
                    at = came[at]
                else:
                    at -= 1
                    ids += self.model.fallback(text[at])[::-1]
            self.known[u] = array("I", ids[::-1]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        return [ids for i in range(0, len(texts), TEXTS) for ids in self._encode(texts[i:i + TEXTS])]

    def _encode(self, texts: list[str]) -> list[bytes]:
        find = self.model.units.findall
        split = [find(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.known) > KEPT_UNITS or self.chars > KEPT_CHARS:
            self.known.clear()
            self.chars = 0
        some, size = [], 0
        for u in set().union(*split).difference(self.known):
            some.append(u)
            size += len(u) + 1
            if size > INDEX_CHARS:
                self.encode_units(some)
                some, size = [], 0
        if some:
            self.encode_units(some)
        get = self.known.__getitem__
        return [b"".join(map(get, units)) for units in split]

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.piece_bytes.__getitem__, array("I", ids)))
        return data.decode(errors="replace")[1:]


def coder(path: str) -> Coder:
    """One coder per Python worker and path."""
    return resident(("piece coding", path), lambda: Coder(Pieces(path)))


CODED = "ids binary, n_tokens long, ids_crc32 long, decoded string"


def coded(texts: list, path: str, want_ids: bool, want_text: bool) -> list[tuple]:
    c, out = coder(path), []
    texts = [t or "" for t in texts]
    for text, ids in zip(texts, c.encode(texts)):
        decoded = c.decode(ids)
        out.append((ids if want_ids else None, len(ids) // 4, zlib.crc32(ids), decoded if want_text else None, decoded == text))
    return out


def encoded(text: Column, path: str | None = None, ids: bool = True, decoded: bool = True) -> Column:
    """Struct ids (little-endian 32-bit), n_tokens, ids_crc32, decoded, round_trip of a text column."""
    return per_row(functools.partial(coded, path=path or pieces.default_path(), want_ids=ids, want_text=decoded),
                   CODED + ", round_trip boolean", text)


def tokenised(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The documents with ``token_ids`` (little-endian 32-bit ids), ``n_tokens`` and ``round_trip`` (whether they decode
    to the text); a name that exists gets a prefix `_`."""
    prepare(docs.sparkSession)
    name = fresh(docs, "coded")
    coded_ = docs.withColumn(name, encoded(F.col("text"), path, decoded=False))
    added = {fresh(docs, new): F.col(name)[old] for new, old in (("token_ids", "ids"), ("n_tokens", "n_tokens"), ("round_trip", "round_trip"))}
    return coded_.withColumns(added).drop(name)


def op9_piece_coding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded_ = encoded(F.col("text"), ids=False, decoded=False)
    return docs.select("doc_id", coded_.alias("c")).select("doc_id", "c.n_tokens", "c.ids_crc32", "c.round_trip")
