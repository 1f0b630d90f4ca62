"""Token counts by a finite-state transducer compiled from a BPE piece table.

A state holds what the future can depend on: the longest suffix of the text read so far that may still grow into a
piece, and for each position in it from
which a piece may still grow the last piece before it and the token count there.  A transition reads one
character and is annotated with the change of the token count; states and transitions are compiled when first
met and kept for the worker's life.  As the model's units merge on their own, the automaton returns to its start
state at every unit, so the transition over a whole unit from there is kept as well.

A text is cut into chunks of fixed length.  The map of a chunk takes any entry state to an exit state and a count:
up to the chunk's first synchronising point (a space after a non-space) the outcome depends on the entry state,
behind it no more, so the map is (head, count behind it, exit state).  Maps compose associatively; a parallel
prefix scan over a document's maps gives the entry state and the count before each chunk.

Defined results: null and empty texts have no tokens; the space mark U+2581 counts as a space, as in the library;
every row gives one row, an empty table an empty one; other columns are not read.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm import pieces
from shelfmatch.llm.common import per_row, resident, table
from shelfmatch.llm.pieces import SPACE, Pieces

CHUNK_CHARS = 65536
LIMIT = 4096
#: Units whose transition is kept; the table is dropped and filled anew beyond it.
KEPT_UNITS = 250_000
#: States kept likewise.
KEPT_STATES = 300_000

_SYNC = re.compile("[^ ] ")


class Transducer:
    def __init__(self, model: Pieces):
        self.model = model
        self.units: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        #: State -> (suffix, ((last piece, count relative to here) for each position in the suffix)).
        self.meaning: list[tuple] = [("", ((None, 0),))]
        self.number = {self.meaning[0]: 0}
        #: State -> character -> (state, change of the count).
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition of ``state`` over ``char``."""
        model = self.model
        c = SPACE if char == " " else char
        suffix, marks = self.meaning[state]
        if c not in model.id:
            to, change = self.meaning[0], len(c.encode())
        else:
            if c == SPACE and suffix.strip(SPACE):
                suffix, marks = "", ((None, 0),)
            text = suffix + c
            for i in range(len(text)):
                piece = text[i:]
                if marks[i] is None:
                    continue
                last, count = marks[i]
                if piece in model.id and (last is None or model.pair(last, piece)):
                    break
            change = count + 1
            marks = [m and (m[0], m[1] - change) for m in marks] + [(piece, 0)]
            # only positions from which a piece may still grow matter
            open_ = [text[i:] in model.prefixes for i in range(len(text))] + [True]
            start = open_.index(True)
            to = (text[start:], tuple(m if o else None for m, o in zip(marks[start:], open_[start:])))
        number = self.number.setdefault(to, len(self.meaning))
        if number == len(self.meaning):
            self.meaning.append(to)
            self.moves.append({})
        move = self.moves[state][char] = (number, change)
        return move

    def read(self, state: int, text: str) -> tuple[int, int]:
        """Exit state and count over ``text``."""
        count, moves = 0, self.moves
        for char in text:
            state, change = moves[state].get(char) or self.compile(state, char)
            count += change
        return state, count

    def unit(self, text: str) -> int:
        count = self.units.get(text)
        if count is None:
            if len(self.units) > KEPT_UNITS:
                self.units.clear()
            if len(text) > 64:  # long units are seldom met again
                return self.read(0, text)[1]
            count = self.units[text] = self.read(0, text)[1]
        return count

    def chunk_map(self, text: str) -> tuple:
        """(head, synchronised, count behind the head, exit state)."""
        sync = _SYNC.search(text)
        if not sync:
            return text, False, 0, 0
        units = self.model.units.findall(text, sync.start() + 1)
        known = self.units
        count = 0
        for u in units[:-1]:
            n = known.get(u)
            count += self.unit(u) if n is None else n
        state, last = self.read(0, units[-1])
        return text[:sync.start() + 1], True, count + last, state

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of the text of ``a`` followed by that of ``b``."""
        if not a[1]:
            return a[0] + b[0], b[1], b[2], b[3]
        state, count = self.read(a[3], b[0])
        return (a[0], True, a[2] + count + b[2], b[3]) if b[1] else (a[0], True, a[2] + count, state)

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """All prefixes of ``maps`` composed: neighbours are joined, their scan spread to the maps between."""
        if len(maps) < 2:
            return maps
        inner = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(inner[i // 2] if i % 2 else self.compose(inner[i // 2 - 1], maps[i]))
        return out

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if not text:
            return 0
        if len(self.meaning) > KEPT_STATES:
            self._reset()
        text = " " + text.replace(SPACE, " ")  # the dummy prefix
        whole = self.scan([self.chunk_map(text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)])[-1]
        return self.read(0, whole[0])[1] + whole[2]


def transducer(path: str) -> Transducer:
    """One transducer per Python worker and path."""
    return resident(("token counts", path), lambda: Transducer(Pieces(path)))


def counts(texts: list, path: str, chunk_chars: int = CHUNK_CHARS) -> list[tuple]:
    machine = transducer(path)
    return [(len((t or "").encode()), machine.count(t or "", chunk_chars)) for t in texts]


def token_counts(text: Column, path: str | None = None) -> Column:
    """Struct n_bytes, n_tokens of a text column."""
    return per_row(functools.partial(counts, path=path or pieces.default_path()), "n_bytes long, n_tokens long", text)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", token_counts(F.col("text")).alias("c")).select(
        "doc_id", "c.n_bytes", "c.n_tokens", (F.col("c.n_tokens") > LIMIT).alias("over_limit"))
