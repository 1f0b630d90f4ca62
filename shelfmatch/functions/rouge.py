"""Text similarity scores as native column expressions.

ROUGE-L F1 between two texts: tokens are the lower-cased runs of [a-z0-9]
(everything else separates tokens), LCS is computed by a nested
``aggregate`` over the two token arrays (the classic dynamic-programming
row), and F1 = 2*LCS / (m + n), which is what precision/recall F-measure
reduces to.  Either side empty after stripping -> 0.0.  Stemming of tokens
longer than three letters, done by the scoring library the reference calls,
is not applied (documented difference).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType

from shelfmatch.functions.text import py_strip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rouge_tokens(c: Column | str) -> Column:
    """Token array of a text; null text -> empty array."""
    spaced = F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9]+", " ")
    return F.filter(F.split(spaced, " "), lambda t: t != "")


def _masks(b: list) -> dict:
    """For each token of ``b`` the places where it stands, as bits."""
    masks: dict = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | (1 << j)
    return masks


def _lcs_bits(a: list, masks: dict, n: int) -> int:
    """LCS length by the bit-parallel recurrence (one big-int step per token of ``a``), with the masks of the other text of n tokens."""
    v = full = (1 << n) - 1
    for x in a:
        u = v & masks.get(x, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _tokens(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all lists one behind the other, as numbers that are equal where tokens are."""
    both = pa.concat_arrays([a.flatten(), b.flatten()])
    if not pa.types.is_int64(both.type) or both.null_count:
        both = both.dictionary_encode(null_encoding="encode").indices
    both = both.to_numpy(zero_copy_only=False)
    n = len(a.flatten())
    return both[:n], both[n:]


def _padded(tokens: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of at most ``width`` tokens as rows of a matrix, and which of its places hold one."""
    held = np.arange(width) < length[:, None]
    return tokens[np.where(held, start[:, None] + np.arange(width), 0)], held


def _lcs_of_rows(a: tuple, b: tuple, n: np.ndarray) -> np.ndarray:
    """``_lcs_bits`` of all rows at once; the lists of ``b`` in rows of 8, 16, 32 or 64 places."""
    (ta, in_a), (tb, in_b) = a, b
    bits = np.dtype(f"<u{tb.shape[1] // 8}")
    v = full = np.full(len(n), 2**64 - 1, dtype=np.uint64) >> (64 - n).astype(np.uint64)
    for i in range(ta.shape[1]):
        same = (tb == ta[:, i, None]) & in_b & in_a[:, i, None]
        u = v & np.packbits(same, axis=1, bitorder="little").view(bits)[:, 0].astype(np.uint64)
        v = ((v + u) | (v - u)) & full
    return n - np.bitwise_count(v)


@arrow_udf(IntegerType())
def lcs_length(a: pa.Array, b: pa.Array) -> pa.Array:
    """Length of the longest common subsequence of two token arrays (Arrow batches).

    The dynamic programme as nested ``aggregate`` (``lcs_length_native``) is
    interpreted code and allocates an array per cell; this bit-parallel form
    takes a step per token of ``a`` for all pairs of a batch whose texts have at most 64 tokens,
    grouped by length; longer texts go one by one, an integer step per token.
    """
    ta, tb = _tokens(a, b)
    m, n = (pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
    return pa.array(lcs_of(ta, np.cumsum(m) - m, m, tb, np.cumsum(n) - n, n))


def lcs_of(ta: np.ndarray, at_a: np.ndarray, m: np.ndarray, tb: np.ndarray, at_b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``lcs_length`` of pairs of lists: those of ``m`` tokens from ``at_a`` in ``ta``, and of ``n`` from ``at_b`` in ``tb``."""
    out = np.zeros(len(m), dtype=np.int32)
    width = lambda k: np.maximum(2 ** np.ceil(np.log2(np.maximum(k, 1))).astype(np.int64), 8)
    group = np.where((m > 0) & (n > 0), np.where((m <= 64) & (n <= 64), width(m) * 1000 + width(n), -1), 0)
    for g in np.unique(group[group > 0]).tolist():
        rows = np.flatnonzero(group == g)
        for k in range(0, len(rows), 4096):
            some = rows[k:k + 4096]
            out[some] = _lcs_of_rows(_padded(ta, at_a[some], m[some], int(m[some].max())), _padded(tb, at_b[some], n[some], g % 1000), n[some])
    for r in np.flatnonzero(group < 0).tolist():
        y = tb[at_b[r]:at_b[r] + n[r]].tolist()
        out[r] = _lcs_bits(ta[at_a[r]:at_a[r] + m[r]].tolist(), _masks(y), len(y))
    return out


def lcs_length_native(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two string arrays, in SQL functions only.

    Both arrays are first bound to lambda variables (one ``transform`` over a
    one-element array), so an input given as an expression - e.g. the
    tokenizer - is evaluated once per row, not once per DP cell.
    """
    return F.get(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))),
                             lambda p: _lcs_bound(p["a"], p["b"])), 0)


def _lcs_bound(a: Column, b: Column) -> Column:
    n = F.size(b)
    first_row = F.array_repeat(F.lit(0), n + 1)

    def next_row(prev: Column, x: Column) -> Column:
        def cell(cur: Column, j: Column) -> Column:
            val = F.when(F.get(b, j - 1) == x, F.get(prev, j - 1) + 1).otherwise(
                F.greatest(F.get(prev, j), F.get(cur, j - 1)))
            return F.concat(cur, F.array(val))
        return F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0)), cell)

    last = F.aggregate(a, first_row, next_row)
    return F.when((F.size(a) == 0) | (n == 0), F.lit(0)).otherwise(F.get(last, n))


def f1_from_lcs(lcs: Column, m: Column, n: Column) -> Column:
    return F.when((m == 0) | (n == 0), F.lit(0.0)).otherwise(2.0 * lcs / (m + n))


def rouge_l_f1(reference: Column | str, response: Column | str) -> Column:
    """ROUGE-L F1 of two texts; empty or null either side -> 0.0."""
    r, s = _c(reference), _c(response)
    ta, tb = rouge_tokens(py_strip(r)), rouge_tokens(py_strip(s))
    score = f1_from_lcs(lcs_length(ta, tb), F.size(ta), F.size(tb))
    empty = r.isNull() | s.isNull() | (r == "") | (s == "")
    return F.when(empty, F.lit(0.0)).otherwise(score)


def string_score(t1: Column | str, t2: Column | str) -> Column:
    """R2: 1.0 when equal, else 0.0 (null compares unequal, as NaN does in pandas)."""
    return F.coalesce((_c(t1) == _c(t2)).cast("double"), F.lit(0.0))


def min_overlap(m: Column, t: float) -> Column:
    """Least LCS a text of m tokens needs with any partner for F1 >= t (at least 1)."""
    return F.greatest(F.lit(1), F.ceil(F.lit(t) * m / F.lit(2.0 - t) - F.lit(1e-9)).cast("int"))
