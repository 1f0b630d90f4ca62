"""Blocked products of two vector tables.

Both sides are dealt into blocks of bounded size; each pair of blocks meets in one group, where a kernel sees two
matrices.  A row is sent to the blocks named in its ``partners``, so block pairs that cannot matter are left out
before the shuffle.  Nothing is collected or broadcast, and memory is bounded by two blocks and one tile of
scores, whatever the sizes of the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of vectors (as doubles) in a block; each row is sent once per block of the other side.
BLOCK_BYTES = 32 << 20
#: Scores that a kernel computes at once.
TILE = 1 << 21


def blocks_for(df: DataFrame, vec: str = "embedding") -> int:
    """Number of blocks for a table, from its measured size."""
    n, dims = df.agg(F.count("*"), F.max(F.size(vec))).first()
    return max(1, -(-n * max(dims or 1, 1) * 8 // BLOCK_BYTES))


def hash_block(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(17)), F.lit(n)).cast("int")


def block_pairs(left: DataFrame, right: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """``kernel(left ids, left matrix, right ids, right matrix)`` for every pair of blocks.

    Both sides are ``(id long, embedding array<double>, block int, partners array<int>)``; the kernel yields tuples
    of equally long arrays in the order of ``schema``.
    """
    def sent(df: DataFrame, side: int) -> DataFrame:
        other = F.explode("partners")
        first, second = ("block", "__o") if side == 0 else ("__o", "block")
        return df.select("id", "embedding", "block", other.alias("__o")).select(
            F.col(first).alias("first"), F.col(second).alias("second"), F.lit(side).alias("side"), "id", "embedding")

    both = sent(left, 0).unionByName(sent(right, 1)).repartition("first", "second").sortWithinPartitions("first", "second", "side", "id")
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for parts in _groups(batches):
            sides = [_matrix([b for s, b in parts if s == side]) for side in (0, 1)]
            if not all(len(ids) for ids, _ in sides):
                continue
            (ids_l, l), (ids_r, r) = sides
            if l.shape[1] != r.shape[1]:
                raise ValueError(f"dimension mismatch: {l.shape[1]} vs {r.shape[1]}")
            step = max(1, TILE // len(ids_r))
            for a in range(0, len(ids_l), step):
                for columns in kernel(ids_l[a:a + step], l[a:a + step], ids_r, r):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return both.mapInArrow(run, schema)


def _groups(batches):
    """The (side, batch) parts of each pair of blocks; a group may reach over batches."""
    now, parts = None, []
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2)])
        cuts = [0, *(np.nonzero((np.diff(keys) != 0).any(axis=0))[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key = tuple(keys[:2, a].tolist())
            if key != now:
                if parts:
                    yield parts
                now, parts = key, []
            parts.append((int(keys[2, a]), batch.slice(a, b - a)))
    if parts:
        yield parts


def _matrix(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    ids = np.concatenate([p.column(3).to_numpy(zero_copy_only=False) for p in parts])
    flat = np.concatenate([p.column(4).flatten().to_numpy(zero_copy_only=False) for p in parts])
    lengths = {n for p in parts for n in np.diff(p.column(4).offsets.to_numpy()).tolist()}
    if len(lengths) != 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
    return ids, flat.reshape(len(ids), lengths.pop())
