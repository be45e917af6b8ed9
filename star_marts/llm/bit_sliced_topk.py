"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to floor(256 x).  In a block of rows, bit s of attribute d of all rows is
one bitmap.  A query's score is a sum of attributes times integers, so it is a sum of bitmaps of
weight 2^(s+b) for each set bit b of the query's components, which full adders over whole bitmaps
reduce to the bit slices of the score.  For a negative component the complement of the attribute
is added, which shifts all scores of the block alike.  Bitmaps of the least weights are left out
of the sum; what they can add at most is known.  The k-th score is read from the most significant
slice downward, every row that may still reach it is kept, and these rows are resolved exactly.

Vectors with a component of 131,072 or more either way stay out of the bitmaps, which they would
make many: they are candidates of every query, and as queries they meet every row.  Scores are
computed as longs where no sum can exceed one, else as integers of any size.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; empty
vectors score zero with each other; a score among the k best that exceeds a long is an error; rows
that repeat a vec_id are all candidates, but of queries with another id, and are each answered as
queries; rows without vec_id take no part; queries meet vectors of their own length only; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from star_marts.llm.vector_blocks import Arrays, best_of, known_vectors, search

K = 5
SCALE = 256  # fixed value of the quantisation
LARGEST = 1 << 25  # of a quantised component in the bitmaps
QUERY_EVERY = 50
TOO_LARGE = "a score exceeds a long"
_LEFT_OUT = 6  # weights 2^0 .. 2^5 are not summed


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as longs, or as integers of any size if one does not fit."""
    if not x.size or np.abs(x).max() < 2.0**62 / SCALE:
        return np.floor(x * SCALE).astype(np.int64)
    # From 2^53 on doubles are whole, and 256 times the largest is no double.
    whole = np.frompyfunc(lambda v: int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE), 1, 1)
    return whole(x).astype(object)


def products(values: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Scores of rows, exactly."""
    if not values.size:
        return np.zeros(len(values), np.int64)
    if len(vector) * int(np.abs(values).max()) * int(np.abs(vector).max()) < 1 << 63:
        return values.astype(np.int64) @ vector.astype(np.int64)
    return values.astype(object) @ vector.astype(object)


def build(ids: np.ndarray, x: np.ndarray) -> Arrays:
    """Slices [attribute and its complement, bit, word] of the attributes above their least value,
    and apart from them the rows that are too large, as they are."""
    small = (np.abs(x) < LARGEST // SCALE).all(axis=1) & (x.shape[1] > 0)
    large_ids, large = ids[~small], x[~small]
    ids, values = ids[small], quantised(x[small])
    if not len(ids):
        return {"ids": ids, "values": values, "slices": np.empty((2, x.shape[1], 1, 0), np.uint64),
                "large_ids": large_ids, "large": large}
    low = values.min(axis=0)
    above = values - low
    bits = max(1, int(above.max()).bit_length())
    rows, dims = above.shape
    padded = np.zeros((-(-rows // 64) * 64, dims), np.int64)
    padded[:rows] = above
    slices = np.empty((2, dims, bits, len(padded) // 64), np.uint64)
    for b in range(bits):
        set_rows = np.ascontiguousarray((padded.T >> b & 1).astype(np.uint8))
        slices[0, :, b] = np.packbits(set_rows, axis=1, bitorder="little").view(np.uint64)
    slices[1] = ~slices[0]
    return {"ids": ids, "values": values, "slices": slices, "large_ids": large_ids, "large": large}


def add_columns(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Bit slices of a sum, from `columns[w]`, the bitmaps of weight 2^w, by full adders."""
    out, w = [], 0
    while w < len(columns):
        maps = columns[w]
        carried: list[np.ndarray] = []
        while len(maps) > 1:
            if len(maps) == 2:
                a, b = maps
                carried.append((a & b)[None])
                maps = (a ^ b)[None]
                break
            n = len(maps) // 3
            a, b, c = maps[:n], maps[n : 2 * n], maps[2 * n : 3 * n]
            half = a ^ b
            carried.append((a & b) | (half & c))
            maps = np.concatenate([half ^ c, maps[3 * n :]])
        out.append(maps[0] if len(maps) else None)
        if carried:
            if w + 1 == len(columns):
                columns.append(np.empty((0, carried[0].shape[1]), np.uint64))
            columns[w + 1] = np.concatenate([columns[w + 1], *carried])
        w += 1
    return out


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def candidates(slices: list[np.ndarray], rows: np.ndarray, k: int, slack: int) -> np.ndarray:
    """Bitmap of the rows whose sum is at least the k-th highest sum less `slack`."""
    kth, wanted, tied = 0, k, rows
    for w in range(len(slices) - 1, -1, -1):
        higher = tied & slices[w]
        n = _count(higher)
        if n >= wanted:
            kth, tied = kth | 1 << w, higher
        else:
            wanted -= n
            tied = tied & ~slices[w]
    least = max(0, kth - slack)
    above, equal = np.zeros_like(rows), rows
    for w in range(len(slices) - 1, -1, -1):
        if least >> w & 1:
            equal = equal & slices[w]
        else:
            above |= equal & slices[w]
            equal = equal & ~slices[w]
    return above | equal


def _reaching(block: Arrays, rows: np.ndarray, vector: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows in the bitmaps that may be among the k best besides the query's own."""
    slices, count = block["slices"], len(block["ids"])
    bits, words = slices.shape[2], slices.shape[3]
    size, side = np.abs(vector), (vector < 0).astype(np.intp)
    set_bits = max(1, int(size.max()).bit_length())
    columns, slack = [], 0
    chosen = [np.flatnonzero(size >> b & 1) for b in range(set_bits)]
    for w in range(bits + set_bits - 1):
        parts = [(b, w - b) for b in range(set_bits) if 0 <= w - b < bits]
        if w < _LEFT_OUT:
            slack += sum(len(chosen[b]) for b, _ in parts) << w
            continue
        maps = [slices[side[chosen[b]], chosen[b], s] for b, s in parts]
        columns.append(np.concatenate(maps) if maps else np.empty((0, words), np.uint64))
    empty = np.zeros(words, np.uint64)
    sums = [empty if s is None else s for s in add_columns(columns)]
    # Sums count in units of 2^_LEFT_OUT; more rows are asked for, by as many as may be the query's own.
    repeats = int(np.unique(block["ids"], return_counts=True)[1].max())
    kept = candidates(sums, rows, min(k + repeats, count), -(-slack >> _LEFT_OUT) + 1)
    return np.flatnonzero(np.unpackbits(kept.view(np.uint8), bitorder="little"))


def probe(block: Arrays, ids: np.ndarray, x: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of a block for each query, exactly; a query's own id is passed over.

    Of a score below all longs the id is masked: whether it is among the k best of all blocks is
    not known here.  One above all longs is, or others above all longs are.
    """
    values, block_ids, large_ids = block["values"], block["ids"], block["large_ids"]
    count, words = len(block_ids), block["slices"].shape[3]
    rows = np.packbits(np.arange(words * 64) < count, bitorder="little").view(np.uint64)
    large = quantised(block["large"])
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    for i, q in enumerate(ids):
        vector = quantised(x[i])
        if count and np.abs(x[i]).max(initial=0) < LARGEST // SCALE:
            at = _reaching(block, rows, vector, k)
        else:
            at = np.arange(count)
        near, scores = block_ids[at], products(values[at], vector)
        if len(large_ids):
            near = np.concatenate([near, large_ids])
            scores = np.concatenate([scores, products(large, vector)])
        near, scores = near[near != q], scores[near != q]
        best = _best(scores, near, k)
        out.append((int(q), near[best], scores[best]))
    scores = np.concatenate([s for _, _, s in out])
    below = np.zeros(len(scores), bool)
    if scores.dtype == object:
        if (scores >= 1 << 63).any():
            raise OverflowError(TOO_LARGE)
        below = (scores < -(1 << 63)).astype(bool)
        scores[below] = -(1 << 63)
        scores = scores.astype(np.int64)
    found = np.concatenate([i for _, i, _ in out])
    return (
        np.concatenate([np.full(len(i), q, np.int64) for q, i, _ in out]),
        np.ma.masked_array(found, below) if below.any() else found, scores,
    )


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """`best_of`, for integers of any size too."""
    if scores.dtype != object:
        return best_of(scores, ids, k)
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.intp)


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for vectors and queries of (vec_id, embedding)."""

    def best(block: Arrays, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return probe(block, ids, x, k)

    found = search(known_vectors(rows), known_vectors(queries), k, build, best, "long")
    too_small = F.raise_error(F.lit(TOO_LARGE)).cast("long")
    return found.withColumn("vec_id", F.coalesce("vec_id", too_small))


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, coalesce(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
