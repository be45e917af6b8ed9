"""Approximate nearest neighbours by inner product with vantage-point trees.

Each shard of the vectors has a tree.  A node splits its rows by their distance to a vantage point
at the median; a query goes to its side first, and to the other only if the boundary is nearer
than `factor` times the distance of its k-th best so far.  By the triangle inequality factor one
is exact; smaller factors pass over sides that are unlikely to hold a better row.

Inner products become distances by one more component: with M the largest norm of the shard, x
gets sqrt(M² - |x|²) and a query 0, so that the nearest row has the largest inner product.

Equal vectors are one row of the tree, which holds all their ids, so that copies are found together
and have one score.  Ties go to the smaller vec_id, in a shard as between shards: where a leaf's
products are too near the k-th best to tell, they are computed again, each in the same way.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part; rows that repeat a vec_id are all candidates, but of queries with another id, and are each
answered as queries; rows without vec_id take no part; queries meet vectors of their own length
only; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from star_marts.llm.vector_blocks import Arrays, best_of, known_vectors, search

K = 20
QUERY_EVERY = 20
FACTOR = 0.25  # measured recall in the README
LEAF = 256
_SEED = 11


def build(ids: np.ndarray, x: np.ndarray) -> Arrays:
    """Distinct vectors in tree order with the ids of each, and per node: rows, vantage point,
    radius, children (-1: a leaf)."""
    x = x + 0.0  # no negative zeros, so that equal vectors have equal bytes
    first: dict[bytes, int] = {}
    group = np.array([first.setdefault(row.tobytes(), len(first)) for row in x])
    x = x[np.unique(group, return_index=True)[1]]
    norms = np.einsum("ij,ij->i", x, x)
    most = norms.max()
    lifted = np.column_stack([x, np.sqrt(np.maximum(most - norms, 0))])
    rng = np.random.default_rng(_SEED)
    order = np.arange(len(x))
    spans, vantage, radius, children = [], [], [], []

    def grow(start: int, end: int) -> int:
        node = len(spans)
        spans.append((start, end))
        vantage.append(np.zeros(lifted.shape[1]))
        radius.append(0.0)
        children.append((-1, -1))
        if end - start > LEAF:
            rows = order[start:end]
            # Of a few rows the one that spreads the others most.
            tried = rng.choice(rows, 5, replace=False)
            spread = [np.linalg.norm(lifted[rows] - lifted[t], axis=1) for t in tried]
            far = max(spread, key=np.std)
            point = tried[[d is far for d in spread].index(True)]
            split = (end - start) // 2
            by_distance = np.argpartition(far, split)
            order[start:end] = rows[by_distance]
            vantage[node] = lifted[point]
            radius[node] = far[by_distance[split]]
            children[node] = (grow(start, start + split), grow(start + split, end))
        return node

    grow(0, len(x))
    place = np.argsort(order)[group]  # of each id's vector in tree order
    return {
        "ids": ids[np.lexsort((ids, place))], "ends": np.cumsum(np.bincount(place, minlength=len(x))),
        "x": x[order], "most": np.array(most), "spans": np.array(spans),
        "vantage": np.array(vantage), "radius": np.array(radius), "children": np.array(children),
    }


def probe(
    block: Arrays, ids: np.ndarray, q: np.ndarray, k: int = K, factor: float = FACTOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows found in a block for each query; a query's own id is passed over."""
    rows, row_ids, ends, spans = block["x"], block["ids"], block["ends"], block["spans"]
    vantage, radius, children = block["vantage"], block["radius"], block["children"]
    starts = np.append(0, ends[:-1])
    # Of a vector's ids the least, whether it is the only one, and the next one where it is not.
    least, single = row_ids[starts], row_ids[starts] == row_ids[ends - 1]
    repeats = int(np.unique(row_ids, return_counts=True)[1].max())
    beyond = [starts + np.minimum(r, ends - starts - 1) for r in range(1, repeats + 1)]
    next_ = row_ids[ends - 1].copy()
    for place in reversed(beyond):
        next_ = np.where(row_ids[place] != least, row_ids[place], next_)
    lengths = np.einsum("ij,ij->i", q, q) + float(block["most"])
    dims = q.shape[1]
    # What rounding can change in a product, and in a distance that is its root.
    blur = 8 * (dims + 1) * np.finfo(float).eps * lengths
    root = 2 * np.sqrt(blur)
    best = np.full((len(q), k), -np.inf)
    places = np.full((len(q), k), -1)

    def distance(product: np.ndarray, some: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(lengths[some] - 2 * product, 0))

    def least_other(at: np.ndarray, own: int) -> np.ndarray:
        """The smallest id of each vector that is not the query's own."""
        return np.where(least[at] == own, next_[at], least[at])

    def visit(node: int, some: np.ndarray) -> None:
        if not len(some):
            return
        left, right = children[node]
        if left < 0:
            start, end = spans[node]
            products = q[some] @ rows[start:end].T
            own = (least[start:end][None] == ids[some][:, None]) & single[start:end]
            products[own] = -np.inf
            all_products = np.concatenate([best[some], products], axis=1)
            all_places = np.concatenate(
                [places[some], np.broadcast_to(np.arange(start, end), products.shape)], axis=1
            )
            keep = np.argpartition(-all_products, k - 1, axis=1)[:, :k]
            best[some] = np.take_along_axis(all_products, keep, axis=1)
            places[some] = np.take_along_axis(all_places, keep, axis=1)
            kth = best[some].min(axis=1)
            near = all_products >= (kth - blur[some])[:, None]
            for i in np.flatnonzero(np.isfinite(kth) & (near.sum(axis=1) > k)):
                at, query = all_places[i][near[i]], some[i]
                scores = (rows[at] * q[query]).sum(axis=1)
                chosen = best_of(scores, least_other(at, ids[query]), k)
                best[query], places[query] = scores[chosen], at[chosen]
            return
        away = distance(q[some] @ vantage[node][:dims], some)
        inside = away < radius[node]
        visit(left, some[inside])
        visit(right, some[~inside])
        # The k-th best is known better now.  The margin is for rounding, so that one stays exact.
        kth = distance(best[some].min(axis=1), some)
        open_ = np.abs(away - radius[node]) <= factor * kth + root[some]
        visit(right, some[inside & open_])
        visit(left, some[~inside & open_])

    visit(0, np.arange(len(q)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(len(q)):
        at = places[i][(places[i] >= 0) & np.isfinite(best[i])]
        scores = (rows[at] * q[i]).sum(axis=1)
        # Of a vector's ids the k smallest; more by as many as may be the query's own.
        taken = [row_ids[starts[a] : min(ends[a], starts[a] + k + repeats)] for a in at]
        scores = np.repeat(scores, [len(t) for t in taken])
        found = np.concatenate([*taken, np.zeros(0, row_ids.dtype)])
        scores, found = scores[found != ids[i]], found[found != ids[i]]
        order = best_of(scores, found, k)
        out.append((np.full(len(order), ids[i]), found[order], scores[order]))
    return tuple(np.concatenate([o[c] for o in out]) for c in range(3))


def usable(rows: DataFrame) -> DataFrame:
    return known_vectors(rows.filter(F.exists(F.col("embedding").cast("array<double>"), lambda x: x != 0)))


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score for vectors and queries of (vec_id, embedding)."""

    def best(block: Arrays, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return probe(block, ids, x, k, factor)

    return search(usable(rows), usable(queries), k, build, best, "double")
