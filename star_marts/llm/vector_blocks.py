"""Search a set of query vectors against all vectors, block by block.

Vectors are dealt to index blocks by a hash of their row, and queries to slices; every slice meets
every block of its dimension.  A task holds the vectors of one block, builds their index, and
answers the queries that stream by.  Each meeting gives the k best of that block per query; the
best of those are the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from star_marts.llm.common import spread_join
from star_marts.llm.meeting import GROUP, meet
from star_marts.session import stage

BLOCK_ROWS = 8192
SLICE_QUERIES = 8192  # that one task compares with a block
QUERY_ROWS = 256  # that are answered at once

Arrays = dict[str, np.ndarray]
Build = Callable[[np.ndarray, np.ndarray], Arrays]  # ids, vectors -> an index
Probe = Callable[[Arrays, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector.cast("array<double>"), good), F.lit(False))


def known_vectors(rows: DataFrame) -> DataFrame:
    """row, vec_id, vector (doubles) and dim of the rows with an id and finite components, stored."""
    known = rows.filter(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    return stage(
        known.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"), F.size("embedding").alias("dim"),
        ),
        "vectors",
    )


def _matrix(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, as they come."""
    ids, vectors = rows.column("vec_id").to_numpy(), rows.column("vector")
    whole = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), len(whole[0]))


def _distinct_runs(ids: np.ndarray) -> Iterator[np.ndarray]:
    """Places, in parts none of which has an id twice; usually one part."""
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], ids[order][1:] != ids[order][:-1]]))
    turn = np.arange(len(ids)) - np.repeat(starts, np.diff([*starts, len(ids)]))
    for t in range(int(turn.max()) + 1):
        yield order[turn == t]  # in the order of ids


def search(
    vectors: DataFrame, queries: DataFrame, k: int, build: Build, probe: Probe, score: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best vectors, ties to the smaller vec_id.

    Both frames are `known_vectors`.  A query meets vectors of its own length, but none with its id;
    rows that repeat an id count each, as vectors and as queries.  `probe(index, ids, vectors)`
    gives, for a block and queries of different ids, (query id, vec_id, score) with at least the k
    best per query; an id may be masked, and comes last of its score.  `score` is the type of
    scores.
    """
    asked = queries.groupBy("dim").agg(F.ceil(F.count("*") / SLICE_QUERIES).cast("int").alias("slices"))
    sizes = stage(
        vectors.groupBy("dim").agg(F.count("*").alias("n")).join(asked, "dim").select(
            "dim", "n", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"), "slices"
        ),
        "sizes",
    )
    name = lambda block, part: F.concat_ws("/", "dim", block.cast("string"), part.cast("string")).alias(GROUP)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = spread_join(vectors, sizes, ["dim"], "n", ["row"]).withColumn("_slice", every("slices"))
    block = F.pmod(F.xxhash64("row"), F.col("blocks"))
    index = dealt.select(name(block, F.col("_slice")), "vec_id", "vector")
    spread = spread_join(queries, sizes, ["dim"], "n", ["row"]).withColumn("_block", every("blocks"))
    part = F.pmod(F.xxhash64("row"), F.col("slices"))
    probes = spread.select(name(F.col("_block"), part), "row", "vec_id", "vector")
    groups = sizes.agg(F.sum(F.col("blocks") * F.col("slices"))).first()[0] or 0

    def made(rows: pa.Table) -> Arrays:
        ids, x = _matrix(rows)
        order = np.argsort(ids, kind="stable")
        return build(ids[order], x[order])

    def answer(block: Arrays, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.column("row").to_numpy()
        ids, x = _matrix(batch)
        for start in range(0, len(ids), QUERY_ROWS):
            piece = np.arange(start, min(start + QUERY_ROWS, len(ids)))
            for some in _distinct_runs(ids[piece]):
                at = piece[some]
                query, near, found = probe(block, ids[at], x[at])
                row = rows[at][np.searchsorted(ids[at], query)]
                columns = [pa.array(c) for c in (row, query, near, found)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "query_id", "vec_id", "score"])

    found = meet(index, probes, groups, made, answer, f"row long, query_id long, vec_id long, score {score}")
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]
