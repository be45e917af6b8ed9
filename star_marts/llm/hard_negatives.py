"""Hard negatives for contrastive training, by exact scores from subset-sum tables.

Components are quantised to floor(256 x).  In a block of candidates, a bit plane holds one bit of
every component, less the least value of its attribute; the bits of eight attributes are one byte.
For an anchor, a table of 256 sums per group of eight dimensions holds what each such byte adds.
A full score is the planes' lookups, from the highest bit downward, doubled and added, plus the
anchor's product with the least values.  Nothing is estimated, so no score is computed twice.

Rows are dealt to blocks by label first.  An anchor's positives are searched in the blocks of its
own label only; its negatives in all blocks, where rows of its label are passed over.  Either way a
block sends its few best per anchor (and positive), and the best of those are the answer.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part;
rows without vec_id do, as the last among ties, and are no anchors; of repeated vec_ids every row
counts, and passes over itself only; anchors meet vectors of their own length; empty vectors score
zero; an empty table gives no rows; other columns are not read.  A score is a long; a positive score
or a negative one of a returned row that exceeds it is an error.  Components of any finite size are
exact: where sums may pass a long, Python's integers stand in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from star_marts.llm.common import spread_join
from star_marts.llm.meeting import GROUP, meet
from star_marts.llm.vector_blocks import finite
from star_marts.session import stage

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # per cent of the positive's score that a negative has
ANCHOR_EVERY = 50
MOVED_EVERY, LABELS = 7, 10  # fixed values of the label rule
SCALE = 256  # fixed value of the quantisation
BLOCK_ROWS = 8192
SLICE_ANCHORS = 8192  # that one task compares with a block
_ANCHORS_AT_ONCE = 256
_TILE = 256  # candidates whose sums stay in the cache
_SMALL = 1 << 31  # quantised components from here on are scored apart
TOO_LARGE = "a score exceeds a long"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


# --- scores --------------------------------------------------------------------------------


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as longs, or as integers of any size where one does not fit."""
    if not x.size or np.abs(x).max() < _SMALL / SCALE:
        return np.floor(x * SCALE).astype(np.int64)
    # From 2^53 on doubles are whole, and 256 times the largest is no double.
    whole = np.frompyfunc(lambda v: int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE), 1, 1)
    return whole(x).astype(object)


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of each attribute, and bytes [plane, group, row] of what is above it."""
    rows, dims = values.shape
    low = values.min(axis=0)
    above = values - low
    bits = max(1, int(above.max()).bit_length()) if dims else 0
    planes = np.empty((bits, -(-dims // 8), rows), np.uint8)
    for b in range(bits):
        ones = (above >> b & 1).astype(np.uint8)
        planes[b] = np.packbits(ones, axis=1, bitorder="little").T
    return low, planes


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, byte, anchor]: the sum of the components that the byte's bits select."""
    count, dims = anchors.shape
    tables = np.zeros((-(-dims // 8), 256, count), anchors.dtype)
    for d in range(dims):
        bit = 1 << d % 8
        tables[d // 8, bit : 2 * bit] = tables[d // 8, :bit] + anchors[:, d]
    return tables


def scores(low: np.ndarray, planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """[candidate, anchor]: full inner products, shifted and added from lookups."""
    bits, groups, rows = planes.shape
    count = len(anchors)
    if not groups:
        return np.zeros((rows, count), np.int64)
    most = max(1, abs(int(anchors.min())), abs(int(anchors.max())))
    least = max(abs(int(low.min())), abs(int(low.max())))
    bound = anchors.shape[1] * most * ((1 << bits) + least)
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 62 else object
    a = anchors.astype(kind)
    tables = subset_sums(a)
    out = np.empty((rows, count), object if kind is object else np.int64)
    shift = (a * low.astype(kind)).sum(axis=1)
    for start in range(0, rows, _TILE):
        end = min(start + _TILE, rows)
        total = np.zeros((end - start, count), kind)
        for b in range(bits - 1, -1, -1):
            total += total
            for g in range(groups):
                total += tables[g].take(planes[b, g, start:end], axis=0)
        out[start:end] = total + shift
    return out


class Candidates:
    """Index rows of a block, ready to be scored: the usual ones, and those with large components."""

    def __init__(self, table: pa.Table):
        dims = len(table["vector"][0])
        flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(table.num_rows, dims)
        label = table["label"].to_numpy()
        large = (np.abs(x) >= _SMALL / SCALE).any(axis=1)
        order = np.lexsort((label, large))
        self.row, self.label = table["row"].to_numpy()[order], label[order]
        self.missing = np.asarray(table["vec_id"].is_null())[order]
        self.id = table["vec_id"].fill_null(_MOST).to_numpy()[order]
        self.parts = []  # each (first, last, low, planes)
        usual = int((~large).sum())
        for start, end in ((0, usual), (usual, len(order))):
            if end > start:
                self.parts.append((start, end, *bit_planes(quantised(x[order[start:end]]))))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        found = [scores(low, planes, anchors) for _, _, low, planes in self.parts]
        return found[0] if len(found) == 1 else np.concatenate([f.astype(object) for f in found])

    def of_label(self, label: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places, low and planes of the rows of a label."""
        out = []
        for start, end, low, planes in self.parts:
            first = np.searchsorted(self.label[start:end], label, "left")
            last = np.searchsorted(self.label[start:end], label, "right")
            if last > first:
                out.append((np.arange(start + first, start + last), low, planes[:, :, first:last]))
        return out

    def best(self, found: np.ndarray, chosen: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Of `chosen`, with scores `found`, the k that come first; row i is at place `at[i]`."""
        if len(chosen) > 4 * k:
            least = np.partition(found, len(found) - k)[len(found) - k]
            some = np.flatnonzero(found >= least)
            found, chosen = found[some], chosen[some]
        places = at[chosen]
        if found.dtype == object:
            key = lambda i: (-found[i], self.missing[places[i]], self.id[places[i]])
            return chosen[sorted(range(len(chosen)), key=key)[:k]]
        return chosen[np.lexsort((self.id[places], self.missing[places], -found))[:k]]

    def ids(self, at: np.ndarray) -> pa.Array:
        return pa.array(self.id[at], pa.int64(), mask=self.missing[at])


def _matrix(batch: pa.RecordBatch, start: int, end: int) -> np.ndarray:
    vectors = batch.column("vector").slice(start, end - start)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return quantised(flat.reshape(end - start, len(vectors[0])))


def _long(score: int) -> int:
    if score > _MOST:
        raise OverflowError(TOO_LARGE)
    return int(score)


def _positives(block: Candidates, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """anchor, positive_id and score of the first rows of the anchor's label in the block.

    A positive with a score below zero has no negatives, and those above it come first: it is left out.
    """
    rows, labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
    for start in range(0, len(rows), _ANCHORS_AT_ONCE):
        end = min(start + _ANCHORS_AT_ONCE, len(rows))
        x = _matrix(batch, start, end)
        anchors, places, found = [], [], []
        for label in np.unique(labels[start:end]):
            some = np.flatnonzero(labels[start:end] == label)
            parts = block.of_label(int(label))
            if not parts:
                continue
            at = np.concatenate([p for p, _, _ in parts])
            each = [scores(low, planes, x[some]) for _, low, planes in parts]
            every = each[0] if len(each) == 1 else np.concatenate([e.astype(object) for e in each])
            for j, i in enumerate(some):
                other = np.flatnonzero(block.row[at] != rows[start + i])
                column = every[other, j]
                for p in block.best(column, other, at, POSITIVES).tolist():
                    if every[p, j] >= 0:
                        anchors.append(rows[start + i])
                        places.append(at[p])
                        found.append(_long(every[p, j]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), block.ids(np.array(places, np.intp)), pa.array(found, pa.int64())],
            ["row", "positive_id", "positive_score"],
        )


def _negatives(block: Candidates, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """anchor, positive score, negative_id and score of the first rows of other labels in the window."""
    rows, labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
    wanted = batch.column("wanted").to_pylist()
    for start in range(0, len(rows), _ANCHORS_AT_ONCE):
        end = min(start + _ANCHORS_AT_ONCE, len(rows))
        every = block.scores(_matrix(batch, start, end)).T
        all_places = np.arange(len(block.label))
        anchors, positive, places, found = [], [], [], []
        for j, i in enumerate(range(start, end)):
            other = np.flatnonzero(block.label != labels[i])
            column = every[j][other]
            for score in wanted[i]:
                # LOW * score <= 100 * s <= HIGH * score, for whole s and score >= 0.
                inside = np.flatnonzero((column >= -(-LOW * score // 100)) & (column <= HIGH * score // 100))
                for p in block.best(column[inside], other[inside], all_places, NEGATIVES).tolist():
                    anchors.append(rows[i])
                    positive.append(score)
                    places.append(p)
                    found.append(int(every[j][p]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), pa.array(positive, pa.int64()), block.ids(np.array(places, np.intp)),
             pa.array(found, pa.int64())],
            ["row", "positive_score", "negative_id", "negative_score"],
        )


# --- blocks and the search --------------------------------------------------------------------


def participants(rows: DataFrame) -> DataFrame:
    """row, vec_id, label, vector, dim and anchor (whether it is one) of all rows that take part."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(vec_id % MOVED_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    known = rows.filter(F.col("label").isNotNull() & finite(F.col("embedding")))
    return stage(
        known.select(
            F.monotonically_increasing_id().alias("row"), vec_id.alias("vec_id"), moved.alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"), F.size("embedding").alias("dim"),
            F.coalesce(vec_id % ANCHOR_EVERY == 0, F.lit(False)).alias("anchor"),
        ),
        "participants",
    )


def placed(rows: DataFrame) -> DataFrame:
    """Rows with `first` and `blocks` of their label's bucket, `block`, and `all_blocks` of their
    length.

    A bucket is a hash of labels, with a block for every BLOCK_ROWS of its rows.
    """
    buckets = max(1, -(-rows.count() // BLOCK_ROWS))
    named = rows.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int"))
    by_length = Window.partitionBy("dim")  # a row per bucket
    sizes = named.groupBy("dim", "bucket").agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("_anchors")
    ).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).select(
        "dim", "bucket", "n", "blocks",
        (F.sum("blocks").over(by_length.orderBy("bucket")) - F.col("blocks")).cast("int").alias("first"),
        F.sum("blocks").over(by_length).cast("int").alias("all_blocks"),
        F.ceil(F.col("_anchors") / SLICE_ANCHORS).cast("int").alias("own_slices"),
        F.ceil(F.sum("_anchors").over(by_length) / SLICE_ANCHORS).cast("int").alias("all_slices"),
    )
    found = spread_join(named, stage(sizes, "buckets"), ["dim", "bucket"], "n", ["row"])
    block = F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    return stage(found.withColumn("block", block).drop("bucket", "n"), "placed")


def _group(block: str, slice_: Column) -> Column:
    return F.concat_ws("/", "dim", block, slice_.cast("string"))


def _every(count: str, first: Column | None = None) -> Column:
    """As many numbers from `first` on as `count` says, nothing for zero."""
    first = F.lit(0) if first is None else first
    end = first + F.col(count)
    return F.explode(F.filter(F.sequence(first, end), lambda i: i < end))


def _index(rows: DataFrame, slices: str) -> DataFrame:
    return rows.withColumn("_slice", _every(slices)).select(
        _group("block", F.col("_slice")).alias(GROUP), "row", "vec_id", "label", "vector"
    )


def _sliced(slices: str) -> Column:
    return F.pmod(F.xxhash64("row", F.lit("slice")), F.col(slices))


def mine(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has vec_id, embedding and label.
    """
    everyone = placed(participants(rows))
    anchors = everyone.filter("anchor")
    blocks = everyone.agg(F.countDistinct("dim", "block")).first()[0]

    own = anchors.withColumn("_block", _every("blocks", F.col("first"))).select(
        _group("_block", _sliced("own_slices")).alias(GROUP), "row", "label", "vector"
    )
    near = meet(
        _index(everyone, "own_slices"), own, blocks, Candidates, _positives,
        "row long, positive_id long, positive_score long",
    )
    best = Window.partitionBy("row").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last())
    positives = stage(
        near.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= POSITIVES).drop("_place"),
        "positives",
    )

    wanted = positives.groupBy("row").agg(F.collect_set("positive_score").alias("wanted"))  # at most POSITIVES
    asked = stage(anchors.join(wanted, "row"), "asked")
    everywhere = asked.withColumn("_block", _every("all_blocks")).select(
        _group("_block", _sliced("all_slices")).alias(GROUP), "row", "label", "vector", "wanted"
    )
    hard = meet(
        _index(everyone, "all_slices"), everywhere, blocks, Candidates, _negatives,
        "row long, positive_score long, negative_id long, negative_score long",
    )
    first = Window.partitionBy("row", "positive_score").orderBy(
        F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last()
    )
    chosen = hard.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= NEGATIVES)
    named = positives.join(asked.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.join(chosen, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    coalesce(list_dot_product(a.e::DOUBLE[], c.e::DOUBLE[]), 0)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.r, place ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank
  FROM p JOIN s ON p.r = s.r AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
  WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
