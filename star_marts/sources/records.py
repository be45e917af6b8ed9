"""CSV records whose quoted fields hold line breaks, read by many tasks.

Whether a line break ends a record depends on all quotes before it.  A line is therefore taken as
a step between two states, outside and inside a quoted field.  A first pass composes the steps of
every block of a file; a running composition over the blocks, a row each, gives the state that each
block starts in; a second pass then cuts every block into records on its own.  A record that
continues in the next block is joined from its pieces; nothing else moves.

A field that no quote closes ends with the file, without the file's last line break.  A field opens
with a quote right after a separator (and, with `trim`, blanks); a quote inside another
field is text; what follows a closing quote up to the separator belongs to the field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from star_marts.session import stage

_MOST_STATES = 1_000_000  # blocks that start inside a field, as one broadcast table
_BLOCK = "file string, block long, kind string, first boolean, value string"

_QUOTED = r'[^"]*+(?:""[^"]*+)*+'  # the inside of a quoted field, and it goes on


def _patterns(trim: bool) -> tuple[str, str]:
    """Lines that end inside a quoted field, when they start outside and when they start inside."""
    blank = r"[\x00-\x20]*+" if trim else ""
    field = rf'{blank}(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|(?=,))'
    opened = rf'(?:{field},)*+{blank}"{_QUOTED}'
    return rf"^{opened}$", rf'^{_QUOTED}(?:"[^,]*+,{opened})?$'


def _steps(a: np.ndarray, b: np.ndarray, start: bool) -> tuple[np.ndarray, np.ndarray]:
    """State before and after each line; a and b are the state after it, from outside and inside."""
    fixed, flips = a == b, a & ~b
    at = np.arange(len(a))
    last = np.maximum.accumulate(np.where(fixed, at, -1))
    turns = np.cumsum(flips)
    since = turns - np.where(last >= 0, turns[np.maximum(last, 0)], 0)
    after = np.where(last >= 0, a[np.maximum(last, 0)], start) ^ (since % 2 == 1)
    return np.concatenate([[start], after[:-1]]).astype(bool), after.astype(bool)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Stretches of one block."""
    files = batch.column("file").to_numpy(zero_copy_only=False)
    blocks = batch.column("block").to_numpy()
    edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        yield (files[low], int(blocks[low])), batch.slice(low, high - low)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the state it ends in, from outside and from inside."""
    now, ends = None, (False, True)

    def given() -> pa.RecordBatch:
        columns = [pa.array([x]) for x in (*now, *ends)]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "out", "in"])

    for batch in batches:
        if not batch.num_rows:
            continue
        for key, part in _runs(batch):
            if key != now:
                if now is not None:
                    yield given()
                now, ends = key, (False, True)
            a, b = (part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            ends = tuple(bool(_steps(a, b, s)[1][-1]) for s in ends)
    if now is not None:
        yield given()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block; `head` and `tail` are pieces of those that cross its ends."""
    now, inside, held, kind, first = None, False, [], "record", False

    def rows(found: list[tuple[str, bool, str]]) -> pa.RecordBatch:
        kinds, firsts, values = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]] * len(found)), pa.array([now[1]] * len(found)), pa.array(kinds), pa.array(firsts),
             pa.array(values, pa.string())],
            ["file", "block", "kind", "first", "value"],
        )

    def rest() -> list[tuple[str, bool, str]]:
        """What the block ends with.  A head that did not end goes on: it is the block's only piece."""
        return [("through" if kind == "head" else "tail", first, "\n".join(held))] if held else []

    for batch in batches:
        if not batch.num_rows:
            continue
        for key, part in _runs(batch):
            if key != now:
                if now is not None and (found := rest()):
                    yield rows(found)
                now, held = key, []
                inside = bool(part.column("inside")[0].as_py())
                kind, first = ("head", False) if inside else ("record", key[1] == 0)
            a, b = (part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            before, after = _steps(a, b, inside)
            inside = bool(after[-1])
            found = []
            for value, goes_on in zip(part.column("value").to_pylist(), after.tolist(), strict=True):
                held.append(value)
                if not goes_on:
                    found.append((kind, first, "\n".join(held)))
                    held, kind, first = [], "record", False
            if found:
                yield rows(found)
    if now is not None and (found := rest()):
        yield rows(found)


def csv_records(spark: SparkSession, paths: str | list[str], *, header: bool = True, trim: bool = False) -> DataFrame:
    """file and value of every record, in no order; empty lines are none, headers are left out."""
    from_outside, from_inside = _patterns(trim)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    ).withColumns({"a": F.col("value").rlike(from_outside), "b": F.col("value").rlike(from_inside)})

    blocks = lines.select("file", "block", "a", "b").mapInArrow(
        _compose, "file string, block long, out boolean, `in` boolean"
    )
    in_order = Window.partitionBy("file").orderBy("block")
    fixed = F.col("out") == F.col("in")
    since = Window.partitionBy("file", "_run").orderBy("block")
    turned = F.sum((F.col("out") & ~F.col("in")).cast("int")).over(since)
    base = F.coalesce(F.first(F.when(fixed, F.col("out").cast("int"))).over(since), F.lit(0))
    ends = stage(
        blocks.withColumn("_run", F.sum(fixed.cast("int")).over(in_order)).select(
            "file", "block", (((base + turned) % 2) == 1).alias("after")
        ),
        "block-ends",
    )
    states = ends.select("file", "block", F.lag("after", 1, False).over(in_order).alias("inside")).filter("inside")

    small = ends.count() <= _MOST_STATES
    known = lines.join(F.broadcast(states) if small else states, ["file", "block"], "left")
    ordered = known if small else known.sortWithinPartitions("file", "block", "at")
    pieces = stage(
        ordered.select("file", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "a", "b", "value").mapInArrow(_cut, _BLOCK),
        "records",
    )
    whole = pieces.filter("kind = 'record'").select("file", "first", "value")
    # A tail opens a record, the pieces up to the next tail belong to it.
    place = F.when(F.col("kind") == "tail", 1).otherwise(0)
    crossing = pieces.filter("kind != 'record'").withColumn(
        "_record", F.sum(place).over(Window.partitionBy("file").orderBy("block", place))
    )
    joined = crossing.groupBy("file", "_record").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", place.alias("p"), "value"))), lambda s: s["value"]), "\n").alias("value"),
    ).select("file", "first", "value")
    every = whole.unionByName(joined).filter((F.col("value") != "") & (F.col("value") != "\r"))
    kept = every.filter(~F.col("first")) if header else every
    # A file whose lines end with a carriage return has such breaks inside its fields too.
    windows = F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), "\r$", "")
    return kept.select("file", F.when(F.endswith("value", F.lit("\r")), windows).otherwise(F.col("value")).alias("value"))
