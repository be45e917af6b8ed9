"""Index rows and the rows that probe them meet group by group, as streams.

Both kinds are dealt by a group's name and sorted so that a group's index rows come first.  A task
holds the index rows of one group, whose number the caller bounds, and passes the probes by in
Arrow batches, however many there are.  A lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP, PROBE = "_group", "_probe"
_MOST_TASKS = 2000  # above that the session's own number of partitions counts


def meet(
    index: DataFrame, probes: DataFrame, groups: int, build: Callable[[pa.Table], Any],
    answer: Callable[[Any, pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """What `answer(build(index rows), some probes)` gives for every group.

    Both frames name a row's group in the column `_group`; `groups` is about how many there are.
    Columns that only one of them has are null for the other.  Probes of a group without index
    rows, and index rows without probes, give nothing.
    """
    both = index.withColumn(PROBE, F.lit(False)).unionByName(
        probes.withColumn(PROBE, F.lit(True)), allowMissingColumns=True
    )
    configured = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(configured, min(2 * groups, _MOST_TASKS))
    dealt = both.repartition(tasks, GROUP).sortWithinPartitions(GROUP, PROBE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, made = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = pc.run_end_encode(batch.column(GROUP))
            start = 0
            for name, end in zip(names.values.to_pylist(), names.run_ends.to_pylist(), strict=True):
                part, start = batch.slice(start, end - start), end
                if name != now:
                    now, rows, made = name, [], None
                first_probe = part.num_rows - (pc.sum(part.column(PROBE)).as_py() or 0)
                if first_probe:
                    rows.append(part.slice(0, first_probe))
                if first_probe < part.num_rows and rows:
                    if made is None:
                        made = build(pa.Table.from_batches(rows))
                    yield from answer(made, part.slice(first_probe))

    return dealt.mapInArrow(run, schema)
