"""SimHash near-duplicates by a generalised pigeonhole over groups of correlated bits.

A text's fingerprint has the bits that more than half of its shingles' hashes have.  Equal
fingerprints are one class.  The 64 bits are split into groups; if group i gets a threshold T_i
and the T_i + 1 sum to the distance limit plus one, two fingerprints within the limit differ in
at most T_i bits of some group i.  Groups hold bits that are correlated, so they are not equally
selective, and dynamic programming gives larger thresholds to the more selective ones, for the
least estimated number of probes and candidates.  Fingerprints are probed by group and verified.

The plan is chosen from a bounded sample of fingerprints; it decides what the search costs, never
what it finds.

Defined cases: null and empty texts have no shingle and fingerprint zero; texts of fewer words
than a shingle are one shingle; long texts are read whole; repeated rows are in one class; a null
doc_id is never the smallest unless a component has no other; an empty table gives no rows; columns
other than doc_id and text are not read by `near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from star_marts.llm.common import spread_join, text_batches, whole_text, word_list
from star_marts.llm.components import components
from star_marts.session import stage

SHINGLE = 3
DISTANCE = 3
SEED = 42  # fixed value of the fingerprint's hash
SAMPLE = 2048  # fingerprints the plan is estimated from
CANDIDATE_COST = 20  # of verifying a candidate, in probes
CROWDED = 200  # fingerprints with one key, from which they are linked by a spanning forest
REFINED = 20_000  # rows with one key, from which the key is extended by further bits
_BATCH = 200_000  # hashes whose bits are counted at a time


def shingles(words: Sequence[bytes], width: int) -> list[bytes]:
    """Runs of `width` words, or all words if fewer, joined by blanks."""
    if not words:
        return []
    text = b" ".join(words)
    if len(words) <= width:
        return [text]
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[: -width])]
    return [text[a:b] for a, b in zip(starts, ends[width - 1 :], strict=True)]


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64 bits, as a signed number."""
    parts = shingles(word_list(text), width)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(parts), _BATCH):
        some = parts[i : i + _BATCH]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in some), np.uint64, len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > len(parts), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed 64 bits) and digest (a hash of the text) per row."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), width) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64()), batch.column(1)], ["doc_id", "fp", "digest"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("digest"),
        whole_text().cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, fp long, digest long")


@dataclass(frozen=True)
class Plan:
    masks: tuple[int, ...]  # bits of each group, signed
    limits: tuple[int, ...]  # threshold of each group; -1 leaves it out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bit_groups(bits: np.ndarray, groups: int) -> list[list[int]]:
    """Split 64 bit numbers into groups of about equal size whose bits are correlated."""
    centred = bits - bits.mean(axis=0)
    spread = np.sqrt((centred**2).sum(axis=0))
    spread[spread == 0] = 1
    alike = np.abs(centred.T @ centred / np.outer(spread, spread))
    np.fill_diagonal(alike, 0)
    left, out = list(range(64)), []
    for g in range(groups):
        size = len(left) // (groups - g)
        group = [max(left, key=lambda b: alike[b, left].max())]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: alike[b, group].mean())
            group.append(best)
            left.remove(best)
        out.append(group)
    return out


def _agreeing(bits: np.ndarray, fps: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0 .. most bits of the group."""
    mask = np.uint64(sum(1 << b for b in group))
    held = fps & mask
    seen = np.zeros(most + 1)
    for i in range(1, len(held)):
        differ = np.bitwise_count(held[i:] ^ held[:-i])
        seen += [(differ <= t).sum() for t in range(most + 1)]
    pairs = max(1, len(held) * (len(held) - 1) // 2)
    # A share too small for the sample comes from the bits as if they were independent.
    chance = np.array([1.0] + [0.0] * most)
    for b in group:
        p = bits[:, b].mean() if len(bits) else 0.5
        other = min(max(2 * p * (1 - p), 1e-3), 0.5)
        chance = chance * (1 - other) + np.concatenate([[0], chance[:-1]]) * other
    return list(np.maximum(seen / pairs, np.cumsum(chance)))


def choose_plan(fps: np.ndarray, total: int, distance: int = DISTANCE) -> Plan:
    """Bit groups and thresholds of least estimated cost for `total` fingerprints like `fps`."""
    fps = fps.view(np.uint64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    best: tuple[float, Plan] | None = None
    for count in range(2, distance + 2):
        groups = bit_groups(bits, count) if len(bits) else np.array_split(np.arange(64), count)
        groups = [list(map(int, g)) for g in groups]
        cost = []
        for group in groups:
            share = _agreeing(bits, fps, group, distance)
            row, probes = [0.0], 0
            for t in range(distance + 1):
                probes += comb(len(group), t)
                row.append(total * (probes + 1) + CANDIDATE_COST * share[t] * total * total / 2)
            cost.append(row)
        # units[u]: least cost, and thresholds, of the groups so far if their T_i + 1 sum to u.
        units: list[tuple[float, tuple[int, ...]] | None] = [(0.0, ())] + [None] * (distance + 1)
        for row in cost:
            following: list[tuple[float, tuple[int, ...]] | None] = [None] * (distance + 2)
            for used, state in enumerate(units):
                for u in range(distance + 2 - used) if state else ():
                    option = (state[0] + row[u], (*state[1], u - 1))
                    if following[used + u] is None or option < following[used + u]:
                        following[used + u] = option
            units = following
        price, limits = units[distance + 1]
        masks = tuple(_signed(sum(1 << b for b in g)) for g in groups)
        if best is None or price < best[0]:
            best = (price, Plan(masks, limits))
    return best[1]


def _flips(mask: int, most: int) -> list[int]:
    bits = [b for b in range(64) if mask >> b & 1]
    return [
        _signed(sum(1 << b for b in some)) for n in range(most + 1) for some in combinations(bits, n)
    ]


def _probes(classes: DataFrame, plan: Plan, probing: bool) -> DataFrame:
    """fp, part, key: the group's bits as they are, or with up to T_i of them flipped."""
    def keys(part: int, mask: int, most: int) -> Column:
        flips = F.array(*[F.lit(f).cast("long") for f in _flips(mask, most if probing else 0)])
        return F.transform(
            flips,
            lambda f: F.struct(
                F.lit(part).alias("part"),
                F.col("fp").bitwiseXOR(f).bitwiseAND(F.lit(mask).cast("long")).alias("key"),
            ),
        )

    used = enumerate(zip(plan.masks, plan.limits, strict=True))
    parts = [keys(i, mask, most) for i, (mask, most) in used if most >= 0]
    return classes.select("fp", F.inline(F.concat(*parts)))


def _differing(a: Column, b: Column, mask: int | None = None) -> Column:
    x = a.bitwiseXOR(b)
    return F.bit_count(x if mask is None else x.bitwiseAND(F.lit(mask).cast("long")))


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of all fingerprints within the distance; linear memory."""
    left = np.unique(fps.view(np.uint64))
    out: list[tuple[int, int]] = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(left ^ at) <= distance
            reached = left[near]
            out += [(int(at.view(np.int64)), int(x)) for x in reached.view(np.int64)]
            front += list(reached)
            left = left[~near]
    return out


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints `classes.fp` that connect all within the distance.

    Keys shared by at most `CROWDED` fingerprints give every link, once.  The fingerprints around
    a more crowded key are linked by a spanning forest, so that links stay in proportion to the
    rows; a key with more than `REFINED` rows is first extended by a quarter of the other bits,
    of which one quarter must be equal.
    """
    total = classes.count()
    sample = classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    plan = choose_plan(np.array([r.fp for r in sample], np.int64), total, distance)
    index = _probes(classes, plan, False)
    probes = _probes(classes, plan, True)
    sizes = stage(index.groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED), "crowded")
    earlier = F.lit(False)  # found by an earlier group already
    a, b = F.col("a.fp"), F.col("b.fp")
    for i, (mask, most) in enumerate(zip(plan.masks, plan.limits, strict=True)):
        if most >= 0:
            earlier = earlier | ((F.col("a.part") > i) & (_differing(a, b, mask) <= most))
    near = (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key")) & (a < b)
    near = near & (_differing(a, b) <= distance) & ~earlier
    if sizes.isEmpty():
        return probes.alias("a").join(index.alias("b"), near).select(a.alias("a"), b.alias("b"))

    # `earlier` would rely on a crowded key of an earlier group, whose forest connects the pair too.
    thin = index.join(sizes, ["part", "key"], "left_anti")
    found = probes.alias("a").join(thin.alias("b"), near).select(a.alias("a"), b.alias("b"))
    around = probes.join(sizes, ["part", "key"])
    rows = stage(around.groupBy("part", "key").agg(F.count("*").alias("rows")), "around")
    around = around.join(rows, ["part", "key"])
    narrower = []
    for i, mask in enumerate(plan.masks):
        others = [b for b in range(64) if not mask >> b & 1]
        for j, quarter in enumerate(np.array_split(others, distance + 1)):
            bits = _signed(sum(1 << int(b) for b in quarter))
            narrower.append(
                F.when(F.col("part") == i, F.struct(
                    F.lit(j).alias("sub"), F.col("fp").bitwiseAND(F.lit(bits).cast("long")).alias("more")
                ))
            )
    whole = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("more")))
    key = F.when(F.col("rows") > REFINED, F.filter(F.array(*narrower), lambda k: k.isNotNull())).otherwise(whole)
    grouped = around.select("fp", "part", "key", F.inline(key))

    def connect(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_forest(group["fp"].to_numpy(np.int64), distance), columns=["a", "b"], dtype="int64")

    dense = grouped.groupBy("part", "key", "sub", "more").applyInPandas(connect, "a long, b long")
    return found.unionByName(dense)


def _rooted(docs: DataFrame, width: int, distance: int) -> DataFrame:
    """Per document: doc_id, fp, component_id, digest of its text, and root, the least fingerprint
    of its component.  Components may share a component_id, never a root."""
    rows = stage(fingerprints(docs, width), "fingerprints")
    classes = stage(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "classes"
    )
    roots = stage(components(links(classes, distance)), "roots")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "copies", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(rooted.join(least, "root").select("fp", "copies", "root", "component_id"), "components")
    return spread_join(rows, named, ["fp"], "copies", ["doc_id", "digest"])


def near_duplicates(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id, and digest of its text."""
    return _rooted(docs, width, distance).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "digest"
    )


def one_of_each(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """`docs` with one row of each component: that of the smallest doc_id, with the smallest text
    digest if several rows have it."""
    known = _rooted(docs, width, distance)
    holders = known.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Components are told apart by their root: a repeated or missing doc_id can name several.
    kept = stage(
        holders.groupBy("root").agg(
            F.min("component_id").alias("_id"), F.min("digest").alias("_digest"), F.count("*").alias("_n")
        ),
        "kept",
    )
    same = F.col("row.doc_id").cast("long").eqNullSafe(kept["_id"])
    same = same & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == kept["_digest"])
    out = docs.select(F.struct("*").alias("row")).join(kept, same)
    if not kept.filter("_n > 1").isEmpty():
        out = out.dropDuplicates(["_id", "_digest"])
    return out.select("row.*")
