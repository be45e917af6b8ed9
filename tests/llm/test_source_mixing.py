import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from star_marts.llm import source_mixing as m
from star_marts.session import stage


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(size_of):
    """Shares by weight; what a capped source cannot take is shared again until nothing is above."""
    order = sorted(size_of, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, free, target = Fraction(sum(size_of.values())), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 3 * size_of[s]}
        if not above:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: Fraction(3 * size_of[s]) for s in above}
        left -= sum(target[s] for s in above)
        free -= above
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "c", "é", "", None, "tiny", "hot", "hot", "hot", "hot", "hot"])
        if source == "tiny" and i > 60:
            source = "hot"
        out.append((i, "w\x0bw " * rng.choice([0, 1, 9, 40]), source))
    return out + [(7, "again and again", "a"), (7, "again and again", "a"), (None, None, "b"), (500, "long " * 20_000, "c")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS size", "2 AS rank", "3 AS shard", "4 AS picks", "length(text) AS n_chars"
    )


@pytest.mark.parametrize("shard_words", [m.SHARD_WORDS, 500])
def test_targets_are_met(spark, docs, rows, shard_words):
    picked = m.block_picks(stage(m.sizes(docs), "t"), shard_words=shard_words).collect()
    size_of = defaultdict(int)
    for _, t, s in rows:
        size_of[s] += words(t)
    target, taken = plain_targets(size_of), defaultdict(int)
    assert len(picked) == len(rows)
    for r in picked:
        own = sum((p.end - p.start) * p.times for p in r.picks)
        taken[r.source] += own
        assert own <= 3 * r.size and r.source_size == size_of[r.source]
        assert r.target == pytest.approx(float(target[r.source]))
        covered = [i for p in r.picks for i in range(p.start, p.end)]
        assert covered == list(range(r.size))
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(20, 0.02 * t)


def test_reruns_agree(docs):
    key = lambda df: sorted(map(str, df.collect()))
    assert key(m.mix(docs)) == key(m.mix(docs.repartition(7)))


@pytest.mark.parametrize("seed", range(4))
def test_apportionment_takes_the_highest_quotients(spark, seed):
    rng = random.Random(seed)
    groups = {g: [rng.choice([1, 1, 2, 5, 50, 700]) for _ in range(rng.randint(1, 40))] for g in range(6)}
    seats = {g: rng.randint(0, 3 * sum(w)) for g, w in groups.items()}
    frame = spark.createDataFrame(
        [(g, i, w, 3 * w, seats[g]) for g, ws in groups.items() for i, w in enumerate(ws)],
        "g int, i int, w long, most long, seats long",
    )
    got = {(r.g, r.i): r.quota for r in m.apportion(frame, ["g"], F.col("seats"), "w", "most", "i").collect()}
    for g, ws in groups.items():
        ranked = sorted((-w / (2 * k - 1), i) for i, w in enumerate(ws) for k in range(1, 3 * w + 1))
        want = [0] * len(ws)
        for _, i in ranked[: seats[g]]:
            want[i] += 1
        assert [got[g, i] for i in range(len(ws))] == want


def test_mixed_documents_hold_what_is_taken(docs, rows):
    taken, found = defaultdict(int), defaultdict(int)
    for r in m.mix(docs).collect():
        taken[r.doc_id] += r.taken
    out = m.mixed_documents(docs)
    assert out.columns == docs.columns
    mixed = out.collect()
    for r in mixed:
        found[r.doc_id] += words(r.text)
        assert r.n_chars == len(r.text)
    assert found == {i: n for i, n in taken.items() if n}
    assert sum(r.doc_id == 7 for r in mixed) <= 2  # equal rows come back as one


def test_empty(docs):
    assert m.mix(docs.limit(0)).count() == 0
    blank = m.mix(docs.filter("doc_id IS NULL")).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)]


def test_rows_without_id_and_equal_rows_are_dealt_evenly(spark):
    """Neither a missing id nor one row repeated fills a shard; all rows are there."""
    many = spark.range(200_000).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("hot").alias("source"),
        F.when(F.col("id") % 2 == 0, F.lit("the same words")).otherwise(F.concat(F.lit("text "), "id")).alias("text"),
    )
    sized = stage(m.sizes(many), "t")
    assert sized.count() == 200_000 == sized.distinct().count()
    shards = [r["count"] for r in sized.groupBy(m.shard_of(F.lit(8))).count().collect()]
    assert len(shards) == 8 and max(shards) < 1.05 * 25_000
    same = [r["count"] for r in sized.filter("size = 3").groupBy(m.shard_of(F.lit(8))).count().collect()]
    assert len(same) == 8 and max(same) < 1.05 * 12_500
    picked = m.block_picks(sized, shard_words=1 << 16)
    taken = F.aggregate("picks", F.lit(0).cast("long"), lambda n, p: n + (p["end"] - p["start"]) * p["times"])
    r = picked.agg(F.count("*").alias("n"), F.sum(taken).alias("taken"), F.max("target").alias("target")).first()
    assert r.n == 200_000 and r.taken == pytest.approx(r.target, rel=0.01)
