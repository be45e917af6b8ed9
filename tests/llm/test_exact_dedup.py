import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from star_marts.llm import exact_dedup
from star_marts.llm.exact_dedup import Directory


def by_definition(rows):
    groups = {}
    for at, (doc, text) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(body, []).append((-len(text or ""), doc is None, doc or 0, at))
    out = []
    for body, group in groups.items():
        first = min(group)
        keep = None if first[1] else first[2]
        for one in group:
            doc = None if one[1] else one[2]
            out.append((doc, keep, len(group), one == first, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\r\nc"), (4, "a  bc"), (5, None), (6, ""), (7, " \x0b\x0c "),
    (8, "a bc"), (9, "a bc"), (None, "abc"), (None, "abc"), (2, "abc"), (2, "abc"), (10, "x" * 300_000),
    (11, "x " * 300_000), (12, "A b c"), (13, "\U0001f600 a"), (14, "\U0001f600a "), (15, "a\x85bc"), (16, "a\x1cbc"),
]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "1 AS key", "2 AS row", "3 AS owner", "4 AS chars", "5 AS sha256")


def result(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_case(spark):
    assert result(exact_dedup.deduplicate(frame(spark, ROWS).repartition(3))) == by_definition(ROWS)


@pytest.mark.parametrize("bits", [1, 7])
def test_collisions_are_told_apart_by_bytes(spark, bits):
    rows = [(i, f"text {i % 300}" + " " * (i % 5)) for i in range(1200)]
    few = lambda text: F.xxhash64(text).bitwiseAND(F.lit((1 << bits) - 1))
    assert result(exact_dedup.deduplicate(frame(spark, rows), few)) == by_definition(rows)


def test_hot_copies_are_combined_in_salted_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_FEW_COPIES", 50)
    rows = [(None, "copy  of a page")] * 700 + [(i, "copy of a page") for i in range(300)] + [(i, f"own {i}") for i in range(900)]
    assert result(exact_dedup.deduplicate(frame(spark, rows).repartition(7))) == by_definition(rows)


def test_empty_table(spark):
    assert exact_dedup.deduplicate(frame(spark, [])).count() == 0


def test_added_documents(spark, tmp_path):
    first, second = frame(spark, ROWS[:9]), frame(spark, ROWS[9:])
    exact_dedup.build(first, str(tmp_path / "one"))
    index = exact_dedup.build(second, str(tmp_path / "two"), earlier=str(tmp_path / "one"))
    both = exact_dedup.assign(exact_dedup.members(frame(spark, ROWS)), index)
    assert result(both) == by_definition(ROWS)
    assert exact_dedup.stored_index(spark, str(tmp_path / "two")).count() == len({r[4] for r in by_definition(ROWS)})


def test_many_owners_and_the_directory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "OWNER_BYTES", 500)
    rows = [(i, f"text {i}") for i in range(400)]
    index = exact_dedup.build(frame(spark, rows), str(tmp_path / "index")).cache()
    assert index.select("owner").distinct().count() > 4
    assert index.filter("owner != shiftrightunsigned(key, 64 - 3)").count() == 0
    slots = exact_dedup.directory_of(index)
    assert slots.groupBy("owner", "slot").count().filter("count > 1").count() == 0
    found = index.withColumn("slot", F.expr("key & (shiftleft(1L, directory_depth) - 1)")).join(slots, ["owner", "slot", "bucket"])
    assert found.count() == 400


def test_splits_and_doubling():
    directory = Directory(bucket_keys=4)
    draw = random.Random(5)
    for key in range(1000):
        directory.add(draw.getrandbits(63), b"%d" % key, 1, key, 1)
    assert directory.depth >= 8 and len(directory.slots) == 1 << directory.depth
    buckets = list(directory.buckets())
    assert all(len(b.chains) <= 4 for b in buckets)
    assert sum(len(b.chains) for b in buckets) == 1000
    assert {b.depth for b in buckets} != {directory.depth}
    for slot, bucket in enumerate(directory.slots):
        assert slot & ((1 << bucket.depth) - 1) == bucket.prefix
        assert all(k & ((1 << bucket.depth) - 1) == bucket.prefix for k in bucket.chains)


def test_a_bucket_at_the_deepest_level_grows():
    directory = Directory(bucket_keys=2, most_depth=3)
    for key in range(50):
        directory.add(key << 10, b"%d" % key, 1, key, 1)
    assert directory.depth == 3 and len(directory.bucket(0).chains) == 50
    directory.add(5 << 10, b"other", 1, 99, 1)
    directory.add(5 << 10, b"5", 9, 98, 1)
    chain = directory.bucket(5 << 10).chains[5 << 10]
    assert [(e.text, e.chars, e.doc, e.copies) for e in chain] == [(b"5", 9, 98, 2), (b"other", 1, 99, 1)]
