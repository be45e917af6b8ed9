import random

import numpy as np
import pytest
from brute_force import by_definition, groups_of
from pyspark.sql import functions as F

from star_marts.llm import simhash_dedup as m
from star_marts.llm.components import components


def near(rng, fp, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        fp ^= 1 << b
    return fp


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_documents(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    texts = base + base[:15] + [t + " w1" for t in base] + [t.upper() for t in base[:5]]
    texts += ["", None, " \n", "one", "one two", "One  two", "ein wort ist keins zwei"]
    rows = list(enumerate(texts, start=10)) + [(10, texts[0]), (None, "nobody has this text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS fp", "1 AS component_id", "2 AS _id")
    got = m.near_duplicates(docs).collect()
    fps = {(i, t): by_definition(t) for i, t in rows}
    reach = groups_of(fps.values())
    least = lambda fp: min((i for (i, _), f in fps.items() if f in reach[fp] and i is not None), default=None)
    want = sorted(str((i, f"{by_definition(t):016x}", least(by_definition(t)))) for i, t in rows)
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    kept = m.one_of_each(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted({str(least(f)) for f in fps.values()})
    assert m.one_of_each(docs).columns == docs.columns
    assert m.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_component_whatever_its_name(spark):
    unlike = [" ".join(f"{w}{i}" for i in range(30)) for w in "abcdefgh"]
    assert len({id(s) for s in groups_of(map(by_definition, unlike)).values()}) == len(unlike)
    rows = [(None, t, i) for i, t in enumerate(unlike[:4])] + [(None, unlike[0], 9)]
    # Doc 10 names two components, one of which has a row more, and one of them twice.
    rows += [(10, unlike[4], 0), (10, unlike[5], 1), (12, unlike[5], 2), (10, unlike[6], 3), (10, unlike[6], 4)]
    rows += [(13, None, 0), (13, "", 1), (14, unlike[4], 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumn("root", F.lit(0))
    kept = m.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(str((r.doc_id, r.text or "")) for r in kept.collect())
    want = [(None, t) for t in unlike[:4]] + [(10, t) for t in unlike[4:7]] + [(13, "")]
    assert got == sorted(map(str, want))


@pytest.mark.parametrize("crowded,refined", [(200, 20_000), (3, 20_000), (3, 10)])
def test_links_connect_all_within_the_distance(spark, monkeypatch, crowded, refined):
    monkeypatch.setattr(m, "CROWDED", crowded)
    monkeypatch.setattr(m, "REFINED", refined)
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(fps)[:40]:
        fps |= {near(rng, centre, 5) for _ in range(rng.choice([2, 2, 30]))}
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = m.links(frame).collect()
    pairs = {(a % 2**64, b % 2**64) for a, b in found}
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    roots = {r.node % 2**64: r.root for r in components(spark.createDataFrame(found, "a long, b long")).collect()}
    reach = groups_of(fps)
    for f in fps:
        for g in reach[f]:
            assert roots.get(f, signed(f)) == roots.get(g, signed(g))
    assert len({roots.get(f, signed(f)) for f in fps}) == len({id(s) for s in reach.values()})


def test_plan_is_exact_and_prefers_selective_groups():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 1000).astype(np.int64)
    fps &= ~np.int64(0xFFFFF)  # twenty bits that tell nothing
    for total in (100, 100_000, 10**9):
        plan = m.choose_plan(fps, total)
        assert sum(t + 1 for t in plan.limits) == 4
        whole = 0
        for mask in plan.masks:
            assert whole & (mask % 2**64) == 0
            whole |= mask % 2**64
        assert whole == 2**64 - 1


def test_long_chain(spark):
    rows = [(i + 1, i) for i in range(300)] + [(1000, 1001)]
    out = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert set(out.values()) == {0, 1000} and out[300] == 0 and out[1001] == 1000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
