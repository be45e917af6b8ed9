import math

import numpy as np
import pytest

from star_marts.llm import bit_sliced_topk, vantage_points
from star_marts.llm.bit_sliced_topk import add_columns


def table(seed, n, dims, scale=1.0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(v) for v in x]) for i, x in enumerate(rng.normal(0, scale, (n, dims)))]
    rows += [(n + i, rows[i][1]) for i in range(8)]  # ties
    return rows


ODD = [
    (900, None), (901, [1.0, None, 0.0, 0.0]), (902, [math.nan, 0.0, 0.0, 0.0]), (903, [math.inf, 0.0, 0.0, 0.0]),
    (904, []), (905, [1.0, 2.0]), (910, [3.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (3, [-9.0, 0.0, 0.0, 0.0]),
    (3, [-9.0, 0.0, 0.0, 0.0]), (911, []), (917, []), (7, [2.0, 1.0, 0.0, 0.5]), (7, [2.0, 1.0, 0.0, 0.5]), (7, [-1.0, 2.0, 2.0, 0.5]),
]


def expected(rows, queries, k, score, usable):
    """Rows that repeat an id count each, but not for queries of their id."""
    known = [
        (i, x) for i, x in rows
        if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x) and usable(x)
    ]
    out = []
    for q, vector in known:
        if q in queries:
            near = [(-score(vector, x), i) for i, x in known if i != q and len(x) == len(vector)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS dim", "2 AS block", "3 AS score"
    )


@pytest.mark.parametrize("scale", [0.2, 90.0])
def test_top_k_is_exact(spark, monkeypatch, scale):
    rows = table(1, 150, 4, scale) + ODD
    docs = frame(spark, rows)
    got = bit_sliced_topk.top_k(docs, docs.filter("vec_id % 7 = 0"), 5).collect()
    whole = lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))
    ids = [i for i, _ in rows if i is not None and i % 7 == 0]
    assert sorted(tuple(r) for r in got) == expected(rows, ids, 5, whole, lambda x: True)


def test_too_large_components_for_the_bitmaps_take_part(spark):
    docs = frame(spark, [(0, [1e6]), (1, [1.0]), (2, [2.0])])
    large = 256 * 10**6
    assert [tuple(r) for r in bit_sliced_topk.top_k(docs, docs).orderBy("query_id", "rank").collect()] == [
        (0, 1, 2, large * 512), (0, 2, 1, large * 256), (1, 1, 0, 256 * large), (1, 2, 2, 256 * 512),
        (2, 1, 0, 512 * large), (2, 2, 1, 512 * 256),
    ]


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    docs = frame(spark, [(0, [1.0]), (1, [2.0]), (1, [5.0]), (1, [2.0]), (2, [1.0])])
    asked = docs.filter("vec_id = 0")
    assert [tuple(r) for r in bit_sliced_topk.top_k(docs, asked).orderBy("rank").collect()] == [
        (0, 1, 1, 256 * 1280), (0, 2, 1, 256 * 512), (0, 3, 1, 256 * 512), (0, 4, 2, 256 * 256)
    ]
    assert [tuple(r) for r in vantage_points.nearest(docs, asked).orderBy("rank").collect()] == [
        (0, 1, 1, 5.0), (0, 2, 1, 2.0), (0, 3, 1, 2.0), (0, 4, 2, 1.0)
    ]


@pytest.mark.parametrize("copies", [3, 60])
def test_copies_under_repeated_ids(copies):
    """A group of equal vectors in which the query's own id occurs many times."""
    rng = np.random.default_rng(12)
    x = np.concatenate([np.repeat(rng.normal(size=(1, 4)), 2 * copies, axis=0), rng.normal(size=(700, 4))])
    ids = np.concatenate([np.repeat(5, copies), np.arange(copies) % 9 + 3, np.arange(100, 800)])
    order = np.argsort(ids, kind="stable")
    block = vantage_points.build(ids[order], x[order])
    for q, vector in ((5, x[0]), (3, x[0]), (150, x[2 * copies + 50])):
        _, found, scores = vantage_points.probe(block, np.array([q]), vector[None], factor=1.0)
        other = ids != q
        products = (x[other] * vector).sum(axis=1)
        best = np.lexsort((ids[other], -products))[: vantage_points.K]
        assert list(found) == list(ids[other][best])
        assert np.allclose(scores, products[best])


def test_large_components_take_part(spark):
    rng = np.random.default_rng(9)
    rows = table(5, 120, 4, 90.0) + [(1000 + i, [float(v) for v in x]) for i, x in enumerate(rng.normal(0, 3e5, (30, 4)))]
    rows += [(2000, [1e6, -1.0, 0.5, 0.0]), (2002, [131_072.0] * 4), (2009, [-3e6, 1.0, 3e6, 7.0])]
    # Beyond a long alone, and in what is left out of the k best.
    rows += [(3001, [-1e30, 0.0, 0.0, 0.0]), (3002, [0.0, 1e300, 0.0, 0.0])]
    whole = lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))
    known = [r for r in rows if r[0] < 3000]
    docs = frame(spark, known)
    got = bit_sliced_topk.top_k(docs, docs.filter("vec_id % 7 = 0"), 5).collect()
    ids = [i for i, _ in known if i % 7 == 0]
    assert sorted(tuple(r) for r in got) == expected(known, ids, 5, whole, lambda x: True)
    down = (3501, [1.0, -1.0, 0.0, 0.0])
    got = bit_sliced_topk.top_k(frame(spark, [*rows, down]), frame(spark, [down]), 5).collect()
    assert sorted(tuple(r) for r in got) == expected([*rows, down], [3501], 5, whole, lambda x: True)
    with pytest.raises(Exception, match="exceeds a long"):
        up = (3502, [0.0, 1.0, 0.0, 0.0])
        bit_sliced_topk.top_k(frame(spark, [*rows, up]), frame(spark, [up]), 5).collect()
    with pytest.raises(Exception, match="exceeds a long"):
        few = frame(spark, [(3001, [-1e30]), (1, [1.0])])
        bit_sliced_topk.top_k(few, few, 5).collect()


def test_adders():
    rng = np.random.default_rng(2)
    maps = [rng.integers(0, 2**63, (n, 3)).astype(np.uint64) for n in (9, 1, 0, 14)]
    bit = lambda m: np.unpackbits(np.ascontiguousarray(m).view(np.uint8), bitorder="little").astype(np.int64)
    want = sum(bit(row) << w for w, m in enumerate(maps) for row in m)
    got = sum(bit(s) << w for w, s in enumerate(add_columns(list(maps))) if s is not None)
    assert (want == got).all()


def test_factor_one_is_exact(spark, monkeypatch):
    monkeypatch.setattr(vantage_points, "LEAF", 16)
    rows = table(3, 400, 4) + ODD + [(906, [0.0, 0.0, 0.0, 0.0])]
    docs = frame(spark, rows)
    got = vantage_points.nearest(docs, docs.filter("vec_id % 7 = 0"), 6, factor=1.0).collect()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    ids = [i for i, _ in rows if i is not None and i % 7 == 0]
    want = expected(rows, ids, 6, dot, any)
    assert len(got) == len(want)
    for a, b in zip(sorted(tuple(r) for r in got), want, strict=True):
        assert a[:2] == b[:2] and a[3] == pytest.approx(b[3], abs=1e-12)
        assert a[2] == b[2] or abs(a[3] - b[3]) < 1e-12


def test_ties_go_to_the_smaller_id():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 16))
    x[rng.permutation(3000)[:900]] = x[0]  # a group of copies, larger than a leaf
    x[rng.permutation(3000)[:300]] = x[1]
    ids = rng.permutation(10_000)[:3000]
    for some in (np.arange(100), np.flatnonzero((x == x[0]).all(axis=1))[:50]):
        q, found, _ = vantage_points.probe(vantage_points.build(ids, x), ids[some], x[some], factor=1.0)
        for i in some:
            scores = (x * x[i]).sum(axis=1)
            order = np.lexsort((ids, -scores))
            want = [j for j in ids[order] if j != ids[i]][: vantage_points.K]
            assert list(found[q == ids[i]]) == want
    # Vectors that differ, but have equal products with the query.
    sides = np.column_stack([np.full(3000, 0.5), rng.normal(size=3000)])
    _, found, _ = vantage_points.probe(
        vantage_points.build(ids, sides), np.array([-1]), np.array([[1.0, 0.0]]), factor=1.0
    )
    assert list(found) == sorted(ids)[: vantage_points.K]


def test_copies_are_found_with_the_production_factor():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(8192, 64))
    x[2000:4000] = x[2000]
    ids = rng.permutation(8192)
    q, found, _ = vantage_points.probe(vantage_points.build(ids, x), ids[2000:2050], x[2000:2050])
    copies = np.sort(ids[2000:4000])
    for i in ids[2000:2050]:
        assert list(found[q == i]) == [j for j in copies if j != i][: vantage_points.K]


def test_recall_with_production_parameters():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8192, 64)) + 0.7 * rng.normal(size=(10, 64))[rng.integers(0, 10, 8192)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    q, _, scores = vantage_points.probe(vantage_points.build(ids, x), ids[:200], x[:200])
    products = x[:200] @ x.T
    products[ids[:200], ids[:200]] = -9
    kth = np.sort(products, axis=1)[:, -vantage_points.K]
    assert (scores >= kth[q] - 1e-12).mean() >= 0.9


def test_few_rows_and_empty_tables(spark):
    docs = frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])])
    for found in (vantage_points.nearest(docs, docs), bit_sliced_topk.top_k(docs, docs)):
        assert found.count() == 6
        assert found.filter("query_id = vec_id").count() == 0
    none = docs.limit(0)
    assert vantage_points.nearest(none, none).count() == 0
    assert bit_sliced_topk.top_k(docs, none).count() == 0
