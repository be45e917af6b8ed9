import math

import numpy as np
import pytest

from star_marts.llm import hard_negatives
from star_marts.llm.hard_negatives import bit_planes, scores, subset_sums


def by_definition(rows):
    known = []
    for at, (i, x, label) in enumerate(rows):
        if label is None or x is None or not all(v is not None and math.isfinite(v) for v in x):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        known.append((at, i, label, [math.floor(256 * v) if abs(v) < 2**52 else int(v) * 256 for v in x]))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for at, i, label, x in known:
        if i is None or i % 50:
            continue
        others = [(sum(a * b for a, b in zip(x, y, strict=True)), j, other) for b, j, other, y in known if b != at and len(x) == len(y)]
        for ps, positive, _ in sorted((o for o in others if o[2] == label), key=order)[:5]:
            inside = [o for o in others if o[2] != label and 50 * ps <= 100 * o[0] <= 95 * ps]
            out += [(i, positive, r, n, ps, ns) for r, (ns, n, _) in enumerate(sorted(inside, key=order)[:3], 1)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "1 AS dim", "2 AS block", "3 AS row", "4 AS anchor", "5 AS bucket", "6 AS score"
    )


def found(spark, rows):
    got = hard_negatives.mine(frame(spark, rows).repartition(3))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def table(seed, n, dims, scale=1.0, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, scale, (labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        rows.append((i * 5, [float(v) for v in centre[label] + rng.normal(0, scale, dims)], label))
    return rows


ODD = [
    (900, None, 1), (950, [1.0, None, 0.0], 1), (1000, [math.nan] * 3, 1), (1050, [math.inf] * 3, 1), (1100, [], 1),
    (1150, [], 2), (1151, [], 1), (1200, [1.0, 2.0], 1), (1201, [0.9, 1.9], 1), (1202, [0.5, 1.2], 2), (1250, [1.0, 1.0, 1.0], None),
    (None, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (None, [0.6, 0.6, 0.6], 3), (1300, [0.0, 0.0, 0.0], 1),
]


def test_every_case(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "SLICE_ANCHORS", 3)
    rows = table(1, 250, 3) + ODD
    rows += [(50, rows[10][1], rows[10][2]), (50, rows[11][1], 2), (255, rows[11][1], 2), (255, rows[11][1], 2)]  # repeats
    rows += [(2000 + i, rows[20][1], rows[20][2] if i % 2 else 9) for i in range(30)]  # ties
    want = by_definition(rows)
    assert len(want) > 40
    assert found(spark, rows) == want


def test_a_label_with_most_rows_and_a_label_for_each_row(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 30)
    rows = table(2, 120, 9, 0.1, labels=2)
    hot = [(i, x, 3) if n % 3 else (i, x, 100 + n) for n, (i, x, _) in enumerate(rows)]
    assert found(spark, hot) == by_definition(hot)


def test_large_components(spark, monkeypatch):
    rows = table(3, 60, 4, 90.0) + [(4000, [1e6, 2.0, 0.5, 0.0], 1), (4001, [3e6, 1.0, 3e6, 7.0], 1), (4002, [1e8, 1e8, -1e8, 1.0], 2)]
    want = by_definition(rows)
    assert found(spark, rows) == want
    with pytest.raises(Exception, match="exceeds a long"):
        found(spark, [(0, [1e300], 1), (1, [1e300], 1), (2, [6e299], 2)])
    below = [(0, [1e300], 1), (1, [-1e300], 1), (50, [0.0], 1), (3, [-1.0], 2)]
    assert found(spark, below) == by_definition(below)


def test_scores_from_tables_are_products():
    rng = np.random.default_rng(4)
    for dims, size in ((1, 5), (8, 300), (13, 70_000), (64, 1 << 40)):
        values, anchors = rng.integers(-size, size, (600, dims)), rng.integers(-size, size, (7, dims))
        got = scores(*bit_planes(values), anchors)
        assert (got == values.astype(object) @ anchors.astype(object).T).all()
    tables = subset_sums(np.arange(1, 11)[None])
    assert tables[0, 0b10000101, 0] == 1 + 3 + 8 and tables[1, 0b11, 0] == 9 + 10


def test_empty_and_lonely(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []
