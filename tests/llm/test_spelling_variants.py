import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from star_marts.llm import spelling_variants as sv


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def by_definition(rows):
    counts = Counter()
    lower = str.maketrans(sv.UPPER, sv.LOWER)
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS near", "4 AS _group")


def corpus(seed, words, letters, docs=60):
    """Words of few letters, so that many are near, of very unequal counts; some with capitals and marks."""
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=draw.randint(5, 9))) for _ in range(words)]
    for w in base[: words // 2]:
        at = draw.randrange(len(w))
        base.append(draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:], w[:at] + draw.choice(letters) + w[at + 1 :]]))
    draw.shuffle(base)
    weight = [1 / (1 + i) for i in range(len(base))]
    rows = []
    for doc in range(docs):
        chosen = draw.choices(base, weight, k=400)
        rows.append((doc, "".join(w.capitalize() + draw.choice([" ", ", ", "-", "1", "ā"]) for w in chosen)))
    return rows


ODD = [
    (None, "letters " * 30 + "leters " * 5), (None, None), (7, ""), (7, "Éclair×s Àprès " * 9), (8, "éclair×s " * 9),
    (9, "x" * 5000 + " "), (9, "x" * 5000), (10, ("y" * 400 + " ") * 40), (10, ("y" * 399 + "z ") * 6),
    (11, "abcdef " * 130 + "abcdeg " * 25 + "abcdegh " * 5 + "abcdefg " * 5 + "abcde " * 90), (11, "abcdef"), (11, "abcdef"),
]


@pytest.mark.parametrize("shard", [65_536, 40])
def test_every_case(spark, monkeypatch, shard):
    monkeypatch.setattr(sv, "SHARD_WORDS", shard)
    rows = corpus(1, 300, "abcdeinsté") + ODD
    want = by_definition(rows)
    assert len(want) > 150 and sum(f is not None for _, f, *_ in want) > 20
    assert any(r != w and r != f for w, f, r, *_ in want)
    assert result(sv.group_variants(frame(spark, rows).repartition(3))) == want


def test_words_with_equal_counts_are_split(spark, monkeypatch):
    """Anagrams: no level tells them apart, so parts of a shard are asked in turn."""
    monkeypatch.setattr(sv, "SHARD_WORDS", 10)
    draw = random.Random(3)
    words = sorted({"".join(draw.sample("aabbcc", 6)) for _ in range(60)} | {"".join(draw.sample("aabbccc", 7)) for _ in range(60)})
    near = sv.near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), 2)
    assert sorted((r.word, r.near) for r in near.collect()) == sorted((a, b) for a in words for b in words if is_near(a, b))


def test_empty_table(spark):
    assert sv.group_variants(frame(spark, [])).count() == 0
    assert sv.group_variants(frame(spark, [(1, None), (2, "a b c")])).count() == 0


def test_one_edit():
    draw = random.Random(2)
    words = ["".join(draw.choices("abé", k=draw.randint(1, 6))) for _ in range(120)]
    a, b = [w for w in words for _ in words], [w for _ in words for w in words]
    assert list(sv.one_edit(*sv.padded(a), *sv.padded(b))) == [is_near(x, y) for x, y in zip(a, b, strict=True)]


def test_trie_finds_all_near_words():
    draw = random.Random(4)
    words = sorted({"".join(draw.choices("abcdef", k=draw.randint(5, 8))) for _ in range(2500)})
    groups = [c % 5 for c in range(256)]
    trie = sv.Trie(words, groups, 5)
    asked = words[::7] + ["zzzzzz"]
    i, j = trie.near(asked)
    found = sorted(zip(i.tolist(), j.tolist(), strict=True))
    assert found == sorted((i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if is_near(a, b))
    counts = sv.letter_counts(*sv.padded(["abca", "f"]), groups, 5)
    assert counts.sum(axis=1).tolist() == [4, 1] and counts[0, ord("a") % 5] == 2
    assert np.array_equal(trie.counts[np.lexsort(trie.counts.T[::-1])], trie.counts)
