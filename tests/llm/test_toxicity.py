import random

import numpy as np
import pytest

from star_marts.llm import toxicity as m

PLAIN = "the of and to in that was with which there one house river green slowly".split()


def corpus(n, seed):
    """Half of the texts hold a few words of a stem, with endings that other texts may not have."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(PLAIN) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randint(3, 150))]
        for _ in range(3 * (i % 2)):
            words.insert(rng.randrange(len(words)), "zork" + "".join(rng.choices("abcdefgh", k=3)))
        out.append((" ".join(words), i % 2))
    return out


@pytest.fixture(scope="module")
def net():
    texts = corpus(300, 1)
    return m.train([t.encode() for t, _ in texts], np.array([y for _, y in texts]))


def test_held_out_accuracy(net):
    texts = corpus(200, 2)
    scores = m.Scorer(net).scores([t.encode() for t, _ in texts])
    assert ((scores >= m.THRESHOLD) == np.array([y for _, y in texts])).mean() >= 0.95


def test_every_window_counts(net):
    clean = " ".join(PLAIN * 200)
    scorer = m.Scorer(net)
    low = scorer.scores([clean.encode()])[0]
    for at in (0, 1000, len(clean) // 2, len(clean)):
        at = clean.rfind(" ", 0, at) + 1
        assert scorer.scores([(clean[:at] + "zorkabc zorkdef zorkgah " + clean[at:]).encode()])[0] > low


def test_windows_cover_and_overlap():
    for n in (0, 1, m.WINDOW, m.WINDOW + 1, 500):
        spans = m.windows(n)
        assert {i for a, b in spans for i in range(a, b)} == set(range(n))
        assert all(b > c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_long_words_are_read_whole():
    word = bytes(range(97, 123)) * 5
    assert b"".join(m.words_of(word)) == word


def test_gradients(net):
    texts = corpus(6, 3)
    numbers: dict[bytes, int] = {}
    documents = [np.array([numbers.setdefault(w, len(numbers)) for w in m.words_of(t.encode())[:40]]) for t, _ in texts]
    word, grams = m.hashes(list(numbers))
    at, there, text = m._laid_out(documents)
    toxic = np.array([y for _, y in texts])[text]
    _, grad = m.gradients(net, word, grams, at, there, toxic)
    rng = np.random.default_rng(0)
    for name, g in grad.items():
        values = net.weights[name]
        if isinstance(g, tuple):
            full = np.zeros_like(values)
            np.add.at(full, g[0], g[1])
            g = full
        flat, slope = values.reshape(-1), np.asarray(g).reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(slope) > 1e-5), 3) if (np.abs(slope) > 1e-5).any() else ():
            before = flat[i]
            losses = []
            for step in (1e-2, -1e-2):
                flat[i] = before + step
                losses.append(m.gradients(net, word, grams, at, there, toxic)[0])
            flat[i] = before
            assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(slope[i], rel=0.1, abs=2e-4), name


def test_rows(spark):
    texts = corpus(80, 4)
    rows = [(i, t) for i, (t, _) in enumerate(texts)] + [(1, texts[1][0]), (None, "the"), (900, None), (901, ""), (902, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS toxic", "3 AS held_out")
    labels = spark.createDataFrame(
        [(i, y) for i, (_, y) in enumerate(texts)] + [(None, 1), (5, None), (900, None)], "doc_id long, toxic int"
    )
    out = m.score(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert len({r.score for r in out if r.doc_id == 1}) == 1
    kept = m.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    # What counts as a word's context does not depend on the batch: both calls decide alike.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if not r.predicted)
    assert m.score(docs.limit(0), labels).count() == 0
    none = m.score(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_labels_of_held_out_documents_are_not_learned(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic")
    held = {r.doc_id for r in docs.filter(m.held_out()).collect()}
    texts, toxic = m.training_sample(docs, labels)
    assert held and {int(t.split()[1]) for t in texts} == set(range(60)) - held
    assert all(int(t.split()[1]) % 2 == y for t, y in zip(texts, toxic, strict=True))
