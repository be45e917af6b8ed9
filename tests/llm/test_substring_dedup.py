import random
import re

from star_marts.llm import substring_dedup as m

PIECE = re.compile(r"""(?s).*?(?:[.!?]["')\]]*[ \t\n\x0B\f\r]+|\n[ \t\n\x0B\f\r]*|\Z)""")
BLANKS = " \t\n\x0b\f\r"


def pieces(text):
    return [p for p in PIECE.findall(text) if p]


def plain(rows, run=m.RUN, least_words=m.LEAST_WORDS):
    """{(doc_id, text): (kept text, sentences, removed)} by looking every span up."""
    places = {}
    cut = {key: pieces(key[1] or "") for key in set(rows)}
    for (doc_id, text), parts in cut.items():
        trimmed = [p.strip(BLANKS) for p in parts]
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in trimmed]
        spans = [
            (i, run, "\n".join(trimmed[i : i + run]))
            for i in range(len(parts) - run + 1) if sum(words[i : i + run]) >= least_words
        ]
        for i, n, key in spans:
            places.setdefault((n, key), []).append((doc_id is not None, doc_id or 0, text, i))
    gone = {key: set() for key in cut}
    for (n, _), found in places.items():
        for known, doc_id, text, i in set(found) - {min(found)}:
            gone[doc_id if known else None, text] |= set(range(i, i + n))
    return {
        key: ("".join(p for i, p in enumerate(parts) if i not in gone[key]) if gone[key] else key[1], len(parts), len(gone[key]))
        for key, parts in cut.items()
    }


def test_documents(spark):
    rng = random.Random(2)
    sentence = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 9))) + rng.choice([". ", "! ", "?\n", "\n\n", '."  '])
    shared = ["".join(sentence() for _ in range(5)) for _ in range(6)] + [" ".join(f"w{i}" for i in range(40)) + ". "]
    rows = []
    for i in range(90):
        parts = [sentence() for _ in range(rng.randint(0, 12))]
        if i % 2:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((i, "".join(parts)))
    rows += [(108, "Own start. " + " ".join("ab" * 9) + ". " + " ".join("cd" * 10) + ". Own end."),
             (109, "Other. " + " ".join("ab" * 9) + ". " + " ".join("cd" * 10) + ". Last."), (110, " ".join(f"w{i}" for i in range(40)) + ". ")]
    rows += [(100, rows[11][1]), (101, rows[11][1]), (102, ""), (103, None), (104, "a. " * 7), (105, "no end"), (5, rows[5][1])]
    rows += [(106, "1. 2. 3. 4. " * 400), (None, "x. y. z."), (107, "x.  y.\nz.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS digest", "9 AS removed", "7 AS n_removed")
    got = m.without_repeats(docs)
    assert got.columns == ["doc_id", "digest", "removed", "text", "n_sentences", "n_removed"]
    want = plain(rows)
    out = sorted(str((r.doc_id, r.text, r.n_sentences, r.n_removed)) for r in got.collect())
    assert out == sorted(str((i, *want[i, t])) for i, t in rows)
    assert sum(w[2] > 0 for w in want.values()) > 20
    assert m.without_repeats(docs.limit(0)).count() == 0


def test_two_long_sentences_are_a_run_and_one_is_none(spark):
    pair = "one two three four five six seven. eight nine ten eleven twelve. "
    alone = " ".join(f"w{i}" for i in range(40)) + "."
    docs = spark.createDataFrame([(1, "A. " + pair), (2, "B. " + pair + "C."), (3, "D. " + alone), (4, "E. " + alone)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in m.without_repeats(docs).collect()}
    assert got == {1: ("A. " + pair, 0), 2: ("B. C.", 2), 3: ("D. " + alone, 0), 4: ("E. " + alone, 0)}
