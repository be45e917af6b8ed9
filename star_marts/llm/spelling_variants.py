"""Spelling variants by a frequency-vector trie.

Words are counted over all texts.  The letters in use are dealt to groups, the most frequent first,
and a word is arranged by how many letters of each group it has, group after group: level d of the
trie branches by the d-th count.  Words one edit apart differ by a surplus of at most one and a
deficit of at most one in these counts, so a depth-first search that spends a budget of one each
meets every leaf that can hold a near word; leaf words are then verified letter by letter.

The upper levels of the trie are the groups that Spark deals words by: a word is stored in the one
that its first counts name, and asks there and in those that the budget reaches.  Each pair of
groups is asked in one direction only.  As many levels are taken as leave a group of at most
SHARD_WORDS words; if words agree in all counts beyond that, they are split by a hash and all parts
are asked.  A task searches for many words at once: a node is visited with all that still reach it.

A word's form is its near word of largest count, if that is at least five times its own, and its
root the last form of the chain, in which counts grow fivefold at each step.

Defined cases: a null text has no words, a null doc_id counts as an empty one in the check sum; rows
that repeat count again; near words of equal count: the smallest in code-point order; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from star_marts.llm.common import spread_join, whole_text
from star_marts.llm.meeting import GROUP, meet
from star_marts.session import stage

# Fixed values of the word rule.  All letters are of Latin-1, one byte each there.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EDITED_EVERY = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
FORM_TIMES = 5

LEVELS = 24  # letter groups
SHARD_WORDS = 65_536  # of one trie
LEAF = 16


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: the runs of letters, some of them with one letter taken out."""
    runs = F.regexp_extract_all(F.translate(whole_text(), UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    check = each.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    place = F.col("h") % F.length("run")
    cut = F.concat(F.col("run").substr(F.lit(1), place.cast("int")), F.col("run").substr((place + 2).cast("int"), F.length("run")))
    words = check.select(F.when(F.col("h") % EDITED_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


# --- letter groups -----------------------------------------------------------------------------


def letter_groups(words: DataFrame, levels: int = LEVELS) -> list[int]:
    """The group of each Latin-1 letter: by falling frequency, dealt to and fro.

    At most 256 rows reach the driver.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    order = [r["letter"] for r in letters.orderBy(F.col("n").desc(), "letter").collect()]
    groups = [0] * 256
    for i, letter in enumerate(order):
        turn, at = divmod(i, levels)
        groups[ord(letter)] = levels - 1 - at if turn % 2 else at
    return groups


def count_column(groups: list[int], level: int) -> Column:
    """How many letters of a word are of a group."""
    of_group = "".join(chr(c) for c in range(256) if groups[c] == level and chr(c).isalpha())
    return F.length("word") - F.length(F.translate("word", of_group, ""))


def letter_counts(words: np.ndarray, lengths: np.ndarray, groups: list[int], levels: int = LEVELS) -> np.ndarray:
    """[word, level] of padded Latin-1 words."""
    used = np.arange(words.shape[1])[None] < lengths[:, None]
    row, _ = np.nonzero(used)
    level = np.asarray(groups, np.int64)[words[used]]
    flat = np.bincount(row * levels + level, minlength=len(words) * levels)
    return flat.reshape(len(words), levels).astype(np.int16 if flat.max(initial=0) < 1 << 14 else np.int64)


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 bytes of words, a row each, and their lengths."""
    coded = [w.encode("latin-1") for w in words]
    lengths = np.array([len(c) for c in coded], np.int64)
    width = max(1, int(lengths.max(initial=0)))
    return np.frombuffer(b"".join(c.ljust(width, b"\0") for c in coded), np.uint8).reshape(len(coded), width), lengths


# --- the trie --------------------------------------------------------------------------------------


def one_edit(a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Whether two padded words, row by row, differ by exactly one letter put in, left out or replaced."""
    width = max(a.shape[1], b.shape[1]) + 1
    a = np.pad(a, ((0, 0), (0, width - a.shape[1])))
    b = np.pad(b, ((0, 0), (0, width - b.shape[1])))
    out = np.zeros(len(a), bool)
    same = a_len == b_len
    out[same] = (a[same] != b[same]).sum(axis=1) == 1
    for longer, shorter, some, size in ((a, b, a_len == b_len + 1, b_len), (b, a, b_len == a_len + 1, a_len)):
        at = np.flatnonzero(some)
        if not len(at):
            continue
        n = size[at]
        inside = np.arange(width - 1)[None] < n[:, None]
        straight = (longer[at, :-1] == shorter[at, :-1]) & inside
        shifted = (longer[at, 1:] == shorter[at, :-1]) | ~inside
        before = np.where(straight.all(axis=1), width - 1, straight.argmin(axis=1))
        after = np.where(shifted.all(axis=1), width - 1, shifted[:, ::-1].argmin(axis=1))
        out[at] = before + after >= width - 1
    return out


class Trie:
    """Words of a shard in the order of their letter counts; a node is a range of them."""

    def __init__(self, words: list[str], groups: list[int], levels: int = LEVELS, leaf: int = LEAF):
        self.groups, self.levels, self.leaf = groups, levels, leaf
        letters, lengths = padded(words)
        counts = letter_counts(letters, lengths, groups, levels)
        self.order = np.lexsort(counts.T[::-1])
        self.letters, self.lengths, self.counts = letters[self.order], lengths[self.order], counts[self.order]

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in `words`, place in the trie's words) that are one edit apart."""
        letters, lengths = padded(words)
        counts = letter_counts(letters, lengths, self.groups, self.levels)
        asked, held = [], []

        def visit(start: int, end: int, level: int, some: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
            if level == self.levels or end - start <= self.leaf:
                rest = counts[some, None, level:] - self.counts[None, start:end, level:]
                over = np.maximum(rest, 0).sum(axis=2) + surplus[:, None]
                under = np.maximum(-rest, 0).sum(axis=2) + deficit[:, None]
                i, j = np.nonzero((over <= 1) & (under <= 1))
                if len(i):
                    i, j = some[i], j + start
                    good = one_edit(letters[i], lengths[i], self.letters[j], self.lengths[j])
                    asked.append(i[good])
                    held.append(self.order[j[good]])
                return
            column = self.counts[start:end, level]
            edges = np.flatnonzero(np.diff(column)) + 1 + start
            for low, high in zip([start, *edges], [*edges, end], strict=True):
                gap = counts[some, level] - self.counts[low, level]
                over, under = surplus + np.maximum(gap, 0), deficit + np.maximum(-gap, 0)
                go = (over <= 1) & (under <= 1)
                if go.any():
                    visit(low, high, level + 1, some[go], over[go], under[go])

        none = np.zeros(len(words), np.int64)
        visit(0, len(self.order), 0, np.arange(len(words)), none, none)
        if not asked:
            return none[:0], none[:0]
        return np.concatenate(asked), np.concatenate(held)


# --- shards and links ------------------------------------------------------------------------------


def _steps(levels: int) -> list[list[int]]:
    """What the budget can change in the first counts, each pair of shards one way only."""
    changes = set()
    for up in range(-1, levels):
        for down in range(-1, levels):
            change = [(i == up) - (i == down) for i in range(levels)]
            if tuple(change) > (0,) * levels:
                changes.add(tuple(change))
    return [list(c) for c in sorted(changes)]


def near_words(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """word, near, near_n: both directions of every pair of near words among `words` (word, n)."""
    groups = letter_groups(words, levels)
    top, shards, largest = 0, 1, words.count()
    while largest > SHARD_WORDS and top < levels:
        top += 1
        sizes = words.groupBy(*[count_column(groups, i).alias(f"c{i}") for i in range(top)]).count()
        shards, largest = sizes.agg(F.count("*"), F.max("count")).first()
    parts = max(1, -(-(largest or 0) // SHARD_WORDS))

    first = F.array(*[count_column(groups, i) for i in range(top)]).cast("array<int>")
    part = F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int")
    name = lambda counts, p: F.concat(F.concat_ws(",", counts.cast("array<string>")), F.lit("/"), p.cast("string"))
    keyed = words.withColumn("_first", first)
    index = keyed.select(name(F.col("_first"), part).alias(GROUP), "word", "n")
    steps = F.array(*[F.array(*[F.lit(x) for x in s]) for s in [[0] * top, *_steps(top)]]) if top else F.array(F.lit([]).cast("array<int>"))
    reached = keyed.select(
        "word", "n", "_first", F.explode(F.transform(steps, lambda s: F.zip_with("_first", s, lambda a, b: a + b))).alias("_at")
    ).filter(F.forall("_at", lambda c: c >= 0))
    probes = reached.select(
        "word", "n", "_at", (F.col("_at") == F.col("_first")).alias("own"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"),
    ).select(name(F.col("_at"), F.col("_part")).alias(GROUP), "word", "n", "own")

    def build(rows: pa.Table) -> tuple[Trie, list[str], np.ndarray]:
        held = rows["word"].to_pylist()
        return Trie(held, groups, levels), held, rows["n"].to_numpy()

    def answer(shard: tuple[Trie, list[str], np.ndarray], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        trie, held, held_n = shard
        asked, asked_n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        i, j = trie.near(asked)
        back = ~np.asarray(batch.column("own"))[i]
        here, there = pa.array(asked), pa.array(held)
        yield pa.RecordBatch.from_arrays([here.take(i), there.take(j), pa.array(held_n[j])], ["word", "near", "near_n"])
        i, j = i[back], j[back]
        yield pa.RecordBatch.from_arrays([there.take(j), here.take(i), pa.array(asked_n[i])], ["word", "near", "near_n"])

    return meet(index, probes, shards * parts, build, answer, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root for words that have a form; `forms` is stored, word and form."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        followers = now.groupBy("root").agg(F.count("*").alias("_followers"))
        further = stage(forms.select(F.col("word").alias("root"), F.col("form").alias("_next")).join(followers, "root"), "further")
        if further.isEmpty():
            return now
        moved = spread_join(now, further, ["root"], "_followers", ["word"], "left")
        now = stage(moved.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of the texts."""
    words = stage(word_counts(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best")
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    strong = -F.col("best.rank") >= FORM_TIMES * F.col("n")
    named = stage(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.rank")).alias("form_n"),
        ),
        "variants",
    )
    chains = roots(stage(named.filter(F.col("form").isNotNull()).select("word", "form"), "forms"))
    return named.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# The check sum byte by byte, its table by rule; variants of words with a letter masked or left out.
ORACLE_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i)) AS steps),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{RUN}')) AS run FROM documents),
counted AS (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL),
coded AS (SELECT *, hex(encode(doc || ':' || run)) AS code FROM counted),
checked AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(length(code) // 2), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(steps[xor(c, b) % 256 + 1], c // 256), 4294967295)) AS h FROM coded, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {EDITED_EVERY} = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM checked)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS k FROM places),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM places),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM masked a JOIN masked b USING (k) WHERE a.word <> b.word
  UNION SELECT s.word, s.n, w.word, w.n FROM shorter s JOIN words w ON s.k = w.word
  UNION SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON s.k = w.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM near GROUP BY word),
named AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN near_n >= {FORM_TIMES} * w.n THEN near END AS form,
    CASE WHEN near_n >= {FORM_TIMES} * w.n THEN near_n END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form FROM named
  UNION ALL SELECT c.word, c.form, f.form FROM chain c JOIN named f ON c.form = f.word)
SELECT d.word, d.form, c.root, d.n, d.n_near, d.form_n FROM named d JOIN chain c ON c.word = d.word AND c.form IS NULL
"""
