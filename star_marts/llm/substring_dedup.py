"""Substring dedup over sliding sentence spans.

A sentence ends with . ! or ? before a blank, or with a line break; the blanks after it belong to
it, so that sentences joined are the text.  Spans are every run of `RUN` consecutive sentences that
has `LEAST_WORDS` words or more; longer repeated passages are covered by their runs.  Spans are equal
if their sentences are, blanks around sentences aside.  The first place of a span is the least
(doc_id, text digest, position); sentences under any other place of it are removed.

Places are found by a 64-bit hash, and told apart by a further 32 bits and the span's length.

Defined cases: null and empty texts have no sentence and stay as they are; long texts are read
whole; rows equal in doc_id and text are one document and share its result; a null doc_id comes
first; an empty table gives no rows; other columns are passed on untouched, but
for n_sentences and n_removed, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from star_marts.llm.common import WORD, let, spread_join, whole_text
from star_marts.session import stage

RUN = 2
LEAST_WORDS = 10
_BLANKS = " \t\n\x0b\f\r"
SENTENCE = r"""(?s).*?(?:[.!?]["')\]]*[ \t\n\x0B\f\r]+|\n[ \t\n\x0B\f\r]*|\z)"""


def sentences(text: Column) -> Column:
    """The text in pieces, nothing left out."""
    return F.filter(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda s: s != "")


def _spans(text: Column, run: int, least_words: int) -> Column:
    """Array of (pos, len, h, more) of every span."""
    trimmed = F.transform(
        sentences(text),
        lambda s: F.struct(F.btrim(s, F.lit(_BLANKS)).alias("s"), F.regexp_count(s, F.lit(WORD)).alias("n")),
    )

    def span(pos: Column, length: int, key: Column) -> Column:
        return F.struct(
            pos.cast("int").alias("pos"), F.lit(length).alias("len"),
            F.xxhash64(key).alias("h"), F.hash(key).alias("more"),
        )

    def all_spans(t: Column) -> Column:
        some = lambda i: F.slice(t, i, F.lit(run))
        words = lambda i: F.aggregate(some(i), F.lit(0), lambda n, x: n + x["n"])
        starts = F.filter(F.sequence(F.lit(1), F.size(t) - run + 1), lambda i: words(i) >= least_words)
        runs = F.transform(
            starts, lambda i: span(i - 1, run, F.array_join(F.transform(some(i), lambda x: x["s"]), "\n"))
        )
        return F.when(F.size(t) >= run, runs)

    return let(trimmed, all_spans)


def removed_sentences(docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, digest and `removed`, the positions under a span that is not the first, for
    documents that have any."""
    text = whole_text()
    spans = docs.select(
        F.col("doc_id"), F.xxhash64(text).alias("digest"), F.inline(_spans(text, run, least_words))
    )
    # Most spans occur once.  A bare count of their hashes finds the others.
    repeated = stage(
        spans.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "repeated"
    )
    hits = stage(spread_join(spans, repeated, ["h"], "n", ["doc_id", "digest", "pos"]).drop("n"), "hits")
    key = ["h", "more", "len"]
    place = F.struct("doc_id", "digest", "pos")
    first = stage(
        hits.groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1"), "first"
    )
    later = spread_join(hits, first, key, "n", ["doc_id", "digest", "pos"]).filter(~place.eqNullSafe(F.col("first")))
    return later.select(
        "doc_id", "digest", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("len") - 1)).alias("at")
    ).groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("at")).alias("removed"))


def without_repeats(docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS) -> DataFrame:
    """`docs` with the text that remains, and the counts n_sentences and n_removed."""
    found = stage(removed_sentences(docs, run, least_words), "removed")
    text = docs["text"]
    some = F.coalesce(text, F.lit(""))
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & (F.xxhash64(some) == found["digest"])
    gone = found["removed"]
    kept = F.array_join(F.filter(sentences(text), lambda s, i: ~F.array_contains(gone, i)), "")
    names = {"n_sentences": F.size(sentences(some)), "n_removed": F.coalesce(F.size(gone), F.lit(0))}
    return docs.join(found, same, "left").select(
        *[docs[c] for c in docs.columns if c not in ("text", *names)],
        F.when(gone.isNotNull(), kept).otherwise(text).alias("text"),
        *[value.cast("long").alias(name) for name, value in names.items()],
    )


#: The same by DuckDB, by the texts of spans instead of their hashes.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT doc_id, text, [x FOR x IN regexp_extract_all(coalesce(text, ''), '(?s).*?(?:[.!?]["'')\]]*[ \t\n\x0B\f\r]+|\n[ \t\n\x0B\f\r]*|\z)') IF x <> ''] AS s
  FROM documents),
sentence AS (
  SELECT doc_id, i - 1 AS pos, s[i] AS raw, trim(s[i], e' \t\n\x0b\f\r') AS t,
    len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM pieces)),
span AS (
  SELECT a.doc_id, a.pos, 2 AS len, a.t || chr(10) || b.t AS key
  FROM sentence a JOIN sentence b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 WHERE a.words + b.words >= 10),
placed AS (SELECT *, row_number() OVER (PARTITION BY len, key ORDER BY doc_id, pos) AS nth FROM span),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM (SELECT doc_id, pos, unnest(generate_series(0, len - 1)) AS k FROM placed WHERE nth > 1))
SELECT p.doc_id, coalesce(k.text, '') AS text, len(p.s)::BIGINT AS n_sentences, coalesce(k.n, 0)::BIGINT AS n_removed
FROM pieces p LEFT JOIN (
  SELECT s.doc_id, coalesce(string_agg(s.raw, '' ORDER BY s.pos) FILTER (g.pos IS NULL), '') AS text, count(g.pos) AS n
  FROM sentence s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.pos = s.pos GROUP BY s.doc_id) k ON k.doc_id = p.doc_id
"""
