"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sizes are words.  A source's rows are dealt to shards of about `shard_words` words by a hash of
doc_id, text and a number among equal rows, so that no repeated id or text fills a shard.  A shard
is cut into blocks of equal length, and whole numbers of blocks are allotted first to sources and
then to the shards of a source, each time by the highest quotients weight / (2k - 1).  A shard
allotted q of its n blocks takes every block q div n times and q mod n of them, chosen by a seeded
order, once more.  DataFrame operations only.

Defined cases: a null text has size 0 and takes 0; a null source is a source of its own, the last;
repeated rows are numbered and dealt separately, and as they are alike it does not matter which
gets what; a null doc_id is hashed like an empty one; an empty table gives
no rows; columns other than doc_id, text and source are not read by `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from star_marts.llm.common import WORD, let, whole_text
from star_marts.session import stage

SEED = "7"
CAP = 3  # a source or document is taken at most this often
MOST_BLOCK_WORDS = 256
BLOCKS_PER_SOURCE = 1024  # on average, before blocks reach their full length
SHARD_WORDS = 1 << 20
_NUMBERS = 4096  # of equal rows, made at once


def _digest(text: Column) -> Column:
    """60 bits of the text's MD5, which other engines can compute too."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, a digest of the text and a number among rows equal in all of these.

    Equal rows are counted, map-side first, and the count is unfolded again: no task sorts them.
    Many equal rows are unfolded by many tasks.
    """
    rows = docs.select(
        "doc_id", "source", F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
        _digest(F.col("text")).alias("digest"),
    )
    counted = rows.groupBy("doc_id", "source", "size", "digest").agg((F.count("*") - 1).alias("last"))
    zero = F.lit(0).cast("long")
    few = counted.filter(F.col("last") < _NUMBERS).withColumn("number", F.explode(F.sequence(zero, "last")))
    starts = F.sequence(zero, F.col("last"), F.lit(_NUMBERS).cast("long"))
    many = counted.filter(F.col("last") >= _NUMBERS).withColumn("first", F.explode(starts)).repartition(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "digest", "first"
    )
    end = F.least(F.col("last"), F.col("first") + _NUMBERS - 1)
    many = many.withColumn("number", F.explode(F.sequence("first", end))).drop("first")
    return few.unionByName(many).drop("last")


def source_targets(sized: DataFrame, cap: int = CAP) -> DataFrame:
    """One row per source: rank, weight (1, 2, 3, repeating), source_size, target.

    Targets share all words by weight.  A target above `cap` times its source stops there, and
    the excess is shared again: in the order of cap / weight, sources are capped for as long as
    the share of what is left exceeds their cap.
    """
    everything = Window.partitionBy()
    ranked = sized.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size",
        F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("rank"),
    )
    limit = (F.col("source_size") * cap).alias("limit")
    weighed = ranked.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("long")).withColumn(
        "limit", limit
    )
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = weighed.withColumn(
        "level", (F.sum("source_size").over(everything) - before) / left
    ).withColumn("order", F.row_number().over(filling))
    fits = F.col("level") * F.col("weight") < F.col("limit")
    final = F.min_by("level", F.when(fits, F.col("order"))).over(everything)
    return level.withColumn("final", final).select(
        "source", "rank", "weight", "source_size",
        F.coalesce(
            F.least(F.col("limit").cast("double"), F.col("final") * F.col("weight")),
            F.col("limit").cast("double"),
        ).alias("target"),
    )


def apportion(rows: DataFrame, group: list[str], seats: Column, weight: str, most: str, tie: str) -> DataFrame:
    """Sainte-Laguë: `rows` with a column `quota` that sums to `seats` in each group.

    Rounding each quota gives the highest quotients of a slightly different number of seats; the
    few that differ are then added or taken away by quotient, `tie` (ascending) breaking ties.
    Only quotients that can be among them are generated.  No row gets more than `most`.
    """
    within = Window.partitionBy(*group)
    share = F.when(
        F.sum(weight).over(within) > 0, seats * F.col(weight) / F.sum(weight).over(within)
    ).otherwise(F.lit(0.0))
    rounded = rows.withColumn("_seats", seats.cast("long")).withColumn("_share", share).withColumn(
        "_q", F.least(F.floor(F.col("_share") + 0.5), F.col(most)).cast("long")
    )
    missing = rounded.withColumn("_more", F.col("_seats") - F.sum("_q").over(within))

    def quotient(k: Column) -> Column:
        return F.col(weight) / (2 * k - 1)

    # Adding: the next quotient of each row bounds what can still be reached, and so for removal.
    add, cut = F.col("_more") > 0, F.col("_more") < 0
    first = F.when(add & (F.col("_q") < F.col(most)), quotient(F.col("_q") + 1)).when(
        cut & (F.col("_q") > 0), -quotient(F.col("_q"))
    )
    order = Window.partitionBy(*group).orderBy(F.col("_first").desc_nulls_last(), F.col(tie))
    bounded = missing.withColumn("_first", first).withColumn("_at", F.row_number().over(order))
    inside = F.when(F.col("_first").isNotNull() & (F.col("_at") <= F.abs("_more")), F.col("_first"))
    known = F.count(inside).over(within)
    bounded = bounded.withColumn(
        "_bound", F.when(known == F.abs("_more"), F.min(inside).over(within))
    )
    # k-th seat: weight / (2k - 1) >= bound  <=>  k <= (weight / bound + 1) / 2
    reach = F.floor((F.col(weight) / F.abs("_bound") + 1) / 2)
    last = F.when(add, F.least(F.col(most), F.coalesce(reach + 1, F.col(most)))).otherwise(F.col("_q"))
    start = F.when(add, F.col("_q") + 1).otherwise(
        F.greatest(F.lit(1), F.coalesce(reach, F.lit(1)))
    )
    steps = F.when(
        F.col("_first").isNotNull() & (start <= last), F.sequence(start.cast("long"), last.cast("long"))
    )
    names = rows.columns
    candidates = bounded.withColumn("_k", F.explode_outer(steps))
    sign = F.when(add, F.lit(1.0)).otherwise(F.lit(-1.0))
    ranked = candidates.withColumn("_value", sign * quotient(F.col("_k"))).withColumn(
        "_place",
        F.row_number().over(
            Window.partitionBy(*group).orderBy(
                F.col("_value").desc_nulls_last(), F.when(add, F.col(tie)).otherwise(-F.col(tie))
            )
        ),
    )
    taken = F.sum(
        F.when(F.col("_k").isNotNull() & (F.col("_place") <= F.abs("_more")), F.signum("_more"))
        .otherwise(F.lit(0))
    ).cast("long")
    return ranked.groupBy(*names, "_q").agg(taken.alias("_extra")).select(
        *names, (F.col("_q") + F.col("_extra")).alias("quota")
    )


def _hashed(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts))


def _row() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest"), F.col("number")]


def shard_of(shards: Column) -> Column:
    """Shard of a row of `sizes`, of so many."""
    return F.pmod(F.conv(F.substring(_hashed(*_row()), 1, 8), 16, 10).cast("long"), shards)


def block_picks(sized: DataFrame, seed: str = SEED, cap: int = CAP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of `sizes` with source_size, target and picks.

    `picks` is an array of (start, end, times): words of the document, end exclusive, and how often
    the mix takes them.  `sized` should be stored; it is read twice.
    """
    targets = source_targets(sized, cap)
    every = Window.partitionBy()
    block_words = F.greatest(
        F.lit(1),
        F.least(
            F.lit(MOST_BLOCK_WORDS),
            F.floor(F.sum("source_size").over(every) / (F.count("*").over(every) * BLOCKS_PER_SOURCE)),
        ),
    ).cast("long")
    shards_of = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    targets = stage(
        targets.withColumn("block_words", block_words).withColumn("shards", shards_of), "targets"
    )
    # `targets` has a row per source; whether that is small enough to broadcast is left to the optimizer.
    same = sized["source"].eqNullSafe(targets["source"])
    dealt = sized.join(targets, same).select(
        sized["doc_id"], sized["source"], "size", "digest", "number", "source_size", "target", "rank",
        "block_words", shard_of(F.col("shards")).alias("shard"),
    )
    shard = dealt.groupBy("rank", "shard").agg(
        F.sum("size").alias("words"), F.first("target").alias("target"),
        F.first("source_size").alias("source_size"), F.first("block_words").alias("block_words"),
    ).filter("words > 0").withColumn(
        "blocks", F.greatest(F.lit(1), F.round(F.col("words") / F.col("block_words"))).cast("long")
    ).withColumn("most", F.col("blocks") * cap)
    by_source = shard.groupBy("rank").agg(
        (F.first("target") * F.sum("blocks") / F.first("source_size")).alias("wanted"),
        F.sum("most").alias("most"), F.lit(1).alias("one"),
    )
    seats = F.round(F.sum("wanted").over(Window.partitionBy("one"))).cast("long")
    per_source = apportion(by_source, ["one"], seats, "wanted", "most", "rank")
    joined = shard.join(per_source.select("rank", F.col("quota").alias("source_quota")), "rank")
    per_shard = stage(
        apportion(
            joined.select("rank", "shard", "words", "blocks", "most", "source_quota"),
            ["rank"], F.col("source_quota"), "blocks", "most", "shard",
        ),
        "quotas",
    )

    in_shard = Window.partitionBy("rank", "shard")
    by_hash = in_shard.orderBy(_hashed(F.lit(seed), *_row()), "doc_id", "size", "digest", "number")
    placed = dealt.withColumn("row", F.row_number().over(by_hash)).withColumn(
        "end", F.sum("size").over(by_hash.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.join(per_shard.select("rank", "shard", "words", "blocks", "quota"), ["rank", "shard"], "left")

    def block_at(position: Column) -> Column:
        return F.floor(((position + 1) * F.col("blocks") - 1) / F.col("words"))

    def bound(block: Column) -> Column:
        return F.floor(block * F.col("words") / F.col("blocks"))

    covered = F.when(
        F.col("size") > 0, F.sequence(block_at(F.col("start")), block_at(F.col("end") - 1))
    )
    pieces = placed.withColumn("block", F.explode_outer(covered)).withColumn(
        "place",
        F.dense_rank().over(
            in_shard.orderBy(
                F.when(
                    F.col("block").isNotNull(),
                    _hashed(F.lit(seed), F.col("rank"), F.col("shard"), F.col("block")),
                ).asc_nulls_last(),
                "block",
            )
        ),
    )
    times = F.floor(F.col("quota") / F.col("blocks")) + F.when(
        F.col("place") <= F.col("quota") % F.col("blocks"), 1
    ).otherwise(0)
    piece = F.when(
        F.col("block").isNotNull(),
        F.struct(
            (F.greatest(F.col("start"), bound(F.col("block"))) - F.col("start")).alias("start"),
            (F.least(F.col("end"), bound(F.col("block") + 1)) - F.col("start")).alias("end"),
            times.alias("times"),
        ),
    )
    # A document's pieces are in its shard already: this grouping moves nothing.
    return pieces.groupBy("rank", "shard", "row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "digest", "source_size", "target")],
        F.array_sort(F.collect_list(piece)).alias("picks"),
    ).drop("rank", "shard", "row")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    picked = block_picks(stage(sizes(docs), "sizes"), seed)
    taken = F.aggregate(
        "picks", F.lit(0).cast("long"),
        lambda total, p: total + (p["end"] - p["start"]) * p["times"],
    )
    return picked.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself, with the columns of `docs`: a document's text is what is taken of it.

    A text taken whole keeps its blanks, and is repeated after a line break if taken more than
    once.  Of others the taken words are joined by blanks, blocks by line breaks.  Documents of
    which nothing is taken go, those without words too.  Rows equal in doc_id and text come
    back as one row that carries what is taken of all of them.
    """
    picked = block_picks(stage(sizes(docs), "sizes"), seed).withColumn(
        "picks", F.filter("picks", lambda p: p["times"] > 0)
    )
    once = stage(
        picked.groupBy("doc_id", "digest").agg(
            F.flatten(F.collect_list("picks")).alias("picks"), F.max("size").alias("size")
        ).filter(F.size("picks") > 0),
        "picks",
    )
    if not picked.groupBy("doc_id", "digest").count().filter("count > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    source = docs["text"]
    same = docs["doc_id"].eqNullSafe(once["doc_id"])
    same = same & (_digest(source) == once["digest"])
    picks = once["picks"]
    times = F.array_max(F.transform(picks, lambda p: p["times"]))
    whole = let(times, lambda most: F.forall(picks, lambda p: p["times"] == most)) & (
        F.aggregate(picks, F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"]) == once["size"]
    )
    words = F.regexp_extract_all(source, F.lit(f"({WORD})"))

    def cut(w: Column, p: Column) -> Column:
        piece = F.slice(w, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))
        return F.array_join(F.array_repeat(F.array_join(piece, " "), p["times"].cast("int")), "\n")

    parts = let(words, lambda w: F.transform(picks, lambda p: cut(w, p)))
    text = F.when(whole, F.array_join(F.array_repeat(source, times.cast("int")), "\n")).otherwise(
        F.array_join(parts, "\n")
    )
    taken = {"text": text, "n_chars": F.length(text).cast("long")}
    return docs.join(once, same).select(*[taken.get(c, docs[c]).alias(c) for c in docs.columns])


#: The same by DuckDB: quotients are all generated and ranked.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT *, concat_ws(':', coalesce(doc_id::VARCHAR, ''), digest,
    row_number() OVER (PARTITION BY doc_id, source, size, digest) - 1) AS id
  FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
      ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS digest FROM documents)),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighed AS (SELECT *, ((rank - 1) % 3 + 1) AS weight, 3 * source_size AS cap FROM ranked),
filled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY cap / weight, rank) AS nth FROM weighed),
final AS (SELECT arg_min(level, nth) FILTER (level * weight < cap) AS level FROM filled),
targets AS (
  SELECT f.source, f.rank, f.source_size, coalesce(least(f.cap::DOUBLE, final.level * f.weight), f.cap::DOUBLE) AS target,
    greatest(1, least(256, floor(sum(source_size) OVER () / (count(*) OVER () * 1024))))::BIGINT AS block_words,
    greatest(1, ceil(source_size / 1048576))::BIGINT AS shards
  FROM filled f, final),
dealt AS (
  SELECT s.doc_id, s.size, s.id, t.*, ('0x' || substr(md5(s.id), 1, 8))::BIGINT % t.shards AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shard AS (
  SELECT rank, shard, sum(size)::BIGINT AS words, greatest(1, round(sum(size) / any_value(block_words)))::BIGINT AS blocks,
    any_value(target) AS target, any_value(source_size) AS source_size
  FROM dealt GROUP BY rank, shard HAVING sum(size) > 0),
by_source AS (
  SELECT rank, any_value(target) * sum(blocks) / any_value(source_size) AS wanted, sum(blocks) * 3 AS most FROM shard GROUP BY rank),
seats AS (SELECT round(sum(wanted))::BIGINT AS n FROM by_source),
source_quota AS (
  SELECT rank, count(*) AS quota FROM (
    SELECT rank, row_number() OVER (ORDER BY wanted / (2 * k - 1) DESC, rank) AS place
    FROM (SELECT rank, wanted, unnest(generate_series(1, most::BIGINT)) AS k FROM by_source)) WHERE place <= (SELECT n FROM seats) GROUP BY rank),
shard_quota AS (
  SELECT rank, shard, any_value(words) AS words, any_value(blocks) AS blocks, count(*) FILTER (place <= quota) AS quota FROM (
    SELECT k.*, q.quota, row_number() OVER (PARTITION BY k.rank ORDER BY k.blocks / (2 * k.k - 1) DESC, k.shard) AS place
    FROM (SELECT rank, shard, words, blocks, unnest(generate_series(1, blocks * 3)) AS k FROM shard) k JOIN source_quota q USING (rank))
  GROUP BY rank, shard),
placed AS (
  SELECT d.doc_id, d.size, d.source_size, d.target, d.rank, d.shard, q.words, q.blocks, q.quota,
    row_number() OVER w AS nth, sum(d.size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
  FROM dealt d LEFT JOIN shard_quota q USING (rank, shard)
  WINDOW w AS (PARTITION BY d.rank, d.shard ORDER BY md5('7:' || d.id), d.id)),
block AS (
  SELECT rank, shard, b, floor(b * words / blocks) AS low, floor((b + 1) * words / blocks) AS high,
    quota // blocks + CASE WHEN row_number() OVER (PARTITION BY rank, shard ORDER BY md5('7:' || rank || ':' || shard || ':' || b), b) <= quota % blocks THEN 1 ELSE 0 END AS times
  FROM (SELECT *, unnest(generate_series(0, blocks - 1)) AS b FROM shard_quota)),
taken AS (
  SELECT p.rank, p.shard, p.nth, sum((least(p.stop, b.high) - greatest(p.stop - p.size, b.low)) * b.times) AS taken
  FROM placed p JOIN block b ON p.rank = b.rank AND p.shard = b.shard AND b.low < p.stop AND b.high > p.stop - p.size
  WHERE p.size > 0 GROUP BY p.rank, p.shard, p.nth)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p LEFT JOIN taken t USING (rank, shard, nth)
"""
