"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash of the text without blanks.  The key's upper bits name the owner, a
range of keys that one task processes; its lower bits lead through the owner's directory to a
bucket.  An overfull bucket splits by one more bit, and the directory doubles where the bucket
already used all of its bits.  Texts of one key are chained and told apart by their bytes.  The
index is a Parquet table in the shared folder: every distinct text once, with its bucket, its
place in the chain, how many rows have it and which of them stays.  More documents are added by
`build(..., earlier=path)`.

Copies are combined before anything moves, in each task, and for keys with more than a thousandth
of all rows once more over salted tasks, so no owner meets a text more often than there are
tasks.  The number of owners follows the bytes of the texts: a task holds the distinct texts of
one range.  A directory has at most 2^16 slots; a bucket that would need more grows instead.

Documents find their class by key and SHA-256; different bytes of one key and digest are an error.

Defined cases: a null text is empty, and all empty texts are one class; of equal texts the row with
the most code points stays, then the one with the smallest doc_id, null last; of rows equal in
that too any one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from star_marts.llm.common import spread_join, whole_text
from star_marts.session import scratch_path, stage

BLANKS = r"[\x20\x09-\x0D]+"  # fixed value: what equality passes over
OWNER_BYTES = 32 << 20  # of texts, in one key range
BUCKET_KEYS = 64
MOST_DEPTH = 16  # of a directory
_HELD_BYTES = 32 << 20  # of texts that a task combines at once
_FEW_COPIES = 1000  # of one key, that need no salted round
_SALTS = 32
_ENTRY = "key long, text binary, chars long, doc_id long, copies long"
_BATCH_BYTES = 8 << 20


def content(text: Column) -> Column:
    """The text without blanks."""
    return F.regexp_replace(text, BLANKS, "")


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _rows(docs: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """key, text, chars, doc_id of every document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.length(whole_text()).cast("long").alias("chars"),
        content(whole_text()).alias("text"),
    )
    return rows.select(key(F.col("text")).alias("key"), "text", "chars", "doc_id")


def members(docs: DataFrame, key: Callable[[Column], Column] = text_key) -> DataFrame:
    """row, doc_id, chars, key, sha256 and bytes of every document, stored; texts are left behind."""
    return stage(
        _rows(docs, key).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "chars", "key",
            F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
            F.octet_length("text").cast("long").alias("bytes"),
        ),
        "members",
    )


# --- entries: a text, how many rows have it, and the one that stays -----------------------


def _stays(chars: int, doc: int | None) -> tuple:
    """The least of these stays."""
    return -chars, doc is None, doc or 0


class Entry:
    __slots__ = ("text", "chars", "doc", "copies")

    def __init__(self, text: bytes, chars: int, doc: int | None, copies: int):
        self.text, self.chars, self.doc, self.copies = text, chars, doc, copies

    def add(self, chars: int, doc: int | None, copies: int) -> None:
        self.copies += copies
        if _stays(chars, doc) < _stays(self.chars, self.doc):
            self.chars, self.doc = chars, doc


def chained(chain: list[Entry], text: bytes, chars: int, doc: int | None, copies: int) -> bool:
    """Add a text to the chain of its key; whether it is a new one there."""
    for entry in chain:
        if entry.text == text:
            entry.add(chars, doc, copies)
            return False
    if chain and hashlib.sha256(text).digest() in {hashlib.sha256(e.text).digest() for e in chain}:
        raise ValueError("different texts with one SHA-256")
    chain.append(Entry(text, chars, doc, copies))
    return True


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes; `size` is the place of the text."""
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += len(row[size])
        if held_bytes > _BATCH_BYTES or len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_ENTRIES = pa.schema([
    ("key", pa.int64()), ("text", pa.binary()), ("chars", pa.int64()), ("doc_id", pa.int64()),
    ("copies", pa.int64()), ("part", pa.int64()),
])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per text, as far as the texts held at once go."""
    part = TaskContext.get().partitionId()
    chains: dict[int, list[Entry]] = {}
    held = 0

    def given() -> Iterator[tuple]:
        for key, chain in chains.items():
            for e in chain:
                yield key, e.text, e.chars, e.doc, e.copies, part

    for batch in batches:
        for key, text, chars, doc, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if chained(chains.setdefault(key, []), text, chars, doc, copies):
                held += len(text)
        if held > _HELD_BYTES:
            yield from _batches(given(), _ENTRIES, 1)
            chains.clear()
            held = 0
    yield from _batches(given(), _ENTRIES, 1)


def _entries(docs: DataFrame, hot: DataFrame | None, key: Callable[[Column], Column]) -> DataFrame:
    """Entries of all documents, copies combined before they move."""
    schema = f"{_ENTRY}, part long"
    rows = _rows(docs, key).select("key", F.col("text").cast("binary").alias("text"), "chars", "doc_id", F.lit(1).cast("long").alias("copies"))
    if hot is None:
        return rows.mapInArrow(_combine, schema).drop("part")
    usual = rows.join(F.broadcast(hot), "key", "left_anti").mapInArrow(_combine, schema).drop("part")
    partly = rows.join(F.broadcast(hot), "key", "left_semi").mapInArrow(_combine, schema)
    salted = partly.repartition("key", F.pmod("part", F.lit(_SALTS))).drop("part")
    return usual.unionByName(salted.mapInArrow(_combine, schema).drop("part"))


# --- the index ---------------------------------------------------------------------------


class Bucket:
    __slots__ = ("depth", "prefix", "chains")

    def __init__(self, depth: int, prefix: int):
        self.depth, self.prefix = depth, prefix
        self.chains: dict[int, list[Entry]] = {}


class Directory:
    """Extendible hashing over the lower bits of the keys of one owner."""

    def __init__(self, bucket_keys: int = BUCKET_KEYS, most_depth: int = MOST_DEPTH):
        self.depth, self.slots = 0, [Bucket(0, 0)]
        self.bucket_keys, self.most_depth = bucket_keys, most_depth

    def bucket(self, key: int) -> Bucket:
        return self.slots[key & ((1 << self.depth) - 1)]

    def add(self, key: int, text: bytes, chars: int, doc: int | None, copies: int) -> None:
        bucket = self.bucket(key)
        while key not in bucket.chains and len(bucket.chains) >= self.bucket_keys and bucket.depth < self.most_depth:
            self._split(bucket)
            bucket = self.bucket(key)
        chained(bucket.chains.setdefault(key, []), text, chars, doc, copies)

    def _split(self, full: Bucket) -> None:
        if full.depth == self.depth:
            self.slots += self.slots
            self.depth += 1
        bit = 1 << full.depth
        pair = Bucket(full.depth + 1, full.prefix), Bucket(full.depth + 1, full.prefix | bit)
        for key, chain in full.chains.items():
            pair[bool(key & bit)].chains[key] = chain
        for slot in range(full.prefix, len(self.slots), bit):
            self.slots[slot] = pair[bool(slot & bit)]

    def buckets(self) -> Iterator[Bucket]:
        return (b for slot, b in enumerate(self.slots) if slot == b.prefix)


_INDEX = pa.schema([
    ("owner", pa.int64()), ("directory_depth", pa.int32()), ("bucket", pa.int64()), ("bucket_depth", pa.int32()),
    ("key", pa.int64()), ("place", pa.int32()), ("text", pa.binary()), ("sha256", pa.string()),
    ("chars", pa.int64()), ("keep_id", pa.int64()), ("copies", pa.int64()),
])
_INDEX_SCHEMA = (
    "owner long, directory_depth int, bucket long, bucket_depth int, key long, place int, text binary, "
    "sha256 string, chars long, keep_id long, copies long"
)


def _index_rows(owner: int, directory: Directory) -> Iterator[tuple]:
    for bucket in directory.buckets():
        for key, chain in bucket.chains.items():
            for place, e in enumerate(chain):
                yield (owner, directory.depth, bucket.prefix, bucket.depth, key, place, e.text,
                       hashlib.sha256(e.text).hexdigest(), e.chars, e.doc, e.copies)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of each owner, from entries in the order of owner and key."""
    now, directory = None, Directory()
    for batch in batches:
        for owner, key, text, chars, doc, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if owner != now:
                if now is not None:
                    yield from _batches(_index_rows(now, directory), _INDEX, 6)
                now, directory = owner, Directory()
            directory.add(key, text, chars, doc, copies)
    if now is not None:
        yield from _batches(_index_rows(now, directory), _INDEX, 6)


def build(
    docs: DataFrame, path: str, known: DataFrame | None = None, earlier: str | None = None,
    key: Callable[[Column], Column] = text_key,
) -> DataFrame:
    """Write the index of the documents, and of an earlier index, to `path`; the stored index.

    `known` are the `members` of the documents, if they are at hand.
    """
    spark = docs.sparkSession
    rows = members(docs, key) if known is None else known
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    total, size = counts.agg(F.sum("n"), F.sum("bytes")).first()
    hot = None
    if total:
        hot = counts.filter(F.col("n") > max(_FEW_COPIES, total // 1000)).select("key")  # under 1000 keys
        hot = None if hot.isEmpty() else hot
    entries = _entries(docs, hot, key)
    size = size or 0
    if earlier is not None:
        old = spark.read.parquet(earlier)
        size += old.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        entries = entries.unionByName(old.select("key", "text", "chars", F.col("keep_id").alias("doc_id"), "copies"))
    bits = max(0, (size // OWNER_BYTES).bit_length())
    owner = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    tasks = max(1 << min(bits, 14), int(spark.conf.get("spark.sql.shuffle.partitions")))
    owned = entries.select(owner.alias("owner"), "key", "text", "chars", "doc_id", "copies")
    dealt = owned.repartition(tasks, "owner").sortWithinPartitions("owner", "key")
    dealt.mapInArrow(_own, _INDEX_SCHEMA).write.parquet(path)
    return spark.read.schema(_INDEX_SCHEMA).parquet(path)


def directory_of(index: DataFrame) -> DataFrame:
    """owner, slot and bucket of every directory slot that leads to a bucket with texts."""
    buckets = index.select("owner", "directory_depth", "bucket", "bucket_depth").distinct()
    step, last = F.expr("shiftleft(1L, bucket_depth)"), F.expr("shiftleft(1L, directory_depth) - 1")
    return buckets.select("owner", F.explode(F.sequence("bucket", last, step)).alias("slot"), "bucket")


def assign(known: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for `members` of an index."""
    classes = index.select("key", "sha256", F.col("copies").alias("group_size"), F.col("chars").alias("keep_chars"), "keep_id")
    found = spread_join(known, classes, ["key", "sha256"], "group_size", ["row"])
    first_of = (F.col("chars") == F.col("keep_chars")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    found = stage(found.select("row", "doc_id", "keep_id", "group_size", "key", "sha256", first_of.alias("_first")), "found")
    # Rows equal in all that counts: the first of them.  Joined by its number, which is unique.
    stays = found.filter("_first").groupBy("key", "sha256").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("_stays"))
    return found.join(stays, "row", "left").select(
        "doc_id", "keep_id", "group_size", F.coalesce("_stays", F.lit(False)).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: Callable[[Column], Column] = text_key) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    known = members(docs, key)
    index = build(docs, scratch_path(docs.sparkSession, "exact-index"), known, key=key)
    return assign(known, index)


def stored_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX_SCHEMA).parquet(path)


ORACLE_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id::BIGINT AS doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
    count(*) OVER (PARTITION BY body) AS group_size
  FROM t WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM k
"""
