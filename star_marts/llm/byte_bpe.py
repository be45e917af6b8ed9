"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a piece has exactly one token that can end its encoding: a token that encodes to
itself, is a suffix of the prefix, and may follow the last token of what is before it.  Storing
that token for each prefix makes an append exact without looking back further than the longest
token, and after an edit only the bytes until the stored tokens agree again are encoded anew.

Texts are split by a pattern first and each match is encoded by itself; a match that is a token as
a whole is that token.  Ranks come from a public file whose path is a parameter.

Defined cases: a null text is empty and has no ids; long texts and matches are encoded whole, in
time linear in their bytes; repeated rows each give a row; an empty table gives no rows; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from star_marts.llm.common import text_batches, whole_text

RANKS = "byte_bpe_multi_50k.tiktoken"
_KNOWN_PIECES = 1_000_000  # pieces a worker remembers before it starts anew
_KNOWN_PAIRS = 1_000_000  # and pairs of tokens


class Encoder:
    """Ranks, and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.longest = max(map(len, ranks))
        # Every end of a token, and the token if it is one: longer ends are not looked for.
        self.ending = dict.fromkeys((t[i:] for t in ranks for i in range(1, len(t))), -1) | ranks
        self.pairs: dict[tuple[int, int], bool] = {}
        self._own: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """The definition: merge the neighbours of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank, none = self.ranks.get, 1 << 60
        joined = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while joined and (least := min(joined)) < none:
            i = joined.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joined[i]
            if i:
                joined[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(joined):
                joined[i] = rank(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def reaches_itself(self, token: int) -> bool:
        known = self._own.get(token)
        if known is None:
            known = self._own[token] = self.merged(self.tokens[token]) == [token]
        return known

    def may_follow(self, first: int, second: int) -> bool:
        """Whether both, as they are, are the encoding of their bytes."""
        if len(self.pairs) >= _KNOWN_PAIRS:
            self.pairs.clear()
        both = self.merged(self.tokens[first] + self.tokens[second])
        known = self.pairs[first, second] = both == [first, second]
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else Prefixes(self, piece).ids()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """The last token of every prefix of one piece."""

    def __init__(self, encoder: Encoder, piece: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Encode `more` after what is there: for each new prefix the one token that can end it."""
        done, self.data = len(self.data), self.data + more
        data, last, encoder = self.data, self.last, self.encoder
        ending, pairs = encoder.ending.get, encoder.pairs.get
        for end in range(done + 1, len(data) + 1):
            for start in range(end - 1, -1, -1):
                token = ending(data[start:end])
                if token is None:
                    raise ValueError("a byte has no token")
                if token < 0:
                    continue
                if not start:
                    if encoder.reaches_itself(token):
                        break
                else:
                    fits = pairs((last[start - 1], token))
                    if encoder.may_follow(last[start - 1], token) if fits is None else fits:
                        break
            last.append(token)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes start .. end by `new`; returns how many prefixes were computed."""
        tail, known = self.data[end:], self.last[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(new)
        agree = 0
        for i, token in enumerate(known):
            # A token depends on those up to the longest token before it, and on its own bytes.
            if agree >= self.encoder.longest:
                self.data += tail[i:]
                self.last += known[i:]
                return len(new) + i
            self.append(tail[i : i + 1])
            agree = agree + 1 if self.last[-1] == token else 0
        return len(new) + len(known)

    def ids(self) -> list[int]:
        whole = self.encoder.ranks.get(self.data)
        if whole is not None:
            return [whole]
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.encoder.tokens[out[-1]])
        return out[::-1]


class TextEncoder:
    """Whole texts, remembering the ids of pieces seen before."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.encoder = Encoder({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})
        self.names = [b"%d" % i for i in range(len(self.encoder.tokens))]
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def _ids(self, piece: str) -> tuple[int, ...]:
        if len(self.known) >= _KNOWN_PIECES:
            self.known.clear()
        ids = self.known[piece] = tuple(self.encoder.encode(piece.encode()))
        return ids

    def encode(self, text: str) -> list[int]:
        known, ids = self.known.get, self._ids
        return list(chain.from_iterable([known(p) or ids(p) for p in self.split(text)]))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal with commas, SHA-256 of what they decode to."""
        ids = self.encode(text)
        written = b",".join(map(self.names.__getitem__, ids))
        decoded = self.encoder.decode(ids)
        return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded).hexdigest()


@cache
def text_encoder(path: str | None = None, pattern: str | None = None) -> TextEncoder:
    """One encoder per process; without a path, the installed file."""
    return TextEncoder(path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids, one array per document."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            ids = pa.array([encoder.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and data, the bytes of each row's ids; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path).encoder
        for batch in batches:
            data = pa.array([encoder.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; ids stay where they are made."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            rows = [encoder.digest(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_DIGEST_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], _DIGEST_NAMES)

    return _rows(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


_DIGEST_TYPES = (pa.int64(), pa.string(), pa.string())
_DIGEST_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
