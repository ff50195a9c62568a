"""Byte-level BPE encoding and decoding with a given table of ranks.

Bytes are mapped to the characters of the same number (Latin-1) so that one
Aho-Corasick automaton over the vocabulary finds, for every position of a piece, the
longest token that starts there. Encoding takes the longest token and steps back to a
shorter one whenever two neighbours could not stand side by side after the merges; that
test is memoised by pair, and a position found hopeless is never tried again, so a piece
costs time linear in its length. The result is that of applying the merges by rank.

A piece is a match of the pattern and is encoded on its own; a piece that is itself a
token is that token. Texts are cut at single spaces first and the ids of a space with its
word are remembered: the pattern must let a match begin at a space before a non-space and
never run across one, as those of the public rank files do. Where other white space
touches a space, the whole text goes through the pattern at once. Null texts count as empty and give no ids. All other columns are
carried along unchanged.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from riskgraph.llm.common import map_batches, utf8

#: Entries of the word and pair caches (words are at most LONG_WORD characters): some tens of MB a worker.
WORDS_KEPT = 100_000
PAIRS_KEPT = 200_000
LONG_WORD = 64


class _Crossing(Exception):
    """White space touches a space: a match may run over the place where the text was cut."""


class _Words(dict):
    """Packed ids of a space and the word behind it; what is missing is encoded, and kept if it is short.

    Full, it becomes the older generation; words still in use move from there to the new one.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def age(self) -> None:
        self.older = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if not word or word[0].isspace() or word[-1].isspace():
                raise _Crossing
            ids = self.codec.whole(" " + word)
        if len(word) < LONG_WORD:
            self[word] = ids
        return ids


class _Pairs(dict):
    """Whether two tokens (left << 24 | right) can be neighbours, found out once."""

    def __init__(self, stand):
        super().__init__()
        self.stand = stand

    def __missing__(self, pair: int) -> bool:
        known = self[pair] = self.stand(pair >> 24, pair & 0xFFFFFF)
        return known


class Codec:
    """Encoder and decoder of one vocabulary; built once in each Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split_text = regex.compile(pattern).findall
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.pairs = _Pairs(self._stand)
        self.words = _Words(self)
        self.packed = {i: int(i).to_bytes(4, "little") for i in ranks.values()}
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.size = {i: len(b) for b, i in ranks.items()}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1 or self._take_apart(token, i):
                self.automaton.add_word(token.decode("latin-1"), i)
            else:
                continue  # no sequence of merges ends in it: only a whole piece can be this token
            self.shorter[i] = None
        self.automaton.make_automaton()
        for i in self.shorter:
            token = self.bytes_of[i]
            self.shorter[i] = next(
                (j for k in range(len(token) - 1, 0, -1)
                 if (j := ranks.get(token[:k])) is not None and j in self.shorter), None)
        self.pairs.clear()  # answers found while only a part of the merges was known

    def _take_apart(self, token: bytes, i: int) -> bool:
        for k in range(1, len(token)):
            left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
            if left is None or right is None or left >= i or right >= i:
                continue
            if self._stand(left, right):
                self.parts[i] = (left, right)
                self.joined[left, right] = i
                return True
        return False

    def _stand(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side.

        The merges are undone from the later of the two, piece by piece along the seam; if
        some pair across the seam would have been merged before the step that is undone,
        the two tokens can't both have come about.
        """
        before = 1 << 60
        while True:
            merged = self.joined.get((left, right))
            if merged is not None and merged < before:
                return False
            if left > right and left in self.parts:
                before, left = left, self.parts[left][1]
            elif right in self.parts:
                before, right = right + 1, self.parts[right][0]
            elif left in self.parts:
                before, left = left, self.parts[left][1]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece: longest matches, a shorter one where two neighbours clash, a step back
        where there is none. A run of longest matches without a clash is taken in one scan."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        text = piece.decode("latin-1")
        scan, fits, size, shorter = self.automaton.iter_long, self.pairs, self.size, self.shorter
        n, at, out, hopeless = len(text), 0, [], set()
        while at < n:
            for _, token in scan(text, at):
                if hopeless or out and not fits[out[-1] << 24 | token]:
                    break
                out.append(token)
                at += size[token]
            else:
                return out
            while token is not None and (at + size[token] in hopeless or out and not fits[out[-1] << 24 | token]):
                token = shorter[token]
                while token is None:
                    hopeless.add(at)
                    last = out.pop()
                    at -= size[last]
                    token = shorter[last]
            out.append(token)
            at += size[token]
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.words) > WORDS_KEPT:
            self.words.age()
        if len(self.pairs) > PAIRS_KEPT:
            self.pairs.clear()
        head, *tail = text.split(" ")
        if not head or head[0].isspace() or head[-1].isspace():
            return self.whole(text)
        try:
            return self.whole(head) + b"".join(map(self.words.__getitem__, tail))
        except _Crossing:
            return self.whole(text)

    def whole(self, text: str) -> bytes:
        return b"".join([self.packed[i] for p in self.split_text(text) for i in self.encode_piece(p.encode())])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(ranks_file: str, pattern: str) -> Codec:
    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Codec(ranks, pattern)


def _with_column(df: DataFrame, source: str, name: str, fn) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != name]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{name}` binary"

    def one(batch: pa.RecordBatch) -> dict:
        return {f.name: batch.column(f.name) for f in kept} | {name: fn(batch)}

    return map_batches(df, one, schema)


def encode(df: DataFrame, ranks_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the packed ids (little-endian unsigned 32-bit) of its texts, which must be a column of strings."""

    def one(batch: pa.RecordBatch) -> list[bytes]:
        c = codec(ranks_file, pattern)
        return [c.encode(t or "") for t in batch.column(text).to_pylist()]

    return _with_column(df, text, ids, one)


def decode(df: DataFrame, ranks_file: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the bytes of its packed ids."""

    def one(batch: pa.RecordBatch) -> list[bytes]:
        c = codec(ranks_file, pattern)
        return [c.decode(t or b"") for t in utf8(batch, ids)]

    return _with_column(df, ids, decoded, one)


def _round_trip(batch: pa.RecordBatch, ranks_file: str, pattern: str) -> tuple[list[bytes], list[bytes]]:
    """Packed ids and their decoded bytes for the texts of a batch, by one codec in one worker."""
    c = codec(ranks_file, pattern)
    ids = [c.encode(t or "") for t in batch.column("text").to_pylist()]
    return ids, [c.decode(i) for i in ids]


def token_digests(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, encoded and decoded again.

    Encoding and decoding run in one Arrow pass, so a task holds one Python worker and one codec.
    """
    def one(batch: pa.RecordBatch) -> dict:
        ids, decoded = _round_trip(batch, ranks_file, pattern)
        return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": decoded}

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = map_batches(texts, one, "doc_id long, ids binary, decoded binary")
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_ids(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decoded_equal): the packed ids, and whether they decode to the text.

    One Arrow pass encodes and decodes, so a task holds one Python worker and one codec.
    """
    def one(batch: pa.RecordBatch) -> dict:
        ids, decoded = _round_trip(batch, ranks_file, pattern)
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "source": batch.column("source"), "n_tokens": [len(i) // 4 for i in ids],
                "ids": ids, "decoded_equal": [d == t for d, t in zip(decoded, texts)]}

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("text").cast("string"))
    return map_batches(texts, one, "doc_id long, source string, n_tokens long, ids binary, decoded_equal boolean")
