"""Exact duplicates against a history kept as a minimal perfect hash.

The distinct digests of the history are dealt into buckets by their first bytes. In
each bucket a hash-and-displace function sends every digest to a slot of its own, with
as many slots as digests; the slots hold the full digest, the locator of the winner
(the largest id) and the number of rows. An arriving digest goes to its bucket, computes
its slot and is compared with the full 32 bytes there: equal means a repeat of the
history, anything else is new and forms groups of its own. Copies are counted before
they are dealt, so a text that fills a third of the table is one row to look up.

Null texts count as empty. A row without an id never wins against one with an id; rows
that repeat both id and text share one winner and are all marked as kept, `keep_winners`
leaves one of them. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskgraph.llm.common import map_batches, utf8
from riskgraph.session import materialise

BUCKET_KEYS = 8192
GROUP_KEYS = 4
INDEX_SCHEMA = "bucket long, n int, seed long, moves binary, digests binary, winners binary, counts binary"


def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row: SHA-256 of the text with A-Z lower-cased."""

    def one(batch: pa.RecordBatch) -> dict:
        return {
            "doc_id": batch.column("doc_id"),
            "digest": [hashlib.sha256(t.lower()).digest() for t in utf8(batch)],
        }

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), one,
                       "doc_id long, digest binary")


def _words(digests: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three independent numbers per digest (rows of 32 bytes); another seed gives others."""
    w = digests.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    w = (w ^ (w >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    w ^= w >> np.uint64(29)
    return w[:, 1], w[:, 2], w[:, 3]


def _place(group, first, step, move, n):
    """Slot of a digest whose group was moved by `move` = turn * n + shift."""
    turn, shift = move // n, move % n
    return (first % n + turn * (step % n) + shift) % n


def build_slots(digests: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, moves by group, slot by digest) of distinct digests, shape (n, 32), n > 0.

    Groups of about four digests are placed largest first; a group takes the first move
    that puts all of its digests on free slots.
    """
    n = len(digests)
    m = -(-n // GROUP_KEYS)
    for seed in range(1 << 16):
        a, first, step = _words(digests, seed)
        group = (a % np.uint64(m)).astype(np.int64)
        first, step = (first % np.uint64(n)).astype(np.int64), (step % np.uint64(n)).astype(np.int64)
        moves, slots = np.zeros(m, np.int64), np.zeros(n, np.int64)
        free = np.ones(2 * n, bool)
        order = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[order], np.arange(m + 1))
        placed = True
        for g in np.argsort(-np.diff(ends), kind="stable"):
            members = order[ends[g]:ends[g + 1]]
            if not len(members):
                break
            for turn in range(n):
                base = (first[members] + turn * step[members]) % n
                if len(np.unique(base)) < len(base):
                    continue
                fits = free[base[0]:base[0] + n].copy()
                for b in base[1:]:
                    fits &= free[b:b + n]
                shift = int(fits.argmax())
                if fits[shift]:
                    at = (base + shift) % n
                    free[at] = free[at + n] = False
                    moves[g], slots[members] = turn * n + shift, at
                    break
            else:
                placed = False
                break
        if placed:
            return seed, moves, slots
    raise RuntimeError("no perfect hash found: are the digests distinct?")


def find_slots(digests: np.ndarray, n: int, seed: int, moves: np.ndarray) -> np.ndarray:
    a, first, step = _words(digests, seed)
    group = (a % np.uint64(len(moves))).astype(np.int64)
    first, step = (first % np.uint64(n)).astype(np.int64), (step % np.uint64(n)).astype(np.int64)
    return _place(group, first, step, moves[group], n)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d) for d in column), np.uint8).reshape(-1, 32)


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(rows["digest"])
    seed, moves, slots = build_slots(digests)
    back = np.empty(len(slots), np.int64)
    back[slots] = np.arange(len(slots))
    winners = rows["winner"].fillna(np.iinfo(np.int64).min).to_numpy(np.int64) if rows["winner"].isna().any() \
        else rows["winner"].to_numpy(np.int64)
    return pd.DataFrame({
        "bucket": [key[0]], "n": [len(slots)], "seed": [seed], "moves": [moves.tobytes()],
        "digests": [digests[back].tobytes()], "winners": [winners[back].tobytes()],
        "counts": [rows["n"].to_numpy(np.int64)[back].tobytes()],
    })


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The perfect hash of `history` (digest, n, winner; digests distinct), one row per bucket."""
    return history.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(_build, INDEX_SCHEMA)


def _bucket(buckets: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint"), F.lit(buckets))


_NO_ID = np.iinfo(np.int64).min


def _look_up(key: tuple, index: pd.DataFrame, arrivals: pd.DataFrame) -> pd.DataFrame:
    """The slots with what arrived added, and the arrivals that are in no slot (known = false)."""
    out = []
    new = np.ones(len(arrivals), bool)
    arrived = arrivals["winner"].astype("Int64").fillna(_NO_ID).to_numpy(np.int64)
    if len(index):
        row = index.iloc[0]
        n = int(row["n"])
        held = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
        winners, counts = np.frombuffer(row["winners"], np.int64).copy(), np.frombuffer(row["counts"], np.int64).copy()
        if len(arrivals):
            digests = _matrix(arrivals["digest"])
            slots = find_slots(digests, n, int(row["seed"]), np.frombuffer(row["moves"], np.int64))
            new = ~(held[slots] == digests).all(axis=1)
            np.add.at(counts, slots[~new], arrivals["n"].to_numpy(np.int64)[~new])
            np.maximum.at(winners, slots[~new], arrived[~new])
        out.append(pd.DataFrame({"digest": [d.tobytes() for d in held], "winner": winners, "n": counts, "known": True}))
    if new.any():
        out.append(pd.DataFrame({"digest": arrivals["digest"][new], "winner": arrived[new], "n": arrivals["n"][new], "known": False}))
    return pd.concat(out)[["digest", "winner", "n", "known"]]


def summarise(rows: DataFrame) -> DataFrame:
    """(digest, n, winner) of digest rows."""
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("winner"))


def group_digests(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) over the digest rows of both tables."""
    known, arrived = materialise(summarise(history)), materialise(summarise(arrivals))
    buckets = max(1, -(-known.count() // BUCKET_KEYS))
    index = materialise(build_index(known, buckets))
    found = index.groupBy("bucket").cogroup(arrived.withColumn("bucket", _bucket(buckets)).groupBy("bucket")).applyInPandas(
        _look_up, "digest binary, winner long, n long, known boolean")
    found = materialise(found)
    fresh = found.where("not known").groupBy("digest").agg(F.max("winner").alias("winner"), F.sum("n").alias("n"))
    return found.where("known").select("digest", "winner", "n").unionByName(fresh).select(
        "digest", F.when(F.col("winner") > F.lit(_NO_ID), F.col("winner")).alias("keep_id"), F.col("n").alias("group_size"))


def exact_duplicates(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of both tables."""
    old, new = materialise(digest_rows(history)), materialise(digest_rows(arrivals))
    groups = group_digests(old, new)
    return old.unionByName(new).join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table as history (ids in the lower half of the range) and arrivals (all other rows)."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = F.coalesce(F.col("doc_id") <= F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    return docs.where(middle), docs.where(~middle)


def keep_winners(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; one row of those that repeat id and text."""
    marks = materialise(exact_duplicates(*halves(docs)))
    kept = marks.where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_same"))
    ids = kept.groupBy("doc_id").agg(F.max("_same").alias("_same"), F.count(F.lit(1)).alias("_texts"))
    dropped_too = marks.where("not kept").select("doc_id").distinct().withColumn("_mixed", F.lit(True))
    ids = ids.join(dropped_too, "doc_id", "left")
    found = docs.join(ids.withColumnRenamed("doc_id", "_kept_id"), F.col("doc_id").eqNullSafe(F.col("_kept_id"))).drop("_kept_id")
    plain = (F.col("_same") == 1) & (F.col("_texts") == 1) & F.col("_mixed").isNull()
    once = found.where(plain).select(*docs.columns)
    # an id that stands on several rows: its text decides which of them stay
    again = found.where(~plain).withColumn("_sha", F.sha2(_normal("text"), 256))
    again = again.join(kept.select(F.col("doc_id").alias("_k"), F.col("text_sha256").alias("_sha")), "_sha", "left_semi") \
        .dropDuplicates(["doc_id", "_sha"]).select(*docs.columns)
    return once.unionByName(again)


def _normal(column: str):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.col(column), F.lit("")), upper, upper.lower())
