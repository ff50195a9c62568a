"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints at most three bits apart meet in a point that is close to both, so each
fingerprint emits the points within half the radius and only what meets is compared.
Half of three is not whole, and the two sides of a pair at an odd distance differ in
parity. So the points are those of even parity: a fingerprint of even parity emits itself
and all points two bits away (rounded up), one of odd parity the points one bit away
(rounded down). Every pair at distance one, two or three has a point in common.

All points of one fingerprint share most of their bits, so they travel together: the 64
bits are cut into groups whose parities are the key of a point, a fingerprint is sent once
to each key that its points have, and the task of the key writes the points out in
numpy, sorts them and links what meets. Those who meet in a point are never paired with
each other: all of them that lie one bit from it, and the point itself, are within three
bits of everything there, so one of them stands for the rest (a star). Fingerprints two
bits from the point are linked through it only if such a hub is there; two of them without
one meet again at a centre if they are close. Each link is verified by its distance.

Null and empty texts have fingerprint zero and are linked like any other. A row without
an id gets a component but lends it no id. Rows that repeat an id each get a row. An empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskgraph.llm.common import map_batches, utf8
from riskgraph.operators.components import connected_components
from riskgraph.session import materialise

SEED = 42
#: Points that a task of the average key writes out, and at most at a time.
POINTS_PER_KEY = 1 << 20
POINTS_AT_ONCE = 1 << 22
POINTS_OF_EVEN = 1 + 64 * 63 // 2


def fingerprint(text: bytes, words: int = 3) -> int:
    """64 bits: those set in more than half of the hashes of the text's shingles."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at:at + 8192].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""

    def one(batch: pa.RecordBatch) -> dict:
        prints = np.array([fingerprint(t, words) for t in utf8(batch)], dtype=np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": prints.view(np.int64)}

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), one, "doc_id long, fp long")


def _groups(bits: int) -> list[list[int]]:
    """The 64 bit positions dealt into `bits` groups; the parity of a group is a bit of the key."""
    return [list(range(g, 64, bits)) for g in range(bits)]


def _keys(prints: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(prints), np.int64)
    for g, group in enumerate(_groups(bits)):
        mask = np.uint64(sum(1 << b for b in group))
        out |= (np.bitwise_count(prints & mask) & 1).astype(np.int64) << g
    return out


def _moves(bits: int) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """By change of the key, the bits to flip: for fingerprints of even parity and of odd parity."""
    group = {b: g for g, members in enumerate(_groups(bits)) for b in members}
    even: dict[int, list[int]] = {0: [0]}
    for a, b in combinations(range(64), 2):
        even.setdefault((1 << group[a]) ^ (1 << group[b]), []).append((1 << a) | (1 << b))
    odd: dict[int, list[int]] = {}
    for a in range(64):
        odd.setdefault(1 << group[a], []).append(1 << a)
    return tuple({k: np.array(v, np.uint64) for k, v in side.items()} for side in (even, odd))


def _deal(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for every key that a fingerprint has points in."""
    keys = _keys(prints, bits)
    is_odd = (np.bitwise_count(prints) & 1).astype(bool)
    out_keys, out_prints = [], []
    for side, chosen in zip(_moves(bits), (~is_odd, is_odd)):
        for change in side:
            out_keys.append(keys[chosen] ^ change)
            out_prints.append(prints[chosen])
    return np.concatenate(out_keys), np.concatenate(out_prints)


def _links(key: int, prints: np.ndarray, bits: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over what meets in the points of `key` (those of one part by hash)."""
    change = _keys(prints, bits) ^ key
    is_odd = (np.bitwise_count(prints) & 1).astype(bool)
    points, owners = [], []
    for side, chosen in zip(_moves(bits), (~is_odd, is_odd)):
        for c, flips in side.items():
            of = np.flatnonzero(chosen & (change == c))
            if len(of):
                at = (prints[of][:, None] ^ flips[None, :]).ravel()
                own = np.repeat(of, len(flips))
                if parts > 1:
                    here = (at * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts) == np.uint64(part)
                    at, own = at[here], own[here]
                points.append(at)
                owners.append(own)
    if not points:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    at, own = np.concatenate(points), np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    at, own = at[order], own[order]
    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[begins, len(at)])
    several = np.repeat(sizes > 1, sizes)
    at, own = at[several], own[several]
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[begins, len(at)])
    member = prints[own]
    near = np.bitwise_count(member ^ at) <= 1  # can stand for the others
    hub_at = np.minimum.reduceat(np.where(near, np.arange(len(at)), len(at)), begins)
    hub_at = np.repeat(hub_at, sizes)
    found = hub_at < len(at)
    a, b = member[hub_at[found]], member[found]
    real = (a != b) & (np.bitwise_count(a ^ b) <= 3)
    pairs = np.unique(np.stack([np.minimum(a, b)[real], np.maximum(a, b)[real]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _meet(bits: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["fp"].to_numpy(np.int64).view(np.uint64)
        parts = 1 + len(prints) * (POINTS_OF_EVEN // 16 if bits >= 6 else POINTS_OF_EVEN) // POINTS_AT_ONCE
        a, b = zip(*(_links(int(key[0]), prints, bits, p, parts) for p in range(parts)))
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return run


def close_links(prints: DataFrame, bits: int | None = None) -> DataFrame:
    """(a, b), a < b as unsigned numbers: links whose components are those of "at most three bits apart".

    `prints` has distinct fingerprints in `fp`. `bits` sets the number of keys, 2 ** bits.
    """
    if bits is None:
        total = prints.count() * POINTS_OF_EVEN // 2
        bits = min(24, max(1, (total // POINTS_PER_KEY).bit_length()))

    def deal(batch: pa.RecordBatch) -> dict:
        keys, owners = _deal(batch.column("fp").to_numpy().view(np.uint64), bits)
        return {"key": keys, "fp": owners.view(np.int64)}

    dealt = map_batches(prints.select("fp"), deal, "key long, fp long")
    return dealt.groupBy("key").applyInPandas(_meet(bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): the component is named by its smallest doc_id."""
    rows = materialise(fingerprints(docs, words))
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = materialise(close_links(prints))
    roots = materialise(
        prints.join(connected_components(links, "a", "b").withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    names = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(roots.join(names, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """One row of each group of near-duplicates stays, with all its columns: that of the smallest doc_id.

    Rows are numbered and grouped by number, so two rows with one id but different texts
    are judged apart. Ties (repeated rows, or one id in a group twice) go to the smaller
    row number; a row without id loses to any row with one, and of a group of rows without
    ids one stays.
    """
    numbered = materialise(docs.withColumn("_row", F.monotonically_increasing_id()))
    found = materialise(near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "text"), words))
    rows = found.select(F.col("doc_id").alias("_row"), "component_id").join(numbered.select("_row", "doc_id"), "_row")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    winners = rows.groupBy("component_id").agg(F.min(rank)["_row"].alias("_row"))
    return numbered.join(winners, "_row").select(*docs.columns)
