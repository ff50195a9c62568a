"""Personal data: fixed patterns, and identifiers found by bootstrapping their contexts.

E-mail addresses, IP addresses, card and phone numbers found by fixed patterns are the
seeds. The two words before a seed, and the word on either side of it, are lexical
patterns; those met with at least `MIN_SEEDS` different seeds are looked up in all texts,
with whatever word stands there. Patterns and words form a graph that Spark scores in
rounds: a pattern's confidence is the share of its places filled by known entities, weighted
by their scores; a word's score is the chance that one of its confident patterns is right
(noisy or). Patterns reach `CONFIDENCE` only if nearly all of their places hold personal
data, so ordinary words lend none. A word with a digit or an @ in a confident pattern and
with such a score is a new span, of kind `context`; seeds stay as they are.

Texts go through a filter of fixed size that holds the patterns; what it lets through by
mistake is removed by the join that follows. Places whose word has no digit and no @ and is
no part of a seed can never score: each batch only counts them by pattern. They bound what a
pattern can reach, and patterns whose bound is below `CONFIDENCE` leave the graph before it
is scored, which changes no result. A null text counts as empty. Rows that repeat
an id and text each get all spans. An empty table gives no rows; other columns are not
looked at. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskgraph.llm.common import map_batches, utf8
from riskgraph.session import materialise, materialise_with

KINDS = ("email", "ip", "card", "phone", "context")
MIN_SEEDS = 5
CONFIDENCE = 0.8
ROUNDS = 3
FILTER_BITS = 23

# Fixed patterns of the base entities. Possessive where nothing could be given back: a digit
# run starts and ends whole, so the matches are those of the plain patterns in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str):
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at) if begin < at else None
        if found:
            yield begin, found.end()
            free = found.end()
        at = text.find("@", max(free, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


class _Words:
    """Words of a text (white space apart) with their byte places, numbers and patterns."""

    def __init__(self, data: bytes):
        joined = np.frombuffer(data.lower(), np.uint8)
        space = (joined == 32) | ((joined >= 9) & (joined <= 13))
        edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
        self.begin, self.end = edge[::2], edge[1::2]
        self.n = len(self.begin)
        if self.n:
            value = (joined.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
            word_begin = np.r_[np.zeros(self.begin[0], np.int64), np.repeat(self.begin, np.diff(np.r_[self.begin, len(joined)]))]
            place = (np.arange(len(joined)) - word_begin).astype(np.uint64)
            value *= (place * np.uint64(2) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            value ^= value >> np.uint64(32)
            value[space] = 0
            self.name = np.add.reduceat(value, self.begin)

    def patterns(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word the pattern of the two before it, and of the one on either side."""
        edge = np.uint64(0x1234567)
        one = np.r_[edge, self.name[:-1]]
        two = np.r_[edge, one[:-1]]
        after = np.r_[self.name[1:], edge]
        mix = lambda a, b, c: _stir(_stir(a + np.uint64(c)) * np.uint64(3) + b)
        return mix(two, one, 1), mix(one, after, 2)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _code_points(data: bytes) -> np.ndarray:
    """Code points before each byte (and the end)."""
    return np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]


def _seed_word(words: _Words, points: np.ndarray, start: int, end: int) -> tuple[int, int]:
    """The words that a span touches: first and last."""
    begins = points[words.begin]
    first = int(np.searchsorted(begins, start, side="right")) - 1
    return max(0, first), max(0, int(np.searchsorted(begins, end, side="left")) - 1)


def _base(batch: pa.RecordBatch) -> dict:
    ids, hashes, spans, found = batch.column("doc_id").to_pylist(), [], [], []
    for data in utf8(batch):
        text = data.decode()
        base = base_spans(text)
        hashes.append(xxhash.xxh64_intdigest(data) - (1 << 63))
        spans.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
        seeds = []
        if base:
            words, points = _Words(data), _code_points(data)
            left, _ = words.patterns()
            one = np.r_[np.uint64(0x1234567), words.name[:-1]]
            for _, a, b in base:
                first, last = _seed_word(words, points, a, b)
                after = words.name[last + 1] if last + 1 < words.n else np.uint64(0x1234567)
                around = _stir(_stir(one[first:first + 1] + np.uint64(2)) * np.uint64(3) + after)[0]
                value = xxhash.xxh64_intdigest(text[a:b].encode()) - (1 << 63)
                seeds += [{"pattern": int(np.uint64(p).view(np.int64)), "value": value} for p in (left[first], around)]
        found.append(seeds)
    return {"doc_id": ids, "text_hash": hashes, "spans": spans, "seeds": found}


def base_table(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans, seeds): the fixed spans of every text and the patterns around them."""
    return map_batches(
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), _base,
        "doc_id long, text_hash long, spans array<struct<kind: int, start: long, end: long>>,"
        " seeds array<struct<pattern: long, value: long>>")


def pattern_filter(patterns: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A table of 2 ** bits bits with one set for each pattern; its size does not depend on the data."""
    spots = patterns.select(F.pmod("pattern", F.lit(1 << bits)).alias("spot")).groupBy(
        F.shiftright("spot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(spot % 64 as int)))").alias("bits"))
    table = np.zeros(1 << (bits - 6), np.int64)
    for r in spots.toLocalIterator():  # 2 ** (bits - 6) rows at most
        table[r["word"]] = r["bits"]
    return table


def mentions(docs: DataFrame, patterns: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(pattern, n, doc_id, text_hash, start, end, value, known, shaped): the places of every pattern.

    `known`: the word overlaps a fixed span; `shaped`: it has a digit or an @. A place that is
    neither has no row of its own: such places are counted, in rows with a null value and their number n.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pattern_filter(patterns, bits))

    def one(batch: pa.RecordBatch) -> dict:
        table = shared.value
        out = {k: [] for k in ("pattern", "n", "doc_id", "text_hash", "start", "end", "value", "known", "shaped")}
        plain = Counter()
        for doc_id, data in zip(batch.column("doc_id").to_pylist(), utf8(batch)):
            words = _Words(data)
            if not words.n:
                continue
            taken = None
            for pattern in words.patterns():
                spot = (pattern & np.uint64((1 << bits) - 1)).astype(np.int64)
                hit = np.flatnonzero(table[spot >> 6] >> (spot & 63) & 1)
                if not len(hit):
                    continue
                if taken is None:
                    points, text = _code_points(data), data.decode()
                    text_hash = xxhash.xxh64_intdigest(data) - (1 << 63)
                    taken = np.zeros(len(text) + 1, bool)
                    for _, a, b in base_spans(text):
                        taken[a:b] = True
                for i in hit:
                    a, b = int(points[words.begin[i]]), int(points[words.end[i]])
                    word = text[a:b]
                    name = int(pattern[i:i + 1].view(np.int64)[0])
                    known, shaped = bool(taken[a:b].any()), any(c.isdigit() or c == "@" for c in word)
                    if not (known or shaped):
                        plain[name] += 1
                        continue
                    out["pattern"].append(name)
                    out["n"].append(1)
                    out["doc_id"].append(doc_id)
                    out["text_hash"].append(text_hash)
                    out["start"].append(a)
                    out["end"].append(a + len(word.rstrip(".,;:!?")) or b)
                    out["value"].append(xxhash.xxh64_intdigest(word.rstrip(".,;:!?").encode()) - (1 << 63))
                    out["known"].append(known)
                    out["shaped"].append(shaped)
        out["pattern"] += plain.keys()
        out["n"] += plain.values()
        return {k: v + [None] * (len(out["n"]) - len(v)) for k, v in out.items()}

    places = map_batches(
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), one,
        "pattern long, n long, doc_id long, text_hash long, start long, end long, value long, known boolean, shaped boolean")
    return places.join(patterns.select("pattern"), "pattern", "left_semi")


def score_graph(places: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(confident patterns, scores of values) after some rounds over the counted graph."""
    named = places.where("value is not null")
    totals = materialise(places.groupBy("pattern").agg(
        F.sum("n").alias("total"), F.count("value").alias("possible")).where(F.col("possible") / F.col("total") >= confidence))
    edges = materialise(named.join(totals.select("pattern"), "pattern", "left_semi").groupBy("pattern", "value").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("known").cast("int")).alias("known"), F.max(F.col("shaped").cast("int")).alias("shaped")))
    scores = materialise(named.groupBy("value").agg(F.max(F.col("known").cast("double")).alias("score")))
    good = None
    for _ in range(rounds):
        # a value without a score adds to the total alone
        weighed = edges.join(scores.where("score > 0"), "value").groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("weight"))
        good = materialise(
            totals.join(weighed, "pattern").select("pattern", (F.col("weight") / F.col("total")).alias("confidence"))
            .where(F.col("confidence") >= confidence))
        miss = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        found = edges.join(good, "pattern").groupBy("value").agg(
            F.max("known").alias("known"), F.max("shaped").alias("shaped"), (1 - miss).alias("score"))
        better = found.select("value", F.when(F.col("known") == 1, 1.0).when(F.col("shaped") == 1, F.col("score")).otherwise(0.0).alias("new"))
        scores = materialise(scores.join(better, "value", "left").select("value", F.greatest("score", F.coalesce("new", F.lit(0.0))).alias("score")))
    return good, scores


def discover(docs: DataFrame, base: DataFrame, min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """(doc_id, text_hash, start, end): spans that no fixed pattern has."""
    pairs = base.select(F.explode("seeds").alias("s")).select("s.pattern", "s.value").distinct()
    patterns, seen = materialise_with(pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_seeds))
    nothing = base.select("doc_id", "text_hash", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end")).limit(0)
    if not seen["rows"]:
        return nothing
    places = materialise(mentions(docs, patterns))
    good, scores = score_graph(places, confidence=confidence)
    fresh = places.where("shaped and not known").join(good, "pattern").join(scores.where(F.col("score") >= confidence), "value")
    return fresh.select("doc_id", "text_hash", "start", "end").distinct()


def find(docs: DataFrame, min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """(doc_id, spans): all spans of every row as structs of kind (a place in KINDS), start and end."""
    base = materialise(base_table(docs))
    new = materialise(discover(docs, base, min_seeds, confidence))
    extra = new.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct(
        F.lit(len(KINDS) - 1).alias("kind"), "start", "end"))).alias("extra"))
    joined = base.join(extra.withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"}),
                       F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")), "left")
    return joined.select("doc_id", F.col("spans").alias("base"), F.concat("spans", F.coalesce("extra", F.expr(
        "cast(array() as array<struct<kind: int, start: bigint, end: bigint>>)"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the base spans hashed, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))
