import hashlib
import random

import numpy as np
import pytest

from riskgraph.llm import suffix_dedup
from riskgraph.llm.common import start

SCHEMA = "doc_id long, text string, kept int, d long"


def brute(rows):
    """rows (doc_id, text), ids unique -> {doc_id: (n_bytes, n_removed, n_spans, sha)}"""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for a in range(len(data) - 99):
            s = data[a:a + 100]
            if s in seen:
                gone[a:a + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdeé", k=rnd.randrange(2, 8))) for _ in range(200)]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    shared = [prose(40) for _ in range(5)]
    out = [None, "", "x" * 99, "x" * 100, "x" * 450, "ab" * 300, "aab" * 200, prose(3000), "z" * 250 + prose(30)]
    for _ in range(60):
        parts = [prose(rnd.randrange(1, 60)) for _ in range(rnd.randrange(1, 4))]
        for _ in range(rnd.randrange(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randrange(0, 60)
            parts.insert(rnd.randrange(len(parts) + 1), s[a:a + rnd.randrange(90, 220)])
        out.append("".join(parts))
    base = prose(120)
    for _ in range(12):
        at = rnd.randrange(len(base))
        out.append(base[:at] + "#" + base[at + 1:])
    return out + [out[20], out[21], out[7]]


@pytest.mark.parametrize("hot,shard,segment", [(50_000, 24_000, 1 << 20), (2, 40, 1 << 20), (5, 7, 1000)])
def test_against_brute_force(spark, texts, monkeypatch, hot, shard, segment):
    start(spark)
    for name, value in (("HOT_PIECES", hot), ("SHARD_PIECES", shard), ("SEGMENT", segment)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = list(enumerate(texts)) + [(None, texts[30])]
    table = spark.createDataFrame([(i, t, 0, 5) for i, t in rows], SCHEMA).repartition(4)
    if segment < 1 << 20:  # workers have their own copy of the module
        for i, t in rows:
            found = list(suffix_dedup.pieces((t or "").encode()))
            assert sum(int(n.sum()) for _, _, n in found) == max(0, len((t or "").encode()) - 99)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.remove_repeats(table)).collect()}
    assert got == brute(rows)


def test_odd_tables(spark, texts):
    start(spark)
    assert suffix_dedup.digest(suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA))).count() == 0
    twice = spark.createDataFrame([(1, texts[30], 0, 0)] * 2 + [(2, texts[30], 0, 0), (3, None, 0, 0)], SCHEMA)
    got = sorted((r["doc_id"], r["n_removed"]) for r in suffix_dedup.remove_repeats(twice).collect())
    n = len(texts[30].encode())
    own = brute([(1, texts[30])])[1][1]
    assert got == [(1, own), (1, own), (2, n if n >= 100 else 0), (3, 0)]


def test_suffix_array_and_prefixes():
    rnd = np.random.default_rng(0)
    for data in (rnd.integers(97, 99, 400).astype(np.uint8), np.full(300, 97, np.uint8), rnd.integers(0, 255, 500).astype(np.uint8)):
        raw = data.tobytes()
        order = suffix_dedup.suffix_array(data, 128)
        assert sorted(order) == list(range(len(data)))
        cut = [raw[i:i + 128] for i in order]
        assert cut == sorted(cut)
        shared = suffix_dedup.common_prefixes(data, order)
        for i in range(1, len(order)):
            a, b = raw[order[i - 1]:], raw[order[i]:]
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[i] == n


def test_prefixes_end_with_the_text():
    for raw in (b"\0" * 40, b"ab\0\0" * 9, b"abcdefgh" * 5 + b"\0"):
        data = np.frombuffer(raw, np.uint8)
        order = suffix_dedup.suffix_array(data, 128)
        shared = suffix_dedup.common_prefixes(data, order)
        for i in range(1, len(order)):
            a, b = raw[order[i - 1]:], raw[order[i]:]
            assert shared[i] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_pieces_of_many_texts_are_those_of_each(texts, monkeypatch):
    data = [(t or "").encode() for t in texts] + [b"", b"z" * 99, b""] + [b"q" * n for n in range(90, 210, 7)]
    data += [b"long " * 900, b"", b"ab" * 60]
    want = [(a, i, f, n) for i, x in enumerate(data) for p in suffix_dedup.pieces(x) for a, f, n in zip(*(c.tolist() for c in p))]
    for block in (1, 300, 4000, 1 << 17):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        assert list(zip(*(c.tolist() for c in suffix_dedup.pieces_of(data)))) == want
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 17)
    calls, real = [], suffix_dedup.segment_pieces
    monkeypatch.setattr(suffix_dedup, "segment_pieces", lambda *a: calls.append(1) or real(*a))
    suffix_dedup.pieces_of(data)
    assert len(calls) == 1  # one pass for all, not one for each


def test_strip_joins_runs_that_touch_or_overlap():
    data = bytes(range(250)) * 4
    rnd = random.Random(2)
    for _ in range(200):
        runs = [(rnd.randrange(0, 880), rnd.randrange(1, 20)) for _ in range(rnd.randrange(0, 6))]
        runs += [(a + n + 99, 1) for a, n in runs[:1] if a + n + 199 <= 1000]
        gone = bytearray(1000)
        for a, n in runs:
            gone[a:a + n + 99] = b"\1" * (n + 99)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        assert suffix_dedup._strip(data, [a for a, _ in runs], [n for _, n in runs]) == (sum(gone), spans, kept)


def test_written_steps_leave_no_shuffle_files(spark, texts, monkeypatch):
    start(spark)
    key, seen, real = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], suffix_dedup.materialise
    before = spark.conf.get(key, None)
    monkeypatch.setattr(suffix_dedup, "materialise", lambda df: seen.append(spark.conf.get(key)) or real(df))
    table = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts[:30])], SCHEMA)
    suffix_dedup.repeated_runs(table, False)
    assert seen == ["true"] * 3 and spark.conf.get(key, None) == before
