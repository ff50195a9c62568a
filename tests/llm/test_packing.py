"""Best-fit packing against item-by-item best fit and a direct tokenisation."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from riskgraph.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ARGS = (PATH, RANKS, public_tokenizers.PATTERN)


def best_fit(lengths, cap):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            i = min(fits, key=lambda i: free[i])
            free[i] -= n
        else:
            free.append(cap - n)
    return sorted(free)


def test_plan_equals_item_by_item_best_fit():
    random.seed(5)
    for cap in (10, 64, 2048):
        for _ in range(30):
            lengths = [random.choice([random.randint(1, cap - 1), cap // 3, cap // 2 + 1, 1]) for _ in range(random.randint(0, 300))]
            groups = packing.plan(Counter(lengths), cap)
            frees = sorted(f for bins, slots in groups for f in [cap - sum(n * m for n, m in slots)] * bins)
            assert frees == best_fit(lengths, cap)
            placed = Counter()
            for bins, slots in groups:
                for n, m in slots:
                    placed[n] += bins * m
            assert placed == Counter(lengths)


def _check(spark, rows, cap):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df.withColumn("extra", df["text"]), *ARGS, cap).toPandas()
    tok = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, _ in rows:
        ids = np.asarray(tok.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        first = len(ids) % cap or cap
        bounds = [0, *range(first, len(ids) + 1, cap)]
        want += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    have = [tuple(None if v != v else int(v) for v in r)
            for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(have, key=key) == sorted(want, key=key)
    seqs = defaultdict(list)
    for r in got.itertuples(index=False):
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at <= cap
    short = [r[3] for r in want if r[3] < cap]
    assert len(seqs) == len(best_fit(short, cap)) + sum(1 for r in want if r[3] == cap)


def test_pack_pieces_and_sequences(spark):
    random.seed(7)
    words = ["alpha", "beta", "gamma", " ", "\n", "é", "<|endoftext|>"]
    rows = [(i, None if i % 17 == 0 else "".join(random.choice(words) for _ in range(random.randint(0, 120))), "s")
            for i in range(300)]
    rows += [(1000, "long text " * 400, "s"), (1001, "", "s"), (5, "same", "s"), (5, "same", "s"), (None, "no id", "s")]
    odd = [" a  b \n c\n d", "x \ny z", "a" * 5000, "0" * 3000, " " * 50 + "\n\n\t x", "it's we'll 'S",
           "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "\u00e9\u4e2d\U0001F600 mixed", "\r\n\x00 ctrl"]
    rows += [(2000 + i, t, "s") for i, t in enumerate(odd)]
    _check(spark, rows, 64)


def test_pack_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, *ARGS).count() == 0
