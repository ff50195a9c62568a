"""The conversation prefix trie against a plain trie built in Python."""

import hashlib
import random
import re
import zlib

from riskgraph.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r or "", x or ""))
    for turns in convs.values():
        turns.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
    rebuilt = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        base = convs.get(c - c % 20, [])
        rebuilt[c] = [(r, x) for _, r, x in base[:h]] + [(r, x) for _, r, x in convs[c][h:]]
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def words(t):
        return len(re.findall(r"[^\x20\x09-\x0D]+", t))

    out = set()
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        leaves = sum(1 for q in below if q not in children)
        saved = sum((len(nodes[q]) - 1) * words(q[-1][1]) for q in below if q)
        ends = sorted(c for c in members if len(rebuilt[c]) == len(p))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])),
                 leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def _check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumn("extra", df["text"])
    got = {tuple(r) for r in prefix_trie.trie(df).collect()}
    assert got == brute(rows)
    return got


def test_trie_equals_plain_trie(spark):
    random.seed(3)
    texts = ["hi", "hello there", "", None, "a b  c", "x\ty\nz", "long " * 3000]
    rows = []
    for c in list(range(0, 61)) + [100, 101, 140, 141, 142]:
        for t in range(random.randint(0, 6)):
            rows.append((c, random.choice([t, t, None]), random.choice(["user", "assistant", None]), random.choice(texts)))
    rows += [(None, 0, "user", "ignored"), (5, 1, "user", "hi"), (5, 1, "user", "hi")]
    rows += [(c, t, "user", "same words here") for c in range(200, 260) for t in range(3)]
    _check(spark, rows)


def test_empty_and_turnless(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    got = _check(spark, [(3, 0, "user", "one")])  # h = 3 borrows from absent conversation 0: no turns left
    assert {r[1] for r in got} == {0}
