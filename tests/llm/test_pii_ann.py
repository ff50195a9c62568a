import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from riskgraph.llm import ann, pii
from riskgraph.llm.common import start

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.0@-+ ()2é", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_by_hand():
    for text in ("x a@b.c.d@e.f y", "1.2.3.4.5.6.7.8 000255.1.1.1 256.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112",
                 "+1 (649) 555-1648. +12", "4" * 5000, "@@a@@b.c", "+" * 50 + "1234 5678 9"):
        assert pii.base_spans(text) == plain(text)
    assert pii.base_spans("4" * 1_000_000) == []  # linear here; the plain patterns are quadratic in such a run


SCHEMA = "doc_id long, text string, spans string, kind int"


def make(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)


def test_contexts_find_what_no_pattern_has(spark):
    start(spark)
    rnd = random.Random(1)
    filler = lambda: " ".join(rnd.choices(["lorem", "ipsum", "dolor", "sit", "amet", "the", "of"], k=12))
    texts = [f"{filler()} client contact: user{i}@mail.example.com {filler()} the {i} of" for i in range(40)]
    texts += [f"Ä {filler()} client contact: acct-{i}77, {filler()}" for i in range(3)]
    texts += [f"{filler()} the {i} of {filler()}" for i in range(40)] + [None, "", "  ", "a@b.co"]
    found = {r["doc_id"]: r for r in pii.digest(pii.find(make(spark, texts))).collect()}
    assert len(found) == len(texts)
    for i in range(40):
        assert found[i]["n_email"] == 1 and "context" not in found[i]["spans"]
    for i in (40, 41, 42):
        at = texts[i].index("acct")
        assert found[i]["spans"] == f"context:{at}:{at + len(f'acct-{i - 40}77')}"
    assert all(found[i]["spans"] == "" for i in range(43, len(texts) - 1))
    assert found[len(texts) - 1]["spans"] == "email:0:6"


def test_pii_odd_rows(spark):
    start(spark)
    rows = [(1, "a@b.co", None, None)] * 2 + [(None, "+1 (649) 555-1648", None, None), (None, None, None, None), (7, "x " * 50000 + "9.9.9.9", None, None)]
    got = pii.digest(pii.find(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(r["spans"] for r in got.collect()) == ["", "email:0:6", "email:0:6", "ip:100000:100007", "phone:0:17"]
    assert pii.digest(pii.find(spark.createDataFrame([], SCHEMA))).count() == 0


def brute(vectors, queries, k):
    out = {}
    for q in queries:
        v = vectors[q]
        scored = sorted((-float(np.dot(w, v) / (np.linalg.norm(w) * np.linalg.norm(v))), i) for i, w in vectors.items() if i != q)
        out[q] = scored[:k]
    return out


@pytest.mark.parametrize("shard_nodes", [100000, 300])
def test_ann_recall_and_ties(spark, shard_nodes):
    start(spark)
    r = np.random.default_rng(shard_nodes)
    real = {i: r.normal(size=16).astype(np.float32).astype(float) for i in range(900)}
    for i in range(900, 960):
        real[i] = real[7]
    odd = [(1001, None), (1002, [0.0] * 16), (1003, [None] + [1.0] * 15), (1004, [float("nan")] * 16), (1005, [float("inf")] * 16), (None, [1.0] * 16), (1006, [])]
    rows = [(i, v.tolist()) for i, v in real.items()] + odd + [(3, real[3].tolist())]
    table = spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = ann.nearest(table, table.where("vec_id % 50 = 0 or vec_id > 1000 or vec_id = 7"), 5, shard_nodes).collect()
    asked = [i for i in real if i % 50 == 0 or i == 7]
    want = brute(real, asked, 5)
    by = {}
    for row in got:
        by.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(by) == set(asked)
    hits = 0
    for q, rows in by.items():
        rows.sort()
        assert [x[0] for x in rows] == [1, 2, 3, 4, 5] and all(x[1] != q for x in rows)
        hits += len({x[1] for x in rows} & {i for _, i in want[q]})
        for _, i, s in rows:
            assert s == pytest.approx(float(np.dot(real[i], real[q]) / np.linalg.norm(real[i]) / np.linalg.norm(real[q])), abs=1e-12)
    assert hits / (5 * len(asked)) >= 0.95
    assert [x[1] for x in sorted(by[7])] == [900, 901, 902, 903, 904]


def test_ann_few_candidates(spark):
    start(spark)
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(table, table).orderBy("query_id").collect()] == [(0, 1, 1, 0.0), (1, 1, 0, 0.0)]
    assert ann.nearest(table.limit(0), table.limit(0)).count() == 0
