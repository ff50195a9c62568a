import math
import random
from collections import Counter

import numpy as np
import pytest

from riskgraph.llm import lm_scoring
from riskgraph.llm.common import start

TEXTS = ["abra cadabra", "Abra", "", None, "é" * 40, "the cat sat " * 50, "a", "zzzz yyyy"]
TARGET = ["the cat", "sat the cat on", None, ""]


def cell(gram: bytes, bits):
    got = lm_scoring.cells(np.frombuffer(gram, np.uint8), np.zeros(len(gram), np.int64), len(gram), bits)
    return int(got[-1])


def counts(texts, bits):
    out = Counter()
    for t in texts:
        b = (t or "").encode().lower()
        for k in range(1, 5):
            for i in range(len(b) - k + 1):
                out[cell(b[i:i + k], bits)] += 1
    return out


def loss(table, b, bits):
    total = sum(table[i] for i in range(256))
    out = 0.0
    for i in range(len(b)):
        p = 1 / 256
        for k in range(1, 5):
            if i + 1 >= k:
                n = table[cell(b[i + 1 - k:i + 1], bits)]
                context = total if k == 1 else table[cell(b[i + 1 - k:i], bits)]
                p = (n + 4 * p) / (max(context, n) + 4)
        out -= math.log(p)
    return out / len(b) if b else 0.0


def test_scores_against_counting_by_hand(spark):
    start(spark)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(1, "Abra", "x"), (None, "abc", None)],
                                 "doc_id long, text string, score string").repartition(3)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = lm_scoring.cross_entropy_difference(docs, target).collect()
    all_texts = TEXTS + ["Abra", "abc"]
    t, b = counts(TARGET, lm_scoring.CELL_BITS), counts(all_texts, lm_scoring.CELL_BITS)
    assert len(got) == len(all_texts)
    for r in got:
        data = ((TEXTS[r["doc_id"]] if r["doc_id"] is not None else "abc") or "").encode().lower()
        a, c = loss(t, data, lm_scoring.CELL_BITS), loss(b, data, lm_scoring.CELL_BITS)
        assert r["n_tokens"] == len(data)
        assert (r["target_loss"], r["background_loss"], r["score"]) == (pytest.approx(a), pytest.approx(c), pytest.approx(a - c))
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[5] < by_id[7]
    assert lm_scoring.cross_entropy_difference(docs.limit(0), target.limit(0)).count() == 0
    uniform = lm_scoring.score(docs, lm_scoring.model(target.limit(0)), lm_scoring.model(docs)).where("n_tokens > 0").collect()
    assert all(r["target_loss"] == pytest.approx(math.log(256)) for r in uniform)


def test_every_ngram_has_a_cell_of_its_own(spark):
    """Counts and losses are exact, with most n-grams outside the broadcast head as well."""
    start(spark)
    rnd = random.Random(3)
    texts = [bytes(rnd.randrange(128) for _ in range(rnd.choice((0, 1, 2, 3, 5, 3000)))).decode() for _ in range(60)]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    target = docs.where("doc_id % 3 = 0")
    grams = Counter(t.encode().lower()[i:i + k] for t in texts for k in range(1, 5) for i in range(len(t) - k + 1))
    found = {r["cell"]: r["n"] for r in lm_scoring.model(docs).collect()}
    assert found == {cell(g, lm_scoring.CELL_BITS): n for g, n in grams.items()}
    with pytest.raises(ValueError):
        cell(b"abcd", 21)

    def rows(df):
        return sorted((r["doc_id"], r["n_tokens"], round(r["target_loss"], 9), round(r["background_loss"], 9)) for r in df.collect())

    whole = rows(lm_scoring.cross_entropy_difference(docs, target))
    assert whole == rows(lm_scoring.cross_entropy_difference(docs, target, head_cells=50))
    b = counts(texts, lm_scoring.CELL_BITS)
    assert [r[3] for r in whole if r[1] > 100] == pytest.approx(
        [x[1] for x in sorted((i // 2, loss(b, t.encode().lower(), lm_scoring.CELL_BITS)) for i, t in enumerate(texts) if len(t) > 100)])
