"""The stages one after the other, each against a plain version on what its predecessor kept."""

from collections import Counter

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from riskgraph.llm import mixing, quality  # noqa: E402
from riskgraph.session import materialise  # noqa: E402
from test_operators import brute_components, brute_print  # noqa: E402


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, after = [docs], {}
    for name, stage in pipeline.STAGES:
        kept.append(materialise(stage(spark, kept[-1], sf)))
        after[name] = kept[-1]
    assert all(k.columns == docs.columns for k in kept[:-1])
    ids = [[r["doc_id"] for r in k.collect()] for k in kept]
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}

    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = {r["doc_id"] for r in quality.scores(docs, model).where("predicted = 1").collect()}
    assert set(ids[1]) == good

    last = {}
    for i in sorted(ids[1]):
        last[texts[i].encode().lower()] = i
    assert sorted(ids[2]) == sorted(last.values())

    prints = {i: brute_print(texts[i]) for i in ids[2]}
    roots = brute_components(prints.values())
    first = {}
    for i in sorted(ids[2]):
        first.setdefault(roots[prints[i]], i)
    assert sorted(ids[3]) == sorted(first.values())

    times = {r["doc_id"]: r["times"] for r in mixing.mix(kept[3]).collect()}
    assert Counter(ids[4]) == Counter({i: t for i, t in times.items() if t})
    rows = kept[5].collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(ids[4])
    assert all(r["decoded_equal"] and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
