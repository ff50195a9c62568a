"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 48 words. Each passage is described by numbers (shares
of kinds of characters, word lengths, repeats), encoded by one dense layer, and weighted by
gated attention: the weights are a softmax over w . (tanh(V h) * sigmoid(U h)). The document
is scored by a logistic unit on the weighted sum. All layers are learned together from the
labels of documents; no passage has one.

The model is fitted on a bounded sample of labelled rows, `SAMPLE_ROWS` at most (a hash of
the id picks them), and everything else covers all rows: every passage of every text is
encoded and weighted. Labels, language, source and id are no inputs of a score.

Null and empty texts are one passage without words and get the score the model gives that.
A null id is never held out. Without labels every score is 0.5. Rows that repeat an id get
a row each; of repeated labels the largest counts. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.llm.common import map_batches, utf8

PASSAGE_WORDS = 48
SAMPLE_ROWS = 6000
THRESHOLD = 0.3
FOLDS = 5
ENCODED, GATED = 24, 12
#: Texts are described together up to so many bytes.
BLOCK_BYTES = 1 << 20

_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KINDS = 6 + len(_SIGNS)


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.int64)
    for i in range(256):
        c = chr(i)
        kind[i] = (0 if i in b" \t\n\r\x0b\x0c" else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if c.isdigit() and i < 128
                   else 6 + _SIGNS.index(c) if c in _SIGNS else 4 if i >= 128 else 5)
    return kind


KIND = _kinds()
FEATURES = _KINDS + 8


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(one row of numbers per passage, first passage of each text)."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = KIND[joined]
    inside = kind > 0
    begins = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    stops = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
    doc = np.searchsorted(ends, begins, side="right")
    words = np.bincount(doc, minlength=len(texts))
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    first = np.r_[0, np.cumsum(passages)[:-1]]
    n = int(passages.sum())
    nth = np.arange(len(begins)) - np.r_[0, np.cumsum(words)[:-1]][doc]
    passage = first[doc] + nth // PASSAGE_WORDS
    out = np.zeros((n, FEATURES), np.float32)
    if not len(begins):
        return out, first
    # counts of kinds: every byte of a word belongs to the word's passage
    marks = np.zeros(len(joined), np.int64)
    marks[begins] = 1
    at = passage[np.cumsum(marks)[inside] - 1]
    counts = np.bincount(at * _KINDS + kind[inside], minlength=n * _KINDS).reshape(n, _KINDS).astype(np.float64)
    size = np.maximum(1, counts.sum(axis=1, keepdims=True))
    out[:, :_KINDS] = counts / size
    # words as numbers: sums of powers, the same for the same letters
    value = (joined.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value ^= value >> np.uint64(32)
    word_begin = np.r_[np.zeros(begins[0], np.int64), np.repeat(begins, np.diff(np.r_[begins, len(joined)]))]
    place = (np.arange(len(joined)) - word_begin).astype(np.uint64)
    value *= (place + np.uint64(3)) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    value[~inside] = 0
    name = np.add.reduceat(value, begins)
    count = np.maximum(1, np.bincount(passage, minlength=n))
    length = stops - begins
    same = np.r_[False, (name[1:] == name[:-1]) & (passage[1:] == passage[:-1])]
    order = np.lexsort((name, passage))
    fresh = np.r_[True, (name[order][1:] != name[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
    order_doc = np.lexsort((name, doc))
    fresh_doc = np.r_[True, (name[order_doc][1:] != name[order_doc][:-1]) | (doc[order_doc][1:] != doc[order_doc][:-1])]
    per = lambda w: np.bincount(passage, weights=w, minlength=n) / count
    mean = per(length)
    distinct_doc = np.bincount(doc[order_doc], weights=fresh_doc, minlength=len(texts)) / np.maximum(1, words)
    breaks = np.bincount(passage, weights=np.r_[(joined[stops[:-1]] == 10) & (doc[1:] == doc[:-1]), False].astype(float), minlength=n)
    extra = [
        mean / 10, np.sqrt(np.maximum(0, per(length.astype(float) ** 2) - mean ** 2)) / 10, per(same),
        np.bincount(passage[order], weights=fresh, minlength=n) / count, np.repeat(distinct_doc, passages),
        np.log1p(np.bincount(passage, minlength=n)) / 4, breaks / count, np.repeat(np.log1p(words) / 10, passages),
    ]
    out[:, _KINDS:] = np.stack(extra, axis=1)
    return out, first


class Model:
    """Encoder, gated attention and logistic unit; `fit` learns them by Adam on mini-batches of bags."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        draw = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"W": draw(FEATURES, ENCODED), "b": np.zeros(ENCODED), "V": draw(ENCODED, GATED), "U": draw(ENCODED, GATED),
                  "w": draw(GATED, 1)[:, 0], "c": np.zeros(ENCODED), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        p = self.p
        bag = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(x)]))
        h = np.tanh(x @ p["W"] + p["b"])
        a, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (a * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        weight = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return bag, h, a, g, weight, z, 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale, first)[-1]

    def _slopes(self, x, first, y) -> dict[str, np.ndarray]:
        p = self.p
        bag, h, a, g, weight, z, score = self.forward(x, first)
        dl = (score - y) / len(y)
        dz = dl[:, None] * p["c"]
        dw = (h * dz[bag]).sum(axis=1)
        de = weight * (dw - np.add.reduceat(weight * dw, first)[bag])
        da, dg = de[:, None] * p["w"] * g * (1 - a * a), de[:, None] * p["w"] * a * g * (1 - g)
        dh = (weight[:, None] * dz[bag] + da @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh + 1e-4 * p["W"], "b": dh.sum(axis=0), "V": h.T @ da, "U": h.T @ dg,
                "w": (a * g).T @ de, "c": z.T @ dl + 1e-4 * p["c"], "d": dl.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, rounds: int = 40, batch: int = 200, rate: float = 0.01) -> "Model":
        every = np.concatenate(bags).astype(np.float64)
        self.mean, self.scale = every.mean(axis=0), every.std(axis=0) + 0.02
        r = np.random.default_rng(5)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(rounds):
            order = r.permutation(len(bags))
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                x = (np.concatenate([bags[i] for i in some]) - self.mean) / self.scale
                first = np.r_[0, np.cumsum([len(bags[i]) for i in some])[:-1]]
                step += 1
                for k, s in self._slopes(x, first, labels[some]).items():
                    m[k] = 0.9 * m[k] + 0.1 * s
                    v[k] = 0.99 * v[k] + 0.01 * s * s
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        return self


def _blocks(texts: list[bytes]):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_BYTES):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Model | None:
    """A model of `labels.quality` from at most `sample` rows that are not held out."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    def passages(batch: pa.RecordBatch) -> dict:
        found = [describe([t])[0] for t in utf8(batch)]
        return {"doc_id": batch.column("doc_id"), "y": batch.column("_y"), "passages": [f.tobytes() for f in found]}

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(F.broadcast(known), "doc_id")
    rows = sorted(map_batches(texts, passages, "doc_id long, y int, passages binary").collect(), key=lambda r: (r["doc_id"], bytes(r["passages"])))
    if not rows:
        return None
    bags = [np.frombuffer(r["passages"], np.float32).reshape(-1, FEATURES) for r in rows]
    return Model().fit(bags, np.array([float(r["y"]) for r in rows]))


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""

    def one(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch)
        if model is None:
            found = np.full(len(texts), 0.5)
        else:
            found = np.concatenate([model.score(*describe(texts[a:b])) for a, b in _blocks(texts)] or [np.empty(0)])
        return {"doc_id": batch.column("doc_id"), "score": found}

    scored = map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), one, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are predicted to be good, with all their columns."""
    model = train(docs, labels)
    fields = [f for f in docs.schema.fields]

    def one(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch)
        keep = np.ones(len(texts), bool) if model is None or not texts else np.concatenate(
            [model.score(*describe(texts[a:b])) for a, b in _blocks(texts)]) >= THRESHOLD
        kept = batch.filter(pa.array(keep))
        return {f.name: kept.column(f.name) for f in fields}

    return map_batches(docs, one, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
