"""Cross-entropy difference of documents under two matched n-gram models.

Tokens are the bytes of the lower-cased text, so the target and the background model share
one vocabulary of 256, and they are matched: same orders, same smoothing, same table. The
probability of a byte is smoothed order by order, p_k = (n(context, byte) + M p_(k-1)) /
(n(context) + M), from p_0 = 1 / 256 up to `ORDER` bytes. A document's score is the mean
over its bytes of target loss minus background loss, in nats: lower is nearer the target.

The counts cover all texts of both corpora and are exact: every n-gram has a cell of its
own. The loss of a byte depends on the last `ORDER` bytes only, so it is computed once for
each n-gram that occurs, by joins, and not once for each byte. A document adds up the losses
of its bytes: those of the `HEAD_CELLS` most frequent n-grams are sent to the tasks, which
bounds what is broadcast; those of all other n-grams are joined, one row per document and
n-gram.

Null and empty texts have no tokens, losses and score 0. Rows that repeat an id get a row
each. Without target texts the target model is uniform. An empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.llm.common import utf8
from riskgraph.session import materialise, materialise_with

ORDER = 4
#: Bits of a cell number: enough for every n-gram of up to `ORDER` bytes.
CELL_BITS = 33
PRIOR = 4.0
BLOCK_BYTES = 1 << 19
#: N-grams whose losses are sent to every task; all others are joined.
HEAD_CELLS = 1 << 20
#: N-grams that a task merges before it hands them on.
MERGE_ROWS = 1 << 20


def first_cell(order: int) -> int:
    """The cells of the n-grams of `order` bytes begin here."""
    return sum(256 ** k for k in range(1, order))


def cells(data: np.ndarray, begins: np.ndarray, order: int, bits: int = CELL_BITS) -> np.ndarray:
    """The cell of the n-gram of `order` bytes that ends at each byte; -1 where the text is not that long.

    `data` is several texts end to end and `begins` has for each byte the begin of its text.
    No two n-grams share a cell.
    """
    if first_cell(order + 1) > 1 << bits:
        raise ValueError(f"{bits} bits do not give each n-gram of {order} bytes a cell of its own")
    n = len(data)
    out = np.full(n, -1, np.int64)
    if n < order:
        return out
    gram = np.zeros(n - order + 1, np.int64)
    for k in range(order):
        gram = gram << 8 | data[k:n - order + 1 + k]
    whole = np.arange(order - 1, n) - begins[order - 1:] >= order - 1
    out[order - 1:] = np.where(whole, gram + first_cell(order), -1)
    return out


def longest_cells(data: np.ndarray, begins: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The cell of the longest n-gram, of up to `order` bytes, that ends at each byte."""
    out = cells(data, begins, order)
    short = np.flatnonzero(out < 0)  # the first bytes of a text
    for k in range(1, order):
        here = short[short - begins[short] == k - 1]
        gram = np.zeros(len(here), np.int64)
        for back in range(k - 1, -1, -1):
            gram = gram << 8 | data[here - back]
        out[here] = gram + first_cell(k)
    return out


def _blocks(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(texts of the block, bytes, begin of each byte's text): whole texts up to BLOCK_BYTES, long ones alone."""
    at = 0
    while at < len(texts):
        chosen, size = [], 0
        while at < len(texts) and (not chosen or size + len(texts[at]) <= BLOCK_BYTES):
            chosen.append(at)
            size += len(texts[at])
            at += 1
        lengths = [len(texts[i]) for i in chosen]
        yield chosen, np.frombuffer(b"".join(texts[i] for i in chosen).lower(), np.uint8), np.repeat(np.r_[0, np.cumsum(lengths)[:-1]], lengths)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(cells, counts) of several such pairs, each cell once."""
    cell, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return cell, np.bincount(place, np.concatenate([n for _, n in parts]), len(cell)).astype(np.int64)


def count_cells(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(cell, n) over all texts, for n-grams of one to `order` bytes.

    Tasks count the longest n-gram at each byte; the shorter ones are its ends, so they are
    derived from the counted n-grams and not from the bytes.
    """

    def handed_on(cell: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(cell), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(cell[at:at + 100_000]), pa.array(n[at:at + 100_000])], names=["cell", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            for _, data, begins in _blocks(utf8(batch)):
                parts.append(np.unique(longest_cells(data, begins, order), return_counts=True))
                waiting += len(parts[-1][0])
                if waiting > MERGE_ROWS:
                    parts = [_merged(parts)]
                    waiting = len(parts[0][0])
                    if waiting > MERGE_ROWS // 2:
                        yield from handed_on(*parts[0])
                        parts, waiting = [], 0
        if parts:
            yield from handed_on(*_merged(parts))

    longest = docs.select(F.col("text").cast("string")).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    ends = F.filter(F.array(*[F.when(F.col("cell") >= first_cell(k), _end(F.col("cell"), k, order)) for k in range(1, order + 1)]),
                    lambda c: c.isNotNull())
    return longest.select(F.explode(ends).alias("cell"), "n").groupBy("cell").agg(F.sum("n").alias("n"))


def _end(cell: Column, order: int, longest: int) -> Column:
    """The cell of the last `order` bytes of the n-gram of a cell, which has as many or more."""
    out = cell
    for k in range(order + 1, longest + 1):
        out = F.when(cell >= first_cell(k), (cell - F.lit(first_cell(k))) % F.lit(256 ** order) + F.lit(first_cell(order))).otherwise(out)
    return out


def model(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The counts of a corpus, written once: (cell, n)."""
    return materialise(count_cells(docs, order))


def losses(met: DataFrame, target: DataFrame, background: DataFrame, order: int = ORDER) -> DataFrame:
    """(cell, target_loss, background_loss): nats of the last byte of every n-gram of `met`, under each model.

    One step per order: the count of the n-gram, that of its context, and the probability of
    the order before, each by a join on its cell.
    """
    both = materialise(
        target.select("cell", F.col("n").alias("t"), F.lit(0).cast("bigint").alias("b"))
        .unionByName(background.select("cell", F.lit(0).cast("bigint").alias("t"), F.col("n").alias("b")))
        .groupBy("cell").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    )
    bytes_ = both.where(F.col("cell") < 256).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in ("t", "b")]).first()
    before, out = None, None
    for k in range(1, order + 1):
        first = F.lit(first_cell(k))
        here = met.where((F.col("cell") >= first) & (F.col("cell") < F.lit(first_cell(k + 1)))).select("cell")
        here = here.join(both, "cell", "left")
        if k == 1:
            here = here.select("cell", *[F.coalesce(m, F.lit(0)).alias(m) for m in ("t", "b")],
                               *[F.lit(bytes_[m]).alias(f"{m}_before") for m in ("t", "b")],
                               *[F.lit(1 / 256).alias(f"{m}_p") for m in ("t", "b")])
        else:
            gram = F.col("cell") - first
            shorter = F.lit(first_cell(k - 1))
            contexts = both.select(F.col("cell").alias("_context"), F.col("t").alias("t_before"), F.col("b").alias("b_before"))
            here = here.withColumns({"_context": F.shiftright(gram, 8) + shorter, "_end": gram % F.lit(256 ** (k - 1)) + shorter})
            # the context's own count includes its places at the end of texts
            here = here.join(contexts, "_context", "left").join(before.withColumnRenamed("cell", "_end"), "_end")
            here = here.select("cell", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("t", "b", "t_before", "b_before")], "t_p", "b_p")
        step = here.select("cell", *[
            ((F.col(m) + F.lit(PRIOR) * F.col(f"{m}_p")) / (F.greatest(f"{m}_before", m) + F.lit(PRIOR))).alias(f"{m}_p")
            for m in ("t", "b")])
        before = materialise(step)
        out = before if out is None else out.unionByName(before)
    return out.select("cell", (-F.log("t_p")).alias("target_loss"), (-F.log("b_p")).alias("background_loss"))


def score(docs: DataFrame, target: DataFrame, background: DataFrame, met: DataFrame | None = None,
          head_cells: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every document.

    `met` holds the cells of the n-grams of `docs`, with their counts; they are counted here if not given.
    """
    head_cells = HEAD_CELLS if head_cells is None else head_cells
    met = model(docs) if met is None else met
    priced, size = materialise_with(losses(met, target, background).join(met, "cell"))
    head = priced if size["rows"] <= head_cells else priced.orderBy(F.desc("n"), "cell").limit(head_cells)
    known = head.select("cell", "target_loss", "background_loss").toArrow()  # `head_cells` rows at most
    order = np.argsort(known.column("cell").to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(
        [known.column(c).to_numpy()[order] for c in ("cell", "target_loss", "background_loss")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, *nats = shared.value
        for batch in batches:
            texts = utf8(batch)
            found, rare = np.zeros((len(texts), 2)), [[] for _ in texts]
            for chosen, data, begins in _blocks(texts):
                if not len(data):
                    continue
                full = [i for i in chosen if texts[i]]
                first = np.r_[0, np.cumsum([len(texts[i]) for i in full])[:-1]]
                met_here, place = np.unique(longest_cells(data, begins), return_inverse=True)
                at = np.minimum(np.searchsorted(cell, met_here), len(cell) - 1)
                known_here = cell[at] == met_here
                for m in range(2):
                    found[full, m] = np.add.reduceat(np.where(known_here, nats[m][at], 0)[place], first)
                other = np.flatnonzero(~known_here[place])
                for i, b in zip(np.searchsorted(first, other, "right") - 1, other):
                    rare[full[i]].append(int(met_here[place[b]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(found[:, 0]), pa.array(found[:, 1]),
                 pa.array(rare, pa.list_(pa.int64()))], names=["doc_id", "n_tokens", "target_loss", "background_loss", "rare"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, target_loss double, background_loss double, rare array<long>")
    if size["rows"] > head_cells:
        rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
        others = rows.select("_row", F.explode("rare").alias("cell")).groupBy("_row", "cell").agg(F.count(F.lit(1)).alias("_times"))
        sums = others.join(priced, "cell").groupBy("_row").agg(
            *[F.sum(F.col(c) * F.col("_times")).alias(f"_{c}") for c in ("target_loss", "background_loss")])
        rows = rows.join(sums, "_row", "left").withColumns({
            c: F.col(c) + F.coalesce(f"_{c}", F.lit(0.0)) for c in ("target_loss", "background_loss")})
    mean = [(F.col(c) / F.greatest("n_tokens", F.lit(1))).alias(c) for c in ("target_loss", "background_loss")]
    return rows.select("doc_id", "n_tokens", *mean).withColumn("score", F.col("target_loss") - F.col("background_loss"))


def cross_entropy_difference(docs: DataFrame, target: DataFrame, head_cells: int | None = None) -> DataFrame:
    """`score` of `docs` with the texts of `target` as the target and `docs` as the background."""
    background = model(docs)
    return score(docs, model(target), background, background, head_cells)
