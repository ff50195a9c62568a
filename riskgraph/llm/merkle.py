"""Merkle manifest of a document table, with an inclusion proof per row, by checkpoint-and-recompute.

Every row is a leaf. Per source the leaves, ascending by doc_id, are folded three at a
time into a subroot; the subroots, ordered by source, are folded likewise into the root.

Only every `SPAN`-th level of a tree is persisted (written to the shared folder). A proof
is extracted per persisted level: its nodes are grouped by aligned subtree of 3**SPAN
nodes, the interior level above them is recomputed from those stored descendants, every
member emits its siblings at both levels, and the recomputed nodes are discarded. A leaf's
proof is then its own steps plus the steps of its ancestor at each higher persisted level,
put together top-down by joins whose right sides shrink ninefold per step.

Everything runs as DataFrame expressions (grouping, joins, higher-order array functions);
groups hold at most 9 nodes whatever the size of a source, so a source with a third of all
rows is spread like any other. Row positions inside a source come from a distributed sort.

Defined cases: null fields hash as `-`; a null doc_id sorts first in its source and is
never tampered; rows with equal doc_id are ordered by their leaf digest (identical rows
are identical leaves, each kept); a source with one leaf has that leaf as subroot and an
empty proof path; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.functions.order import with_row_position
from riskgraph.session import materialise

#: Levels between two persisted ones: aligned subtrees of 3 ** SPAN = 9 nodes are recomputed.
SPAN = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(c: Column) -> Column:
    """`-` for null, else the UTF-8 byte count of the value's text, `:`, the text (integers decimal)."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(text: Column) -> Column:
    """Leaf digest of a row whose text column is `text`."""
    parts = [F.col(f) if f != "text" else text for f in FIELDS]
    return _h(F.concat(*[_field(p) for p in parts]))


def tampered_text() -> Column:
    """Text with every newline deleted where unsigned crc32(decimal doc_id) is even; null stays null."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.translate(F.col("text"), "\n", "")).otherwise(F.col("text"))


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda o: o["h"]), "")


def _up(level: DataFrame) -> DataFrame:
    """The next level: each run of three (the last may be shorter) becomes the digest of its members."""
    return (
        level.where(F.col("width") > 1)
        .groupBy("key", F.floor(F.col("idx") / 3).alias("idx"), "width")
        .agg(_h(_joined(F.array_sort(F.collect_list(F.struct("idx", "h"))))).alias("h"))
        .select("key", "idx", F.ceil(F.col("width") / 3).cast("long").alias("width"), "h")
    )


def _steps(level: DataFrame) -> DataFrame:
    """(key, idx, steps) of a persisted level: siblings at it and at the recomputed level above.

    A step is (left, right): the concatenated digests of the run's members before and after.
    """
    groups = (
        level.where(F.col("width") > 1)
        .groupBy("key", F.floor(F.col("idx") / 9).alias("g"), "width")
        .agg(F.array_sort(F.collect_list(F.struct("idx", "h"))).alias("m"))
    )
    run = lambda e: F.floor(e["idx"] / 3)
    parents = F.transform(
        F.array_distinct(F.transform(F.col("m"), run)),
        lambda t: F.struct(t.alias("t"), _h(_joined(F.filter(F.col("m"), lambda o: run(o) == t))).alias("h")),
    )
    upper_exists = F.ceil(F.col("width") / 3) > 1

    def member(e: Column) -> Column:
        own = F.struct(
            _joined(F.filter(F.col("m"), lambda o: (run(o) == run(e)) & (o["idx"] < e["idx"]))).alias("left"),
            _joined(F.filter(F.col("m"), lambda o: (run(o) == run(e)) & (o["idx"] > e["idx"]))).alias("right"),
        )
        above = F.struct(
            _joined(F.filter(F.col("parents"), lambda p: p["t"] < run(e))).alias("left"),
            _joined(F.filter(F.col("parents"), lambda p: p["t"] > run(e))).alias("right"),
        )
        steps = F.when(upper_exists, F.array(own, above)).otherwise(F.array(own))
        return F.struct(e["idx"].alias("idx"), steps.alias("steps"))

    return (
        groups.withColumn("parents", parents)
        .select("key", F.explode(F.transform(F.col("m"), member)).alias("e"))
        .select("key", "e.idx", "e.steps")
    )


def fold_tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fold (key, idx, width, h) per key; idx runs 0..width-1 within a key.

    Returns (tops, paths): tops is (key, h), the single remaining node of each key; paths is
    (key, idx, path) with the steps of each input node from the bottom to its top, empty
    for a lone node.
    """
    level = materialise(nodes.select("key", "idx", "width", "h"))
    persisted = [level]
    tops = [level.where(F.col("width") == 1).select("key", "h")]
    height = 0
    widest = level.agg(F.max("width")).first()[0] or 1
    while widest > 1:
        widest, height = -(-widest // 3), height + 1
        level = _up(level)
        if height % SPAN == 0:
            level = materialise(level)
            persisted.append(level)
        tops.append(level.where(F.col("width") == 1).select("key", "h"))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    suffix = None
    for lvl in reversed(persisted):
        steps = _steps(lvl)
        if suffix is not None:
            above = suffix.select(F.col("key").alias("_k"), F.col("idx").alias("_g"), F.col("path").alias("_above"))
            steps = (
                steps.join(above, F.col("key").eqNullSafe(F.col("_k")) & (F.floor(F.col("idx") / 9) == F.col("_g")), "left")
                .select("key", "idx", F.concat("steps", F.coalesce("_above", F.array().cast(steps.schema["steps"].dataType))).alias("path"))
            )
        else:
            steps = steps.withColumnRenamed("steps", "path")
        suffix = materialise(steps) if lvl is not persisted[0] else steps
    return top, suffix


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified) per row of `docs`.

    proof_sha256 hashes the sibling digests level by level, left then right, via the subroot
    to the root; folded_root recomputes the root from the tampered row's leaf and the
    original siblings; verified says whether it equals the root.
    """
    rows = docs.select(*FIELDS).select(
        *FIELDS, leaf(F.col("text")).alias("leaf"), leaf(tampered_text()).alias("tampered_leaf")
    )
    placed = materialise(with_row_position(
        rows, [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ))
    spans = placed.groupBy("source").agg(F.min("position").alias("_first"), F.count(F.lit(1)).alias("width"))
    spans = spans.withColumnRenamed("source", "_s")
    leaves = placed.join(spans, F.col("source").eqNullSafe(F.col("_s"))).select(
        "*", (F.col("position") - F.col("_first")).alias("idx")
    )
    sub_tops, sub_paths = fold_tree(leaves.select(F.col("source").alias("key"), "idx", "width", F.col("leaf").alias("h")))

    ranked = with_row_position(sub_tops, [F.col("key").asc_nulls_first()], "idx")
    total = sub_tops.count()
    roots, top_paths = fold_tree(ranked.select(F.lit(0).alias("sort_key"), "key", "idx", "h").select(
        F.col("sort_key").alias("key"), "idx", F.lit(total).cast("long").alias("width"), "h", F.col("key").alias("source")
    ))
    by_source = ranked.select(F.col("key").alias("_src"), "idx", F.col("h").alias("subroot")).join(
        top_paths.select(F.col("idx").alias("_i"), F.col("path").alias("top_path")), F.col("idx") == F.col("_i"), "left"
    ).select("_src", "subroot", "top_path")

    step_type = sub_paths.schema["path"].dataType
    empty = F.array().cast(step_type)
    out = (
        leaves.join(
            sub_paths.select(F.col("key").alias("_k"), F.col("idx").alias("_i"), "path"),
            F.col("source").eqNullSafe(F.col("_k")) & (F.col("idx") == F.col("_i")), "left",
        )
        .join(by_source, F.col("source").eqNullSafe(F.col("_src")))
        .crossJoin(F.broadcast(roots.select(F.col("h").alias("root"))))  # one row
        .withColumn("full", F.concat(F.coalesce("path", empty), F.coalesce("top_path", empty)))
    )
    siblings = F.aggregate("full", F.lit(""), lambda acc, s: F.concat(acc, s["left"], s["right"]))
    folded = F.aggregate("full", F.col("tampered_leaf"), lambda cur, s: _h(F.concat(s["left"], cur, s["right"])))
    return out.select(
        "doc_id", "source", "leaf", "subroot", "root", _h(siblings).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )
