"""Prefix trie of conversations by truncation peeling.

A node of depth d is a distinct sequence of the first d turns (role, text); its members are
the conversations that start with it. Every conversation is peeled from its last turn
upward: each prefix (the conversation with its last turns stripped) regroups with the
equal prefixes of the others, and one aggregation over all (conversation, depth) rows
discovers the nodes of every depth at once, with members, smallest member, parent and the
conversations that end there. Subtree totals follow from the same peeling: a node is owned
by its smallest member, which owns every deeper node of its own path too, so a running sum
along each conversation from its deepest turn upward, summed over a node's members, is the
total of the node's subtree. The number of Spark jobs does not depend on the depth.

Node identity is four position-salted hash sums over the turns of the prefix, formed by a
running sum per conversation, so no prefix is ever materialised as text; four sums of
31-bit hashes make 124 bits, summed in longs without overflow.

All steps are DataFrame aggregations and joins, except the SHA-256 of the conversations
that end at a node: that hash is sequential by definition, so those ids are streamed in
order through one Arrow pass, holding one running hash at a time (a node that a third of
all conversations end at is streamed by one task, but never held in memory).

Defined cases: turns order by turn with nulls first, then by role and text; a null role or
text is empty; rows without conv_id belong to no conversation and are ignored; repeated
rows are repeated turns; a conversation whose rebuilt form has no turns ends at the root;
an empty table gives no rows (there is no root without conversations).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskgraph.session import materialise

#: Conversations are rebuilt on the first turns of the conversation that opens their block of 20.
BLOCK = 20
#: At most this many turns are borrowed (h = crc32 % 4 is at most 3).
BORROW = 4
WORD_GAPS = "[\\x20\\x09-\\x0D]+"
#: Hash sums that name a node.
KEY_SUMS = 4
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def words(text):
    """Number of runs of `[^\\x20\\x09-\\x0D]`."""
    return F.size(F.filter(F.split(text, WORD_GAPS), lambda w: w != F.lit("")))


def rebuild(conversations: DataFrame) -> DataFrame:
    """(c, d, role, text, n) per turn of every rebuilt conversation, d from 1; and (c, n) of turnless ones (d = 0).

    n is the rebuilt length. Conversation c takes the first h turns of c - c % 20, then its own
    turns after its first h; h is unsigned crc32 of decimal c, mod 4.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = turns.withColumn("pos", F.row_number().over(order) - 1)
    ids = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select(
        F.col("conv_id").alias("c"), "own",
        (F.crc32(F.col("conv_id").cast("string")) % BORROW).alias("h"),
        (F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))).alias("b"),
    )
    heads = placed.where(F.col("pos") < BORROW - 1).select(
        F.col("conv_id").alias("b"), F.col("pos").alias("bpos"), F.col("role").alias("brole"), F.col("text").alias("btext")
    )
    head_len = heads.groupBy("b").agg(F.count(F.lit(1)).alias("blen"))
    ids = ids.join(head_len, "b", "left").withColumn("taken", F.least(F.col("h"), F.coalesce("blen", F.lit(0))))
    ids = ids.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    borrowed = ids.join(heads, "b").where(F.col("bpos") < F.col("h")).select(
        "c", (F.col("bpos") + 1).alias("d"), F.col("brole").alias("role"), F.col("btext").alias("text"), "n"
    )
    own = placed.join(ids, placed.conv_id == ids.c).where(F.col("pos") >= F.col("h")).select(
        "c", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("d"), "role", "text", "n"
    )
    return borrowed.unionByName(own), ids.where(F.col("n") == 0).select("c", "n")


def _turn_hash(salt: int):
    """A 31-bit hash of a turn at its position: sums of 2^32 of them still fit a long."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col("d"), F.col("role"), F.col("text")), F.lit(1 << 31))


def prefix_rows(rebuilt: DataFrame) -> DataFrame:
    """(c, d, key, parent, w, ends): the node of depth d each conversation passes, its parent, the last turn's words."""
    upto = Window.partitionBy("c").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(_turn_hash(i)).over(upto).alias(f"k{i}") for i in range(KEY_SUMS)]
    keyed = rebuilt.select("c", "d", "n", words(F.col("text")).cast("long").alias("w"), *sums)
    key = F.concat_ws(":", *[F.col(f"k{i}").cast("string") for i in range(KEY_SUMS)])
    before = Window.partitionBy("c").orderBy("d")
    return keyed.select(
        "c", "d", key.alias("key"), F.coalesce(F.lag(key).over(before), F.lit("")).alias("parent"), "w",
        (F.col("d") == F.col("n")).alias("ends"),
    )


def _ends_digest(ended: DataFrame) -> DataFrame:
    """(d, key, ends_sha256): SHA-256 of the ascending decimal ids of the conversations ending at each node."""
    def stream(batches):
        group, digest, first = None, None, True
        out_d, out_k, out_h = [], [], []
        for batch in batches:
            for d, key, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (d, key) != group:
                    if group is not None:
                        out_d.append(group[0]), out_k.append(group[1]), out_h.append(digest.hexdigest())
                    group, digest, first = (d, key), hashlib.sha256(), True
                digest.update((b"" if first else b",") + str(c).encode())
                first = False
            if len(out_d) >= 4096:
                yield pa.RecordBatch.from_pydict({"d": out_d, "key": out_k, "ends_sha256": out_h})
                out_d, out_k, out_h = [], [], []
        if group is not None:
            out_d.append(group[0]), out_k.append(group[1]), out_h.append(digest.hexdigest())
        if out_d:
            yield pa.RecordBatch.from_pydict({"d": out_d, "key": out_k, "ends_sha256": out_h})

    ordered = ended.select(F.col("d").cast("long"), "key", F.col("c").cast("long")).repartition("d", "key")
    return ordered.sortWithinPartitions("d", "key", "c").mapInArrow(stream, "d long, key string, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    rebuilt, turnless = rebuild(conversations)
    rows = materialise(prefix_rows(rebuilt))
    turnless = materialise(turnless)

    # Discover the nodes of every depth: members, smallest member, parent, last turn's words, ends.
    nodes = rows.groupBy("d", "key").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"), F.first("parent").alias("parent"),
        F.first("w").alias("w"), F.sum(F.col("ends").cast("long")).alias("n_ends"),
    )
    children = nodes.groupBy((F.col("d") - 1).alias("_d"), F.col("parent").alias("_k")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(
        nodes.join(children, (F.col("d") == F.col("_d")) & (F.col("key") == F.col("_k")), "left")
        .select("d", "key", "n_convs", "conv_id", "parent", "w", "n_ends",
                F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))
    )
    # Peeling from each conversation's last turn upward: a node is counted once, by its smallest
    # member, which is a member of every node of its own path from there down; so the subtree
    # totals of a node are sums, over its members, of what they own from its depth down.
    owned = nodes.select(
        F.col("conv_id").alias("c"), "d", ((F.col("n_convs") - 1) * F.col("w")).alias("_saved"),
        (F.col("n_children") == 0).cast("long").alias("_leaf"),
    )
    below = Window.partitionBy("c").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    peeled = rows.select("c", "d", "key").join(owned, ["c", "d"], "left").select(
        "d", "key", "c",
        F.sum(F.coalesce("_saved", F.lit(0))).over(below).alias("_saved"),
        F.sum(F.coalesce("_leaf", F.lit(0))).over(below).alias("_leaves"),
    )
    totals = materialise(peeled.groupBy("d", "key").agg(F.sum("_saved").alias("saved_tokens"), F.sum("_leaves").alias("n_leaves")))
    root_from = peeled.where(F.col("d") == 1)
    top = nodes.where(F.col("d") == 1).agg(F.count(F.lit(1)).alias("n_children"))
    conv_count = root_from.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("m"), F.sum("_saved").alias("s"),
                               F.sum("_leaves").alias("l"))
    ends_at_root = turnless.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("m"))
    root = conv_count.crossJoin(ends_at_root.withColumnsRenamed({"n": "tn", "m": "tm"})).crossJoin(top).select(
        F.lit(0).cast("long").alias("d"), F.lit("").alias("key"), (F.col("n") + F.col("tn")).alias("n_convs"),
        F.least("m", "tm").alias("conv_id"), F.lit(None).cast("string").alias("parent"), "n_children",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.coalesce("l", F.lit(0))).cast("long").alias("n_leaves"),
        F.coalesce("s", F.lit(0)).cast("long").alias("saved_tokens"),
    )
    every = nodes.join(totals, ["d", "key"]).select(
        F.col("d").cast("long").alias("d"), "key", "n_convs", "conv_id", "parent", "n_children", "n_leaves", "saved_tokens"
    ).unionByName(root.where(F.col("n_convs") > 0))
    every = materialise(every)
    parents = every.select((F.col("d") + 1).alias("_d"), F.col("key").alias("_p"), F.col("conv_id").alias("parent_conv_id"))
    ended = rows.where("ends").select("d", "key", "c").unionByName(turnless.select(F.lit(0).alias("d"), F.lit("").alias("key"), "c"))
    digests = _ends_digest(ended).select(F.col("d").alias("_ed"), F.col("key").alias("_ek"), "ends_sha256")
    out = (
        every.join(parents, (F.col("d") == F.col("_d")) & (F.col("parent") == F.col("_p")), "left")
        .join(digests, (F.col("d") == F.col("_ed")) & (F.col("key") == F.col("_ek")), "left")
    )
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", F.col("n_convs").cast("long").alias("n_convs"),
        "n_children", "n_leaves", F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
           " saved_tokens long, ends_sha256 string")
