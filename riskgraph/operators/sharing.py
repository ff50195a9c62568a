"""Accounts connected by shared devices.

Two accounts are neighbours when they share at least one device. A device used by
many accounts makes a clique, so the neighbour list grows with the square of its
users; `shared_device_edges` produces that list because it is a result of its own,
but nothing else in the package is computed from it. Sums over neighbours use the
`Sharing` form, which is linear in (account, device) rows:

    sum over neighbours of x  =  sum over device subsets S of an account,
                                 (-1)^(|S|+1) * (sum of x over accounts having all of S)
                                 minus x of the account itself

(inclusion-exclusion, so a neighbour met on several devices counts once). Only the
subsets that two accounts hold are needed; they are grown as a lattice level by level
(`shared_subsets`), with no cap on devices per account and no list of pairs. Its size
is the number of (account, shared set) memberships: linear in (account, device) rows
when accounts share few devices with any one other account; k devices that two accounts
both hold give 2^k - 1 sets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.functions import skew
from riskgraph.functions.skew import attach
from riskgraph.session import materialise, materialise_with



def uses(df: DataFrame) -> DataFrame:
    """Distinct (account_id, device_id)."""
    return df.select("account_id", "device_id").where(
        F.col("account_id").isNotNull() & F.col("device_id").isNotNull()
    ).distinct()


@dataclass
class Pairs:
    """(account, device) pairs read once for all graph operators."""

    uses: DataFrame
    accounts: DataFrame
    rows: int


def pairs_of(df: DataFrame) -> Pairs:
    """One scan of two columns; accounts without a device are kept as accounts."""
    both, seen = materialise_with(
        df.select("account_id", "device_id").where(F.col("account_id").isNotNull()).distinct()
    )
    return Pairs(both.where(F.col("device_id").isNotNull()), both.select("account_id").distinct(), seen["rows"])


def visits(df: DataFrame) -> DataFrame:
    """Distinct (account_id, merchant_id)."""
    return df.select("account_id", "merchant_id").where(
        F.col("account_id").isNotNull() & F.col("merchant_id").isNotNull()
    ).distinct()


def account_profile(df: DataFrame) -> DataFrame:
    """Nested profile: per account and calendar day (`part`), its transactions as an array, with
    that day's merchant and device sets.

    One shape at every size: an account of five transactions and one of fifty thousand are
    both cut by day, so no array holds more than one account's day. The account-wide sets
    are tables of their own (`visits`, `uses`), not arrays. A null timestamp makes a part of
    its own (null day).
    """
    return df.groupBy("account_id", F.to_date("timestamp").alias("part")).agg(
        F.collect_list(
            F.struct("transaction_id", "amount", "timestamp", "merchant_id", "device_id", "is_fraud")
        ).alias("transactions"),
        F.sort_array(F.collect_set("merchant_id")).alias("merchants"),
        F.sort_array(F.collect_set("device_id")).alias("devices"),
    )


def whole_profile(parts: DataFrame) -> DataFrame:
    """(account_id, txn_count, total_amount, merchants, devices): the parts of `account_profile` put together,
    one row per account with all its merchants and devices. The transactions stay in the parts."""
    amounts = F.filter(F.transform("transactions", lambda t: t["amount"].cast("double")), lambda a: a.isNotNull())
    total = F.when(F.size(amounts) > 0, F.aggregate(amounts, F.lit(0.0), lambda s, a: s + a))

    def entry(n=F.lit(None), total=F.lit(None), merchant=F.lit(None), device=F.lit(None)) -> Column:
        return F.struct(n.cast("bigint").alias("n"), total.cast("double").alias("total"),
                        merchant.cast("string").alias("merchant"), device.cast("string").alias("device"))

    entries = F.concat(
        F.array(entry(n=F.size("transactions"), total=total)),
        F.transform("merchants", lambda m: entry(merchant=m)), F.transform("devices", lambda d: entry(device=d)),
    )
    # One entry per part, merchant and device: the sets are merged by partial aggregates, not from whole arrays.
    return parts.select("account_id", F.explode(entries).alias("e")).groupBy("account_id").agg(
        F.sum("e.n").alias("txn_count"), F.sum("e.total").alias("total_amount"),
        F.sort_array(F.collect_set("e.merchant")).alias("merchants"),
        F.sort_array(F.collect_set("e.device")).alias("devices"),
    )


#: Pairs one cell of the device grid produces at most (in expectation; parts are hashed).
PAIRS_PER_CELL = 1_000_000


def device_grid(u: DataFrame, pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """(device_id, src, dst, _i, _j): every ordered pair of accounts of a device, in grid cells.

    A device of n accounts is cut into a = ceil(n / sqrt(pairs_per_cell)) parts by a hash
    of the account. The cell (i, j) joins part i as source with part j as destination, so
    it holds about (n / a)^2 <= pairs_per_cell pairs: a cell's output is fixed whatever
    the size of the device. Each account row is copied a times on either side, so the
    input of the join grows as n * a and not as its n^2 output.
    """
    n = u.groupBy("device_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = n.select("device_id", "_n", F.ceil(F.col("_n") / F.lit(float(pairs_per_cell) ** 0.5)).cast("int").alias("_a"))
    sized = attach(u, parts, "device_id", how="inner", weight="_n")
    part = F.pmod(F.xxhash64("account_id", F.lit(11)), F.col("_a")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_a") - 1))
    left = sized.select("device_id", F.col("account_id").alias("src"), part.alias("_i"), every.alias("_j"))
    right = sized.select("device_id", F.col("account_id").alias("dst"), every.alias("_i"), part.alias("_j"))
    return left.join(right, ["device_id", "_i", "_j"]).where("src <> dst")


def shared_device_edges(df: DataFrame, pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """Every ordered pair of accounts sharing a device, as the export of the graph.

    Pairs are made in the cells of `device_grid`, so a popular device is spread over
    many tasks of bounded output; pairs met on several devices are kept once.
    """
    return device_grid(uses(df), pairs_per_cell).select("src", "dst").distinct()


@dataclass
class Sharing:
    """Compressed neighbour relation.

    accounts  account_id
    inward    grp, account_id: members of every shared group, and a group of its own per account
    outward   grp, account_id, sign, itself, copies, salt: what an account takes from a group
    short     all of these were counted and are short enough to broadcast
    pairs     what it was built from
    """

    accounts: DataFrame
    inward: DataFrame
    outward: DataFrame
    short: bool
    pairs: Pairs

    def _join(self, left: DataFrame, right: DataFrame, keys) -> DataFrame:
        return left.join(F.broadcast(right) if self.short else right.hint("merge"), keys)

    def gather(self, x: DataFrame, value: str, outward: DataFrame | None = None, **kept: Column) -> DataFrame:
        """(account_id, total, own, kept..): sum of `value` over the neighbours, and the account's own.

        `x` is read once, so steps of an iteration can be chained in one plan.
        `kept` are further aggregates over the account's rows of `outward`.
        """
        xs = x.select("account_id", F.col(value).alias("_x"))
        per_group = self._join(self.inward, xs, "account_id").groupBy("grp", "copies").agg(F.sum("_x").alias("_t"))
        per_group = per_group.select("grp", "_t", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
        taken = self._join(self.outward if outward is None else outward, per_group, ["grp", "salt"])
        return taken.groupBy("account_id").agg(
            F.sum(F.col("sign") * F.col("_t")).alias("total"),
            F.sum(F.when(F.col("itself"), F.col("_t"))).alias("own"),
            *[c.alias(k) for k, c in kept.items()],
        )

    def degrees(self) -> DataFrame:
        """(account_id, connected_accounts) for every account, 0 when isolated."""
        ones = self.accounts.withColumn("_one", F.lit(1).cast("bigint"))
        return self.gather(ones, "_one").select("account_id", F.col("total").cast("bigint").alias("connected_accounts"))


def shared_subsets(u: DataFrame) -> DataFrame:
    """(account_id, _subset): every device set, sorted, that the account and at least one other account hold.

    The lattice is grown level by level (a set held by two accounts has all its subsets
    held by them too): the sets of one level are extended by a larger shared device of the
    same account, and kept where two accounts hold the extension. Accounts with many
    devices pay only for the sets they really share; a hub device met by every account is
    one set of level one. Sets are counted with partial sums and joined by `attach`, so a
    set held by a third of all accounts is spread over many tasks.
    """
    held = u.groupBy("device_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared, seen = materialise_with(attach(u, held, "device_id", how="inner", weight="_n").select("account_id", "device_id"))
    level = shared.select("account_id", F.array("device_id").alias("_subset"), F.col("device_id").alias("_last"))
    levels = [level]
    rows = seen["rows"]
    while rows:
        grown = attach(level, shared.select("account_id", F.col("device_id").alias("_d")), "account_id", how="inner")
        grown = grown.where(F.col("_d") > F.col("_last")).select(
            "account_id", F.concat("_subset", F.array("_d")).alias("_subset"), F.col("_d").alias("_last")
        )
        counts = grown.groupBy("_subset").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        level, seen = materialise_with(attach(grown, counts, "_subset", how="inner", weight="_n").select(
            "account_id", "_subset", "_last"
        ))
        rows = seen["rows"]
        if rows:
            levels.append(level)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.select("account_id", "_subset")


def sharing(df: DataFrame, rows_per_copy: int | None = None) -> Sharing:
    """Build the compressed neighbour relation of a transaction table."""
    rows_per_copy = rows_per_copy or skew.HOT_ROWS
    pairs = pairs_of(df)
    members = shared_subsets(pairs.uses)
    popular = (
        members.groupBy("_subset").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("grp", F.monotonically_increasing_id())
    )
    groups, seen_groups = materialise_with(
        attach(members, popular, "_subset", how="inner", weight="_n").select(
            "grp", "account_id", F.when(F.size("_subset") % 2 == 1, 1).otherwise(-1).alias("sign")
        )
    )
    met = groups.groupBy("account_id").agg(F.sum("sign").alias("_met"))
    # Own groups are numbered downwards from -1, shared ones upwards from 0.
    accounts, seen_accounts = materialise_with(
        pairs.accounts.join(met, "account_id", "left").select(
            "account_id", (-F.coalesce("_met", F.lit(0))).cast("int").alias("sign"),
            (-1 - F.monotonically_increasing_id()).alias("grp"),
        )
    )
    outward = groups.withColumn("itself", F.lit(False)).unionByName(accounts.withColumn("itself", F.lit(True)))
    outward, seen_out = materialise_with(outward)
    copies = outward.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_copy)).alias("copies"))
    copies, seen_copies = materialise_with(copies)
    salted = attach(outward, copies, "grp", right_rows=seen_copies["rows"]).withColumn(
        "salt", F.pmod(F.xxhash64("account_id"), F.col("copies"))
    )
    inward = groups.select("grp", "account_id").unionByName(accounts.select("grp", "account_id"))
    inward = attach(inward, copies, "grp", right_rows=seen_copies["rows"])
    inward, seen_in = materialise_with(inward)
    short = max(seen_in["rows"], seen_out["rows"]) <= skew.loop_rows()
    return Sharing(accounts.select("account_id"), inward, materialise(salted), short, pairs)


def lowest_neighbours(df: DataFrame, most: int = 10, pairs: Pairs | None = None) -> DataFrame:
    """(account1, account2): each account's `most` lowest-named neighbours.

    Only the lowest `most + 1` accounts of a device can be among them, and that cut
    is made per device before accounts are joined to it.
    """
    u = (pairs or pairs_of(df)).uses
    by_device = Window.partitionBy("device_id").orderBy("account_id")
    firsts = (
        u.withColumn("_rank", F.row_number().over(by_device)).where(F.col("_rank") <= most + 1)
        .select("device_id", F.col("account_id").alias("account2"))
    )
    near = (
        attach(u.withColumnRenamed("account_id", "account1"), firsts, "device_id", how="inner")
        .where("account1 <> account2").select("account1", "account2").distinct()
    )
    by_account = Window.partitionBy("account1").orderBy("account2")
    return near.withColumn("_rank", F.row_number().over(by_account)).where(F.col("_rank") <= most).drop("_rank")
