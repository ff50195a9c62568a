"""Graph operators on hand-made graphs and against brute force."""

import itertools
import random
from collections import defaultdict, deque

import pytest

from riskgraph.operators import components, louvain, paths, property_graph, rank, rings, sharing

PATH = [("a", "1"), ("b", "1"), ("b", "2"), ("c", "2"), ("c", "3"), ("d", "3")]
STAR = [("x", "1"), ("a", "1"), ("x", "2"), ("b", "2"), ("x", "3"), ("c", "3"), ("x", "4"), ("d", "4")]
BRIDGE = [(a, "1") for a in "abc"] + [(a, "2") for a in "def"] + [("c", "3"), ("d", "3")]


def neighbours(pairs):
    users, out = defaultdict(set), {a: set() for a, _ in pairs}
    for a, d in pairs:
        users[d].add(a)
    for members in users.values():
        for a, b in itertools.permutations(members, 2):
            out[a].add(b)
    return out


def random_pairs(seed, accounts=24, devices=14, rows=60):
    rnd = random.Random(seed)
    # One device is used by a third of all rows, and one account uses many devices.
    out = [(f"a{rnd.randrange(accounts):02d}", "hub" if rnd.random() < 0.33 else f"d{rnd.randrange(devices):02d}")
           for _ in range(rows)]
    return out + [("a00", f"d{i:02d}") for i in range(devices)]


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def betweenness_by_hand(adj):
    score = dict.fromkeys(adj, 0)
    for s in adj:
        level, order = {s: 0}, deque([s])
        while order:
            u = order.popleft()
            for v in adj[u]:
                if v not in level:
                    level[v] = level[u] + 1
                    order.append(v)
        parent = {v: max(u for u in adj[v] if level.get(u) == level[v] - 1) for v in level if v != s}
        for t in parent:
            at = parent[t]
            while at != s:
                score[at] += 1
                at = parent[at]
    top = max(score.values()) or 1
    return {k: v / top for k, v in score.items()}


def pagerank_by_hand(adj, max_iter, alpha=0.85):
    n = len(adj)
    pr = dict.fromkeys(adj, 1 / n)
    for _ in range(max_iter):
        new = {a: (1 - alpha) / n + alpha * sum(pr[b] / len(adj[b]) for b in adj[a]) for a in adj}
        if all(abs(new[a] - pr[a]) <= 1e-6 + 1e-5 * abs(pr[a]) for a in adj):
            break
        pr = new
    return pr


def components_by_hand(adj):
    out = {}
    for s in sorted(adj):
        if s in out:
            continue
        waiting = [s]
        while waiting:
            u = waiting.pop()
            if u not in out:
                out[u] = s
                waiting += adj[u]
    return out


@pytest.mark.parametrize("pairs", [PATH, STAR, BRIDGE, PATH + [("z", "9")], random_pairs(1), random_pairs(2)])
def test_against_brute_force(make_transactions, pairs):
    df, adj = make_transactions(pairs), neighbours(pairs)
    graph = sharing.sharing(df)
    assert as_dict(graph.degrees(), "account_id", "connected_accounts") == {a: len(b) for a, b in adj.items()}
    assert as_dict(components.account_components(df), "account_id", "community_id") == components_by_hand(adj)
    pr, want = as_dict(rank.pagerank(df, max_iter=15, graph=graph), "account_id", "pagerank_score"), pagerank_by_hand(adj, 15)
    assert pr == pytest.approx(want, abs=1e-9)
    found = as_dict(paths.betweenness(df), "account_id", "betweenness_centrality")
    assert found == pytest.approx(betweenness_by_hand(adj))
    edges = {tuple(r) for r in sharing.shared_device_edges(df).collect()}
    assert edges == {(a, b) for a in adj for b in adj[a]}


@pytest.mark.parametrize("rows_per_copy", [1, 2, 3])
def test_degrees_with_split_groups(make_transactions, rows_per_copy):
    pairs = random_pairs(7)
    graph = sharing.sharing(make_transactions(pairs), rows_per_copy)
    want = {a: len(b) for a, b in neighbours(pairs).items()}
    assert as_dict(graph.degrees(), "account_id", "connected_accounts") == want


def test_lowest_neighbours(make_transactions):
    pairs = random_pairs(3)
    got = defaultdict(list)
    for r in sharing.lowest_neighbours(make_transactions(pairs), 3).collect():
        got[r["account1"]].append(r["account2"])
    want = {a: sorted(b)[:3] for a, b in neighbours(pairs).items() if b}
    assert {a: sorted(b) for a, b in got.items()} == want


def test_ring_limits_are_strict(make_transactions):
    rows = []
    for device, a, b, merchants, other in (
        ("1", "a", "b", "xy", 0.69), ("2", "c", "d", "xy", 0.71), ("3", "e", "f", "x", 1.0)
    ):
        rows += [(a, device, m, 100) for m in merchants] + [(b, device, m, 100 * other) for m in merchants]
    found = {(r["account1"], r["account2"]) for r in rings.fraud_rings(make_transactions(rows)).collect()}
    assert found == {("c", "d"), ("d", "c")}


def test_no_rings_keeps_the_columns(make_transactions):
    df = make_transactions([("a", "1"), ("b", "2")])
    found = rings.fraud_rings(df)
    assert found.columns == ["account1", "account2", "shared_merchants", "amount_similarity", "ring_size"]
    assert {r["fraud_ring_flag"] for r in rings.ring_flags(df, found).collect()} == {0}


def test_suspicious_counts_multiply(make_transactions):
    rows = []
    for account, devices, payments in (("a", 2, 2), ("b", 2, 3), ("c", 3, 1), ("d", 2, 6), ("e", 1, 5)):
        rows += [(account, f"{account}{i % devices}", "m", 600 if i < payments else 1) for i in range(max(devices, payments))]
    found = as_dict(property_graph.suspicious_accounts(make_transactions(rows)), "account_id", "high_value_txns")
    assert found == {"b": 6, "c": 3, "d": 12}


@pytest.mark.parametrize("seed", [4, 5])
def test_device_rings_against_all_pairs(make_transactions, seed):
    rnd = random.Random(seed)
    rows = [(a, d, f"m{rnd.randrange(4)}", rnd.choice([0, 1, 10, 11.9, 12, 12.1, 15, 100, 124.9])) for a, d in random_pairs(seed, rows=90)]
    devices, paid = defaultdict(set), defaultdict(list)
    for a, d, m, x in rows:
        devices[a].add(d)
        paid[a].append((m, float(x)))
    want = sorted(
        (a, b) for a, b in itertools.permutations(devices, 2)
        if len(devices[a] & devices[b]) > 1
        and any(m == n and y * 0.8 < x < y * 1.2 for m, x in paid[b] for n, y in paid[a])
    )
    for limit in (5, 1000):
        got = property_graph.device_rings(make_transactions(rows), limit).collect()
        assert sorted((r["account1"], r["account2"]) for r in got) == want[:limit]


def test_louvain_splits_the_bridge(make_transactions):
    out = louvain.louvain(make_transactions(BRIDGE)).collect()
    label = {r["account_id"]: r["community_id"] for r in out}
    assert label["a"] == label["b"] and label["e"] == label["f"] and label["a"] != label["e"]
    assert out[0]["modularity"] > 0


def test_profile_parts_by_day_at_every_size(make_transactions):
    """5 and 50,000 rows per account give the same shape: one part per account and day."""
    rows = [("small", "1", "m", 1.0, f"2024-01-0{1 + i % 3} 10:00:00") for i in range(5)]
    rows += [("big", f"d{i % 7}", f"m{i % 11}", 2.0, f"2024-01-{1 + i % 20:02d} 1{i % 10}:00:00") for i in range(50_000)]
    out = sharing.account_profile(make_transactions(rows)).toPandas()
    assert out.groupby("account_id").size().to_dict() == {"small": 3, "big": 20}
    assert out["transactions"].map(len).sum() == 50_005
    assert out[out["account_id"] == "big"]["transactions"].map(len).max() == 2_500
    assert list(out.columns) == ["account_id", "part", "transactions", "merchants", "devices"]


def test_whole_profile_puts_the_days_together(make_transactions):
    rows = [("big", f"d{i % 7}", f"m{i % 11}", 2.0, f"2024-01-{1 + i % 20:02d} 10:00:00") for i in range(12_000)]
    rows += [("small", "d1", "m1", 1.5), ("small", "d2", "m1", 1.0, "2024-01-02 10:00:00")]
    out = {r["account_id"]: r for r in sharing.whole_profile(sharing.account_profile(make_transactions(rows))).collect()}
    assert len(out) == 2
    assert (out["big"]["txn_count"], out["big"]["total_amount"]) == (12_000, 24_000.0)
    assert out["big"]["merchants"] == sorted(f"m{i}" for i in range(11)) and out["big"]["devices"] == [f"d{i}" for i in range(7)]
    assert tuple(out["small"])[1:] == (2, 2.5, ["m1"], ["d1", "d2"])


def test_hub_device_of_accounts_with_many_devices(make_transactions):
    """Every account has 20 devices, one of them a hub of all; neighbours in twos share two more.

    The lattice holds 7 sets per account (hub, both pair devices, and their unions), so it is
    shorter than the (account, device) rows; nothing grows with the square of the hub.
    """
    n = 2000
    rows = []
    for i in range(n):
        devices = ["hub", f"g{i // 2}a", f"g{i // 2}b"] + [f"p{i}_{k}" for k in range(17)]
        rows += [(f"a{i:05d}", d) for d in devices]
    df = make_transactions(rows)
    memberships = sharing.shared_subsets(sharing.uses(df)).count()
    assert memberships == 7 * n <= len(rows)
    degrees = as_dict(sharing.sharing(df).degrees(), "account_id", "connected_accounts")
    assert degrees == {f"a{i:05d}": n - 1 for i in range(n)}


def test_grid_cells_of_a_hub_device_are_bounded(make_transactions):
    """One device of 1,500 accounts: 2,247,000 pairs in cells of at most about 40,000."""
    rows = [(f"a{i:05d}", "hub") for i in range(1500)] + [("a00001", "d2"), ("b", "d2"), ("c", "d3")]
    df = make_transactions(rows)
    grid = sharing.device_grid(sharing.uses(df), pairs_per_cell=40_000)
    cells = grid.groupBy("device_id", "_i", "_j").count().toPandas()
    hub = cells[cells["device_id"] == "hub"]
    assert len(hub) == 64 and hub["count"].max() <= 1.5 * 40_000  # a = ceil(1500 / 200) = 8 parts
    assert hub["count"].sum() == 1500 * 1499
    edges = sharing.shared_device_edges(df, pairs_per_cell=40_000)
    assert edges.count() == 1500 * 1499 + 2
