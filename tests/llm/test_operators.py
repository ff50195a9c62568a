"""Each operator against a brute-force version on small tables, with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from riskgraph.llm import bpe, exact_dedup, mixing, quality, reshard, simhash
from riskgraph.llm.common import start
from riskgraph.llm.queries import RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, digest string, fp int"
ODD = [None, "", " ", "\t\n", "a", "A", "x " * 30000, "Ä ä", "one two", "One TWO", "one two three", "\x1c\x85 \xa0z"]


@pytest.fixture(scope="module")
def docs(spark):
    start(spark)
    rnd = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta", "eps", "zeta", "eta", "theta"]
    texts = ODD + [" ".join(rnd.choices(words, k=rnd.randrange(1, 40))) for _ in range(120)]
    texts += ["same text here for all of them"] * 60
    rows = [(i, t, None if i % 11 == 0 else "en", None if i % 13 == 0 else f"s{min(i % 7, 3)}", None, 1, "x", None)
            for i, t in enumerate(texts)]
    rows += [rows[20], rows[21], (None, "no id", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_exact_dedup(docs, empty):
    got = rows_of(exact_dedup.exact_duplicates(*exact_dedup.halves(docs)))
    groups = {}
    all_rows = rows_of(docs.select("doc_id", "text"))
    key = lambda t: hashlib.sha256((t or "").encode().lower()).hexdigest()
    for r in all_rows:
        groups.setdefault(key(r["text"]), []).append(r["doc_id"])
    want = []
    for r in all_rows:
        g = groups[key(r["text"])]
        keep = max((i for i in g if i is not None), default=None)
        want.append((r["doc_id"], keep, len(g), r["doc_id"] == keep, key(r["text"])))
    assert Counter(tuple(r.values()) for r in got) == Counter(want)
    assert exact_dedup.exact_duplicates(*exact_dedup.halves(empty)).count() == 0
    kept = exact_dedup.keep_winners(docs.where("doc_id is not null"))
    assert kept.columns == docs.columns
    assert kept.count() == len({key(r["text"]) for r in all_rows if r["doc_id"] is not None})


@pytest.mark.parametrize("n", [1, 2, 3, 7, 500, 3000])
def test_perfect_hash(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
    seed, moves, slots = exact_dedup.build_slots(digests)
    assert sorted(slots) == list(range(n))
    assert (exact_dedup.find_slots(digests, n, seed, moves) == slots).all()


def brute_print(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", data) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {p: find(p) for p in distinct}


def test_simhash(docs, empty):
    got = rows_of(simhash.near_duplicates(docs))
    all_rows = rows_of(docs.select("doc_id", "text"))
    prints = [brute_print(r["text"]) for r in all_rows]
    roots = brute_components(prints)
    name = {}
    for r, p in zip(all_rows, prints):
        if r["doc_id"] is not None:
            name[roots[p]] = min(name.get(roots[p], 1 << 60), r["doc_id"])
    want = Counter((r["doc_id"], f"{p:016x}", name.get(roots[p])) for r, p in zip(all_rows, prints))
    assert Counter(tuple(r.values()) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("bits", [1, 4, 7])
def test_ball_links_keep_every_component(spark, bits):
    rnd = random.Random(bits)
    prints = {0, 1, 3, 7, 15}
    for _ in range(25):
        base = rnd.getrandbits(64)
        for _ in range(12):
            prints.add(base)
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                base ^= 1 << b
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.close_links(spark.createDataFrame(signed, "fp long"), bits).collect()]
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in links)
    want, root = brute_components(prints), {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    same = {(want[p], find(p)) for p in prints}
    assert len(same) == len(set(want.values())) == len({f for _, f in same})


def test_crowded_key_is_cut_without_loss(monkeypatch):
    rnd = random.Random(9)
    prints = np.array([5 ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(60)], np.uint64)
    whole = {tuple(x) for k in range(4) for x in zip(*simhash._links(k, prints, 2, 0, 1))}
    parts = {tuple(x) for k in range(4) for p in range(3) for x in zip(*simhash._links(k, prints, 2, p, 3))}
    assert whole == parts


def test_mixing(docs, empty):
    found = rows_of(mixing.mix(docs))
    again = rows_of(mixing.mix(docs.repartition(5)))
    assert Counter(map(str, found)) == Counter(map(str, again))
    size = lambda t: len((t or "").encode().split())
    words = Counter()
    for r in rows_of(docs.select("source", "text")):
        words[r["source"]] += size(r["text"])
    order = sorted(words, key=lambda s: (s is None, s or ""))
    due = mixing.targets([words[s] for s in order], 1.5, 2)
    assert abs(sum(due) - 1.5 * sum(words.values())) < 1e-6
    by = {}
    for r in found:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert sorted(by) == sorted({(words[s], t) for s, t in zip(order, due)})
    for (_, target), taken in by.items():  # one source has a document of 30,000 words that fits nowhere
        assert abs(sum(taken) - target) <= (1 if max(taken) < 30000 else 15000)
    assert mixing.mix(empty).count() == 0
    with_ids = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert mixing.take(with_ids).columns == docs.columns


def test_targets_reshare_the_excess():
    assert mixing.targets([10, 100, 100], 1.5, 2, (3, 1, 2)) == pytest.approx([20, 295 / 3, 590 / 3])
    assert mixing.targets([0, 0], 1.5, 2) == [0, 0]


def test_fit_is_as_near_as_any_choice():
    rnd = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted(rnd.sample(range(1, 30), rnd.randrange(1, 5))))
        counts = np.array([rnd.randrange(1, 4) for _ in lengths])
        budget = rnd.randrange(0, int((lengths * counts).sum()) + 1)
        taken = mixing.fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + k * int(n) for s in sums for k in range(c + 1)}
        gap = abs(int((taken * lengths).sum()) - budget)
        assert gap <= lengths.max() and (gap == min(abs(s - budget) for s in sums) or budget > 4 * lengths.max() or gap <= lengths.max() / 2 + 1)


def test_reshard(spark, docs, empty, tmp_path):
    from pyspark.sql import functions as F

    old = F.length(F.coalesce("source", F.lit(""))) + F.coalesce(F.substring("source", 2, 1).cast("int"), F.lit(0))
    found = rows_of(reshard.reshard(docs, old, 7))
    assert len(found) == docs.count()
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    for s in counts:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
                   for r in rows_of(docs.select("doc_id", "text")))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    # the fewest bytes: every surplus shard gives its smallest rows
    by_old = {}
    for r in found:
        by_old.setdefault(r["old_shard"], []).append(r)
    each, extra = divmod(len(found), 7)
    for i, rows in by_old.items():
        moved = sorted(r["size"] for r in rows if r["shard"] != i)
        assert moved == sorted(r["size"] for r in rows)[:len(moved)]
        assert len(moved) in (max(0, len(rows) - each - 1), max(0, len(rows) - each)) or i >= 7
    assert reshard.reshard(empty, old, 7).count() == 0
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    plan = reshard.reshard(unique, old, 7)
    affected = {r["shard"] for r in reshard.rewrite(unique, plan, str(tmp_path / "new")).collect()}
    written = spark.read.parquet(str(tmp_path / "new"))
    assert Counter(r["shard"] for r in written.collect()) == Counter(r["shard"] for r in plan.collect() if r["shard"] in affected)


def test_reshard_moves_the_fewest_bytes(spark):
    import itertools
    from pyspark.sql import functions as F

    start(spark)
    rnd = random.Random(5)
    layouts = [[[64, 65, 127, 127, 127], [64, 100, 100, 100, 100]]]
    layouts += [[[rnd.randint(16, 200) for _ in range(rnd.randint(0, 12))] for _ in range(3)] for _ in range(3)]
    for shards, layout in zip((3, 3, 4, 2), layouts):
        rows = [(k, "x" * (size - 16), i) for k, (i, size) in enumerate((i, size) for i, sizes in enumerate(layout) for size in sizes)]
        df = spark.createDataFrame(rows, "doc_id long, text string, was int").repartition(3)
        found = rows_of(reshard.reshard(df, F.col("was"), shards))
        moved = sum(r["size"] for r in found if r["shard"] != r["old_shard"])
        each, extra = divmod(len(rows), shards)
        best = min(
            sum(sum(sorted(sizes)[:len(sizes) if i >= shards else max(0, len(sizes) - each - (i in more))]) for i, sizes in enumerate(layout))
            for more in itertools.combinations(range(shards), extra))
        assert moved == best, (layout, shards)


def test_reshard_rewrites_the_files_of_a_layout(spark, docs, empty, tmp_path):
    """Null and repeated ids included: every row stands once, in the file of the shard the plan names."""
    from pyspark.sql import functions as F

    for name, table in (("some", docs), ("none", empty)):
        old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(5))
        layout = reshard.lay_out(table, old, str(tmp_path / name / "old"))
        plan = reshard.reshard(layout, F.col("old_shard"), 7)
        affected = reshard.rewrite(layout, plan, str(tmp_path / name / "new"))
        back = rows_of(reshard.read_back(layout, affected, str(tmp_path / name / "new")))
        assert {r["row"]: r["shard"] for r in back} == {r["row"]: r["shard"] for r in rows_of(plan)}
        key = lambda r: repr((r["doc_id"], r["text"], r["source"]))
        assert sorted(map(key, back)) == sorted(map(key, rows_of(table)))


def test_flow_finds_the_cheapest():
    net = reshard.Flow()
    edges = [net.add("s", "a", 4, 1), net.add("s", "b", 2, 2), net.add("a", "t", 2, 1), net.add("a", "b", 2, 1), net.add("b", "t", 4, 1)]
    net.solve("s", "t")
    assert [net.used(e) for e in edges][:2] == [4, 2] and net.used(edges[3]) == 2


@pytest.fixture(scope="module")
def encoder():
    c = bpe.codec(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return c, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=c.ranks, special_tokens={})


def test_bpe_equals_the_library(encoder):
    c, lib = encoder
    rnd = random.Random(3)
    odd = [t or "" for t in ODD] + [" a  b \n c\n d", "x \ny z", "a" * 5000, "0" * 3000, " " * 50 + "\n\n\t x", "it's we'll 'S", "<|endoftext|>"]
    for alphabet in ("ab", "etaoin shr", "aA1 .\n", [chr(i) for i in range(0x20, 0x500)], [chr(i) for i in range(0x1F300, 0x1F700)]):
        odd += ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 400))) for _ in range(60)]
    for t in odd:
        ids = c.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t), t[:80]
        assert c.decode(ids) == t.encode()


def test_bpe_query_columns(encoder, docs, empty):
    c, lib = encoder
    path = public_tokenizers.path(RANKS)
    got = Counter(tuple(r.values()) for r in rows_of(bpe.token_digests(docs, path, public_tokenizers.PATTERN)))
    want = Counter()
    for r in rows_of(docs.select("doc_id", "text")):
        ids = lib.encode_ordinary(r["text"] or "")
        want[(r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    assert got == want
    assert bpe.token_digests(empty, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_stage_encodes_and_decodes_in_one_pass(encoder, docs, empty):
    c, lib = encoder
    path = public_tokenizers.path(RANKS)
    found = bpe.encode_ids(docs, path, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_equal"]
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = Counter()
    for r in found.collect():
        assert r["decoded_equal"]
        got[(r["doc_id"], r["n_tokens"], tuple(np.frombuffer(r["ids"], "<u4").tolist()))] += 1
    want = Counter()
    for r in rows_of(docs.select("doc_id", "text")):
        ids = lib.encode_ordinary(r["text"] or "")
        want[(r["doc_id"], len(ids), tuple(ids))] += 1
    assert got == want
    assert bpe.encode_ids(empty, path, public_tokenizers.PATTERN).count() == 0


def test_quality(spark, sf, docs, empty):
    table, labels = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet"), spark.read.parquet(f"{sf}/../sf0.01/labels.parquet")
    model = quality.train(table, labels)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    found = [r for r in rows_of(quality.scores(table, model)) if r["doc_id"] in truth]
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    odd = rows_of(quality.scores(docs, model))
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in odd)
    assert quality.scores(empty, model).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert {r["score"] for r in rows_of(quality.scores(docs, quality.train(docs, labels.limit(0))))} == {0.5}


def test_quality_slopes_are_those_of_the_loss():
    r = np.random.default_rng(0)
    model, x, first, y = quality.Model(), r.normal(size=(9, quality.FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0, 1])
    loss = lambda: -(lambda s: (y * np.log(s) + (1 - y) * np.log(1 - s)).mean())(model.forward(x, first)[-1])
    slopes = model._slopes(x, first, y)
    for k in ("V", "U", "w"):
        flat = model.p[k].reshape(-1)
        before = flat[1]
        flat[1] = before + 1e-5
        up = loss()
        flat[1] = before - 1e-5
        down = loss()
        flat[1] = before
        assert slopes[k].reshape(-1)[1] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8)


def test_describe_is_the_same_alone_and_in_a_block():
    texts = [b"one two", b"", b"x" * 1000, b"a b c " * 100, b" \n lead", "é à".encode()]
    together, first = quality.describe(texts)
    for i, t in enumerate(texts):
        alone, _ = quality.describe([t])
        assert np.allclose(together[first[i]:first[i] + len(alone)], alone, atol=1e-6)


def test_keep_one_judges_rows_not_ids(spark):
    rows = [(5, "alpha beta gamma delta epsilon", "s"), (5, "one two three four five six", "s"),
            (3, "one two three four five six", "s"), (7, "same same text here now", "s"), (7, "same same text here now", "s"),
            (None, "nothing like the others at all", "s"), (None, "one two three four five six", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    kept = sorted((tuple(r) for r in simhash.keep_one(docs.withColumn("doc_id_2", docs["doc_id"])).drop("doc_id_2").collect()),
                  key=key)
    assert kept == sorted([(5, "alpha beta gamma delta epsilon", "s"), (3, "one two three four five six", "s"),
                           (7, "same same text here now", "s"), (None, "nothing like the others at all", "s")],
                          key=key)


def test_take_repeats_rows_as_the_mix_says(spark):
    rows = [(1, "a b", "x"), (1, "c d e", "x"), (1, "a b", "x"), (2, "f", "y"), (3, "g h i j", "z"), (None, "k", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.take(docs).collect()
    planned = mixing.mix(docs).agg({"times": "sum"}).first()[0]
    assert len(taken) == planned
    counts = Counter(tuple(r) for r in taken)
    for row, n in Counter(rows).items():
        assert counts.get(row, 0) <= 2 * n
