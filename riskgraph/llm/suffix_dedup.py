"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of `WINDOW` bytes that covers it also starts earlier: in a document
with a smaller id or earlier in the same one.

1. Each window of `WINDOW` bytes names an anchor: its `GRAM`-byte substring of smallest hash,
   the leftmost of equals. Equal windows have equal anchors, and neighbouring windows mostly
   share one, so a text is a row of pieces, each with one anchor. Pieces whose anchor is
   met once in the whole corpus have no repeated window.
2. The other pieces are dealt by anchor into shards. A shard lays its distinct pieces end to
   end, sorts all suffixes (Larsson-Sadakane: ranks by 8 bytes, then doubling, in which only
   groups that are still tied are sorted again) and finds common prefixes (Kasai: a prefix
   is one shorter than that of the suffix before it unless the characters in front differ;
   only those that can't be had this way are compared). Windows with a common prefix of
   `WINDOW` bytes are equal, all but the first of them repeat.
3. An anchor with more than `HOT_PIECES` pieces is spread over several shards by document,
   so that copies of one passage are spread too. Such a shard also gives the first of each of
   its windows, as runs sorted by a 128-bit hash; they are merged across shards by binary
   search of each run in the union of those before, in ranges of about `RANGE_HEADS` hashes.

Texts are cut into segments of `SEGMENT` bytes that overlap by `WINDOW - 1`, so memory does
not depend on their length; texts of at most `BLOCK` bytes are hashed many at a time. Null
texts count as empty. Rows that repeat an id and a text are one document, with a row each;
texts that share an id count as different documents, in the order of a hash. A null id comes
last. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskgraph.llm.common import map_batches, utf8
from riskgraph.session import materialise, materialise_with

WINDOW, GRAM = 100, 24
SEGMENT = 1 << 20
BLOCK = 1 << 17
SHARD_PIECES = 24_000
HOT_PIECES = 12_000
RANGE_HEADS = 250_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out


_UP, _DOWN = _powers(0x9E3779B97F4A7C15, SEGMENT + 1), _powers(_INVERSE, SEGMENT + 1)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def segment_pieces(data: np.ndarray, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows) of the pieces of at most SEGMENT bytes.

    `begins`: where texts laid end to end begin; no window crosses into the next.
    """
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_stir(data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    grams = _stir((sums[GRAM:] - sums[:-GRAM]) * _DOWN[:n - GRAM + 1])
    # the smallest (upper bits of the hash, place) of every run of `width`: two passes over blocks
    width, place = WINDOW - GRAM + 1, np.uint64((1 << 21) - 1)
    value = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    padded = np.concatenate([value, np.full(-len(value) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - WINDOW + 1
    anchor = (np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows]) & place).astype(np.int64)
    change = np.r_[True, anchor[1:] != anchor[:-1]]
    if begins is None or len(begins) < 2:
        first = np.flatnonzero(change)
        return grams[anchor[first]], first, np.diff(np.r_[first, windows])
    ends = np.r_[begins[1:], n]
    crossing = np.maximum(begins, ends - WINDOW + 1)  # the first window of each text that leaves it
    change[begins[begins < windows]] = True
    change[crossing[crossing < windows]] = True
    first = np.flatnonzero(change)
    count = np.diff(np.r_[first, windows])
    inside = first < crossing[np.searchsorted(begins, first, side="right") - 1]
    first = first[inside]
    return grams[anchor[first]], first, count[inside]


def pieces(data: bytes):
    """(anchor hashes, first windows, numbers of windows) of a text, segment by segment."""
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, max(1, len(data) - WINDOW + 1), SEGMENT - WINDOW + 1):
        anchors, first, count = segment_pieces(whole[at:at + SEGMENT])
        if len(anchors):
            yield anchors, first + at, count


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, place in `texts`, first window, number of windows), in the order of the texts."""
    out = [(np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)]

    def block(begin: int, end: int) -> None:
        sizes = np.array([len(x) for x in texts[begin:end]], np.int64)
        full = np.flatnonzero(sizes)  # empty texts would share the beginning of the next
        begins = np.cumsum(sizes)[full] - sizes[full]
        anchors, first, count = segment_pieces(np.frombuffer(b"".join(texts[begin:end]), np.uint8), begins)
        if len(first):
            at = np.searchsorted(begins, first, side="right") - 1
            out.append((anchors, begin + full[at], first - begins[at], count))

    begin = held = 0
    for i, data in enumerate(texts):
        if held + len(data) > BLOCK:
            block(begin, i)
            begin, held = i, 0
        if len(data) > BLOCK:
            out.extend((anchors, np.full(len(first), i), first, count) for anchors, first, count in pieces(data))
            begin = i + 1
        else:
            held += len(data)
    block(begin, len(texts))
    return tuple(np.concatenate(x) for x in zip(*out))


def _by_eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, with zeros behind the end."""
    n = len(data)
    key = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for i in (1, 2, 4):  # 2, 4, 8 bytes from each place on
        key[:-i] = key[:-i] << np.uint64(8 * i) | key[i:]
        key[-i:] <<= np.uint64(8 * i)
    return key[:n]


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes (8 times a power of two), by refinement."""
    n = len(data)
    key = _by_eights(data)
    order = np.argsort(key)
    sorted_key = key[order]
    begins = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    h = 8
    while h < depth:
        tied = ~(begins & np.r_[begins[1:], True])  # groups of one are in their place
        at = np.flatnonzero(tied)
        if not len(at):
            break
        some = order[at]
        behind = np.where(some + h < n, rank[np.minimum(some + h, n - 1)] + 1, 0)
        pair = rank[some] * (n + 1) + behind
        again = np.argsort(pair)
        some, pair = some[again], pair[again]
        order[at] = some
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        begins[at] = fresh
        rank[some] = np.maximum.accumulate(np.where(fresh, at, 0))
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in `order` (0 for the first)."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    inherits = np.zeros(n, bool)  # the suffix one character longer shares that character too
    inherits[1:] = (before[1:] > 0) & (data[:-1] == data[np.maximum(before[1:], 1) - 1])
    inherits[1:] &= before[:-1] == before[1:] - 1
    start = np.flatnonzero(~inherits & (before >= 0))
    shared = np.zeros(n, np.int64)
    live, a, b = start, start, before[start]
    key = np.r_[_by_eights(data), np.zeros(1, np.uint64)]
    while len(live):
        differ = key[np.minimum(a, n)] ^ key[np.minimum(b, n)]
        same = (differ == 0) & (np.maximum(a, b) < n)
        shared[live[same]] += 8
        other = differ[~same]
        shared[live[~same]] += sum((other < np.uint64(1 << 8 * i)).astype(np.int64) for i in range(8))
        live, a, b = live[same], a[same] + 8, b[same] + 8
    shared[start] = np.minimum(shared[start], n - np.maximum(start, before[start]))  # zeros behind the end are none of the text
    # a suffix that inherits has one less than the suffix in front of it
    last = np.maximum.accumulate(np.where(~inherits, place, 0))
    by_place = np.where(before >= 0, np.maximum(0, shared[last] - (place - last)), 0)
    out = by_place[order]
    out[0] = 0
    return out


def repeated_windows(contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, piece, offset) of all windows of distinct pieces, by group; equal windows have equal groups."""
    data = np.frombuffer(b"\xff".join(contents.to_pylist()) + b"\xff", np.uint8)  # not a byte of UTF-8
    sizes = _sizes(contents)
    first = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    order = suffix_array(data, 128)
    shared = common_prefixes(data, order)
    piece = np.repeat(np.arange(len(sizes)), sizes + 1)
    whole = (np.arange(len(data)) + WINDOW <= (first + sizes)[piece])[order]
    group, at = np.cumsum(shared < WINDOW)[whole], order[whole]
    return group, piece[at], at - first[piece[at]]


def _sizes(binary: pa.BinaryArray) -> np.ndarray:
    return np.diff(np.frombuffer(binary.buffers()[1], np.int32)[binary.offset:binary.offset + len(binary) + 1]).astype(np.int64)


RESULT = "d long, t long, start long, size long, hash binary, range long, shard long"
_FOUND = pa.schema([(c, pa.binary() if c == "hash" else pa.int64()) for c in ("d", "t", "start", "size", "hash", "range", "shard")])
_RUNS = pa.schema([(c, pa.int64()) for c in ("d", "t", "start", "size")])


def _runs(d: np.ndarray, t: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Single windows as runs (d, t, first window, number of windows)."""
    if not len(d):
        return {"d": d, "t": t, "start": at, "size": at}
    order = np.lexsort((at, t, d))
    d, t, at = d[order], t[order], at[order]
    begin = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (at[1:] > at[:-1] + 1)])
    end = np.r_[begin[1:], len(d)] - 1
    return {"d": d[begin], "t": t[begin], "start": at[begin], "size": at[end] - at[begin] + 1}


def _table(columns: dict, schema: pa.Schema, shard: int | None = None) -> pa.Table:
    n = len(columns["d"])
    if shard is not None:
        columns = columns | {"shard": np.full(n, shard)}
    return pa.table([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _numbers(rows: pa.Table, *names: str) -> list[np.ndarray]:
    return [rows.column(c).to_numpy().astype(np.int64, copy=False) for c in names]


def _shard(rows: pa.Table, ranges: int, shard: int) -> pa.Table:
    """One shard: windows that repeat, as runs; of spread anchors also the first of each window."""
    content = rows.column("content").combine_chunks().dictionary_encode()
    code, texts = content.indices.to_numpy(), content.dictionary
    d, t, start = _numbers(rows, "d", "t", "start")
    spread = rows.column("spread").to_numpy()
    order = np.lexsort((start, t, d, code))
    code, d, t, start, spread = code[order], d[order], t[order], start[order], spread[order]
    again = np.r_[False, code[1:] == code[:-1]]
    same_place = again & np.r_[False, (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (start[1:] == start[:-1])]
    copies = again & ~same_place
    size = _sizes(texts) - WINDOW + 1
    out = [_table({"d": d[copies], "t": t[copies], "start": start[copies], "size": size[code[copies]]}, _FOUND, shard)]
    own = np.flatnonzero(~again)  # by code, so in the order of `texts`
    group, piece, offset = repeated_windows(texts)
    alone = np.r_[True, group[1:] != group[:-1]]
    alone &= np.r_[alone[1:], True]
    at = own[piece]
    some = ~alone | spread[at]
    group, at, offset = group[some], at[some], offset[some]
    wd, wt, ws = d[at], t[at], start[at] + offset
    order = np.lexsort((ws, wt, wd, group))
    first = np.r_[True, group[order][1:] != group[order][:-1]][:len(order)]
    later = order[~first]
    out.append(_table(_runs(wd[later], wt[later], ws[later]), _FOUND, shard))
    heads = order[first]
    heads = heads[spread[at[heads]]]
    if len(heads):
        texts = texts.to_pylist()
        hashes = [hashlib.blake2b(texts[c][o:o + WINDOW], digest_size=16).digest() for c, o in zip(code[at[heads]].tolist(), offset[heads].tolist())]
        out.append(_table({"d": wd[heads], "t": wt[heads], "start": ws[heads], "size": np.ones(len(heads), np.int64), "hash": hashes,
                           "range": [int.from_bytes(h[:4]) * ranges >> 32 for h in hashes]}, _FOUND, shard))
    return pa.concat_tables(out)


def _merge(rows: pa.Table) -> pa.Table:
    """First windows of several shards in one range of hashes: all but the first of equal ones repeat.

    The run of each shard is searched in the union of the runs before it.
    """
    names = np.array([h.hex() for h in rows.column("hash").to_pylist()], dtype="S32")
    shard, d, t, start = _numbers(rows, "shard", "d", "t", "start")
    union, owner, later = np.empty(0, "S32"), np.empty(0, np.int64), []
    for one in np.unique(shard):
        run = np.flatnonzero(shard == one)
        run = run[np.argsort(names[run])]
        at = np.searchsorted(union, names[run])
        known = np.zeros(len(run), bool)
        inside = at < len(union)
        known[inside] = union[at[inside]] == names[run[inside]]
        mine, theirs = run[known], owner[at[known]]
        earlier = (d[mine] < d[theirs]) | (d[mine] == d[theirs]) & (
            (t[mine] < t[theirs]) | (t[mine] == t[theirs]) & (start[mine] < start[theirs]))
        later.append(np.where(earlier, theirs, mine))
        owner[at[known]] = np.where(earlier, mine, theirs)
        fresh = run[~known]
        union, owner = np.insert(union, at[~known], names[fresh]), np.insert(owner, at[~known], fresh)
    later = np.concatenate(later) if later else np.empty(0, np.int64)
    return _table(_runs(d[later], t[later], start[later]), _RUNS)


_LAST = np.iinfo(np.int64).max


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("d"), F.col("text").cast("string"))


def _name(data: bytes, ids_repeat: bool) -> int:
    """What tells texts of one id apart; nothing needs to where no id repeats."""
    return xxhash.xxh64_intdigest(data) - (1 << 63) if ids_repeat else 0


def _ids_repeat(docs: DataFrame) -> bool:
    return bool(_documents(docs).groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())


def anchor_rows(docs: DataFrame, ids_repeat: bool = True) -> DataFrame:
    """(anchor, d, t, start): one row per piece of every text."""

    def one(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch)
        anchors, at, first, _ = pieces_of(texts)
        name = np.array([_name(data, ids_repeat) for data in texts], np.int64)
        return {"anchor": anchors.view(np.int64), "d": _numbers(batch, "d")[0][at], "t": name[at], "start": first}

    return map_batches(_documents(docs), one, "anchor long, d long, t long, start long")


@contextmanager
def _shuffles_go(spark):
    """Shuffle files of what is written inside go when it is written; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _candidates(docs: DataFrame, ids_repeat: bool) -> tuple[DataFrame, int, int]:
    """(d, t, starts, spreads) of the pieces whose anchor is met more than once, how many there are, and how many of them are spread."""
    rows = anchor_rows(docs, ids_repeat)
    met, seen = materialise_with(
        rows.select("anchor").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("anchor", F.ceil(F.col("n") / HOT_PIECES).cast("int").alias("spread"), "n"),
        pieces=F.sum("n"), spread=F.sum(F.when(F.col("spread") > 1, F.col("n"))))
    # one row per document and copy of the document's row: `distinct` by document when it is put together
    found = rows.join(met.select("anchor", "spread"), "anchor").groupBy("d", "t").agg(
        F.collect_set(F.struct("start", "spread")).alias("pieces"))
    return materialise(found), seen["pieces"] or 0, seen["spread"] or 0


def _contents(docs: DataFrame, candidates: DataFrame, shards: int, ids_repeat: bool) -> DataFrame:
    """(shard, spread, content, d, t, start) of the candidate pieces."""
    joined = _documents(docs).join(candidates.withColumnRenamed("t", "_t"), "d")

    def one(batch: pa.RecordBatch) -> dict:
        texts, name, found = utf8(batch), *_numbers(batch, "_t"), batch.column("pieces")
        if ids_repeat:  # another text under the same id
            own = np.array([_name(data, True) for data in texts], np.int64) == name
            batch = batch.filter(pa.array(own))
            texts, name, found = [x for x, mine in zip(texts, own) if mine], name[own], batch.column("pieces")
        wanted = found.flatten()
        want, spread = (wanted.field(c).to_numpy().astype(np.int64) for c in ("start", "spread"))
        owner = np.repeat(np.arange(len(texts)), found.value_lengths().to_numpy())
        anchors, at, first, count = pieces_of(texts)
        # a piece by its text and first window, in one number
        long = max(map(len, texts), default=0) + 1
        have, places = at * long + first, owner * long + want
        k = np.searchsorted(have, places)
        anchors, first, count, at, d = anchors[k], first[k], count[k], at[k], _numbers(batch, "d")[0]
        shard = (anchors % np.uint64(shards)).astype(np.int64)
        for i in np.flatnonzero(spread > 1).tolist():
            salt = xxhash.xxh64_intdigest(f"{d[at[i]]} {name[at[i]]} {first[i]}") % int(spread[i])
            shard[i] = (int(anchors[i]) + salt * 0x9E3779B97F4A7C15) % (1 << 64) % shards
        ends = first + count - 1 + WINDOW
        content = [texts[i][a:b] for i, a, b in zip(at.tolist(), first.tolist(), ends.tolist())]
        return {"shard": shard, "spread": spread > 1, "content": content, "d": d[at], "t": name[at], "start": first}

    return map_batches(joined, one, "shard long, spread boolean, content binary, d long, t long, start long")


def repeated_runs(docs: DataFrame, ids_repeat: bool) -> DataFrame:
    """(d, t, runs): for each document the runs (start, size) of windows that also start earlier."""
    with _shuffles_go(docs.sparkSession):
        candidates, count, spread = _candidates(docs, ids_repeat)
        shards = max(1, -(-count // SHARD_PIECES))
        ranges = max(1, -(-spread * (WINDOW - GRAM) // RANGE_HEADS))  # no piece has more windows that are the first of their kind

        def one(key: tuple, rows: pa.Table) -> pa.Table:
            return _shard(rows, ranges, key[0].as_py())

        found = materialise(_contents(docs, candidates, shards, ids_repeat).groupBy("shard").applyInArrow(one, RESULT))
        merged = found.where("hash is not null").groupBy("range").applyInArrow(_merge, "d long, t long, start long, size long")
        runs = found.where("hash is null").select("d", "t", "start", "size").unionByName(merged)
        return materialise(runs.groupBy("d", "t").agg(F.collect_list(F.struct("start", "size")).alias("runs")))


def _strip(data: bytes, starts: list[int], sizes: list[int]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    removed, spans, reach, kept = 0, 0, -1, []  # reach: end of the run so far
    for start, size in sorted(zip(starts, sizes)):
        end = start + size - 1 + WINDOW
        if start > reach:
            kept.append(data[max(reach, 0):start])
            spans += 1
            removed += end - start
        elif end > reach:
            removed += end - reach
        reach = max(reach, end)
    return removed, spans, b"".join(kept) + data[max(reach, 0):]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document; kept holds the remaining bytes."""
    ids_repeat = _ids_repeat(docs)
    runs = repeated_runs(docs, ids_repeat)
    # one row per id: texts that share an id find their own runs by their hash
    runs = runs.groupBy("d").agg(F.collect_list(F.struct("t", F.col("runs.start").alias("start"), F.col("runs.size").alias("size"))).alias("texts"))
    joined = _documents(docs).withColumn("doc_id", F.nullif(F.col("d"), F.lit(_LAST))).join(runs, "d", "left")

    def one(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept")}
        for data, texts in zip(utf8(batch), batch.column("texts").to_pylist()):
            own = next(((x["start"], x["size"]) for x in texts or () if x["t"] == _name(data, ids_repeat)), ([], []))
            removed, spans, kept = _strip(data, *own)
            for k, v in zip(out, (len(data), removed, spans, kept)):
                out[k].append(v)
        return {"doc_id": batch.column("doc_id")} | out

    return map_batches(joined, one, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
