"""The Merkle manifest against a plain fold in Python."""

import hashlib
import random
import zlib

from riskgraph.llm import merkle


def H(s): return hashlib.sha256(s.encode()).hexdigest()
def fld(v): return "-" if v is None else f"{len(str(v).encode())}:{v}"
def leaf(r, text): return H("".join(fld(x) for x in (r[0], r[3], r[2], r[4], text)))

def brute(rows):
    # rows: (doc_id, text, lang, source, n_chars)
    def tamper(r):
        t = r[1]
        if r[0] is not None and t is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            return t.replace("\n", "")
        return t
    def fold(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            cur = levels[-1]
            levels.append([H("".join(cur[i:i + 3])) for i in range(0, len(cur), 3)])
        return levels
    def path(levels, i):
        out = []
        for lv in levels[:-1]:
            s = i // 3 * 3
            out.append(("".join(lv[s:i]), "".join(lv[i + 1:s + 3])))
            i //= 3
        return out
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    keyf = lambda s: (s is not None, (s or "").encode())
    srcs = sorted(by, key=keyf)
    sub = {}
    for s in srcs:
        rs = sorted(by[s], key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, leaf(r, r[1])))
        lv = fold([leaf(r, r[1]) for r in rs])
        sub[s] = (rs, lv)
    top = fold([sub[s][1][-1][0] for s in srcs])
    root = top[-1][0]
    out = {}
    for si, s in enumerate(srcs):
        rs, lv = sub[s]
        for i, r in enumerate(rs):
            p = path(lv, i) + path(top, si)
            cur = leaf(r, tamper(r))
            for l, rr in p:
                cur = H(l + cur + rr)
            out.setdefault(r[0], []).append((leaf(r, r[1]), lv[-1][0], root, H("".join(l + rr for l, rr in p)), cur, cur == root))
    return out



def _check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.manifest(df.withColumn("extra", df["text"])).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for g in got:
        t = (g["leaf"], g["subroot"], g["root"], g["proof_sha256"], g["folded_root"], g["verified"])
        assert t in want[g["doc_id"]]
    return got


def test_manifest_equals_plain_fold(spark):
    random.seed(1)
    rows = []
    for i in range(200):
        src = random.choice(["a", "b", None, "\u00e9", "c"]) if i % 7 else "a"
        text = random.choice([None, "", "x\ny", "hello\n\nworld", "plain", "long " * 5000])
        rows.append((i, text, random.choice([None, "en"]), src, None if text is None else len(text)))
    rows += [(None, "z\n", "en", "a", 2), (5, "dup", "en", "a", 3), (5, "dup", "en", "a", 3), (999, "solo\n", None, "solo", 5)]
    got = _check(spark, rows)
    assert 0 < sum(g["verified"] for g in got) < len(got)


def test_one_row_and_empty(spark):
    got = _check(spark, [(4, "a\nb", None, None, 3)])
    assert got[0]["root"] == got[0]["leaf"] == got[0]["subroot"] and got[0]["proof_sha256"] == H("")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.manifest(empty).count() == 0


def test_one_source_of_many_levels(spark):
    rows = [(i, f"t{i}\n", "en", "hot", 3) for i in range(100)] + [(1000, "x", "en", "cold", 1)]
    _check(spark, rows)
