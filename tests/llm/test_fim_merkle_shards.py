"""Fill-in-middle, Merkle manifest and sharding against plain Python."""
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from lifetab.llm import entry, fill_middle, merkle, sharding
from pyspark.sql import functions as F


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def write(df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def duck(name, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet/*.parquet')")
    rows = con.execute(entry.SQL[name])
    names = [c[0] for c in rows.description]
    return sorted((tuple(sorted(zip(names, r))) for r in rows.fetchall()), key=repr)


def spark_rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def texts(n, seed=1):
    r = random.Random(seed)
    parts = ["été", "a", "long-word", "𝄞", "<", "<P", "S>", "\n", "  ", "\t", "\x0b", " ", " ", "$1", "\\"]
    return ["".join(r.choice(parts) + r.choice(["", " ", "\n"]) for _ in range(r.randrange(12))) for _ in range(n)]


# ---- 11 ---------------------------------------------------------------------

def fim(i, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (i, n, "plain", None, None, sha(text), sha(text))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return (i, n, form, len(p), len(m), sha(out), sha(text))


def test_fill_in_middle(spark, make, odd, tmp_path):
    rows = [(i, t, "en", "a") for i, t in enumerate(texts(300))] + [(1000 + i, f"x <{m}> y", "en", "a") for i, m in enumerate("PSM" * 4)]
    docs = make(rows).unionByName(odd)
    sf = write(docs, tmp_path)
    out = fill_middle.op11_fill_in_middle(spark, sf)
    want = sorted((fim(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert spark_rows(out) == duck("op11_fill_in_middle", sf)


def test_fill_in_middle_long_text_and_none(spark, make, none):
    long = " ".join(f"w{i}" for i in range(400_000)) + "\n"
    docs = make([(i, long, "en", "a") for i in range(8)])
    out = fill_middle.fill_in_middle(docs, rate=100)
    got = out.select("n", "form", (fill_middle.restore(F.col("output"), F.col("form")) == F.col("text")).alias("same")).collect()
    assert all(r.same and r.n == 400_001 and r.form != "plain" for r in got)
    assert fill_middle.fill_in_middle(none).count() == 0


# ---- 12 ---------------------------------------------------------------------

def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return sha("".join(enc(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def plain_tree(leaves, arity=3):
    levels = [leaves]
    while len(levels[-1]) > 1:
        d = levels[-1]
        levels.append([sha("".join(d[i:i + arity])) for i in range(0, len(d), arity)])
    return levels


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(by[s], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[s] = own, plain_tree([leaf_of(r, r.text) for r in own])
    top = plain_tree([trees[s][1][-1][0] for s in names])
    out = []
    for rank, s in enumerate(names):
        own, levels = trees[s]
        for i, r in enumerate(own):
            cut = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            node = leaf_of(r, r.text.replace("\n", "") if cut and r.text is not None else r.text)
            proof = ""
            for path, at in ((levels, i), (top, rank)):
                for level in path[:-1]:
                    run = level[at - at % 3:at - at % 3 + 3]
                    proof += "".join(d for k, d in enumerate(run) if k != at % 3)
                    run[at % 3] = node
                    node = sha("".join(run))
                    at //= 3
            out.append((r.doc_id, levels[0][i], levels[-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes,block", [((1, 1, 1), 3), ((40, 3, 9, 28, 1, 2), 9), ((130, 27), 3), ((130, 27), 2187)])
def test_manifest_equals_plain_tree(spark, make, odd, monkeypatch, tmp_path, sizes, block):
    rows = [(1000 * s + i, f"text {i}\nof {s}" if i % 3 else f"no break {i}", "en", f"s{s}é" if s else None)
            for s, n in enumerate(sizes) for i in range(n)]
    docs = make(rows).unionByName(odd) if len(sizes) > 3 else make(rows)
    sf = write(docs, tmp_path)
    manifest = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda d, **k: manifest(d, block=block, **k))
    out = merkle.op12_merkle_manifest(spark, sf)
    want = plain_manifest(docs.collect())
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert out.columns == list(names)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert len(want) < 10 or {w[-1] for w in want} == {True, False}
    if block == 9:
        assert spark_rows(out) == duck("op12_merkle_manifest", sf)


def test_manifest_of_nothing(spark, none):
    assert merkle.manifest(none).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(none, block=10)


def test_missing_is_the_least_union():
    r = random.Random(3)
    for _ in range(200):
        width = r.randrange(1, 60)
        places = r.sample(range(width), r.randrange(1, width + 1))
        got = {(l, int(p)) for l, m in merkle.missing(np.array(places), width) for p in m}
        widths = [width]
        while widths[-1] > 1:
            widths.append(-(-widths[-1] // 3))
        over = {(l, p // 3 ** l) for p in places for l in range(len(widths))}   # on a path: derived
        need = {(l, q) for l, p in over if l < len(widths) - 1
                for q in range(p - p % 3, min(p - p % 3 + 3, widths[l]))} - over
        assert got == need


# ---- 13 ---------------------------------------------------------------------

def least_capacity(sizes, shards):
    def fits(c):
        n, now = 1, 0
        for s in sizes:
            if s > c:
                return False
            n, now = (n, now + s) if now + s <= c else (n + 1, s)
        return n <= shards
    return next(c for c in range(max(max(sizes), -(-sum(sizes) // shards)), sum(sizes) + 1) if fits(c))


def ordered_sizes(rows):
    groups = {}
    for i, text, *_ in rows:
        g = groups.setdefault(text or "", [0, []])
        g[0] += len((text or "").encode()) + 8
        g[1].append(i)
    return groups


@pytest.mark.parametrize("grid,probes", [(1 << 16, 32), (6, 2), (2, 1)])
def test_minimax_equals_brute_force(spark, monkeypatch, grid, probes):
    monkeypatch.setattr(sharding, "GRID", grid)
    monkeypatch.setattr(sharding, "PROBES", probes)
    r = random.Random(grid)
    for trial in range(4):
        sizes = [r.choice([1, 2, 3, 9, 10, 50, 400 if trial % 2 else 5]) * r.randrange(1, 9) for _ in range(r.randrange(1, 80))]
        shards = r.choice([1, 3, 7, 24])
        ends = np.cumsum(sizes).tolist()
        groups = spark.createDataFrame(list(zip(sizes, ends)), "size long, end long").repartition(3)
        cuts, capacity = sharding.minimax(groups, shards)
        assert capacity == least_capacity(sizes, shards)
        assert set(cuts) <= set(ends[:-1]) and len(cuts) < shards
        edges = [0, *cuts, ends[-1]]
        assert max(b - a for a, b in zip(edges, edges[1:])) == capacity


def test_shards_of_documents(spark, make, odd, none):
    rows = [(i, f"document {i} " + "é" * (i % 50), "en", "a") for i in range(300)]
    rows += [(1000 + i, "the same text over and over", "en", "a") for i in range(700)]
    docs = make(rows).unionByName(odd)
    out = sharding.shard(docs).collect()
    assert len(out) == docs.count()
    text_of = {}
    for r in docs.collect():
        text_of.setdefault(r.doc_id, []).append(r.text or "")
    shards, texts_in = {}, {}
    for r in out:
        assert (r.text_crc32, r.size) in {(zlib.crc32(t.encode()), len(t.encode()) + 8) for t in text_of[r.doc_id]}
        shards.setdefault(r.shard, []).append(r)
        texts_in.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in texts_in.values())
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in shards.values())
    assert set(shards) == set(range(24))
    held = sorted(sum(r.size for r in rs) for rs in shards.values())
    assert held[-1] > 50_000 and held[-2] > 24_000 and held[-3] < 1_600     # two large groups alone, the rest even
    assert sharding.shard(none).count() == 0
    again = sharding.shard(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.shard, r.slot)
    assert sorted(map(key, out)) == sorted(map(key, again))
