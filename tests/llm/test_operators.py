"""Small fixtures against brute force, and the defined odd cases."""
import collections
from collections import Counter
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lifetab.llm import (common, fingerprints, jaccard_join, language_id, line_dedup, lm_scoring, mixing, packing, pii,
                         topk_search, toxicity)

from .conftest import LINE, ODD


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


# ---- 1: language model

def tokens(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [" "]


def test_lm_base_and_distribution(make, odd, none):
    rows = [(i, " ".join(words(30, i)) + " The end, of it.", "en", "a") for i in range(60)] + ODD
    docs = make(rows)
    model = lm_scoring.train(docs.where("doc_id % 2 = 0 or doc_id is null"), rounds=3)
    got = sorted(lm_scoring.score(docs, model).collect(), key=str)
    count = collections.Counter(t for i, x, *_ in rows if i is None or i % 2 == 0 for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = collections.Counter()
    for i, x, *_ in rows:
        t = tokens(x)
        want[i, len(t), sum(count[w] > 0 for w in t), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6)] += 1
    assert want == collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    units = model["units"]
    p = np.exp(lm_scoring.log_probs(model["theta"], units, np.array([0, 5, (lm_scoring.CLASSES + 1) * (units.n + 1) + units.n])))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    assert lm_scoring.score(none, model).count() == 0
    empty = lm_scoring.train(none, rounds=1)
    assert {round(r.base_score, 9) for r in lm_scoring.score(odd, empty).collect()} == {0.0}


def test_lm_counts_pairs_of_all_words(make):
    import xxhash
    shared = " ".join(f"frequent{k}" for k in range(lm_scoring.SHORTLIST + 9))     # fills the shortlist
    rows = [(i, shared, "en", "a") for i in range(20)] + [(100 + i, f"rareone{i % 3} raretwo{i % 3} rarefour{i % 3}", "en", "a") for i in range(6)]
    model = lm_scoring.train(make(rows), rounds=2)
    assert not set(model["units"].words.to_pylist()) & {f"rareone{k}" for k in range(3)}
    seen, other, skip = (lm_scoring.score(make([(1, t, "en", "a")]), model).first().score for t in (
        "rareone1 raretwo1 rarefour1", "rareone1 raretwo2 rarefour1", "raretwo2 rareone1 rarefour1"))
    assert seen > other > skip
    got = {k: n for r in model["keys"].collect() for k, n in zip(np.frombuffer(r.a, np.uint64).tolist(), np.frombuffer(r.b, np.int64).tolist())}
    want = collections.Counter()
    for _, text, *_ in rows:
        own = ["start", "start", *tokens(text)]
        for two, one, y in zip(own, own[1:], own[2:]):
            want.update([("w", y), ("1", one), ("2", two), ("1", one, y), ("2", two, y)])
    assert len(got) == len(want) and sorted(got.values()) == sorted(want.values())
    words = np.array([xxhash.xxh3_64_intdigest(w) for w in ("rareone1", "raretwo1")], np.uint64)
    own = lm_scoring.Keys(words, np.array([0, 1]), np.array([0, 2]))
    assert [got[int(k)] for k in own.pairs[:2]] == [want["1", "start", "rareone1"], want["1", "rareone1", "raretwo1"]]


def test_lm_score_is_the_plain_formula(make, monkeypatch):
    rows = [(i, " ".join(words(25, i, 40)), "en", "a") for i in range(30)] + ODD
    docs, learned = make(rows), F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    own = [["start", "start", *tokens(x)] for i, x, *_ in rows if i is None or i % 3]
    count = collections.Counter(w for t in own for w in t[2:])
    pairs = [collections.Counter((t[k - back], t[k]) for t in own for k in range(2, len(t))) for back in (1, 2)]
    seen = [collections.Counter(h for h, _ in p.elements()) for p in pairs]
    for known in (1 << 16, 6):      # with few numbered words, the others meet by their hashes
        monkeypatch.setattr(lm_scoring, "KNOWN", known)
        model = lm_scoring.train(docs.where(learned), rounds=1)
        assert len(model["known"].value[0]) <= known
        units, (mass, kinds), discount = model["units"], model["rest"], model["discount"]

        def score(text):
            t = ["start", "start", *tokens(text)]
            unit = units.of(pa.array(t[2:-1], pa.string())) if t[3:] else np.zeros(0, np.int64)
            h, y, _ = units.sequences(unit, np.array([0, len(unit)]))
            lp, out = lm_scoring.log_probs(model["theta"], units, h), 0.0
            for k, w in enumerate(t[2:]):
                p, c = math.exp(lp[k, y[k]]), y[k] - units.first_rest
                if c >= 0:
                    p *= (max(count[w] - discount, 1e-9) if count[w] else (discount * kinds[c] + 1) / (kinds[c] + 1)) / (mass[c] + 1)
                for back, m in ((2, lm_scoring.PRIOR[1]), (1, lm_scoring.PRIOR[0])):
                    p = (pairs[back - 1][t[k + 2 - back], w] + m * p) / (seen[back - 1][t[k + 2 - back]] + m)
                out += math.log10(p)
            return out
        want = sorted((str(i), round(score(x), 5)) for i, x, *_ in rows)
        for got in (lm_scoring.score(docs, model), lm_scoring.score(docs, model, learned=learned)):
            assert np.allclose([v for _, v in sorted((str(r.doc_id), r.score) for r in got.collect())], [v for _, v in want], atol=1e-4)


def test_lm_moves_few_bytes_a_token(make):
    r = random.Random(5)
    rows = [(i, " ".join(f"w{int(r.paretovariate(0.5)) % 30000}" for _ in range(400)), "en", "a") for i in range(100)]
    docs = make(rows)
    model = lm_scoring.train(docs, rounds=1)
    sent = docs.select("doc_id", "text", F.lit(True).alias("learned")).coalesce(1).mapInArrow(
        lm_scoring._send(model["units"], model["known"], 8, True), lm_scoring.ROW)
    size = sent.agg(F.sum(F.length("a"))).first()[0]
    assert 0 < size < 16 * 40_100       # bare 64-bit keys took over 30 bytes a token
    values = [np.array(x, np.uint64) for x in ([], [0, 0], [7, 300, 1 << 40], range(1000))]
    assert all((a == b).all() for a, b in zip(values, lm_scoring._unpacked(lm_scoring._packed(*values)), strict=True))


# ---- 2: toxicity

def test_toxicity_learns_and_odd_cases(spark, make, odd, none):
    bad = [i for i in range(400) if i % 4 == 0]
    docs = make([(i, " ".join(words(20, i)) + (" you vile wretch" if i in set(bad) else ""), "en", "a") for i in range(400)])
    labels = spark.createDataFrame([(i, int(i in set(bad)), 1) for i in range(400)] + [(None, 1, 1), (7, None, 0)],
                                   "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all((got[i] >= 0.5) == (i % 4 == 0) for i in held)
    assert len(model[0]) < 3000
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i] < 0.5}
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(none, model).count() == 0
    untrained = toxicity.train(none, labels)
    assert {r.score for r in toxicity.score(odd, untrained).collect()} == {0.5}


def test_toxicity_without_labels_keeps_all_rows(spark, make, odd, none):
    kind = "doc_id long, toxic int"
    other = [i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 5]
    for rows in ([], [(i, None) for i in range(9)], [(i, 1) for i in other]):
        model = toxicity.train(odd, spark.createDataFrame(rows, kind))
        assert toxicity.clean(odd, model).count() == len(ODD)
        assert {r.score for r in toxicity.score(odd, model).collect()} == {0.5}
    assert toxicity.clean(none, toxicity.train(none, spark.createDataFrame([], kind))).count() == 0


def test_toxicity_sample_is_of_labels_with_documents(spark, make):
    docs = make([(i, " ".join(words(20, i)) + (" you vile wretch" if i % 2 else ""), "en", "a") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1000 + i, 0) for i in range(4000)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, sample=160)
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in toxicity.score(docs, model).collect())


# ---- 3: top-k

def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk_search, "LEAF", 8)
    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)], 0) for i in range(300)] + [(400 + i, [0.5] * 6, 0) for i in range(80)]
    bad = [(900, None, 0), (950, [1.0, None], 0), (1000, [float("nan")] * 6, 0), (1050, [float("inf")] * 6, 0), (None, [1.0] * 6, 0)]
    df = spark.createDataFrame([*rows, *rows[:5], *bad], "vec_id long, embedding array<float>, rank int")
    import pyspark.sql.functions as F
    got = topk_search.exact_topk(df, F.col("vec_id") % 50 == 0).collect()
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v, _ in rows}
    want = {}
    for q in (i for i in x if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(x[q], x[c])), c) for c in x if c != q)[:5]
        want[q] = [(k, c, -s) for k, (s, c) in enumerate(best, 1)]
    found = collections.defaultdict(list)
    for g in got:
        found[g.query_id].append((g["rank"], g.vec_id, g.score))
    assert {q: sorted(v) for q, v in found.items()} == want
    assert topk_search.exact_topk(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_large_components_stay_exact():
    q, x = np.array([[2**40, 1]]), np.array([[2**40, 3], [-2**62, 0]])
    assert topk_search.dots(q, x).tolist() == [[min(2**80 + 3, 2**63 - 1), -2**63]]


# ---- 4: mixing

def test_mix_targets_and_totals(make, none):
    rows = [(i, " ".join(words(5 + i % 30, i)), "en", "s%d" % (0 if i % 3 == 0 else i % 7)) for i in range(700)]
    rows += [(1000 + i, "tiny one", "en", None) for i in range(3)] + [(2000, None, "en", "s1"), (2001, "", None, "s1")]
    docs = make(rows)
    plan = mixing.plan_mix(docs.drop("size")).collect()
    size = {i: len(re.findall("[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    assert {r.doc_id: r["size"] for r in plan} == size
    total = sum(size.values())
    by = {}
    for r in plan:
        by.setdefault(r.source, []).append(r)
        assert r.taken <= 3 * r["size"]
    names = sorted(x for x in by if x is not None) + [None]
    words_of = {s: sum(r["size"] for r in by[s]) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, target = set(), {}
    while True:
        rest = total - sum(3 * words_of[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * words_of[s] if s in full else rest * weight[s] / free for s in names}
        over = {s for s in names if target[s] > 3 * words_of[s]} - full
        if not over:
            break
        full |= over
    for s in names:
        assert by[s][0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in by[s]) - target[s]) <= max(r["size"] for r in by[s])
    again = {(r.doc_id, r.taken) for r in mixing.plan_mix(docs.drop("size").repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in plan}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r["size"] for r in mixed.collect()} == {"x"}
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {r.doc_id: r.copies for r in plan if r.copies}
    assert mixing.mix(none).count() == 0


def test_mix_spreads_null_ids(make):
    docs = make([(None, " ".join(words(9, i)), "en", "a") for i in range(200)] + [(None, None, "en", "a")])
    plan = mixing.plan_mix(docs).collect()
    assert len({r["_h"] for r in plan}) == 201
    assert sum(r.taken for r in plan) == sum(r["size"] for r in plan) == 1800


def test_position_inverts_the_integral(spark):
    from pyspark.sql import functions as F
    knots = ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5))
    at = [r.t for r in spark.range(0, 101).select(mixing.position(F.col("id") / 100, knots).alias("t")).orderBy("id").collect()]
    assert at[0] == 0 and at[100] == pytest.approx(1) and at == sorted(at)
    t = at[60]
    area = lambda t: 1.5 * t - 0.5 * t * t      # noqa: E731  of 1.5 - t on 0..1
    assert area(t) == pytest.approx(0.6)


# ---- 5: line dedup

def cut_lines(rows):
    first, wins = {}, []
    for i, text in sorted(rows):
        lines = [(k, x.strip(" ")) for k, x in enumerate(text.split("\n")) if x.strip(" ")]
        for p in range(len(lines)):
            for k in (1, 2, 3):
                own = lines[p:p + k]
                if len(own) == k and (k == 3 or sum(len(x.split()) for _, x in own) >= 50):
                    key = tuple(x for _, x in own)
                    wins.append((key, i, own[0][0], own[-1][0]))
                    first.setdefault(key, (i, own[0][0]))
    gone = collections.defaultdict(set)
    for key, i, a, b in wins:
        if first[key] != (i, a):
            gone[i] |= set(range(a, b + 1))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}


def test_line_dedup_against_brute_force(make, odd, none):
    r = random.Random(5)
    shared = "\n".join(f"shared line {k}" for k in range(5))
    long = " ".join(words(60, 1))
    rows = []
    for i in range(60):
        lines = [f"own {i} {k} {r.random()}" for k in range(r.randrange(8))]
        if i % 4 == 0:
            lines.insert(r.randrange(len(lines) + 1), shared)
        if i % 5 == 0:
            lines.insert(r.randrange(len(lines) + 1), long)
        rows.append((i, "\n".join([*lines, "", "same last line"])))
    rows.append((99, "\n".join(["again"] * 9)))
    got = line_dedup.dedup_lines(make([(i, t, "en", "a") for i, t in rows]).drop("size"))
    assert {x.doc_id: x.text for x in got.collect()} == cut_lines(rows)
    out = line_dedup.dedup_lines(odd)
    assert out.columns == [*odd.columns, "lines_removed"] and out.count() == len(ODD)
    assert sorted(map(str, (x.text for x in out.collect()))) == sorted(str(x[1]) for x in ODD)
    assert line_dedup.dedup_lines(none).count() == 0


# ---- 6: n-gram Jaccard

def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_against_brute_force(make, odd, none, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 8)
    r, rows = random.Random(6), []
    for g in range(12):
        text = words(80, g)
        for k in range(40 if g == 0 else 4):
            own = list(text)
            for _ in range(k % 3):
                own[r.randrange(80)] = f"edit{r.randrange(50)}"
            rows.append((len(rows), " ".join(own), "en", "a"))
    docs = make(rows + [(i + 1000 if i is not None else None, *x) for i, *x in ODD])
    got = {x.doc_id: x for x in jaccard_join.jaccard_classes(docs).collect()}
    first = {}
    for i, t, *_ in rows:
        first.setdefault(tuple(t.split()), i)
    sets = {i: grams(" ".join(w)) for w, i in first.items()}
    links, root = collections.Counter(), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    for i, t, *_ in rows:
        rep = first[tuple(t.split())]
        assert (got[i].class_id, got[i].n_links) == (find(rep), links[rep])
    assert got[1005].class_id == got[1006].class_id == 1005 and got[1006].n_copies == 3
    assert got[1001].class_id == got[1002].class_id == got[1003].class_id == 1001
    kept = jaccard_join.one_per_class(docs)
    assert kept.columns == docs.columns
    ids = [x.doc_id for x in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, {x.class_id for x in got.values()}))
    assert jaccard_join.jaccard_classes(none).count() == 0


def test_jaccard_counts_links_once_when_a_block_is_empty(make, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 100)     # two blocks for two texts
    docs = make([(2 * g + k, " ".join([*words(80, g), f"end{k}"]), "en", "a") for g in range(16) for k in range(2)])
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_classes(docs).collect()}
    assert got == {i: (i - i % 2, 1) for i in range(32)}


def test_one_per_class_with_null_and_equal_ids(make):
    one, two, three = (" ".join(words(30, i)) for i in range(3))
    docs = make([(None, one, "en", "a"), (None, two, "en", "a"), (None, two, "en", "a"), (7, three, "en", "a"),
                 (7, three.upper(), "en", "a"), (7, one, "en", "a"), (None, None, None, None)])
    kept = collections.Counter((r.doc_id, (r.text or "").lower()) for r in jaccard_join.one_per_class(docs).collect())
    assert kept == {(7, one): 1, (None, two): 1, (7, three): 1, (None, ""): 1}


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.bands_for(0.8, 0.999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999


# ---- 7: PII

PATTERN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return 13 <= len(d) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def test_pii_against_brute_force(make, odd, none):
    texts = ["a@b.com_x@y.org z@q", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
             " ".join("1" * 30_000), "+1 (415) 555-2671 +44 20 7946 0958. +1 2 +12 34 56 78 9- (+999999999999999999)",
             "éab@x.y.z. é𝒳 bob@mail.example.com 😀 10.0.0.1", "x@y..z x@y.z..w a@b@c.d.e", "+1+1 234 567 8901", "", None]
    texts += ["".join(random.Random(k).choices("ab1 .@+-()9é", k=60)) for k in range(150)]
    got = {r.doc_id: r for r in pii.find_pii(make([(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        own = [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERN.items() for m in re.finditer(p, t or "") if valid(k, m[0])]
        assert got[i].base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest(), (t, own, got[i].spans)
        assert set(own) <= set(got[i].spans.split(",")) | {""}
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(x.startswith(k) for x in own) for k in PATTERN)
    assert pii.find_pii(odd).count() == len(ODD) and pii.find_pii(none).count() == 0


def test_pii_terms_that_disclose(make):
    rows = [(i, f"common words number{i} write Zorbamax at joe@site.example.org for more", "en", "a") for i in range(3)]
    rows += [(9, "only Zorbamax here", "en", "a")] + [(20 + i, f"common words write text number for more {i}", "en", "a") for i in range(400)]
    docs = make(rows)
    got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    assert "13" not in got[20] and got[20] == "" and ("term:5:13" in got[9] or "secret:5:13" in got[9])
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "joe@" not in clean[0] and "Zorbamax" not in clean[9] and "[EMAIL]" in clean[0] and clean[20] == rows[4][1]


def test_pii_terms_anywhere_in_the_document(make):
    far = " ".join(f"filler{k} common words and more" for k in range(30))
    rows = [(i, f"Lee holds account 88412007{i // 3} in this title\n\n{far} own{i}\n\nmail kim@site.example.org for more", "en", "a") for i in range(3)]
    rows += [(9, "only Lee and 884120070 here", "en", "a")] + [(20 + i, f"{far} holds account in this title mail for more {i}", "en", "a") for i in range(400)]
    got = {r.doc_id: r.spans.split(",") for r in pii.find_pii(make(rows)).collect()}
    assert [x.split(":", 1)[1] for x in got[9]] == ["5:8", "13:22"]
    assert {x.split(":")[0] for x in got[9]} <= {"term", "secret"} and got[20] == [""]
    assert {"0:3", "18:27"} <= {x.split(":", 1)[1] for x in got[0]}


def entropy(chars):
    return sum(-n / len(chars) * math.log2(n / len(chars)) for n in Counter(chars).values())


def test_pii_runs_of_high_information(make):
    rnd = random.Random(5)
    keys = ["".join(rnd.choices("0123456789abcdef", k=40)) for _ in range(12)]
    rows = [(i, f'plain words {i} token = "{k}" and more', "en", "a") for i, k in enumerate(keys)]
    rows += [(50, f"é😀 Token: {keys[0].upper()}!", "en", "a"), (51, "a" * 40 + "1 and hahahahahahahahaha1", "en", "a"),
             (52, "covid19 thequickbrownfoxjumps 20240101 1234567890123456789012", "en", "a"), (53, "x" + keys[1] + "é", "en", "a"),
             (54, "id k3J9x0Qw7Zb2Lr5Tn8V", "en", "a"), (55, None, "en", "a"), (None, f"token {keys[2]}", "en", "a")]
    got = {r.doc_id: r for r in pii.find_pii(make(rows)).collect()}
    for i in range(12):
        at = rows[i][1].index('"') + 1
        assert f"secret:{at}:{at + 40}" in got[i].spans.split(",") and (got[i].n_secret, got[i].n_term) == (1, 0)
    assert got[50].spans == "secret:10:50" and got[None].spans == "secret:6:46" and got[54].spans == "term:3:22"
    assert all(got[i].spans == "" for i in (51, 52, 53, 55))
    # information against plain Python, over the values of each shape in its context
    docs = make(rows).select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text")).withColumn("_t", F.xxhash64("_text"))
    found = {}
    for i, t, *_ in rows:
        for m in re.finditer(r"(?<![^\W_])[A-Za-z0-9]{16,}(?![^\W_])", t or ""):
            v = m[0]
            cls = tuple(bool(re.search(c, v)) for c in ("[0-9]", "[a-z]", "[A-Z]"))
            if cls[0] and any(cls[1:]):
                found[i, m.start()] = (re.findall(r"[^\W_]+", t[:m.start()].lower() or " ") or [""])[-1], (len(v), cls), v
    kinds = set(found.values())
    for r in pii.informative_runs(docs).collect():
        c, s, v = found.pop((r._id, r.s))
        near, wide = [x for a, b, x in kinds if (a, b) == (c, s)], {x for _, b, x in kinds if b == s}
        among = near if len(near) > 1 else sorted(wide)
        assert r.bits == pytest.approx(len(v) * min(entropy("".join(among)), entropy(v)))
    assert not found


def test_pii_without_broadcast_keys(make, monkeypatch):
    rows = [(i, f"words {i} Zorbamax joe@site.example.org and Qy{i % 2}", "en", "a") for i in range(6)]
    rows += [(20 + i, f"words Zorbamax {i}" if i == 0 else f"plain text {i}", "en", "a") for i in range(300)]
    want = sorted(pii.find_pii(make(rows)).collect())
    monkeypatch.setattr(pii, "SENT", 0)
    assert sorted(pii.find_pii(make(rows)).collect()) == want and any("term" in r.spans or "secret" in r.spans for r in want)


def test_pii_disclosures_against_brute_force(make):
    rnd = random.Random(11)
    vocab = [f"w{k}" for k in range(25)]
    rows = []
    for i in range(120):
        words = rnd.choices(vocab, k=6)
        if rnd.random() < 0.2:
            words += [f"u{rnd.randrange(4)}@site{words[0][-1]}.example.org", "code" + words[0][-1]]
        rows.append((i, " ".join(words), "en", "a"))
    rows += [rows[3], rows[7]]
    docs = make(rows).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).withColumn("_t", F.xxhash64("_text"))
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(docs, pii.base_spans(docs)).collect()}
    terms = [set(re.findall(r"[^\W_]+", t)) for _, t, *_ in rows]
    own = [{n for m in re.finditer(PATTERN["email"], t) for n in (f"0:{m[0]}", "*0:" + m[0].split("@")[1])} for _, t, *_ in rows]
    want = {}
    for e in set().union(*own):
        ne = sum(e in o for o in own)
        for w in set().union(*terms):
            with_both = [k for k in range(len(rows)) if e in own[k] and w in terms[k]]
            if len({rows[k][1] for k in with_both}) >= (3 if e[0] == "*" else 2):
                d = 1 - math.log(len(with_both) / sum(w in t for t in terms)) / math.log(ne / len(rows))
                if d >= pii.GENERALISE:
                    want[e, w] = d
    assert got.keys() == want.keys() and any(e[0] == "*" for e, _ in want)
    assert all(got[k] == pytest.approx(d) for k, d in want.items())


# ---- 8: fingerprints

def test_prefix_hash_spans_and_extension():
    powers = fingerprints.Powers()
    a, b = (fingerprints.PrefixHash(fingerprints._points(t), powers) for t in ("abcabcabd", "xxabcabcabq"))
    assert a.key(0, 3) == a.key(3, 3) == b.key(2, 3) and a.key(0, 3) != a.key(1, 3)
    assert a.extension(0, b, 2) == 8 and a.extension(0, a, 3) == 5 and a.extension(9, b, 0) == 0


def test_long_texts_are_alike_to_their_ends():
    r = np.random.default_rng(8)
    a, b = (r.integers(97, 123, 4_000_000).astype("<u4") for _ in range(2))
    b[:3_120_000] = a[:3_120_000]
    powers = fingerprints.Powers()
    assert fingerprints.Fingerprint(a, powers).like(fingerprints.Fingerprint(b, powers)) >= 0.77


def test_fingerprints_against_brute_force(make, odd, none):
    r = random.Random(8)
    texts = ["".join(r.choices("abc dé😀", k=r.randrange(0, 400))) for _ in range(80)] + ["same text"] * 3
    rows = list(enumerate(texts))
    shuffled = rows[:]
    r.shuffle(shuffled)
    got = {x.doc_id: x for x in fingerprints.fingerprints(make([(i, t, "en", "a") for i, t in shuffled])).collect()}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and (got[i].near_next == 1) == (t == nxt)
        if len(t) > 60:
            assert got[i].near_edited > 0.35
    prints = collections.defaultdict(set)
    for i, t in rows:
        prints[t].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in prints.values()) and len({min(x) for x in prints.values()}) == len(prints)
    assert fingerprints.fingerprints(odd).count() == len(ODD) and fingerprints.fingerprints(none).count() == 0


# ---- 9: language

def test_language_mixture(make, odd, none):
    def text(lang, i):
        r = random.Random(f"{lang}{i}")
        own = {"aa": ["tion", "the", "ing", "wh"], "bb": ["ñar", "que", "ción", "el"], "cc": ["sch", "ung", "der", "tz"]}[lang]
        return " ".join("".join(r.choices(own, k=r.randrange(1, 4))) for _ in range(30))
    docs = make([(k * 100 + i, text(x, i), x, "a") for k, x in enumerate(("aa", "bb", "cc")) for i in range(40)] + [(999, "text", None, "a")])
    model = language_id.learn(docs.where("doc_id % 4 <> 0"))
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(got[k * 100 + i].lang_pred == x for k, x in enumerate(("aa", "bb", "cc")) for i in range(40))
    both, _ = language_id.infer(pa.array([text("aa", 1) + " " + text("aa", 2) + " " + text("bb", 3)]), model[1])
    assert model[0][both[0]] == "aa"
    found = {(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (8, "und", 0.0)} <= found
    assert {r.lang_pred for r in language_id.predict(odd, language_id.learn(none)).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0


# ---- 10: packing

def test_packing_round_trip(make, odd, none):
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    rows = [(i, " ".join(words(i * 7 % 90, i)) + " It's, a|b | c. é, İ, ×.", "en", "a") for i in range(120)]
    rows += [(500, " ".join(words(900, 5)), "en", "a"), *((i + 1000 if i is not None else None, *x) for i, *x in ODD)]
    got = packing.pack(make(rows), path, capacity=256, places=4).collect()
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = np.array([*Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for a in range(0, len(ids), 256):
            part = ids[a:a + 256]
            want[i, a // 256, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert want == collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    lower = -(-sum(r.length for r in got) // 256)
    assert len(bins) <= lower + max(3, lower // 20)
    assert packing.pack(none, path).count() == 0


def test_best_fit_takes_the_fullest_and_closes_it():
    fit = packing.BestFit(10, 2)
    assert fit.place(6)[:2] == (0, 0) and fit.place(7)[:2] == (1, 0)
    assert fit.place(3) == (1, 7, [1])          # the fuller bin, now full
    assert fit.place(5) == (2, 0, [])           # a free place
    assert fit.place(9)[2] == [0]               # no place: the fullest closes
    assert fit.place(10)[2] == [4]


# ---- helpers

def test_words_and_chunks():
    offs, flat = common.words_of(pa.array(["", " a\x0bb\x0c ", "\x1c x", "c"]).slice(1))
    assert flat.to_pylist() == ["a", "b", "\x1c x", "c"] and offs.tolist() == [0, 2, 3, 4]
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "c"])], names=["text"])
    parts = [b.num_rows for b in common.text_chunks([batch], limit=12)]
    assert sum(parts) == 4 and parts == [2, 1, 1]


def test_ranked_positions(spark):
    got = common.ranked(spark.range(1000, numPartitions=7).selectExpr("id * 37 % 1000 as v", "id as other"), "r", "v").collect()
    assert all(x.r == x.v for x in got)
