"""N-gram Jaccard join (operator 6): MinHash banding with exact verification.

Texts are sets of five-word shingles (lower case, white-space words; a shorter
text is one shingle).  Equal word sequences are one class before anything
else, so copies cost one row each.  For every class representative a MinHash
signature is cut into bands; band and row counts are the cheapest with the
wanted recall at the threshold.  Band hashes are shuffled, bands with one
member fall away, bands with the same members are kept once, and every pair
that shares a band is verified on its full shingle sets, in the first band it
shares, so links are counted once and no pairs are written.

Scale: the text is read once for signatures and shuffled once to meet the
candidate list; only candidates carry shingles.  A band group larger than a
block is split into blocks of members, and each pair of blocks is a task of
its own; a task writes at most one link count and two forest edges per member.
Linked texts become classes by repeated minimum-label joins with pointer
jumping, all in tables.

Defined cases: null and empty texts are copies of each other; repeated rows
are copies; null ids take part (the class id is the smallest id that is not
null); rows that share an id are told apart by their texts; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, mix64, text_chunks, texts_of, word_hashes, words_of

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
BLOCK_ROWS = 512
BLOCK_SHINGLES = 2_000_000


def bands_for(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows): the least hashes that reach ``recall`` for a pair at the
    threshold, with at least four rows a band so that unlike texts rarely meet."""
    best = None
    for rows in range(4, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= 120 and (best is None or rows > best[1]):
            best = (bands, rows)
    return best


def shingles(texts, words: int = WORDS):
    """(row offsets of words, word hash per word, row offsets of shingles, shingle hashes)."""
    offs, flat = words_of(pc.utf8_lower(texts))
    hashes, which = word_hashes(flat)
    w = hashes[which] if len(which) else np.zeros(0, np.uint64)
    n = np.diff(offs)
    count = np.where(n == 0, 0, np.maximum(n - words + 1, 1))
    soffs = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(soffs[-1]) - np.repeat(soffs[:-1], count) + np.repeat(offs[:-1], count)
    end = np.repeat(offs[1:], count)
    s = np.zeros(len(at), np.uint64)
    padded = np.concatenate([w, np.zeros(words, np.uint64)])
    for k in range(words):
        s = s * np.uint64(0x9E3779B97F4A7C15) + np.where(at + k < end, padded[at + k], np.uint64(k + 1))
        s = s ^ (s >> np.uint64(31))
    return offs, w, soffs, mix64(s)


def signatures(soffs: np.ndarray, s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) band hashes; texts without shingles have zeros."""
    rng = np.random.default_rng(7)
    mult = rng.integers(1, 2**32, bands * rows, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = rng.integers(0, 2**32, bands * rows, dtype=np.uint64).astype(np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(soffs))
    out = np.zeros((len(soffs) - 1, bands), np.uint64)
    if not len(full):
        return out
    at = 0
    while at < len(full):  # pieces that stay in the processor's cache
        upto = max(at + 1, int(np.searchsorted(soffs[full], soffs[full[at]] + 200_000)))
        a, b = soffs[full[at]], soffs[full[upto - 1] + 1]
        part, starts = x[a:b], soffs[full[at:upto]] - a
        for k in range(bands):
            h = np.full(upto - at, k + 1, np.uint64)
            for j in range(k * rows, (k + 1) * rows):
                low = np.minimum.reduceat(part * mult[j] + add[j], starts)
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + low)
            out[full[at:upto], k] = h
        at = upto
    return out


def _text_keys(offs, w) -> list[bytes]:
    return [xxhash.xxh3_128_digest(w[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:])]


def _lists(values: np.ndarray, offs, kind=pa.int64()):
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values, kind))


def _sketch(bands: int, rows: int, words: int):
    def run(batches):
        for chunk in text_chunks(batches):
            offs, w, soffs, s = shingles(texts_of(chunk), words)
            sig = signatures(soffs, s, bands, rows).view(np.int64)
            n = chunk.num_rows
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("key"), pa.array(_text_keys(offs, w), pa.binary()),
                 _lists(sig.reshape(-1), np.arange(n + 1) * bands)], names=["doc_id", "key", "th", "bands"])
    return run


def _sets(words: int):
    def run(batches):
        for chunk in text_chunks(batches):
            offs, w, soffs, s = shingles(texts_of(chunk), words)
            own = [np.unique(s[a:b]) for a, b in zip(soffs[:-1], soffs[1:])]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(_text_keys(offs, w), pa.binary()),
                 pa.array([len(x) for x in own], pa.int32()), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["doc_id", "th", "n", "grams"])
    return run


def _intersections(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``pairs`` of rows."""
    if len(pairs) <= 4 * len(sets) and len(pairs) <= 64:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs], np.int64)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = count[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        x = np.zeros((len(sets), width), np.float32)
        x[row[lo:hi], column[lo:hi] - a] = 1
        total += x @ x.T
    return np.rint(total[pairs[:, 0], pairs[:, 1]]).astype(np.int64)


def _verify_block(ths, bands, sets, side, within: bool, band: int, threshold: float):
    """Link counts and forest edges of one block (``within``) or pair of blocks,
    one of which may be empty."""
    m = len(ths)
    size = np.fromiter(map(len, sets), np.int64, m)
    i, j = np.triu_indices(m, 1)
    if not within:
        keep = side[i] != side[j]
        i, j = i[keep], j[keep]
    keep = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
    i, j = i[keep], j[keep]
    for k in range(band):  # pairs met in an earlier band are counted there
        if not len(i):
            break
        keep = bands[i, k] != bands[j, k]
        i, j = i[keep], j[keep]
    if not len(i):
        return [], [], []
    both = _intersections(sets, np.stack([i, j], 1))
    keep = both >= threshold * (size[i] + size[j] - both) - 1e-9
    i, j = i[keep], j[keep]
    links = np.bincount(i, minlength=m) + np.bincount(j, minlength=m)
    a, b, n = [], [], []
    for x in np.flatnonzero(links):
        a.append(ths[x]), b.append(None), n.append(int(links[x]))
    root = np.arange(m)
    while True:  # minimum-label propagation over the block's links
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    for x in np.flatnonzero(root != np.arange(m)):
        a.append(ths[x]), b.append(ths[root[x]]), n.append(0)
    return a, b, n


def _verifier(threshold: float):
    def groups(batches):
        key, held = None, []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("g", "bi", "bj", "band", "side", "th", "bands", "grams")))
            for g, bi, bj, band, side, th, sig, grams in rows:
                if (g, bi, bj) != key:
                    if held:
                        yield key, held
                    key, held = (g, bi, bj), []
                held.append((band, side, th, sig, grams))
        if held:
            yield key, held

    def run(batches):
        a, b, n = [], [], []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())],
                                              names=["a", "b", "links"])
        for (_, bi, bj), held in groups(batches):
            x = _verify_block([h[2] for h in held], np.array([h[3] for h in held], np.int64),
                              [np.frombuffer(h[4], np.uint64) for h in held],
                              np.array([h[1] for h in held], bool), bi == bj, held[0][0], threshold)
            for own, more in zip((a, b, n), x):
                own += more
            if len(a) > 20_000:
                yield out()
                a, b, n = [], [], []
        yield out()
    return run


def classes(edges: DataFrame) -> DataFrame:
    """(node, label): every node of ``edges`` (a, b) with the least node it is
    connected to.  Minimum over neighbours, then pointer jumping, until no
    label changes; each round is two joins over written tables."""
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    lab = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(lab.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        step = lab.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "m").alias("low"))
        step = materialise(step, "step")
        up = step.select(F.col("node").alias("low"), F.col("low").alias("top"))
        new = materialise(step.join(up, "low").select("node", F.col("label").alias("old"), "top"), "labels")
        moved = new.where("old <> top").limit(1).count()
        lab = new.select("node", F.col("top").alias("label"))
        if not moved:
            return lab


def _labelled(docs: DataFrame, threshold: float, words: int, recall: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(documents as doc_id, th; texts as th, first, n_copies, n_links, label).
    ``first`` is a text's first document (none, doc_id, key of the text)."""
    bands, rows = bands_for(threshold, recall)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    sig = materialise(src.mapInArrow(_sketch(bands, rows, words), "doc_id long, key long, th binary, bands array<long>"), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    reps = materialise(sig.groupBy("th").agg(first.alias("first"), F.count(F.lit(1)).alias("n_copies"),
                                             F.any_value("bands").alias("bands")), "texts")
    g = reps.where(F.element_at("bands", 1) != 0).select("th", F.col("first.doc_id").alias("rep"), F.posexplode("bands").alias("band", "g"))
    near = g.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.min("band").alias("band"),
                              F.bit_xor(F.xxhash64("th")).alias("x"), F.sum(F.shiftright(F.xxhash64(F.lit(5), "th"), 20)).alias("y")).where("m > 1")
    once = materialise(near.groupBy("m", "x", "y").agg(F.min(F.struct("band", "g")).alias("z")).select("z.band", "z.g", "m"), "groups")
    members = materialise(g.select("th", "rep", "g").join(once, "g"), "members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    some = src.drop("key").join(wanted, src.doc_id.eqNullSafe(wanted.doc_id), "left_semi")
    sets = some.mapInArrow(_sets(words), "doc_id long, th binary, n int, grams binary")
    sets = materialise(sets.groupBy("th").agg(F.any_value("n").alias("n"), F.any_value("grams").alias("grams")), "sets")
    sized = members.join(sets.select("th", "n"), "th")
    blocks = sized.groupBy("g").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    own = members.join(blocks, "g").withColumn("own", F.pmod(F.xxhash64("th"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("g", "band", "th", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                     F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"))
    full = own.join(sets.select("th", "grams"), "th").join(reps.select("th", "bands"), "th")
    full = full.repartition("g", "bi", "bj").sortWithinPartitions("g", "bi", "bj", "th")
    found = materialise(full.mapInArrow(_verifier(threshold), "a binary, b binary, links long"), "verified")
    links = found.where("b is null").groupBy(F.col("a").alias("th")).agg(F.sum("links").alias("n_links"))
    label = classes(found.where("b is not null")).withColumnRenamed("node", "th")
    texts = (reps.select("th", "first", "n_copies").join(links, "th", "left").join(label, "th", "left")
             .withColumn("label", F.coalesce("label", "th")).withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")))
    return sig.select("doc_id", "th"), texts


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (least id of its class), n_copies
    (documents with its words, itself included) and n_links (different texts
    with Jaccard similarity at the threshold or above)."""
    own, texts = _labelled(docs, threshold, words, recall, id_col, text_col)
    least = texts.groupBy("label").agg(F.min("first").alias("least"))
    texts = texts.join(least, "label").select("th", F.col("least.doc_id").alias("class_id"), "n_copies", "n_links")
    return own.join(texts, "th").select("doc_id", "class_id", "n_copies", "n_links")


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but one document of every class: the least id, of
    its rows the least text by hash; a class without ids keeps its least text
    by hash, and of equal rows one stays."""
    _, texts = _labelled(docs, threshold, words, recall, id_col, text_col)
    keep = texts.groupBy("label").agg(F.min("first").alias("z")).select(F.col("z.doc_id").alias("_keep"), F.col("z.key").alias("_key"))
    keyed = docs.withColumn("_t", F.xxhash64(text_col))
    met = keyed.join(keep, F.col(id_col).cast("long").eqNullSafe(F.col("_keep")) & (F.col("_t") == F.col("_key")))
    return met.dropDuplicates([id_col, "_t"]).select(*docs.columns)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document."""
    return jaccard_classes(load(spark, sf_dir, "documents"))
