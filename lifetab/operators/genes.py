"""Gene-level operators: layer merge, ortholog map, synthetic and supplied
interaction graphs, degree centrality, over-representation (enrichment),
network top-k, neighbour propagation, literature hits.

The reference asks remote services for orthologs, enrichment and article
titles.  Here each lookup is a join against a table the caller supplies
(``mapping``, ``term_gene``, ``docs``), so the work is distributed and the
result reproducible.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from ..functions.ordered import global_row_index, top_k_per_group


# --------------------------------------------------------------------------- C1
def merge_layers(layers: Sequence[DataFrame], on: str = "gene", names: Sequence[str] | None = None) -> DataFrame:
    """Inner equi-join of two or more tables on ``on``.

    The measurements of the i-th further table are called ``<column>_m<i>``,
    whether they collide or not.  Duplicate keys multiply rows, NULL keys never
    match (SQL semantics).  The join strategy (broadcast hash or sort-merge,
    skew split) is left to AQE.
    """
    known = list(names) if names else [f"number {i}" for i in range(len(layers))]
    without = [n for n, df in zip(known, layers) if on not in df.columns]
    if without:
        raise ValueError(f"no key column {on!r} in the layers: {', '.join(map(str, without))}")
    first, *further = layers if len(layers) > 1 else [None]
    if not further:
        raise ValueError("a merge takes two layers or more")
    apart = [df.withColumnsRenamed({c: f"{c}_m{i}" for c in df.columns if c != on}) for i, df in enumerate(further, 1)]
    return reduce(lambda whole, layer: whole.join(layer, on), apart, first)


# --------------------------------------------------------------------------- C2
def map_orthologs(genes: DataFrame, mapping: DataFrame, gene: str = "gene", ortholog: str = "ortholog",
                  rank: str | None = "rank") -> DataFrame:
    """First ortholog per gene (lowest rank, then smallest ortholog id);
    genes without a match are absent.  ``genes``: one column ``gene``;
    ``mapping``: (gene, ortholog[, rank]).  The first match is a
    ``min(struct(rank, ortholog))`` aggregate (partial per task), so a gene
    with a huge candidate list is not one task's window."""
    order = F.col(rank) if rank and rank in mapping.columns else F.lit(0)
    m = mapping.select(F.col(gene).alias("gene"), F.struct(order.alias("r"), F.col(ortholog).alias("o")).alias("_s"))
    g = genes.select(F.col(gene).alias("gene")).distinct()
    best = m.join(g, "gene", "left_semi").groupBy("gene").agg(F.min("_s").alias("_s"))
    return best.select("gene", F.col("_s.o").alias("ortholog"))


# --------------------------------------------------------------------------- C5
def edge_hash(a, b) -> F.Column:
    """Reproducible pair hash: first 8 hex digits of md5(a || b) as an integer."""
    return F.conv(F.substring(F.md5(F.concat(a, b)), 1, 8), 16, 10).cast("bigint")


BLOCK_GENES = 4000      # of a block, more if there would be over MOST_BLOCKS
MOST_BLOCKS = 100       # a gene is sent once for each block, so to no more tasks
PAIRS = 65_536          # hashed at a time
BATCH_BYTES = 2 ** 23   # of the edges sent back at a time


def _edges(modulus: int, block: int):
    """The edges between two blocks of genes: ``edge_hash`` of many pairs at a
    time, the 64 steps of MD5 over arrays of pairs.  Steps that read the first
    text alone are taken once for all its pairs."""
    turns = (7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)
    schedule = [(i // 16, (i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16, *np.array(
        [int(abs(math.sin(i + 1)) * 2 ** 32), turns[i // 16][i % 4], 32 - turns[i // 16][i % 4]], np.uint32)) for i in range(64)]
    start = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
    pairs, batch_bytes = PAIRS, BATCH_BYTES

    def words(texts, lead, tail, size):
        """Little-endian words of texts behind ``lead`` zero bytes, one row a word."""
        whole = b"".join((b"\0" * lead + t + tail).ljust(4 * size, b"\0") for t in texts)
        return np.frombuffer(whole, "<u4").reshape(len(texts), size).T.copy()

    def steps(state, left, right, at, since, to):
        """Steps of the message's 16 words from word ``at``, in place; a word is the sum of its two sides."""
        a, b, c, d = state
        f = np.empty_like(a)
        for kind, word, sine, turn, back in schedule[since:to]:
            if kind == 0:
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
            elif kind == 1:
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
            elif kind == 2:
                np.bitwise_xor(b, c, out=f)
                f ^= d
            else:
                np.invert(d, out=f)
                f |= b
                f ^= c
            f += a
            first, second = left.get(at + word), right.get(at + word)
            f += sine if first is None else first + sine
            if second is not None:
                f += second
            np.left_shift(f, turn, out=a)
            np.right_shift(f, back, out=f)
            a |= f
            a += b
            a, b, c, d = d, a, b, c
        state[:] = a, b, c, d

    def first_words(left, right, own, size, rows):
        """A function of columns: first word of the MD5 of messages of ``size``
        words, of which ``own`` bytes are of the first text."""
        head = [np.full((rows, 1), v, np.uint32) for v in start]
        known = own // 64 * 16
        for at in range(0, known, 16):
            state = [x.copy() for x in head]
            steps(state, left, {}, at, 0, 64)
            head = [x + y for x, y in zip(head, state)]
        since = own % 64 // 4
        begun = [x.copy() for x in head]
        steps(begun, left, {}, known, 0, since)

        def of(columns):
            theirs = {w: x[:, columns] for w, x in right.items()}
            shape = rows, columns.stop - columns.start
            before = head
            state = [np.broadcast_to(x, shape).copy() for x in begun]
            for at in range(known, size - 16, 16):
                steps(state, left, theirs, at, since if at == known else 0, 64)
                before = [x + y for x, y in zip(before, state)]
                state = [x.copy() for x in before]
            # the word comes out of step 61 and is only passed on by the last three
            steps(state, left, theirs, size - 16, since if size - 16 == known else 0, 61)
            return before[0] + state[1]
        return of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        genes = pa.Table.from_batches(batches).sort_by("_i")
        names, place = genes["g"].combine_chunks(), genes["_i"].to_numpy()
        texts = names.cast(pa.binary()).to_pylist()
        sizes = np.array([len(t) for t in texts])
        at = place // block
        a, b = np.flatnonzero(at == at[0]), np.flatnonzero(at == at[-1])
        most = max(1, batch_bytes // (2 * int(sizes.max()) + 8))
        held = []

        def batch():
            own, found = (np.concatenate(c) for c in zip(*held))
            held.clear()
            for k in range(0, len(own), most):
                ends = own[k:k + most], found[k:k + most]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(x)) for x in ends], ["src", "dst"])

        for own in np.unique(sizes[a]).tolist():
            ia = a[sizes[a] == own]
            left = {w: x[:, None] for w, x in enumerate(words([texts[i] for i in ia], 0, b"", -(-own // 4)))}
            blocks = -(-(own + sizes[b] + 9) // 64)
            for n in np.unique(blocks).tolist():
                ib = b[blocks == n]
                right = words([texts[i] for i in ib], own % 4, b"\x80", 16 * n - own // 4)
                bits = 8 * (own + sizes[ib])
                right[-2], right[-1] = bits & 0xFFFFFFFF, bits >> 32
                right = {own // 4 + w: x[None] for w, x in enumerate(right) if x.any()}
                step = max(1, pairs // len(ib))
                for k in range(0, len(ia), step):
                    rows = ia[k:k + step]
                    later = int(np.searchsorted(place[ib], place[rows[0]], "right"))
                    hashes = first_words({w: x[k:k + step] for w, x in left.items()}, right, own, 16 * n, len(rows))
                    for m in range(later, len(ib), pairs):
                        columns = ib[m:m + pairs]
                        # the digest shows the word's bytes in order
                        edge = hashes(slice(m, m + len(columns))).byteswap() % np.uint32(modulus) == 0
                        if place[rows[-1]] >= place[columns[0]]:
                            edge &= place[rows, None] < place[columns]
                        x, y = np.divmod(np.flatnonzero(edge), len(columns))
                        held.append((rows[x], columns[y]))
                        if sum(len(x) for x, _ in held) >= most:
                            yield from batch()
        if held:
            yield from batch()
    return run


def synthetic_edges(genes: DataFrame, gene: str = "gene", modulus: int = 17,
                    max_genes: int | None = None) -> DataFrame:
    """Deterministic pseudo-random graph over a gene list: the pair (a, b),
    a < b, is an edge when hash(a || b) % modulus == 0.

    The reference tests every pair of its list, and so does this (the
    predicate is a function of the pair): a self join on ``a < b`` whose size
    is n(n-1)/2, spread over tasks.  It is meant for gene lists (thousands), not for row-level
    tables; supplied interaction tables skip it.  A list of any length is
    worked through; with ``max_genes`` a longer one raises before the
    quadratic job starts.
    """
    g = genes.select(F.col(gene).cast("string").alias("g")).where("g IS NOT NULL").distinct()
    n = g.count()
    if max_genes is not None and n > max_genes:
        raise ValueError(f"{n} genes: the synthetic graph has ~n^2/{2 * modulus} edges; supply an edge table")
    # blocks of the sorted list; a task meets two of them, so none holds the list
    # (left to itself, the list is one small partition and all pairs one task),
    # and sends edges on while it finds them, so none holds those of its blocks
    g = global_row_index(g, ["g"], "_i")
    block = max(BLOCK_GENES, -(-n // MOST_BLOCKS))
    blocks = max(1, -(-n // block))
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    g = g.select("g", "_i", F.floor(F.col("_i") / block).alias("_at"), met.alias("_met"))
    g = g.select("g", "_i", F.least("_at", "_met").alias("p"), F.greatest("_at", "_met").alias("q"))
    groups = blocks * (blocks + 1) // 2
    tasks = max(groups, min(4 * groups, 2000))      # a few pairs of blocks seldom share one
    return g.repartition(tasks, "p", "q").groupBy("p", "q").applyInArrow(_edges(modulus, block), "src string, dst string")


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected simple graph: (min, max) per edge, self-loops and repeats removed."""
    s, d = F.col(src).cast("string"), F.col(dst).cast("string")
    return (edges.select(F.least(s, d).alias("src"), F.greatest(s, d).alias("dst"))
            .where("src <> dst").distinct())


# --------------------------------------------------------------------------- D3
def degree_centrality(nodes: DataFrame, edges: DataFrame, node: str = "gene", src: str = "src",
                      dst: str = "dst") -> DataFrame:
    """deg / (n - 1) per node of the undirected simple graph; isolated nodes 0;
    a graph with one node gives 1.  Edges whose ends are not nodes are added
    as nodes (as a graph library would)."""
    e = canonical_edges(edges, src, dst)
    ends = e.select(F.col("src").alias("gene")).unionByName(e.select(F.col("dst").alias("gene")))
    all_nodes = nodes.select(F.col(node).cast("string").alias("gene")).unionByName(ends).distinct()
    deg = ends.groupBy("gene").agg(F.count(F.lit(1)).alias("_deg"))
    n = all_nodes.agg(F.count(F.lit(1)).alias("_n"))
    x = all_nodes.join(deg, "gene", "left").crossJoin(F.broadcast(n))
    score = F.when(F.col("_n") <= 1, F.lit(1.0)).otherwise(
        F.coalesce(F.col("_deg"), F.lit(0)) / (F.col("_n") - 1))
    return x.select("gene", F.coalesce(F.col("_deg"), F.lit(0)).cast("long").alias("degree"),
                    score.alias("centrality"))


def centrality_features(cent: DataFrame) -> DataFrame:
    """(feature, score) with keys ``deg_centrality_<gene>``."""
    return cent.select(F.concat(F.lit("deg_centrality_"), F.col("gene")).alias("feature"),
                       F.col("centrality").alias("score"))


# --------------------------------------------------------------------------- E2
def network_top_k(nodes: DataFrame, edges: DataFrame | None = None, k: int = 50, node: str = "gene",
                  order: str | None = None) -> DataFrame:
    """Top-k genes by degree centrality (ties by gene id).  Without a graph,
    the first k genes by ``order`` (input order) or by id."""
    if edges is None:
        o = [F.col(order)] if order else []
        return nodes.select(F.col(node).alias("gene"), *([F.col(order)] if order else [])) \
            .orderBy(*o, "gene").limit(k).select("gene")
    cent = degree_centrality(nodes, edges, node)
    return cent.orderBy(F.col("centrality").desc(), F.col("gene")).limit(k)


# --------------------------------------------------------------------------- D4
def pathway_enrichment(genes: DataFrame, term_gene: DataFrame, background: DataFrame | None = None,
                       top: int | None = 10, adjust: str = "bonferroni", gene: str = "gene",
                       term_id: str = "term_id", term_name: str | None = "term_name") -> DataFrame:
    """Over-representation test per term.

    N = background size (all genes of ``term_gene`` when None), K = term size
    within the background, n = query genes in the background, k = query
    genes in the term.  p = P(X >= k) for X ~ Hypergeometric(N, K, n),
    computed as a sum of exp(log C(K,i) + log C(N-K,n-i) - log C(N,n)) over
    i = k..min(n, K); log-factorials are column expressions (exact values up
    to 10!, Stirling series above), all on the JVM.  ``adjust``: 'bonferroni' (x number of tested
    terms, capped at 1), 'bh' (Benjamini-Hochberg) or 'none'.  Output per
    term: term_id, term_name, hits (k), term_size (K), query_size (n),
    background_size (N), p_value, p_adjusted, score
    (-log10 p_adjusted, 0 when p <= 0), feature (``enrich_<name>``), ordered
    by p then term id; ``top`` keeps the first terms.
    """
    tg = term_gene.select(F.col(term_id).alias("term_id"),
                          (F.col(term_name) if term_name and term_name in term_gene.columns
                           else F.lit(None).cast("string")).alias("term_name"),
                          F.col(gene).cast("string").alias("gene")).distinct()
    if background is None:
        bg = tg.select("gene").distinct()
    else:
        bg = background.select(F.col(gene).cast("string").alias("gene")).distinct()
        tg = tg.join(bg, "gene", "left_semi")
    q = genes.select(F.col(gene).cast("string").alias("gene")).distinct().join(bg, "gene", "left_semi")
    sizes = bg.agg(F.count(F.lit(1)).alias("bn")).crossJoin(q.agg(F.count(F.lit(1)).alias("qn")))
    names = tg.groupBy("term_id").agg(F.min("term_name").alias("term_name"))
    counts = (tg.select("term_id", "gene").distinct()
              .join(q.withColumn("_q", F.lit(1)), "gene", "left")
              .groupBy("term_id")
              .agg(F.count(F.lit(1)).alias("tk"), F.count("_q").alias("hk")))
    t = counts.join(names, "term_id").crossJoin(F.broadcast(sizes)).where("hk > 0")
    return _finish_enrichment(hypergeom_sf(t), adjust, top)


def _lfact(x):
    # ln(x!) = lgamma(x + 1).  Spark SQL has no lgamma: exact table values for
    # x <= 10, the Stirling series (error < 1e-12 for z >= 11) above.
    xd = x.cast("double") + F.lit(1.0)
    z = F.greatest(xd, F.lit(11.0))
    series = ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi)
              + 1.0 / (12.0 * z) - 1.0 / (360.0 * z * z * z) + 1.0 / (1260.0 * F.pow(z, 5))
              - 1.0 / (1680.0 * F.pow(z, 7)))
    small = F.element_at(F.array(*[F.lit(math.lgamma(i + 1.0)) for i in range(11)]),
                         (F.least(x, F.lit(10)) + 1).cast("int"))
    return F.when(x <= 10, small).otherwise(series)


def lchoose(nn, kk):
    """ln C(n, k) as a column expression (exact to ~1e-13 relative)."""
    return _lfact(nn) - _lfact(kk) - _lfact(nn - kk)


def hypergeom_sf(t: DataFrame, N: str = "bn", K: str = "tk", n: str = "qn", k: str = "hk") -> DataFrame:
    """Add ``p_value`` = P(X >= k), X ~ Hypergeometric(population N, K
    successes, n draws), one test per row.

    The tail i = k..min(n, K) is exploded into rows (one per term, so the
    work is spread and every term is a compiled column expression), each
    term is exp(ln C(K,i) + ln C(N-K,n-i) - ln C(N,n)), and the terms are
    summed back per test.  Rows produced = total tail length, bounded by the
    term sizes.
    """
    # the p-value is a function of (N, K, n, k): compute it once per distinct tuple
    tests = t.select(F.col(N).alias("_pop"), F.col(K).alias("_succ"), F.col(n).alias("_draw"),
                     F.col(k).alias("_hit")).distinct()
    hi = F.least(F.col("_draw"), F.col("_succ"))
    terms = tests.select("*", F.explode(F.sequence(F.col("_hit").cast("long"),
                                                    F.greatest(hi, F.col("_hit")).cast("long"))).alias("_i"))
    i = F.col("_i")
    lt = (lchoose(F.col("_succ"), i) + lchoose(F.col("_pop") - F.col("_succ"), F.col("_draw") - i)
          - lchoose(F.col("_pop"), F.col("_draw")))
    valid = (i <= hi) & (F.col("_draw") - i <= F.col("_pop") - F.col("_succ"))
    sums = (terms.groupBy("_pop", "_succ", "_draw", "_hit")
            .agg(F.least(F.lit(1.0), F.sum(F.when(valid, F.exp(lt)).otherwise(0.0))).alias("p_value")))
    cond = [(t[N] == sums["_pop"]), (t[K] == sums["_succ"]), (t[n] == sums["_draw"]), (t[k] == sums["_hit"])]
    return t.join(sums, cond, "left").drop("_pop", "_succ", "_draw", "_hit")


def _finish_enrichment(p: DataFrame, adjust: str, top: int | None) -> DataFrame:
    m = p.agg(F.count(F.lit(1)).alias("_m"))
    x = p.crossJoin(F.broadcast(m))
    if adjust == "bonferroni":
        x = x.withColumn("p_adjusted", F.least(F.lit(1.0), F.col("p_value") * F.col("_m")))
    elif adjust == "bh":
        from ..functions.ordered import global_row_index
        ranked = global_row_index(x, ["p_value", "term_id"], index_col="_i").withColumn("_i", F.col("_i") + 1)
        raw = F.least(F.lit(1.0), F.col("p_value") * F.col("_m") / F.col("_i"))
        # step-up: running minimum from the largest rank down; one row per
        # tested term (bounded by the term catalogue)
        w = Window.orderBy(F.col("_i").desc()).rowsBetween(Window.unboundedPreceding, 0)
        x = ranked.withColumn("p_adjusted", F.min(raw).over(w)).drop("_i")
    else:
        x = x.withColumn("p_adjusted", F.col("p_value"))
    out = x.select("term_id", "term_name", F.col("hk").cast("long").alias("hits"),
                   F.col("tk").cast("long").alias("term_size"), F.col("qn").cast("long").alias("query_size"),
                   F.col("bn").cast("long").alias("background_size"), "p_value", "p_adjusted",
                   F.when(F.col("p_adjusted") > 0, -F.log10("p_adjusted")).otherwise(F.lit(0.0)).alias("score"),
                   F.concat(F.lit("enrich_"), F.regexp_replace(
                       F.coalesce("term_name", "term_id", F.lit("unknown")), " ", "_")).alias("feature"))
    if top:
        out = out.orderBy("p_adjusted", "p_value", "term_id").limit(top)
    return out


def ortholog_enrichment(genes: DataFrame, mapping: DataFrame, term_gene: DataFrame, **kw) -> DataFrame:
    """Map genes to orthologs (C2), test the orthologs (D4), prefix keys ``orth_``."""
    orth = map_orthologs(genes, mapping).select(F.col("ortholog").alias("gene")).distinct()
    res = pathway_enrichment(orth, term_gene, **kw)
    return res.withColumn("feature", F.concat(F.lit("orth_"), F.col("feature")))


# --------------------------------------------------------------------------- H11
def neighbour_propagate(features: DataFrame, edges: DataFrame, node: str = "gene",
                        cols: Sequence[str] | None = None, hops: int = 1) -> DataFrame:
    """Symmetric-normalised neighbour aggregation D^-1/2 (A + I) D^-1/2 X.

    Degrees include the self loop.  Each hop is an edge join + ``groupBy``
    sum (a sparse matrix product); nodes without edges keep x (degree 1).
    """
    cols = list(cols) if cols is not None else [c for c in features.columns if c != node]
    e = canonical_edges(edges)
    nodes = features.select(F.col(node).cast("string").alias("gene"), *cols)
    arcs = (e.select(F.col("src").alias("a"), F.col("dst").alias("b"))
            .unionByName(e.select(F.col("dst").alias("a"), F.col("src").alias("b"))))
    deg = arcs.groupBy("a").agg((F.count(F.lit(1)) + 1).alias("_d"))
    dn = nodes.join(deg.withColumnRenamed("a", "gene"), "gene", "left") \
        .select("gene", F.coalesce("_d", F.lit(1)).cast("double").alias("_d"))
    loops = dn.select(F.col("gene").alias("a"), F.col("gene").alias("b"))
    arcs_all = arcs.unionByName(loops)
    w = (arcs_all.join(dn.select(F.col("gene").alias("a"), F.col("_d").alias("_da")), "a")
         .join(dn.select(F.col("gene").alias("b"), F.col("_d").alias("_db")), "b")
         .select("a", "b", (F.lit(1.0) / F.sqrt(F.col("_da") * F.col("_db"))).alias("_w")))
    cur = nodes
    for _ in range(hops):
        src = cur.select(F.col("gene").alias("b"), *cols)
        cur = (w.join(src, "b")
               .groupBy(F.col("a").alias("gene"))
               .agg(*[F.sum(F.col("_w") * F.col(c)).alias(c) for c in cols]))
    return cur


# --------------------------------------------------------------------------- C7
def literature_hits(features: DataFrame, docs: DataFrame, k: int = 3, feature: str = "feature",
                    doc_id: str = "doc_id", text: str = "text", title: str | None = None) -> DataFrame:
    """For each feature term, the first k documents that mention it.

    Documents are tokenised on non-letters (lower case, whole text) and
    exploded to (doc, token, hits); the feature list is joined on the token;
    the ranking is hits desc, then doc id; top k per feature is a
    ``row_number`` window partitioned by feature over the joined (matching)
    rows only.
    """
    require_columns(docs, [doc_id, text])
    f = features.select(F.lower(F.col(feature)).alias("token"), F.col(feature).alias("feature")).distinct()
    toks = docs.select(F.col(doc_id).alias("doc_id"),
                       F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")).alias("token"))
    toks = toks.where(F.length("token") > 0).join(f.select("token").distinct(), "token", "left_semi")
    hits = toks.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("hits"))
    x = hits.join(f, "token")
    out = top_k_per_group(x, ["feature"], [F.col("hits").desc(), F.col("doc_id").asc()], k,
                          salt=F.col("doc_id"), rank_col="rank")
    cols = ["feature", "doc_id", F.col("hits").cast("long").alias("hits"), F.col("rank").cast("long").alias("rank")]
    if title and title in docs.columns:
        out = out.join(docs.select(F.col(doc_id).alias("doc_id"), F.col(title).alias("title")), "doc_id")
        cols.append("title")
    return out.select(*cols)
