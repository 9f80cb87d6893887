"""PII (operator 7): information-theoretic sanitisation, DataFrame functions only.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers that the fixed patterns find, and the groups they belong to: mail
domain, network (first two parts), first six digits of a card, first five of a
phone number.  Terms (runs of letters or digits) are counted with every entity
of their documents, wherever both stand; how strongly a term reveals an entity
is the share of the entity's information that the term gives away,

    disclosure(t, e) = 1 - log P(e | t) / log P(e),

with P(e | t) = documents of t and e / documents of t, P(e) = documents of e /
all documents, every row one document.  Terms seen with an entity in
``min_support`` different texts (with a group: ``group_support``) whose
disclosure reaches a threshold become spans too, wherever they occur:
generalised at the lower threshold, removed at the upper one.

Keys and tokens stand in one text only, so no count of theirs reveals anything;
what they give away is the information they carry themselves.  A run of letters
A-Z and digits, with both, has a shape (its length and classes of characters)
in a context (the word before).  The corpus gives the entropy H of a character
of that shape in that context, over its distinct values (of the shape in any
context, where a context has only one); the run itself has the entropy h.  Its
information is length * min(H, h) bits: from ``BITS`` on it is generalised,
from twice that removed, however rarely it occurs.  A run of m characters has
at most m log2(m) bits, so runs of fewer than ``MIN_RUN`` cannot reach the
threshold.  Words without digits, and scripts other than A-Z, are left to the
counts.

Patterns: possessive and anchored at the start of a run (or the end of the
last match) forms of the contract's patterns; they find the same matches
without backtracking, in linear time.  Places come from the pieces between
matches, summed by a window per document and kind.

Scale: text is scanned, never shuffled, to find matches and count terms; only
matches and terms move; of the runs, those of ``MIN_RUN`` characters or more.
Texts with an entity of ``min_support`` texts, one row
each, and documents with a revealing term meet their text again; hashes of at
most ``SENT`` keys, sent to every task, keep others out of these joins.  Terms that no
entity's counts could bring to the threshold (in fewer than ``min_support``
documents, or in more than P(e)^(threshold - 1) times those of e) never meet
the entities; nothing else is left out.

Defined cases: a null text is empty; rows that repeat an id and text share one
result; null ids take part; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import load, materialise

KINDS = ("email", "ip", "card", "phone", "term", "secret")   # "term": generalised, "secret": removed
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
# What every match of a kind holds; a cheap test before the pattern runs.
HINTS = ("@", ".", None, "+")
BYTE_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
MIN_SUPPORT = 2
GROUP_SUPPORT = 3
GENERALISE, REMOVE = 0.9, 0.97
SENT = 1 << 20     # 8-byte hashes at most in a broadcast
BITS = 64.0
MIN_RUN = 16        # 16 log2(16) = BITS
RUN = r"(?<![\p{L}\p{N}])[A-Za-z0-9]{%d,}+(?![\p{L}\p{N}])" % MIN_RUN
CONTEXT = 200       # characters before a run in which its word before is looked for
KEY = ["_id", "_t"]


def _thinned(df: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """Rows whose key may be among those of ``others`` (a written table), for a
    join that follows.  Hashes of the keys are sent to every task if they are
    at most ``SENT``; with more, all rows go on to the join."""
    keys = others.select(F.xxhash64(key).alias("_key")).distinct()
    if keys.limit(SENT + 1).count() > SENT:
        return df
    return df.join(F.broadcast(keys), F.xxhash64(key) == F.col("_key"), "left_semi")


def _located(df: DataFrame, by: list[str]) -> DataFrame:
    """Start and end of every match of rows (by..., i, n, match): the lengths
    of the pieces before it and of the matches between them, summed."""
    grow = F.col("n") + F.length("match")
    end = F.sum(grow).over(W.partitionBy(*by).orderBy("i").rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("e", end.cast("long")).withColumn("s", F.col("e") - F.length("match"))


def base_spans(docs: DataFrame) -> DataFrame:
    """(_id, _t, k, s, e, match) of the patterns' valid matches."""
    found = []
    for k, (p, hint) in enumerate(zip(PATTERNS, HINTS)):
        hit = F.regexp_extract_all("_text", F.lit(p), F.lit(0))
        some = F.when(F.contains("_text", F.lit(hint)), hit) if hint else hit
        found.append(some.alias(f"m{k}"))
    rows = docs.select(*KEY, "_text", *found)
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"m{k}").alias("m")) for k in range(len(PATTERNS))])
    rows = rows.where(" or ".join(f"size(m{k}) > 0" for k in range(len(PATTERNS))))
    rows = rows.select(*KEY, "_text", F.explode(F.filter(each, lambda x: F.size(x["m"]) > 0)).alias("z"))
    cut = F.split("_text", F.element_at(F.array(*map(F.lit, PATTERNS)), F.col("z.k") + 1), -1)
    rows = rows.select(*KEY, F.col("z.k").alias("k"), F.col("z.m").alias("m"), cut.alias("c"))
    zipped = F.transform("m", lambda x, i: F.struct(F.length(F.get("c", i)).alias("n"), x.alias("match")))
    rows = rows.select(*KEY, "k", F.posexplode(zipped).alias("i", "z"))
    rows = rows.select(*KEY, "k", "i", "z.n", "z.match").distinct()
    rows = _located(rows, [*KEY, "k"])
    digits = F.regexp_replace("match", "[^0-9]", "")
    good = (F.when(F.col("k") == 1, F.col("match").rlike(BYTE_PARTS))
            .when(F.col("k") == 2, F.length(digits).between(13, 19) & F.call_function("luhn_check", digits))
            .when(F.col("k") == 3, F.length(digits).between(9, 15)).otherwise(True))
    return rows.where(good).select(*KEY, "k", "s", "e", "match")


def _terms(col):
    """Runs of letters or digits, lower case."""
    return F.filter(F.split(F.lower(col), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def entity_names():
    """Names of a match as an entity: its value and its group, which starts with *."""
    kind, low = F.col("k").cast("string"), F.lower("match")
    digits = F.regexp_replace("match", "[^0-9]", "")
    group = (F.when(F.col("k") == 0, F.substring_index(low, "@", -1)).when(F.col("k") == 1, F.substring_index(low, ".", 2))
             .when(F.col("k") == 2, F.left(digits, F.lit(6))).otherwise(F.left(digits, F.lit(5))))
    return F.array(F.concat(kind, F.lit(":"), low), F.concat(F.lit("*"), kind, F.lit(":"), group))


def disclosures(docs: DataFrame, spans: DataFrame, min_support: int = MIN_SUPPORT, group_support: int = GROUP_SUPPORT,
                threshold: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of all pairs that reach ``threshold``."""
    least = F.when(F.startswith("entity", F.lit("*")), group_support).otherwise(min_support)
    copies = docs.groupBy("_t").agg(F.count(F.lit(1)).alias("m"))
    held = materialise(spans.select(F.explode(entity_names()).alias("entity"), "_t").distinct().join(copies, "_t"), "entities")
    total = float(docs.count())
    ents = held.groupBy("entity").agg(F.count(F.lit(1)).alias("texts"), F.sum("m").alias("ne"))
    ents = ents.where((F.col("texts") >= least) & (F.col("ne") < total))
    # a term in more documents than this cannot reach the threshold with the entity
    most = F.pow(F.col("ne"), F.lit(threshold)) * F.pow(F.lit(total), F.lit(1 - threshold)) * (1 + 1e-9)
    held = materialise(held.join(ents.select("entity", "ne", most.alias("most")), "entity"), "held")
    most = held.agg(F.max("most")).first()[0] or 0.0
    count = docs.select(F.explode(F.array_distinct(_terms(F.col("_text")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("nt"))
    count = count.where((F.col("nt") >= min_support) & (F.col("nt") <= most))
    texts = _thinned(docs, "_t", held).join(held.select("_t").distinct(), "_t", "left_semi").groupBy("_t").agg(F.any_value("_text").alias("_text"))
    own = texts.select("_t", F.explode(F.array_distinct(_terms(F.col("_text")))).alias("term")).join(count, "term")
    both = own.join(held, "_t").where(F.col("nt") <= F.col("most")).groupBy("entity", "term", "ne", "nt").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("m").alias("both")).where(F.col("texts") >= least)
    gives = 1 - F.log(F.col("both") / F.col("nt")) / F.log(F.col("ne") / F.lit(total))
    return both.select("entity", "term", gives.alias("disclosure")).where(F.col("disclosure") >= threshold)


def revealing_terms(docs: DataFrame, spans: DataFrame, **limits) -> DataFrame:
    """(term, disclosure): the terms that reveal some entity, and how strongly at most."""
    return disclosures(docs, spans, **limits).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def _bits(counts, total):
    """Entropy in bits of a character, from a sum over counts n of n log2 n."""
    return F.log2(total) - counts / total


def informative_runs(docs: DataFrame) -> DataFrame:
    """(_id, _t, s, e, bits) of all runs of letters and digits, with their information."""
    some = docs.where(F.col("_text").rlike(RUN)).select(
        *KEY, F.regexp_extract_all("_text", F.lit(RUN), F.lit(0)).alias("m"), F.split("_text", RUN, -1).alias("c"))
    rows = some.select(*KEY, F.posexplode(F.transform("m", lambda x, i: F.struct(F.get("c", i).alias("piece"), x.alias("match")))).alias("i", "z"))
    before = F.lower(F.regexp_extract(F.right("z.piece", F.lit(CONTEXT)), r"([\p{L}\p{N}]++)[^\p{L}\p{N}]*+$", 1))
    rows = _located(rows.select(*KEY, "i", F.length("z.piece").alias("n"), "z.match", before.alias("context")).distinct(), KEY)
    has = [F.col("match").rlike(c) for c in ("[0-9]", "[a-z]", "[A-Z]")]
    shape = F.concat_ws(" ", F.length("match").cast("string"), *[h.cast("string") for h in has])
    rows = rows.where(has[0] & (has[1] | has[2])).select(*KEY, "s", "e", "match", "context", shape.alias("shape"))
    rows = materialise(rows, "runs")
    values = rows.select("context", "shape", "match").distinct()
    char = F.explode(F.filter(F.split("match", ""), lambda x: x != "")).alias("char")
    weigh = [F.sum(F.col("n") * F.log2("n")).alias("w"), F.sum("n").cast("double").alias("t")]
    own = values.select("context", "shape", char).groupBy("context", "shape", "char").agg(F.count(F.lit(1)).alias("n"))
    own = own.groupBy("context", "shape").agg(*weigh).select("context", "shape", _bits(F.col("w"), F.col("t")).alias("near"))
    several = values.groupBy("context", "shape").agg(F.count(F.lit(1)).alias("values"))
    wide = values.select("shape", "match").distinct().select("shape", char).groupBy("shape", "char").agg(F.count(F.lit(1)).alias("n"))
    wide = wide.groupBy("shape").agg(*weigh).select("shape", _bits(F.col("w"), F.col("t")).alias("wide"))
    size = F.length("match").cast("double")
    each = F.array_distinct(F.filter(F.split("match", ""), lambda x: x != ""))
    times = F.aggregate(each, F.lit(0.0), lambda a, x: a + (size - F.length(F.replace("match", x, F.lit("")))) * F.log2(
        size - F.length(F.replace("match", x, F.lit("")))))
    found = values.join(own.join(several, ["context", "shape"]), ["context", "shape"]).join(wide, "shape")
    among = F.when(F.col("values") > 1, F.col("near")).otherwise(F.col("wide"))
    found = found.select("context", "match", (size * F.least(among, _bits(times, size))).alias("bits"))
    return rows.join(found, ["context", "match"]).select(*KEY, "s", "e", "bits")


def run_spans(docs: DataFrame, bits: float = BITS) -> DataFrame:
    """(_id, _t, k, s, e) of the runs that carry ``bits`` or more."""
    kind = F.when(F.col("bits") >= 2 * bits, 5).otherwise(4)
    return informative_runs(docs).where(F.col("bits") >= bits).select(*KEY, kind.alias("k"), "s", "e")


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(_id, _t, k, s, e) of every occurrence of the terms."""
    terms = materialise(terms, "revealing")
    word = F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(r"[\p{L}\p{N}]++"), F.lit(0)))).alias("word")
    own = docs.select(*KEY, word).withColumn("term", F.lower("word"))
    own = _thinned(own, "term", terms).join(terms, "term", "left_semi")
    hit = materialise(own.groupBy(*KEY).agg(F.collect_set("word").alias("_words")), "hit")      # a document's own words
    hit = hit.withColumnsRenamed({"_id": "_id2", "_t": "_t2"})
    some = _thinned(docs, "_t", hit.select(F.col("_t2").alias("_t")))
    some = some.join(hit, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_t") == F.col("_t2")))
    any_of = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join("_words", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    some = some.select(*KEY, F.regexp_extract_all("_text", any_of, F.lit(0)).alias("m"), F.split("_text", any_of, -1).alias("c"))
    zipped = F.transform("m", lambda x, i: F.struct(F.length(F.get("c", i)).alias("n"), x.alias("match")))
    rows = some.select(*KEY, F.posexplode(zipped).alias("i", "z")).select(*KEY, "i", "z.n", "z.match").distinct()
    kind = F.when(F.col("disclosure") >= REMOVE, 5).otherwise(4)
    return _located(rows, KEY).withColumn("term", F.lower("match")).join(terms, "term").select(*KEY, kind.alias("k"), "s", "e")


def all_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents as _id, _t, _text; spans as _id, _t, k, s, e): the patterns'
    spans and those of revealing terms and informative runs that lie in none of them."""
    docs = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    docs = docs.withColumn("_t", F.xxhash64("_text"))
    base = materialise(base_spans(docs), "spans")
    more = term_spans(docs, revealing_terms(docs, base)).unionByName(run_spans(docs))
    more = more.groupBy(*KEY, "s", "e").agg(F.max("k").alias("k"))      # a run can be both
    both = base.select(*KEY, "k", "s", "e").unionByName(more)
    order = W.partitionBy(*KEY).orderBy("s", "k")
    is_base = F.col("k") < len(PATTERNS)
    reached = F.max(F.when(is_base, F.col("e"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    free = F.coalesce(reached, F.lit(0)) < F.col("e")
    return docs, both.withColumn("_free", is_base | free).where("_free").drop("_free")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per kind, the digest of the patterns'
    spans, and all spans."""
    texts, spans = all_spans(docs, id_col, text_col)
    per = spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("k", "s", "e"))).alias("_spans"))
    per = per.withColumnsRenamed({"_id": "_id2", "_t": "_t2"})
    out = texts.drop("_text").join(per, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_t") == F.col("_t2")), "left")
    names = F.array(*map(F.lit, KINDS))
    listed = F.transform(F.coalesce("_spans", F.expr("array()")), lambda x: F.struct(
        x["k"].alias("k"), F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string")).alias("w")))
    out = out.withColumn("_l", listed)
    base = F.filter("_l", lambda x: x["k"] < len(PATTERNS))

    def count(k):
        return F.size(F.filter("_l", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(len(KINDS))]
    return out.select(F.col("_id").alias(id_col), *counts,
                      F.sha2(F.concat_ws(",", F.transform(base, lambda x: x["w"])), 256).alias("base_sha256"),
                      F.concat_ws(",", F.transform("_l", lambda x: x["w"])).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): every span replaced by its kind in brackets; terms beyond
    the upper threshold are removed.  Touching spans of several kinds become
    one, of the first kind."""
    texts, spans = all_spans(docs, id_col, text_col)
    own = W.partitionBy(*KEY).orderBy("s", "e", "k")
    reach = F.max("e").over(own.rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("_new", F.when(reach.isNull() | (F.col("s") >= reach), 1).otherwise(0))
    islands = islands.withColumn("_island", F.sum("_new").over(own)).groupBy(*KEY, "_island").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.min("k").alias("k"))
    per = islands.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("s", "e", "k"))).alias("_z"))
    per = per.withColumnsRenamed({"_id": "_id2", "_t": "_t2"})
    both = texts.join(per, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_t") == F.col("_t2")), "left")
    words = ", ".join(f"'[{k.upper()}]'" for k in KINDS[:-1]) + ", ''"
    built = F.expr(f"""concat(array_join(transform(_z, (x, i) -> concat(
        substring(_text, if(i = 0, 1, cast(_z[i - 1].e + 1 as int)), cast(x.s - if(i = 0, 0, _z[i - 1].e) as int)),
        element_at(array({words}), x.k + 1))), ''), substring(_text, cast(element_at(_z, -1).e + 1 as int)))""")
    return both.select(F.col("_id").alias(id_col), F.when(F.col("_z").isNull(), F.col("_text")).otherwise(built).alias(text_col))


def op7_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return find_pii(load(spark, sf_dir, "documents"))
