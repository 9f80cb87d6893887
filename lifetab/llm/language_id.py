"""Language ID (operator 9): multilingual mixture inference.

Learning counts hashed letter n-grams (four bytes around every letter, within
words) per language over all training rows.  A document is a mixture of
languages: every word has a likelihood under each language, and
expectation-maximisation with a weak prior estimates the document's language
proportions.  Where more than one language has a share, the best set of
languages is chosen by penalised likelihood (half a log of the word count per
further language).  The prediction is the language with the largest share in
that set, the score its smoothed share.

Scale: learning shuffles at most 2^16 counts per language and task; the model
(languages x 2^16 numbers) is broadcast; scoring is one pass.

Defined cases: a null text or one without a letter is ``und`` with score 0;
null languages do not train; null ids train; if nothing trains every document
is ``und``; equal shares go to the language first in code point order; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_bucket, load, text_chunks, texts_of

BUCKETS = 1 << 16
HOLD_OUT = 5
ROUNDS = 6
PRIOR = 0.5         # pseudo-words per language
UNKNOWN = "und"


def letter_grams(texts):
    """(gram bucket per letter byte, first letter of each word, words' rows)."""
    low = pc.utf8_lower(texts)
    if isinstance(low, pa.ChunkedArray):
        low = low.combine_chunks()
    width = np.int64 if pa.types.is_large_string(low.type) else np.int32
    offs = np.frombuffer(low.buffers()[1], width)[low.offset:low.offset + len(low) + 1].astype(np.int64)
    data = low.buffers()[2]
    b = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    offs = offs - offs[0]
    is_letter = np.zeros(256, bool)
    is_letter[ord("a"):ord("z") + 1] = True
    is_letter[128:] = True
    letter = is_letter[b]
    m = np.where(letter, b, 0).astype(np.uint32)
    ends = np.zeros(len(b) + 1, bool)       # a text starts here
    ends[offs] = True
    before = np.concatenate([[0], m[:-1]]).astype(np.uint32) if len(m) else m
    before[ends[:-1]] = 0
    after = np.concatenate([m[1:], [0]]).astype(np.uint32) if len(m) else m
    after[ends[1:]] = 0
    third = np.concatenate([after[1:], [0]]).astype(np.uint32) if len(m) else m
    third[(after == 0) | ends[1:]] = 0
    key = (before << np.uint32(24)) | (m << np.uint32(16)) | (after << np.uint32(8)) | third
    at = np.flatnonzero(letter)
    grams = (key[at] * np.uint32(2654435761)) >> np.uint32(16)
    starts = np.flatnonzero(before[at] == 0)
    rows = np.searchsorted(offs, at[starts], side="right") - 1
    return grams, starts, rows


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages in code point order, log probability of every gram bucket
    per language) from all rows of ``docs`` with a language."""
    def count(batches):
        total: dict[str, np.ndarray] = {}
        for chunk in text_chunks(batches):
            lang = chunk.column("lang").to_pylist()
            names = sorted(set(lang))
            code = np.array([names.index(x) for x in lang])
            grams, starts, rows = letter_grams(texts_of(chunk))
            lengths = np.diff(np.append(starts, len(grams)))
            own = np.repeat(code[rows], lengths) if len(rows) else np.zeros(0, np.int64)
            c = np.bincount(own * BUCKETS + grams, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for i, x in enumerate(names):
                total[x] = total.get(x, 0) + c[i]
        for x, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())],
                                             names=["lang", "gram", "n"])
    src = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = src.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = counts.toPandas()   # languages x 2^16 rows at most
    names = sorted(table["lang"].unique())
    c = np.zeros((BUCKETS, len(names)))
    if names:
        c[table["gram"], table["lang"].map({x: i for i, x in enumerate(names)})] = table["n"]
    p = (c + 0.1) / (c + 0.1).sum(axis=0)
    return names, np.log(p).astype(np.float32)


def mixture(like: np.ndarray, starts: np.ndarray, count: np.ndarray, allowed=None):
    """EM over words: (shares per document, log likelihood).  ``like``: words x
    languages; ``starts``/``count``: each document's words; ``allowed``:
    documents x languages."""
    langs = like.shape[1]
    allowed = np.ones((len(starts), langs), np.float32) if allowed is None else allowed.astype(np.float32)
    shares = allowed / allowed.sum(1, keepdims=True)
    prior = PRIOR * allowed
    for step in range(ROUNDS + 1):
        joint = like * np.repeat(shares, count, axis=0)
        total = joint.sum(1)
        if step == ROUNDS:
            return shares, np.add.reduceat(np.log(np.maximum(total, 1e-30)), starts)
        joint /= np.maximum(total, 1e-30)[:, None]
        shares = np.add.reduceat(joint, starts, axis=0) + prior
        shares /= shares.sum(1, keepdims=True)


def language_sets(texts, logp: np.ndarray):
    """(rows of the texts with words, their shares under all languages, shares
    under the chosen set, 0 outside it).

    The set starts with the language of the largest share and takes the next
    one while the penalised likelihood rises.  A text whose likelihood under
    all languages is not above that of one by the price of a second has none to
    gain and is settled at once."""
    langs = logp.shape[1]
    grams, starts, rows = letter_grams(texts)
    if not len(starts) or not langs:
        return np.zeros(0, int), np.zeros((0, langs)), np.zeros((0, langs))
    ll = np.add.reduceat(logp[grams], starts, axis=0)
    like = np.exp(ll - ll.max(1, keepdims=True))
    docs, first, count = np.unique(rows, return_index=True, return_counts=True)
    shares, whole = mixture(like, first, count)
    order = np.argsort(-shares, axis=1, kind="stable")
    chosen = np.zeros_like(shares)
    np.put_along_axis(chosen, order[:, :1], 1.0, axis=1)
    one = like[np.arange(len(like)), np.repeat(order[:, 0], count)]
    value = np.add.reduceat(np.log(np.maximum(one, 1e-30)), first)
    price = 0.5 * np.log(count + 1.0)
    rising = np.flatnonzero(whole - value > price) if langs > 1 else np.zeros(0, int)
    for k in range(2, langs + 1):
        if not len(rising):
            break
        words = np.repeat(np.isin(np.arange(len(docs)), rising), count)
        own = count[rising]
        allowed = np.zeros((len(rising), langs), bool)
        np.put_along_axis(allowed, order[rising][:, :k], True, axis=1)
        part, fit = mixture(like[words], np.cumsum(own) - own, own, allowed)
        fit = fit - (k - 1) * price[rising]
        better = fit > value[rising]
        rising = rising[better]
        value[rising], chosen[rising] = fit[better], part[better]
    return docs, shares, chosen


def infer(texts, logp: np.ndarray):
    """(best language or -1, score) per text."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    docs, shares, chosen = language_sets(texts, logp)
    if len(docs):
        best[docs] = chosen.argmax(1)
        score[docs] = shares[np.arange(len(docs)), best[docs]]
    return best, score


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, one pass."""
    names, logp = model
    table = docs.sparkSession.sparkContext.broadcast(logp)

    def run(batches):
        for chunk in text_chunks(batches):
            texts = texts_of(chunk)
            best, score = infer(texts, table.value)
            known = (best >= 0) & pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, np.clip(score, 0, 1), 0.0), pa.float64())], names=["doc_id", "lang_pred", "score"])
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(id_bucket(F.col("doc_id"), HOLD_OUT) != 0))
    out = predict(docs, model)
    return out.select("doc_id", (id_bucket(F.col("doc_id"), HOLD_OUT) == 0).alias("held_out"), "lang_pred", "score")
