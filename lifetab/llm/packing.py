"""Best-fit packing (operator 10): bounded-space online best-fit.

A fixed number of open bins is kept in a bitset keyed by free space.  An item
goes to the bin with the least free space that still holds it; if none does
and all places are taken, the fullest bin closes.  Each input partition packs
its own stream (no shuffle of text); the items of the bins that are still open
at a partition's end are packed again together, longest first, in few larger
groups, so the waste stays a fixed number of bins per group.

Documents are token ids of a public tokenizer plus one end id; only longer
ones are cut, into pieces of the full capacity.

Defined cases: a null or empty text is the single end id; repeated rows are
packed once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, text_chunks, texts_of, words_of

CAPACITY = 2048
OPEN_BINS = 64
GROUP = 20_000      # left-over pieces packed again in one task
CACHE = 48 << 20    # bytes of words and their ids that a worker keeps, about
ENTRY = 170         # bytes of a cached word besides its letters and ids
RUN = 64            # new words encoded in one call
CHUNK = 4 << 20     # bytes of text at a time
# Latin letters; the tokenizer splits between one of them and a comma or full stop.
LETTER = r"[a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Open bins by free space; ``place`` gives (bin, offset) and the bins it closed."""

    def __init__(self, capacity: int, places: int):
        self.capacity, self.places = capacity, places
        self.mask, self.open, self.made = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.open -= 1
        return bin_

    def _put(self, bin_: int, free: int):
        self.by_free.setdefault(free, []).append(bin_)
        self.mask |= 1 << free
        self.open += 1

    def place(self, length: int) -> tuple[int, int, list[int]]:
        closed = []
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open == self.places and length < self.capacity:
                closed.append(self._take((self.mask & -self.mask).bit_length() - 1))
            bin_, free = self.made, self.capacity
            self.made += 1
        if free > length:
            self._put(bin_, free - length)
        else:
            closed.append(bin_)
        return bin_, self.capacity - free, closed

    def rest(self) -> list[int]:
        return [b for bins in self.by_free.values() for b in bins]


class WordIds:
    """Token ids of texts, by white-space separated words.

    The tokenizer drops white space and never joins across it, so a text's
    ids are the ids of its words in turn.  ASCII case is folded by the
    tokenizer anyway, and a comma or full stop after a Latin letter is always
    a token of its own; both make the cache of words smaller."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        # two generations: words met since the last turn, and those of the turn before
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        (self.bar,) = self.tokenizer.encode("|", add_special_tokens=False).ids

    def _new(self, words: list[str]):
        """Encodes words many at a time, with a bar (a token of its own) between them."""
        odd = [w for w in words if "|" in w]
        plain = [w for w in words if "|" not in w] if odd else words
        for i in range(0, len(plain), RUN * 64):
            runs = [plain[j:j + RUN] for j in range(i, min(i + RUN * 64, len(plain)), RUN)]
            for run, e in zip(runs, self.encode([" | ".join(r) for r in runs], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                ends = (np.flatnonzero(ids == self.bar) * 4).tolist()
                raw = ids.tobytes()
                self.cache.update((w, raw[x:y]) for w, x, y in zip(run, [0, *[z + 4 for z in ends]], [*ends, len(raw)]))
        for w in odd:
            self.cache[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        cache, older = self.cache, self.older
        new = [w for w in words if w not in cache]
        if new:
            kept = {w: older[w] for w in new if w in older}      # words in use stay
            cache.update(kept)
            self._new([w for w in new if w not in kept] if kept else new)
            self.held += sum(map(len, new)) + sum(len(cache[w]) for w in new) + ENTRY * len(new)
        out = [cache[w] for w in words]
        if self.held > CACHE // 2:
            self.cache, self.older, self.held = {}, cache, 0
        return out

    def texts(self, texts, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of an Arrow array of texts, ``end`` after each."""
        offs, flat = words_of(pc.ascii_lower(texts))
        enc = flat.dictionary_encode()
        which = enc.indices.to_numpy(zero_copy_only=False)
        # "word," and "word." are "word" and a token: fewer words to encode
        ended = pc.match_substring_regex(enc.dictionary, LETTER + "[.,]$")
        stems = pc.if_else(ended, pc.utf8_rtrim(enc.dictionary, ".,"), enc.dictionary).dictionary_encode()
        own = self.words(stems.dictionary.to_pylist())
        stops = self.words([".", ","])
        stem = stems.indices.to_numpy(zero_copy_only=False)
        stop = np.where(pc.ends_with(enc.dictionary, ".").to_numpy(zero_copy_only=False), len(own), len(own) + 1)
        stop = np.where(ended.to_numpy(zero_copy_only=False), stop, len(own) + 2)
        own = [*own, *stops, b"", np.array([end], "<u4").tobytes()]
        size = np.fromiter(map(len, own), np.int32, len(own)) // 4     # a text holds under 2^31 ids
        ids = np.frombuffer(b"".join(own), "<u4")
        first = np.cumsum(size, dtype=np.int32) - size
        # every word is its stem and its stop; one more pair per text: the end id
        which = np.insert(which, offs[1:], len(stem))
        pairs = np.stack([np.append(stem, len(own) - 1), np.append(stop, len(own) - 2)], 1).astype(np.int32)
        which = pairs[which].reshape(-1)
        long = size[which]
        at = np.cumsum(long, dtype=np.int32)
        out = ids[np.repeat(first[which] - (at - long), long) + np.arange(at[-1] if len(at) else 0, dtype=np.int32)]
        ends = at[2 * (offs[1:] + np.arange(len(offs) - 1)) + 1]
        return np.concatenate([[0], ends]).astype(np.int64), out


_LOADED: dict = {}


def word_ids(path: str) -> WordIds:
    """The worker's tokenizer.  Where workers have the package, it and its
    cache of words outlive the task."""
    try:
        from lifetab.llm.packing import _LOADED as kept
    except ImportError:
        kept = {}
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def give_back():
    """Hands the allocator's free pages back to the system: a worker that has
    run other stages keeps theirs otherwise."""
    import ctypes
    with contextlib.suppress(OSError, AttributeError):      # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def _table(columns: dict) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "final": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()],
                                      names=list(columns))


class _Stream:
    """Packs pieces as they come; a bin's rows go out when it closes."""

    def __init__(self, capacity: int, places: int, base: int):
        self.fit, self.base, self.held, self.out = BestFit(capacity, places), base, {}, []

    def add(self, row: tuple):
        bin_, offset, closed = self.fit.place(row[3])
        self.held.setdefault(bin_, []).append((*row, self.base + bin_, offset))
        for b in closed:
            self.out += self.held.pop(b)

    def flush(self, final: bool, rows=None):
        rows, self.out = (self.out, []) if rows is None else (rows, self.out)
        names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
        cols = dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}
        return _table(cols | {"final": [final] * len(rows)})

    def rest(self):
        return [r for b in self.fit.rest() for r in self.held[b]]


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, places: int = OPEN_BINS,
         end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with the sequence it went to and its offset there."""
    spark = docs.sparkSession

    def first(batches):
        stream = _Stream(capacity, places, TaskContext.get().partitionId() << 33)
        ids_of = word_ids(tokenizer)
        give_back()
        for chunk in text_chunks(batches, limit=CHUNK):
            keys = chunk.column("doc_id").to_pylist()
            offs, ids = ids_of.texts(texts_of(chunk), end)
            for key, a, b in zip(keys, offs[:-1].tolist(), offs[1:].tolist()):
                for piece, at in enumerate(range(a, b, capacity)):
                    upto = min(at + capacity, b)
                    stream.add((key, piece, at - a, upto - at, zlib.crc32(ids[at:upto].tobytes())))
            del ids
            give_back()
            yield stream.flush(True)
        yield stream.flush(True)
        yield stream.flush(False, stream.rest())

    def again(batches):
        rows = sorted((tuple(r.values()) for b in batches for r in b.to_pylist()),
                      key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[4]))
        stream = _Stream(capacity, len(rows) + 1, (1 << 62) + (TaskContext.get().partitionId() << 33))
        for r in rows:
            stream.add(r)
        yield stream.flush(True)
        yield stream.flush(True, stream.rest())

    schema = PIECE + ", sequence_id long, offset long, final boolean"
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    done = materialise(src.mapInArrow(first, schema), "packed")
    left = done.where(~F.col("final")).select("doc_id", "piece", "start", "length", "ids_crc32")
    groups = max(1, -(-left.count() // GROUP))
    spread = left.repartition(groups, F.xxhash64("doc_id", "piece", "ids_crc32"))
    return done.where("final").drop("final").unionByName(spread.mapInArrow(again, schema).drop("final"))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return pack(load(spark, sf_dir, "documents"), default_tokenizer())
