"""LM scoring (operator 1): hashed maximum-entropy model.

Tokens are white-space words (A-Z lowered) and one end per text.  A token's
probability is class-factored: P(class | history) * P(member | class, history)
* P(word | member).  A word's class comes from its spelling (its last two
letters and whether punctuation is attached), so unseen words have one; a
class's members are the frequent words of that class and one rest member.  The
first two factors are softmaxes over hashed features of the history: the word
before (bigram), the class two before (skip), and both together (trigram).
The rest member spreads over its words by discounted counts; one more share
than there are seen words is kept for unseen ones, so the model is a proper
distribution over them too.

This distribution of fixed size, P0, is the prior of counts of all words that
grow with the corpus: with n the counts of pairs, c those of their histories,

    P2(w | word two before) = (n + M2 P0) / (c + M2),
    P(w | word before)      = (n + M1 P2) / (c + M1),

so every pair and every skip pair of the training rows counts, whatever its
words, and P sums to one as P0 does.

Training counts every word and every (history, member) event of all training
rows; the softmaxes are then fitted by distributed gradient updates: each
round, tasks over the written events return the model's expectations, and each
weight moves by its scaled difference from the observed ones.

Scale: word counts and events are pre-aggregated in the tasks and shuffled by
key.  Frequent words (at most ``KNOWN``) have numbers that every task knows;
other words travel as 64-bit hashes, once a message.  A piece of text sends its
distinct pairs to the parts they are dealt to (``PIECES`` a shuffle partition;
a pair with another word lies where that word lies), with their counts if it is
a training text.  A part sums these under 64-bit keys and sends the totals back
to where the piece's tokens wait.  So texts that are learned and scored send
their pairs once, and no table of counts is written.  All of this is packed: sorted
numbers as differences, byte by byte.  Sent to every task: the numbered words
and the model table (``rows`` x (classes + members)), both of bounded size.

Defined cases: a null or empty text is its end token alone; null ids train;
repeated rows count each; without training rows every factor is uniform; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_bucket, load, materialise, mix64, partitions, row_sums, text_chunks, texts_of, word_hashes, words_of

MODULUS, HELD = 7, 2
CLASSES = 64
SHORTLIST = 191
ROWS = 2048
KNOWN_CHARS = 64    # longer words are never sent to the tasks
KNOWN = 1 << 16     # words with a number of their own
PIECES = 4          # parts of the counts, for every shuffle partition
PRIOR = (1024.0, 4096.0)    # M1 and M2: what the prior weighs, in tokens
SLICES = 4
ROUNDS = 12
STEP, SMOOTH = 0.4, 1.0
END = " "           # no word holds a blank
CHUNK = 2 << 20
BATCH = 65_536      # rows handed to Spark at a time
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def word_classes(words) -> np.ndarray:
    """Class of every word of an Arrow array, from its spelling."""
    bare = pc.utf8_trim(words, MARKS)
    tail = pc.utf8_slice_codeunits(bare, -2).dictionary_encode()
    own = np.array([zlib.crc32(x.encode()) % (CLASSES // 2) for x in tail.dictionary.to_pylist()], np.int64)
    marked = pc.not_equal(pc.binary_length(bare), pc.binary_length(words)).to_numpy(zero_copy_only=False)
    return (own[tail.indices.to_numpy(zero_copy_only=False)] * 2 + marked) if len(words) else np.zeros(0, np.int64)


class Units:
    """Numbers for the end (0), the shortlist and the rest member of each class."""

    def __init__(self, shortlist: list[str]):
        self.words = pa.array(shortlist, pa.string())
        self.first_rest = 1 + len(shortlist)
        self.n = self.first_rest + CLASSES
        self.cls = np.concatenate([[CLASSES], word_classes(self.words), np.arange(CLASSES)]).astype(np.int64)
        self.members = [np.flatnonzero(self.cls == c) for c in range(CLASSES + 1)]

    def of(self, words) -> np.ndarray:
        at = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False)
        return np.where(at >= 0, at + 1, self.first_rest + word_classes(words))

    def sequences(self, unit: np.ndarray, offs: np.ndarray):
        """(history, unit) per token, ends included, and the texts' new offsets.
        A history is the class two before and the unit one before."""
        n = len(offs) - 1
        y = np.insert(unit, offs[1:], 0) if n else unit
        offs = offs + np.arange(n + 1)
        one = np.concatenate([[self.n], y[:-1]]) if len(y) else y
        two = np.concatenate([[CLASSES + 1] * 2, self.cls[y[:-2]]])[:len(y)] if len(y) else y
        one[offs[:-1]] = self.n
        two[offs[:-1]] = CLASSES + 1
        second = offs[:-1][np.diff(offs) > 1] + 1
        two[second] = CLASSES + 1
        return two * (self.n + 1) + one, y, offs

    def feature_rows(self, history: np.ndarray, rows: int) -> np.ndarray:
        """Table rows of a history's features: bias, bigram, skip, both."""
        two, one = np.divmod(history.astype(np.uint64), np.uint64(self.n + 1))
        hashed = [mix64(v * np.uint64(8) + np.uint64(k)) % np.uint64(rows - 1) + np.uint64(1)
                  for k, v in enumerate((one, two, history.astype(np.uint64)), 1)]
        return np.stack([np.zeros(len(history), np.int64), *[h.astype(np.int64) for h in hashed]])


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def log_probs(theta: np.ndarray, units: Units, history: np.ndarray) -> np.ndarray:
    """Natural log probability of every unit after each history."""
    rows = units.feature_rows(history, len(theta))
    logits = theta[rows].sum(axis=0)
    cls = _log_softmax(logits[:, :CLASSES + 1])
    out = np.zeros((len(history), units.n), np.float32)
    for c, own in enumerate(units.members):
        if len(own):
            out[:, own] = cls[:, c:c + 1] + _log_softmax(logits[:, CLASSES + 1 + own])
    return out


def _count_words(parts: int):
    """Words and counts of the task's texts, a packed table for every part."""
    def run(batches):
        held, rows, texts = [], 0, 0

        def merged():
            return pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def out(t):
            own, at = word_hashes(t["word"].combine_chunks())
            part = _scaled((mix64(own)[at] & np.uint64(0xFFFF)).astype(np.int64), parts)
            order = np.argsort(part, kind="stable")
            t, (own, first) = t.take(pa.array(order)), np.unique(part[order], return_index=True)
            kept = [_ipc(t.slice(a, b - a)) for a, b in zip(first, [*first[1:], t.num_rows])]
            return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(kept, pa.binary())], names=["dest", "a"])
        for chunk in text_chunks(batches, limit=CHUNK):
            texts += chunk.num_rows
            enc = words_of(pc.ascii_lower(texts_of(chunk)))[1].dictionary_encode()
            n = np.bincount(enc.indices.to_numpy(zero_copy_only=False), minlength=len(enc.dictionary))
            held.append(pa.RecordBatch.from_arrays([enc.dictionary.cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"]))
            rows += len(n)
            if rows > 1_200_000:
                t = merged()
                held, rows = t.combine_chunks().to_batches(), t.num_rows
                if rows > 600_000:
                    yield out(t)
                    held, rows = [], 0
        if texts:
            held.append(pa.RecordBatch.from_arrays([pa.array([END]), pa.array([texts], pa.int64())], names=["word", "n"]))
            yield out(merged())
    return run


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
        to.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _sum_words(batches):
    """(word, class, count) of every word; rows come part by part."""
    part, held = None, []

    def out():
        t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
        words = t["word"].combine_chunks()
        cls = np.where(pc.equal(words, END).to_numpy(zero_copy_only=False), CLASSES, word_classes(words))
        done = pa.table({"word": words, "cls": pa.array(cls, pa.int32()), "n": t["n_sum"]})
        return done.combine_chunks().to_batches(max_chunksize=BATCH)
    for batch in batches:
        for dest, a in zip(batch.column("dest").to_pylist(), batch.column("a")):
            if dest != part:
                if held:
                    yield from out()
                part, held = dest, []
            held.append(pa.ipc.open_stream(pa.py_buffer(a.as_py())).read_all())
    if held:
        yield from out()


def _count_events(units: Units):
    def run(batches):
        keys, counts = [], []

        def merged():
            k, at = np.unique(np.concatenate(keys), return_inverse=True)
            return k, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        def out():
            k, c = merged()
            for a in range(0, len(k), BATCH):
                own = k[a:a + BATCH]
                yield pa.RecordBatch.from_arrays([pa.array((own // units.n).astype(np.int32)), pa.array((own % units.n).astype(np.int32)),
                                                  pa.array(c[a:a + BATCH])], names=["h", "y", "n"])
        for chunk in text_chunks(batches, limit=CHUNK):
            offs, flat = words_of(pc.ascii_lower(texts_of(chunk)))
            enc = flat.dictionary_encode()
            unit = units.of(enc.dictionary)[enc.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
            h, y, _ = units.sequences(unit, offs)
            k, c = np.unique(h * units.n + y, return_counts=True)
            keys.append(k), counts.append(c)
            if sum(map(len, keys)) > 2_000_000:
                k, c = merged()
                keys, counts = [k], [c]
                if len(k) > 1_000_000:
                    yield from out()
                    keys, counts = [], []
        if keys:
            yield from out()
    return run


MULT = np.uint64(0x27D4EB2F165667C5)


def _word_keys(hashes: np.ndarray) -> np.ndarray:
    return mix64(hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(3))


def _history_keys(hashes: np.ndarray, skip: int) -> np.ndarray:
    """Keys of histories one (skip 0) or two before."""
    return mix64(hashes * np.uint64((0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[skip]) + np.uint64(1 + skip))


def _pair_keys(history: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mix64(history * MULT + hashes)


def _contexts(which: np.ndarray, offs: np.ndarray, end: int):
    """(word, word before, word two before) of every token, ends included, and
    the texts' new offsets.  ``end`` is the end's number, the start's the next."""
    y = np.insert(which, offs[1:], end).astype(np.int64)
    offs = offs + np.arange(len(offs))
    one = np.concatenate([[end + 1], y[:-1]])[:len(y)]
    two = np.concatenate([[end + 1] * 2, y[:-2]])[:len(y)]
    one[offs[:-1]] = two[offs[:-1]] = end + 1
    two[offs[:-1][np.diff(offs) > 1] + 1] = end + 1
    return y, one, two, offs


SPECIAL = np.array([1, 2], np.uint64)   # hashes of the end and of a text's start


class Keys:
    """The 64-bit keys of the pairs and skip pairs of texts, from the hashes of
    their distinct words."""

    def __init__(self, hashes: np.ndarray, which: np.ndarray, offs: np.ndarray):
        words = np.concatenate([hashes, SPECIAL])
        y, one, two, _ = _contexts(which, offs, len(hashes))
        self.pairs = np.concatenate([_pair_keys(_history_keys(words, skip)[at], words[y]) for skip, at in enumerate((one, two))])


def _scaled(spread: np.ndarray, parts: int) -> np.ndarray:
    """The part, of ``parts``, of numbers that are spread over 16 bits."""
    return spread * parts >> 16


def _spread(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes ^ MULT) >> np.uint64(48)).astype(np.uint16)


SHORT = 128         # fewer numbers are not compressed


def _packed(*arrays: np.ndarray) -> bytes:
    """Numbers from 0 on, each byte of them by itself, as far as any is not 0."""
    out = []
    for x in arrays:
        size = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        x = x.astype("<u8" if size > 4 else "<u4").view(np.uint8).reshape(len(x), -1 if len(x) else 4)
        planes = [x[:, k].tobytes() for k in range(size)]
        out.append((len(x), [pa.compress(plane, "zstd", asbytes=True) for plane in planes] if len(x) >= SHORT else planes))
    return pickle.dumps(out)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    out = []
    for n, planes in pickle.loads(packed):
        x = np.zeros((n, 8), np.uint8)
        for k, plane in enumerate(planes):
            x[:, k] = np.frombuffer(pa.decompress(plane, n, "zstd") if n >= SHORT else plane, np.uint8)
        out.append(x.reshape(-1).view("<u8"))
    return out


BITS = np.uint64(31)
LOW = np.uint64((1 << 31) - 1)


class Piece:
    """The distinct keys of a piece of text, as numbers kind, history, word:
    kind 0 pairs, 1 skip pairs, 2 words.  Numbered words come first, then the
    end and the start, then other words in the order of their hashes.  A word
    two before is one that is not the text's last, so (word, end) is asked too.
    ``order`` has the keys part by part."""

    def __init__(self, which: np.ndarray, offs: np.ndarray, spread: np.ndarray, end: int, parts: int):
        self.y, self.one, self.two, self.offs = _contexts(which, offs, end)
        occurs = np.zeros(len(spread), bool)
        occurs[self.y] = True
        self.words = np.flatnonzero(occurs)
        occurs[end + 1] = len(self.y) > 0
        asked = (np.flatnonzero(occurs) << 31) + end
        keys, at = np.unique(np.concatenate([(self.one << 31) + self.y, (1 << 62) + (self.two << 31) + self.y, asked]), return_inverse=True)
        self.pair, self.skip, last = np.split(at, [len(self.y), 2 * len(self.y)])
        self.last = np.zeros(len(spread), np.int64)
        self.last[occurs] = last
        self.keys = np.concatenate([keys.astype(np.uint64), np.uint64(1 << 63) + ((self.words << 31) + end).astype(np.uint64)])
        h, y = ((self.keys >> BITS) & LOW).astype(np.int64), (self.keys & LOW).astype(np.int64)
        both = mix64((spread[h].astype(np.uint64) << np.uint64(16)) + spread[y]) & np.uint64(0xFFFF)
        at = np.where(y > end + 1, spread[y], np.where(h > end + 1, spread[h], both.astype(np.uint16)))
        part = _scaled(at.astype(np.int64), parts)
        self.order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        own, first = np.unique(part[self.order], return_index=True)
        self.parts = list(zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(part)]))

    def counts(self, learned: np.ndarray) -> np.ndarray:
        """How often every key occurs in the texts that are ``learned``."""
        of = np.repeat(learned, np.diff(self.offs)).astype(np.float64)
        pairs = len(self.keys) - len(self.words)
        n = np.bincount(self.pair, of, pairs) + np.bincount(self.skip, of, pairs)
        return np.concatenate([n, np.bincount(self.y, of, len(self.last))[self.words]]).astype(np.int64)

    def messages(self, learned: np.ndarray, hashes: np.ndarray, end: int):
        """(part, its packed keys and counts); ``hashes`` are those of the words without a number."""
        first = end + 2
        n, keys = self.counts(learned)[self.order], self.keys[self.order]
        for part, a, b in self.parts:
            h, y = keys[a:b] >> BITS, (keys[a:b] & LOW).astype(np.int64)
            kind, h = h >> BITS, (h & LOW).astype(np.int64)
            own = np.unique(np.concatenate([h[h >= first], y[y >= first]]))
            h, y = (np.where(x >= first, first + np.searchsorted(own, x), x) for x in (h, y))
            h = (kind << BITS) + h.astype(np.uint64)
            yield part, _packed(np.diff(h, prepend=np.uint64(0)), y, n[a:b], np.diff(hashes[own - first], prepend=np.uint64(0)))


class Message:
    """Keys of 64 bits and counts of a packed message."""

    def __init__(self, packed: bytes, known: np.ndarray):
        h, y, self.n, rare = _unpacked(packed)
        rare, h, end = np.cumsum(rare, dtype=np.uint64), np.cumsum(h, dtype=np.uint64), len(known) - 2
        kind, h = h >> BITS, (h & LOW).astype(np.int64)

        def hashed(code):
            out = known[np.minimum(code, end + 1)]
            out[code >= end + 2] = rare[code[code >= end + 2] - end - 2]
            return out
        h, y = hashed(h), hashed(y.astype(np.int64))
        a, b = np.searchsorted(kind, [1, 2])
        self.words = h[b:]
        self.keys = np.concatenate([_pair_keys(_history_keys(h[:a], 0), y[:a]), _pair_keys(_history_keys(h[a:b], 1), y[a:b]), _word_keys(self.words)])


def _totals(keys: np.ndarray, n: np.ndarray):
    """(distinct keys, their sums, place of every key among them)."""
    order = np.argsort(keys)
    own = keys[order]
    new = np.concatenate([[True], own[1:] != own[:-1]])[:len(own)]
    at = np.empty(len(own), np.int64)
    at[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return own[first], np.add.reduceat(n[order], first) if len(first) else n, at


def _coded(chunk, units: Units, known: pa.Array):
    """Words of a piece as numbers, the texts' offsets, and of the words without
    a number of their own the hashes, in ascending order, and units."""
    offs, flat = words_of(pc.ascii_lower(texts_of(chunk)))
    enc = flat.dictionary_encode()
    number = pc.fill_null(pc.index_in(enc.dictionary, known.cast(enc.dictionary.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rare = np.flatnonzero(number < 0)
    words = enc.dictionary.take(pa.array(rare))
    own, at = word_hashes(words)
    hashes = own[at] if len(rare) else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    number[rare[order]] = len(known) + 2 + np.arange(len(rare))
    which = number[enc.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
    return which, offs, hashes[order], units.of(words)[order]


def _sum_messages(known):
    """A row of sorted keys and counts for every part; rows come part by part.
    Histories one and two before are counted from their words and last words."""
    def run(batches):
        part, held = None, []

        def out():
            keys, n, _ = _totals(np.concatenate([m.keys for m in held]), np.concatenate([m.n for m in held]).astype(np.int64))
            words = np.unique(np.concatenate([m.words for m in held]))

            def of(asked):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                return np.where(keys[at] == asked, n[at], 0)
            one = of(_word_keys(words))
            words = np.where(words == SPECIAL[0], SPECIAL[1], words)    # as many starts as ends
            two = one * (1 + (words == SPECIAL[1])) - of(_pair_keys(_history_keys(words, 0), SPECIAL[0]))
            keys, n = np.concatenate([keys, *(_history_keys(words, skip) for skip in (0, 1))]), np.concatenate([n, one, two])
            order = np.argsort(keys)
            order = order[n[order] > 0]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([keys[order].tobytes()], pa.binary()),
                                               pa.array([n[order].astype("<i8").tobytes()], pa.binary())], names=["dest", "a", "b"])
        for batch in batches:
            for dest, a in zip(batch.column("dest").to_pylist(), batch.column("a")):
                if dest != part:
                    if held:
                        yield out()
                    part, held = dest, []
                held.append(Message(a.as_py(), known.value[1]))
        if held:
            yield out()
    return run


ROW = "dest int, kind int, src long, a binary, b binary"    # kind: 0 keys and counts, 1 a message or its answer, 2 a piece of text


def _row_batch(rows):
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(kinds)], names=["dest", "kind", "src", "a", "b"])


def _answer(known):
    """The totals of the keys of every message; rows come part by part."""
    def run(batches):
        part, keys, n, asked, out, size = None, [], [], [], [], 0

        def answers():
            own, total, at = _totals(np.concatenate(keys), np.concatenate(n))
            total, upto = total[at], np.cumsum([len(k) for k in keys])
            for src, k in asked:
                yield part, 1, src, _packed(total[upto[k] - len(keys[k]):upto[k]]), None
        for batch in batches:
            for dest, kind, src, a, b in zip(*(batch.column(c) for c in ("dest", "kind", "src", "a", "b"))):
                dest, kind, src, a = dest.as_py(), kind.as_py(), src.as_py(), a.as_py()
                if dest != part:
                    for row in answers() if asked else ():
                        out.append(row)
                        size += len(row[3])
                    part, keys, n, asked = dest, [], [], []
                if kind == 0:
                    keys.append(np.frombuffer(a, np.uint64)), n.append(np.frombuffer(b.as_py(), np.int64))
                elif kind == 1:
                    own = Message(a, known.value[1])
                    asked.append((src, len(keys)))
                    keys.append(own.keys), n.append(own.n.astype(np.int64))
                else:
                    out.append((dest, kind, src, a, None))
                    size += len(a)
                if size > 4 << 20:
                    yield _row_batch(out)
                    out, size = [], 0
        out += answers() if asked else ()
        if out:
            yield _row_batch(out)
    return run


def _by_feature(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the histories' values over the table rows of their features."""
    out = np.zeros((n, values.shape[1]), np.float32)
    for r in rows:
        order = np.argsort(r, kind="stable")
        own, first = np.unique(r[order], return_index=True)
        out[own] += np.add.reduceat(values[order], first, axis=0).astype(np.float32)
    return out


def _feature_sums(theta: np.ndarray, units: Units, observed: bool):
    """Observed feature sums over a task's events, or those the model expects."""
    def run(batches):
        cols = [[], [], []]
        for b in batches:
            for out, c in zip(cols, ("h", "y", "n")):
                out.append(b.column(c).to_numpy(zero_copy_only=False))
        if not cols[0]:
            return
        h, y, n = map(np.concatenate, cols)
        history, at = np.unique(h, return_inverse=True)
        rows = units.feature_rows(history, len(theta))
        count = np.bincount(at * units.n + y, n, len(history) * units.n).reshape(-1, units.n)
        total = np.stack([count[:, own].sum(axis=1) for own in units.members], axis=1)
        fit, share = 0.0, np.concatenate([total, count], axis=1).astype(np.float64)
        if not observed:
            logits = theta[rows].sum(axis=0)
            p = _log_softmax(logits[:, :CLASSES + 1])
            fit = float((p * total).sum())
            share[:, :CLASSES + 1] = np.exp(p) * total.sum(axis=1, keepdims=True)
            for c, own in enumerate(units.members):
                p = _log_softmax(logits[:, CLASSES + 1 + own])
                fit += float((p * count[:, own]).sum())
                share[:, CLASSES + 1 + own] = np.exp(p) * total[:, c:c + 1]
        yield pa.RecordBatch.from_arrays([pa.array([fit]), pa.array([_by_feature(rows, share, len(theta)).tobytes()], pa.binary())],
                                         names=["fit", "sums"])
    return run


def _total(batches):
    """The sum of the slices' tables (a fixed number of them)."""
    fit, total = 0.0, None
    for batch in batches:
        for one, table in zip(batch.column("fit"), batch.column("sums")):
            table = np.frombuffer(table.as_py(), np.float32)
            fit, total = fit + one.as_py(), table if total is None else total + table
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([fit]), pa.array([total.tobytes()], pa.binary())], names=["fit", "sums"])


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, rows: int = ROWS):
    """Model of all rows of ``docs``: counts table, statistics, units, weights."""
    src = docs.select(F.col(text_col).alias("text"))
    n = partitions(docs.sparkSession)
    counts = src.mapInArrow(_count_words(n), "dest int, a binary").repartition(n, "dest").sortWithinPartitions("dest")
    counts = materialise(counts.mapInArrow(_sum_words, "word string, cls int, n long"), "counts")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    top = counts.where((F.col("word") != END) & (F.length("word") <= KNOWN_CHARS)).orderBy(F.desc("n"), "word").limit(SHORTLIST)
    units = Units([r["word"] for r in top.select("word").collect()])
    parts = PIECES * n
    short = counts.where((F.col("word") != END) & (F.length("word") <= KNOWN_CHARS)).withColumn("step", F.floor(F.log2("n") * 16))
    least, upto = None, 0
    for r in sorted(short.groupBy("step").count().collect(), reverse=True):     # 1024 steps at most
        upto += r["count"]
        least = r["step"] if upto <= KNOWN else least
    found = short.where(F.col("step") >= least).select("n", "word").collect() if least is not None else []
    words = pa.array([r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"]))], pa.string())
    own, at = word_hashes(words)
    known = docs.sparkSession.sparkContext.broadcast((words, np.concatenate([own[at], SPECIAL])))
    keyed = src.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("learned"))
    keyed = keyed.mapInArrow(_send(units, known, parts, False), ROW).repartition(n, "dest").sortWithinPartitions("dest")
    keyed = keyed.mapInArrow(_sum_messages(known), "dest int, a binary, b binary")      # counted when it is read
    rest = counts.where((F.col("cls") < CLASSES) & ~F.col("word").isin(units.words.to_pylist()))
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rest.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # a row per class
        mass[r["cls"]], kinds[r["cls"]] = r["n"], r["v"]
    discount = float(np.clip(size[2] / (size[2] + 2 * size[3]) if size[2] else 0.5, 0.05, 0.95))
    events = src.mapInArrow(_count_events(units), "h int, y int, n long").groupBy("h", "y").agg(F.sum("n").alias("n"))
    events = materialise(events.repartition(SLICES, "h").sortWithinPartitions("h", "y"), "events")
    theta = np.zeros((rows, CLASSES + 1 + units.n), np.float32)

    def sums(observed):     # one task adds up the SLICES tables; one table comes back
        found = events.mapInArrow(_feature_sums(theta, units, observed), "fit double, sums binary")
        for r in found.repartition(1).mapInArrow(_total, "fit double, sums binary").collect():
            return np.frombuffer(r["sums"], np.float32).reshape(theta.shape), r["fit"]
        return np.zeros_like(theta), 0.0

    seen, _ = sums(True)
    theta[0] = np.log(seen[0] + SMOOTH)     # start from the frequencies of classes and members
    step, before = STEP, -np.inf
    for _ in range(rounds):
        expected, fit = sums(False)
        step = step if fit >= before else step / 2
        before = fit
        theta = theta + step * (seen - expected) / (np.maximum(seen, expected) + SMOOTH)
    return {"keys": keyed, "known": known, "parts": parts, "tokens": size[0], "kinds": size[1], "units": units, "theta": theta,
            "rest": (mass, kinds), "discount": discount}


def _send(units: Units, known, parts: int, waits: bool):
    """A piece's messages to the parts, and its tokens if it waits for answers."""
    def run(batches):
        task, row = TaskContext.get().partitionId(), 0
        words, spread = known.value[0], _spread(known.value[1])
        spread[-1] = spread[-2]     # starts are counted where ends are
        for chunk in text_chunks(batches, limit=CHUNK):
            which, offs, hashes, unit = _coded(chunk, units, words)
            own = _spread(hashes)
            piece = Piece(which, offs, np.concatenate([spread, own]), len(words), parts)
            learned = chunk.column("learned").to_numpy(zero_copy_only=False)
            src = (task << 40) + row
            rows = [(p, 1, src, a, None) for p, a in piece.messages(learned, hashes, len(words))]
            if waits:
                ids = pa.RecordBatch.from_arrays([chunk.column("doc_id")], names=["doc_id"])
                kept = pickle.dumps((_packed(which, np.diff(offs), own, unit), ids.schema.serialize().to_pybytes(), ids.serialize().to_pybytes()))
                rows.append(((task * 31 + row) % parts, 2, src, kept, None))
            yield _row_batch(rows)
            row += 1
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", prior: tuple[float, float] = PRIOR,
          learned=None) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every row.
    ``learned``, a condition, may tell which rows of ``docs`` are the ones the
    model was trained on; they then bring its counts with them."""
    spark = docs.sparkSession
    units, discount, parts, known = model["units"], model["discount"], model["parts"], model["known"]
    mass, kinds = model["rest"]
    table = spark.sparkContext.broadcast(model["theta"])
    each = float(np.log10(model["tokens"] + model["kinds"] + 1))
    unseen = (discount * kinds + 1) / (kinds + 1)

    def finish(batches):
        words, spread = known.value[0], _spread(known.value[1])
        spread[-1] = spread[-2]
        end, numbered, got = len(words), units.of(words), []
        for batch in batches:
            for kind, a in zip(batch.column("kind"), batch.column("a")):
                if kind.as_py() == 1:
                    got += _unpacked(a.as_py())
                    continue
                packed, schema, ids = pickle.loads(a.as_py())
                which, lens, own, unit = _unpacked(packed)
                which, offs = which.astype(np.int64), np.concatenate([[0], np.cumsum(lens.astype(np.int64))])
                unit = np.concatenate([numbered, [0, 0], unit]).astype(np.int64)
                h, y, _ = units.sequences(unit[which], offs)
                histories, place = np.unique(h, return_inverse=True)
                order, lp = np.argsort(place, kind="stable"), np.zeros(len(y), np.float32)
                upto = np.searchsorted(place[order], np.arange(0, len(histories) + 4096, 4096))
                for k, (a, b) in enumerate(zip(upto[:-1], upto[1:])):    # the rows of the histories that occur
                    at = order[a:b]
                    lp[at] = log_probs(table.value, units, histories[4096 * k:4096 * (k + 1)])[place[at] - 4096 * k, y[at]]
                cls = np.where(unit >= units.first_rest, units.cls[unit], -1)     # -1: in the shortlist
                own = Piece(which, offs, np.concatenate([spread, own.astype(np.uint16)]), end, parts)
                n = np.empty(len(own.keys), np.float64)
                n[own.order], got = np.concatenate(got), []
                c = np.zeros(len(unit))
                c[own.words] = n[len(n) - len(own.words):]
                share = np.where(c > 0, np.maximum(c - discount, 1e-9), unseen[cls]) / (mass + 1)[cls]
                share[end] = 1.0
                p = np.exp(lp.astype(np.float64)) * np.where(cls < 0, 1.0, share)[own.y]
                one = c.copy()
                one[end + 1] = c[end]
                two = one - n[own.last]
                two[end + 1] += one[end + 1]
                for m, c_h, at in ((prior[1], two[own.two], own.skip), (prior[0], one[own.one], own.pair)):
                    p = (n[at] + m * p) / (c_h + m)
                size, seen = np.diff(own.offs), c[own.y]
                sums = row_sums(np.stack([seen > 0, np.log10(seen + 1), np.log10(p)], 1), own.offs)
                ids = pa.ipc.read_record_batch(pa.py_buffer(ids), pa.ipc.read_schema(pa.py_buffer(schema)))
                yield pa.RecordBatch.from_arrays([ids.column(0), pa.array(size), pa.array(sums[:, 0].astype(np.int64)),
                                                  pa.array(sums[:, 1] - size * each), pa.array(sums[:, 2])],
                                                 names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      (F.lit(False) if learned is None else F.coalesce(learned, F.lit(False))).alias("learned"))
    kind = dict(src.dtypes)["doc_id"]
    asked = src.mapInArrow(_send(units, known, parts, True), ROW)
    if learned is None:
        asked = asked.union(model["keys"].select("dest", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("src"), "a", "b"))
    met = asked.repartition(partitions(spark), "dest").sortWithinPartitions("dest", "kind", "src").mapInArrow(_answer(known), ROW)
    back = met.repartition(partitions(spark), "src").sortWithinPartitions("src", "kind", "dest")
    return back.mapInArrow(finish, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held = id_bucket(F.col("doc_id"), MODULUS) == HELD
    model = train(docs.where(~held))
    return score(docs, model, learned=~held).select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                                     F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
