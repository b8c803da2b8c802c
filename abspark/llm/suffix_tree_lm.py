"""Language-model scoring by a probabilistic suffix tree (PST).

Symbols are the bytes of the normalised text: its words (`[^\\x20\\x09-\\x0D]+`,
A-Z lower-cased), each closed by one space, and one end byte.  No token's bytes
begin another's, so a token has the product of its bytes' probabilities, and the
probabilities of all possible tokens after a history sum to at most one: an unseen
word costs what its spelling costs.  The tree's contexts are of variable length,
up to ``DEPTH`` bytes back into the text:

* counts of every context and next symbol, over all training texts;
* a context is a candidate when it occurs ``MIN_COUNT`` times, however large the
  corpus, so the tree grows with it;
* a candidate is retained when its next-symbol distribution diverges from its
  suffix's by at least ``MIN_GAIN`` nats over its occurrences;
* a retained context's distribution is smoothed with that of its longest retained
  suffix, weighted by the number of its next symbols (Witten and Bell), down to
  the root's add-one counts.

A symbol is scored in the longest retained suffix of what precedes it.  The score
is the log10 probability of the whole text.

Grams are dealt by the three bytes nearest to the symbol, in packed blocks, so a
subtree lies in one task, which counts, tests and emits only what is retained: one
shuffle.  Contexts of up to two bytes (at most 2**24 pairs) are tested on the
driver.  Scoring looks up the contexts of the largest counts, up to ``TREE_ROOM``
rows, in the tasks; a bit map of bounded size tells which grams may have a context
in the rest of the tree, and those are scored by a join.

The base score needs a count for every word, which grows with the corpus: the
``FREQUENT`` most frequent words (a bounded table) are looked up in the tasks,
all others by a join.  Words are keyed by a 64-bit hash.

Defined cases: null, empty and white-space-only texts are the end token alone;
a null doc_id counts as the text '' for the fold; with no training text every
count is zero and the tree is the uniform root; repeated rows have equal
results; very long texts are counted and scored like any other, their words a
batch at a time; ties do not occur (nothing is ranked); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abspark.llm.chunks import Chunks, ascii_words
from abspark.llm.common import bounded_batches, mix64, new_folder, staged, thrifty

FOLDS, FOLD = 7, 2
DEPTH = 6
MIN_COUNT = 256
MIN_GAIN = 8.0
TREE_ROOM = 3_000_000
FREQUENT = 1 << 18
TOP = 2  # contexts up to this length are tested on the driver
BUCKETS = 4096  # parts of the subtrees
BUCKET_GRAMS = 1_000_000  # counted grams of one subtree task, about
MAP_BITS = 1 << 26
END = 10  # no word holds a newline
BATCH_BYTES = 2 << 20
_MERGE = 2_000_000
_CONTEXT = 1 << 60  # marks a context's key; a key holds its length above 56 bits


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == FOLD


# -- symbols -----------------------------------------------------------------
def word_hashes(words: list[str]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words), np.uint64, len(words)).view(np.int64)


def symbols(cut: Chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, where each text begins, and where each token does (each with the end behind the last)."""
    raw = [w.encode() + b" " for w in cut.words] + [bytes([END])]
    pool = np.frombuffer(b"".join(raw), np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    # The token codes with an end token behind each text.
    code = np.insert(cut.codes, cut.starts[1:], len(raw) - 1)
    each = size[code]
    stops = np.cumsum(each)
    total = int(stops[-1]) if len(stops) else 0
    out = pool[np.repeat((np.cumsum(size) - size)[code] - (stops - each), each) + np.arange(total)]
    tokens = np.concatenate([[0], stops])
    return out, tokens[cut.starts + np.arange(len(cut.starts))], tokens


def grams(stream: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The ``DEPTH`` bytes before each symbol, nearest first, and the symbol in the lowest byte.

    END marks the text's begin, zeros what is before that.  A shorter context
    is a prefix of the number, so sorted grams are sorted at every length.
    """
    size = np.diff(begins)
    first = [begins[:-1][size > place] + place for place in range(DEPTH)]  # each text's first places
    out = stream.astype(np.uint64)
    for back in range(1, DEPTH + 1):
        byte = np.zeros(len(stream), np.uint64)
        byte[back:] = stream[:-back]
        for place in range(back):
            byte[first[place]] = END if place == back - 1 else 0
        out |= byte << np.uint64(8 * (DEPTH - back + 1))
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate(keys)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    return key[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(key) else np.zeros(0, np.int64)


class _Counts:
    """Counts by key of what was added; ``full`` when so many distinct keys are held that they should go out."""

    def __init__(self):
        self.keys, self.counts, self.held, self.full = [], [], 0, False

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > _MERGE:
            self.held = len(self.merge()[0])
            self.full = self.held > _MERGE // 2

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        key, count = _summed(self.keys, self.counts)
        self.keys, self.counts = [key], [count]
        return key, count

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merge()
        self.__init__()
        return out


def shorter(pair: np.ndarray) -> np.ndarray:
    """Pairs (context, symbol) without the context's oldest byte."""
    return (pair >> np.uint64(16) << np.uint64(8)) | (pair & np.uint64(255))


def packed(key: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted keys as their differences, in the fewest bytes that hold the largest, and counts likewise."""
    step = np.diff(key, prepend=np.uint64(0))
    parts = [np.array([len(key)], "<u8").tobytes()]
    for values in (step, n.astype(np.uint64)):
        width = max(1, (int(values.max()).bit_length() + 7) // 8)
        parts.append(bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())  # like bytes together
    return b"".join(parts)


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, at, out = int(np.frombuffer(block, "<u8", 1)[0]), 8, []
    for _ in range(2):
        width = block[at]
        raw = np.zeros((size, 8), np.uint8)
        raw[:, :width] = np.frombuffer(block, np.uint8, size * width, at + 1).reshape(width, size).T
        out.append(raw.reshape(-1).view("<u8"))
        at += 1 + size * width
    return np.cumsum(out[0], dtype=np.uint64), out[1].astype(np.int64)


WORDS, SHORT, GRAMS = 0, 1, 2


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n, block), summed per task: short pairs, and words (by hash) and grams in packed blocks (key: bucket, n: how many)."""
    bounded_batches(docs.sparkSession, size=BATCH_BYTES)
    names = ["kind", "key", "n", "block"]

    def block_rows(kind: int, key: np.ndarray, n: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(bucket, kind="stable")
        key, n, bucket = key[order], n[order], bucket[order]
        cut = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(key)]])
        for at in range(0, len(cut) - 1, 512):
            ends = list(zip(cut[at : at + 512], cut[at + 1 : at + 513], strict=False))
            blocks = [packed(key[a:b], n[a:b]) for a, b in ends]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ends), kind, np.int8)), pa.array([int(bucket[a]) for a, _ in ends], pa.int64()), pa.array([int(b - a) for a, b in ends], pa.int64()), pa.array(blocks, pa.binary())], names=names)

    def word_rows(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from block_rows(WORDS, key, n, (key % np.uint64(BUCKETS)).astype(np.int64))

    def gram_rows(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        short, c = _summed([(key >> np.uint64(8 * (DEPTH - TOP + 1)) << np.uint64(8)) | (key & np.uint64(255))], [n])
        for at in range(0, len(short), 100_000):
            part = short[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), SHORT, np.int8)), pa.array(part.view(np.int64)), pa.array(c[at : at + 100_000]), pa.nulls(len(part), pa.binary())], names=names)
        yield from block_rows(GRAMS, key, n, (mix64(key >> np.uint64(8 * (DEPTH - TOP))) % np.uint64(BUCKETS)).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Counts(), _Counts()
        for batch in thrifty(batches, 2):
            cut = ascii_words(batch.column(0))
            count = np.bincount(cut.codes, minlength=len(cut.words))
            words.add(word_hashes(cut.words)[count > 0].view(np.uint64), count[count > 0])
            seen.add(*np.unique(grams(*symbols(cut)[:2]), return_counts=True))
            if words.full:
                yield from word_rows(*words.taken())
            if seen.full:
                yield from gram_rows(*seen.taken())
        for rows, held in ((word_rows, words), (gram_rows, seen)):
            key, n = held.taken()
            if len(key):
                yield from rows(key, n)

    return docs.select("text").mapInArrow(run, "kind byte, key long, n long, block binary")


def by_bucket(parts: DataFrame, kind: int, make: Callable[[np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``make(keys, counts)`` of the summed blocks of every bucket; all of a bucket in one task, one bucket at a time."""
    blocks = parts.filter(F.col("kind") == kind)
    many = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dealt = blocks.select(F.col("key").alias("bucket"), "block").repartition(min(BUCKETS, 1 + many // BUCKET_GRAMS), "bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in thrifty(batches):
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != now and held:
                    yield make(*_summed(*zip(*held, strict=True)))
                    held = []
                now = bucket
                held.append(unpacked(block.as_py()))
        if held:
            yield make(*_summed(*zip(*held, strict=True)))

    return dealt.mapInArrow(run, schema)


def word_counts(parts: DataFrame) -> DataFrame:
    """(key, c) of every word."""
    rows = lambda key, n: pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "c"])
    return by_bucket(parts, WORDS, rows, "key long, c long")


# -- the tree ----------------------------------------------------------------
def _sums(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of sorted pairs, where each begins, and its count."""
    ctx = pair >> np.uint64(8)
    first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
    return ctx[first], first, np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Level:
    """All pairs of one context length, sorted, with their counts and smoothed probabilities."""

    pair: np.ndarray
    n: np.ndarray
    p: np.ndarray


def retained(k: int, pair: np.ndarray, n: np.ndarray, up: Level, least: int, gain: float) -> tuple[Level, tuple[np.ndarray, ...]]:
    """The level of the pairs of length ``k``, and (keys, values, counts) of its retained contexts and their pairs.

    ``up`` is the level one byte shorter.  A context's value is the weight of
    falling to its suffix, a pair's the smoothed probability.  The pairs of
    contexts that are not retained have their suffix's probability.
    """
    ctx, first, c = _sums(pair, n)
    size = np.diff(np.append(first, len(pair)))
    up_ctx, _, up_c = _sums(up.pair, up.n)
    suffix = _find(up.pair, shorter(pair) if k > 1 else pair & np.uint64(255))[0]
    uc = np.repeat(up_c[_find(up_ctx, ctx >> np.uint64(8))[0]], size)
    each, d = np.repeat(c, size), np.repeat(size, size)
    diverged = np.add.reduceat(n * np.log(n * (uc / up.n[suffix]) / each), first) if len(first) else np.zeros(0)
    keep = (c >= least) & (diverged >= gain) & (ctx & np.uint64(255) != 0)  # no contexts from before the text
    on = np.repeat(keep, size)
    p = np.where(on, (n + d * up.p[suffix]) / (each + d), up.p[suffix])
    mark = np.uint64(k << 56)
    keys = np.concatenate([ctx[keep] | mark | np.uint64(_CONTEXT), pair[on] | mark])
    return Level(pair, n, p), (keys, np.concatenate([(size / (c + size))[keep], p[on]]), np.concatenate([c[keep], each[on]]))


def subtree_states(parts: DataFrame, short: Level, least: int = MIN_COUNT, gain: float = MIN_GAIN) -> DataFrame:
    """(key, v, c) of the retained contexts longer than ``TOP`` and their pairs, a subtree in one task."""
    def states(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        counted = {DEPTH: (pair, n)}
        for k in range(DEPTH, TOP + 1, -1):
            counted[k - 1] = _summed([shorter(counted[k][0])], [counted[k][1]])
        level, found = short, []
        for k in range(TOP + 1, DEPTH + 1):
            level, kept = retained(k, *counted[k], level, least, gain)
            found.append(kept)
        key, v, c = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(v.astype(np.float32)), pa.array(c)], names=["key", "v", "c"])

    return by_bucket(parts, GRAMS, states, "key long, v float, c long")


@dataclass
class SuffixTree:
    root: np.ndarray  # probability of each byte
    levels: dict[int, tuple[np.ndarray, ...]]  # of each length: contexts (sorted), their values, pairs (sorted), theirs
    bits: np.ndarray | None = None  # bit map of the contexts in the rest of the tree

    @classmethod
    def of(cls, root: np.ndarray, keys: np.ndarray, values: np.ndarray) -> SuffixTree:
        order = np.argsort(keys)
        keys, values = keys[order], values[order].astype(np.float32)
        at = np.searchsorted(keys, np.array([f | k << 56 for f in (0, _CONTEXT) for k in range(1, DEPTH + 2)], np.uint64))
        part = lambda f, k: slice(at[f * (DEPTH + 1) + k - 1], at[f * (DEPTH + 1) + k])
        return cls(root, {k: (keys[part(1, k)], values[part(1, k)], keys[part(0, k)], values[part(0, k)]) for k in range(1, DEPTH + 1)})

    @property
    def contexts(self) -> int:
        return sum(len(level[0]) for level in self.levels.values())

    def open(self, gram: np.ndarray) -> np.ndarray:
        """The lengths at which the rest of the tree may hold a context of each gram, one bit a length."""
        out = np.zeros(len(gram), np.int64)
        if self.bits is not None:
            for k in range(TOP + 1, DEPTH + 1):
                out |= _bit(self.bits, context_key(gram, k)).astype(np.int64) << k
        return out

    def score(self, gram: np.ndarray, more: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """log10 probability of each gram's symbol after its context (quickest for sorted grams).

        From the longest context down: where the symbol was seen, its smoothed
        probability ends the search, else the weight of falling is paid.
        ``more``: of a length, each gram's context and pair values in the rest (NaN: none).
        """
        out, todo = np.ones(len(gram)), np.arange(len(gram))
        for k in range(DEPTH, 0, -1):
            contexts, falls, pairs, owns = self.levels[k]
            ctx = context_key(gram[todo], k)
            first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
            at, hit = _find(contexts, ctx[first])  # each run of one context once
            size = np.diff(np.append(first, len(ctx)))
            fall, own = np.full(len(todo), np.nan), np.full(len(todo), np.nan)
            on = np.flatnonzero(np.repeat(hit, size))
            if len(on):
                fall[on] = np.repeat(falls[at[hit]], size[hit])
                where, has = _find(pairs, pair_key(gram[todo[on]], k))
                own[on[has]] = owns[where[has]]
            if more and k in more:
                there = ~np.isnan(more[k][0][todo])
                fall[there], own[there] = more[k][0][todo[there]], more[k][1][todo[there]]
            seen = ~np.isnan(own)
            out[todo] *= np.where(seen, own, np.where(np.isnan(fall), 1.0, fall))
            todo = todo[~seen]
        out[todo] *= self.root[(gram[todo] & np.uint64(255)).astype(np.int64)]
        return np.log10(out)


def context_key(gram: np.ndarray, k: int) -> np.ndarray:
    return gram >> np.uint64(8 * (DEPTH - k + 1)) | np.uint64(_CONTEXT | k << 56)


def pair_key(gram: np.ndarray, k: int) -> np.ndarray:
    return (gram >> np.uint64(8 * (DEPTH - k + 1)) << np.uint64(8)) | (gram & np.uint64(255)) | np.uint64(k << 56)


def _bit(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = mix64(key) % np.uint64(32 * len(bits))
    return bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1) > 0


def bit_map(rest: DataFrame) -> np.ndarray:
    """The contexts of ``rest`` in ``MAP_BITS`` bits, joined on Spark; a fixed size, however many there are."""
    size = MAP_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(mix64(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(size)).astype(np.int64)
            word, where = np.unique(at >> 5, return_inverse=True)
            bits = np.zeros(len(word), np.int64)
            np.bitwise_or.at(bits, where, 1 << (at & 31))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits)], names=["word", "bits"])

    found = rest.filter(F.col("key") >= _CONTEXT).select("key").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 32, np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def grown(spark: SparkSession, parts: DataFrame, folder: str, least: int = MIN_COUNT, gain: float = MIN_GAIN, room: int | None = None) -> tuple[SuffixTree, DataFrame | None]:
    """The tree's most frequent contexts with about ``room`` rows (None: all), and the rest as a table (key, v)."""
    # At most 2**24 pairs of two bytes and a symbol.
    top = parts.filter(F.col("kind") == SHORT).groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toArrow()
    pair, n = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy().astype(np.int64)
    one = _summed([shorter(pair)], [n]) if len(pair) else (pair, n)
    by_byte = np.bincount((pair & np.uint64(255)).astype(np.int64), weights=n, minlength=256)
    root = (by_byte + 1) / (by_byte.sum() + 256)
    if not len(pair):
        return SuffixTree.of(root, np.zeros(0, np.uint64), np.zeros(0)), None
    seen = np.flatnonzero(by_byte)
    level, first = retained(1, *one, Level(seen.astype(np.uint64), by_byte[seen].astype(np.int64), root[seen]), least, gain)
    level, second = retained(2, pair, n, level, least, gain)
    found = [first, second]
    states = staged(subtree_states(parts, level, least, gain), "states", folder)
    floor = 0
    if room is not None:
        # A context and its pairs share its count, so whole contexts are cut off, in steps of a 32nd of an octave.
        bands = sorted(((r.band, r["count"], r.least) for r in states.groupBy(F.floor(F.log2("c") * 32).alias("band")).agg(F.count("*").alias("count"), F.min("c").alias("least")).collect()), reverse=True)
        floor, left = 1 << 62, room
        for _, many, lowest in bands:
            if many > left:
                break
            floor, left = lowest, left - many
    near = states.filter(F.col("c") >= floor).select("key", "v").toArrow()
    keys = np.concatenate([*(x[0] for x in found), near["key"].to_numpy().view(np.uint64)])
    tree = SuffixTree.of(root, keys, np.concatenate([*(x[1] for x in found), near["v"].to_numpy()]))
    rest = states.filter(F.col("c") < floor).select("key", "v")
    if rest.isEmpty():
        return tree, None
    tree.bits = bit_map(rest)
    return tree, rest


def looked_up(need: DataFrame, rest: DataFrame, tree) -> DataFrame:
    """(gram, logp) of distinct grams (gram, at), ``at`` the lengths of contexts they may have in ``rest``; ``tree`` is the broadcast part."""
    probe = []
    for k in range(TOP + 1, DEPTH + 1):
        context = F.shiftrightunsigned("gram", 8 * (DEPTH - k + 1))
        pair = F.shiftleft(context, 8).bitwiseOR(F.col("gram").bitwiseAND(255))
        for is_context, key in ((True, context.bitwiseOR(F.lit(_CONTEXT | k << 56))), (False, pair.bitwiseOR(F.lit(k << 56)))):
            probe.append(F.struct(F.lit(k).alias("k"), F.lit(1 << k).cast("long").alias("bit"), F.lit(is_context).alias("context"), key.alias("key")))
    asked = F.filter(F.array(*probe), lambda x: F.col("at").bitwiseAND(x["bit"]) != 0)
    hits = need.select("gram", F.explode(asked).alias("p")).select("gram", "p.*").join(rest, "key")
    of = lambda k, c: F.max(F.when((F.col("k") == k) & (F.col("context") == c), F.col("v")))
    lengths = range(TOP + 1, DEPTH + 1)
    hits = hits.groupBy("gram").agg(*(of(k, c).alias(f"{'f' if c else 'a'}{k}") for k in lengths for c in (True, False)))
    met = need.join(hits, "gram", "left").select("gram", *(f"{x}{k}" for k in lengths for x in "fa"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(0).to_numpy().view(np.uint64)
            more = {}
            for i, k in enumerate(lengths):
                more[k] = tuple(batch.column(1 + 2 * i + j).to_numpy(zero_copy_only=False).astype(np.float64) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tree.value[2].score(gram, more))], names=["gram", "logp"])

    return met.mapInArrow(run, "gram long, logp double")


# -- scoring -----------------------------------------------------------------
def _lists(size: np.ndarray, fields: dict[str, np.ndarray]) -> pa.ListArray:
    items = pa.StructArray.from_arrays([pa.array(x) for x in fields.values()], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), items)


def _per_text(of: np.ndarray, code: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of each text with their number: (how many a text has, code, times)."""
    if not len(of):
        return np.zeros(n_texts, np.int64), code[:0], code[:0]
    most = int(code.max()) + 1
    pair, times = np.unique(of * most + code, return_counts=True)
    return np.bincount(pair // most, minlength=n_texts), pair % most, times


def score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``, learned from ``train``."""
    spark = docs.sparkSession
    bounded_batches(spark, size=BATCH_BYTES)
    folder = new_folder(spark, "lm")
    parts = staged(train.select("text").transform(corpus_counts), "parts", folder)
    words = staged(word_counts(parts), "words", folder)
    tree, rest = grown(spark, parts, folder, room=TREE_ROOM)
    texts = train.count()
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens_, types = n + texts, v + (texts > 0)
    # The most frequent words that a bounded table holds, cut at a power of two of the count.
    bands = sorted(((r.band, r["count"]) for r in words.groupBy(F.floor(F.log2("c")).alias("band")).count().collect()), reverse=True)
    floor, room = None, FREQUENT
    for band, many in bands:
        if many > room:
            break
        floor, room = 2**band, room - many
    table = words.filter(F.col("c") >= (floor or 0)).toArrow() if floor else words.limit(0).toArrow()
    keys, count = table["key"].to_numpy(), table["c"].to_numpy()
    order = np.argsort(keys)
    sent = spark.sparkContext.broadcast((keys[order], count[order], tree))
    base = lambda c: np.log10((c + 1.0) / (tokens_ + types + 1.0))
    end_score, end_known = float(base(texts)), int(texts > 0)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n_tokens long, known long, base double, score double, rare array<struct<key:long,m:long>>, open array<struct<gram:long,at:long,m:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, counted, tree = sent.value
        made = TaskContext.get().partitionId() << 33
        for batch in thrifty(batches, 2):
            cut = ascii_words(batch.column(1))
            n_texts = len(cut.starts) - 1
            stream, begins, _ = symbols(cut)
            gram, at = np.unique(grams(stream, begins), return_inverse=True)
            lengths = tree.open(gram)
            more = lengths > 0
            logp = np.concatenate([[0.0], np.cumsum(np.where(more, 0.0, tree.score(gram))[at])])
            later = np.flatnonzero(more[at]) if more.any() else at[:0]  # symbols for the rest of the tree
            n_open, open_gram, open_times = _per_text(np.searchsorted(begins, later, "right") - 1, at[later], n_texts)
            key = word_hashes(cut.words)
            where, hit = _find(top, key)
            own = np.where(hit, counted[where], 0) if len(top) else np.zeros(len(key), np.int64)
            text, code = cut.texts, cut.codes
            seen = hit[code]
            known = np.bincount(text[seen], minlength=n_texts) + end_known
            shares = np.bincount(text[seen], weights=base(own[code[seen]]), minlength=n_texts) + end_score
            n_rare, rare, times = _per_text(text[~seen], code[~seen], n_texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made + np.arange(n_texts)), batch.column(0), pa.array(np.diff(cut.starts) + 1), pa.array(known), pa.array(shares.astype(float)),
                 pa.array(np.diff(logp[begins])), _lists(n_rare, {"key": key[rare], "m": times}), _lists(n_open, {"gram": gram[open_gram].view(np.int64), "at": lengths[open_gram], "m": open_times})],
                names=["row", "doc_id", "n_tokens", "known", "base", "score", "rare", "open"],
            )
            made += n_texts

    rows = staged(docs.select("doc_id", "text").mapInArrow(run, schema), "rows", folder)
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(words, "key", "left")
    share = F.log10((F.coalesce("c", F.lit(0)) + 1.0) / (tokens_ + types + 1.0))
    more = rare.groupBy("row").agg(F.sum(F.col("m") * share).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("m"))).alias("found"))
    out = rows.drop("rare", "open").join(more, "row", "left").withColumn("gain", F.lit(0.0))
    if rest is not None:
        opened = rows.select("row", F.explode("open").alias("o")).select("row", "o.*")
        full = staged(looked_up(opened.select("gram", "at").distinct(), rest, sent), "full", folder)
        gains = opened.join(full, "gram").groupBy("row").agg(F.sum(F.col("m") * F.col("logp")).alias("gain"))
        out = out.drop("gain").join(gains, "row", "left")
    nothing = F.lit(0.0)
    return out.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(tokens_).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more", nothing)).alias("base_score"), (F.col("score") + F.coalesce("gain", nothing)).alias("score"))


def op10_suffix_tree(docs: DataFrame) -> DataFrame:
    rows = score(docs, docs.filter(~held_out(F.col("doc_id"))))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
