"""Byte-level BPE encoding in length-bucketed padded matrices, and decoding.

A text is split by the vocabulary's public pattern.  The distinct pieces of a
batch that are no token of their own are dealt by length into padded matrices
of token ids, one row a piece.  Every round each row merges its leftmost pair of
least rank: ranks of adjacent pairs come from a hash table (open addressing in
numpy arrays), the matrices lose one column a round, and rows without a pair
left are taken out (compaction).  A pair's rank is that of the bytes it makes.

Long pieces (a text without white space is one piece) are first cut between two
bytes that no token holds side by side, where no merge can ever reach across;
what is still longer than ``LONG`` bytes merges by the same rule from a heap of
(rank, place), so its cost is n log n, not n^2.

Defined cases: a null text is the empty text and has no ids; decoding gives
back every text's bytes exactly; very long texts are split a block at a time;
equal texts (repeated rows) have equal ids; rows with a null key stay; an empty
table gives an empty table; other columns are not read.  Special tokens do not
exist: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abspark.llm.common import bounded_batches, process_memo, thrifty

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BATCH_ROWS = 400
MEMO_PIECES = 200_000
MEMO_IDS = 2_000_000
SPLIT_CHARS = 1 << 20  # characters of a text that are split at once
FLUSH_PIECES = 1 << 19  # pieces encoded at once
MATRIX = 1 << 21  # entries of one padded matrix
CUT = 64  # pieces of more bytes are looked through for cuts
LONG = 1024  # and beyond this merge from a heap
NONE = np.int32(2**31 - 1)

# Letters and numbers of Unicode versions after the one that the tiktoken library knows; to it they are
# neither.  The `regex` module knows them, so texts that hold one are split by a pattern without them.
LATER = """
    0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
    10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
    16FF2-16FF3 16FF4-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168
    1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
    1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_EMPTY = np.uint64(2**64 - 1)


class PairTable:
    """(left id, right id) -> rank, open addressing with linear probing; at most half full."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(2 * len(rank)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, _EMPTY), np.full(1 << bits, NONE, np.int32)
        key = self._key(left, right)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == _EMPTY]
            at, first = np.unique(slot[free], return_index=True)
            self.keys[at], self.ranks[at] = key[free[first]], rank[free[first]]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is none (padding is -1 and pairs with nothing)."""
        key = self._key(left, right)
        slot = self._slot(key)
        held = self.keys[slot]
        rank = np.where(held == key, self.ranks[slot], NONE)
        todo = np.flatnonzero((held != key) & (held != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            rank[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (held != _EMPTY)]
        rank[(left < 0) | (right < 0)] = NONE
        return rank


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[i] .. starts[i] + sizes[i] - 1 of every i, one after another."""
    stop = np.cumsum(sizes)
    return np.repeat(starts - (stop - sizes), sizes) + np.arange(int(stop[-1]) if len(stop) else 0)


def splitters() -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
    """The public pattern; what tells that a text needs the other one; the pattern without later letters and numbers."""
    later = "".join("-".join(f"\\U{int(end, 16):08X}" for end in span.split("-")) for span in LATER.split())
    pattern = public_tokenizers.PATTERN
    other = r"[^\s\p{L}\p{N}]"
    strict = pattern.replace(other, f"[{other}||[{later}]]").replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{later}]]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{later}]]+")
    return regex.compile(pattern), regex.compile(f"[{later}]"), regex.compile(strict, regex.V1)


class ByteBpe:
    def __init__(self, path: str | None = None):
        with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split, self.later, self.strict = splitters()
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, beside = [], np.zeros((256, 256), bool)
        for token, rank in self.ranks.items():
            for at in range(1, len(token)):
                beside[token[at - 1], token[at]] = True
                left, right = self.ranks.get(token[:at]), self.ranks.get(token[at:])
                if left is not None and right is not None:
                    pairs.append((left, right, rank))
        self.beside = beside
        self.table = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.token_size = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.token_at = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.at, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    # ---- merging ---------------------------------------------------------
    def merge_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the rows of a padded matrix to the end: (merged ids padded with -1, ids of each row)."""
        out, row = np.full(ids.shape, -1, np.int32), np.arange(len(ids))
        rank = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while len(row):
            place = rank.argmin(axis=1)  # the leftmost of the least
            best = rank[np.arange(len(row)), place]
            done = best == NONE
            if done.any():
                out[row[done], : ids.shape[1]] = ids[done]
                row, ids, rank, place, best = row[~done], ids[~done], rank[~done], place[~done], best[~done]
                if not len(row):
                    break
            here, column = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            ids = np.where(column > place[:, None], ids[:, 1:], ids[:, :-1])
            ids[here, place] = best
            rank = np.where(column[:-1] > place[:, None], rank[:, 1:], rank[:, :-1])
            on = np.flatnonzero(place > 0)
            rank[on, place[on] - 1] = self.table.find(ids[on, place[on] - 1], ids[on, place[on]])
            on = np.flatnonzero(place < rank.shape[1])
            rank[on, place[on]] = self.table.find(ids[on, place[on]], ids[on, place[on] + 1])
            if not rank.shape[1]:
                out[row, : ids.shape[1]] = ids
                break
        return out, (out >= 0).sum(axis=1)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same rule for one long piece: the heap gives the leftmost pair of least rank."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self.table.find(ids[:-1], ids[1:])
        on = np.flatnonzero(ranks != NONE)
        heap = list(zip(ranks[on].tolist(), on.tolist(), strict=True))
        heapq.heapify(heap)
        ids, n = ids.tolist(), len(ids)
        pair = ranks.tolist() + [int(NONE)]  # the rank of each living place with the next one
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        token = self.tokens
        def ranked(a: int, b: int) -> int:
            return self.ranks.get(token[ids[a]] + token[ids[b]], int(NONE)) if a >= 0 and b < n else int(NONE)

        while heap:
            rank, at = heapq.heappop(heap)
            if pair[at] != rank:
                continue  # one of the two has gone into another token
            gone = after[at]
            ids[at], ids[gone], pair[gone] = rank, -1, int(NONE)
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            pair[at] = ranked(at, after[at])
            if pair[at] != NONE:
                heapq.heappush(heap, (pair[at], at))
            if before[at] >= 0:
                pair[before[at]] = ranked(before[at], at)
                if pair[before[at]] != NONE:
                    heapq.heappush(heap, (pair[before[at]], before[at]))
        return np.array([i for i in ids if i >= 0], np.int32)

    def cuts(self, piece: bytes) -> list[bytes]:
        """``piece`` cut wherever no token holds the two bytes side by side."""
        raw = np.frombuffer(piece, np.uint8)
        at = [0, *(np.flatnonzero(~self.beside[raw[:-1], raw[1:]]) + 1).tolist(), len(piece)]
        return [piece[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of ids of each piece)."""
        parts, owner, found = [], [], {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:  # a whole token needs no merge
                parts.append(rank)
                owner.append(i)
                continue
            for part in self.cuts(piece) if len(piece) > CUT else (piece,):
                parts.append(part)
                owner.append(i)
        size = np.fromiter((1 if isinstance(p, int) else len(p) for p in parts), np.int64, len(parts))
        whole = np.fromiter((isinstance(p, int) for p in parts), bool, len(parts))
        values: list[np.ndarray] = [np.array([p for p in parts if isinstance(p, int)], np.int32)]
        counts, order = [np.ones(int(whole.sum()), np.int64)], [np.flatnonzero(whole)]
        rest = np.flatnonzero(~whole)
        for i in rest[size[rest] > LONG].tolist():
            if parts[i] not in found:
                found[parts[i]] = self.merge_long(parts[i])
            values.append(found[parts[i]])
            counts.append(np.array([len(values[-1])]))
            order.append(np.array([i]))
        rest = rest[size[rest] <= LONG]
        width = 1
        while width // 2 < LONG:
            bucket = rest[(size[rest] > width // 2) & (size[rest] <= width)]
            for at in range(0, len(bucket), max(1, MATRIX // width)):
                rows = bucket[at : at + max(1, MATRIX // width)]
                raw = self.byte_ids[np.frombuffer(b"".join([parts[i] for i in rows.tolist()]), np.uint8)]
                there = np.arange(width) < size[rows][:, None]
                ids = np.full(there.shape, -1, np.int32)
                ids[there] = raw
                if width > 1:
                    ids, n = self.merge_rows(ids)
                else:
                    n = np.ones(len(rows), np.int64)
                values.append(ids[ids >= 0])
                counts.append(n)
                order.append(rows)
            width *= 2
        flat, count, part = np.concatenate(values), np.concatenate(counts), np.concatenate(order)
        back = np.argsort(part, kind="stable")
        ids = flat[spread((np.cumsum(count) - count)[back], count[back])]
        return ids, np.bincount(np.array(owner, np.int64), count[back], len(pieces)).astype(np.int64)

    # ---- texts -----------------------------------------------------------
    def pieces_of(self, text: str) -> Iterator[list[str]]:
        """The pattern's matches in order, a block at a time; the last two of a block may go on behind it."""
        at, block = 0, SPLIT_CHARS
        split = self.split if text.isascii() or not self.later.search(text) else self.strict
        while at < len(text):
            if len(text) - at <= block:
                yield split.findall(text, at)
                return
            found = split.findall(text, at, at + block)[:-2]
            if found:
                at += sum(map(len, found))
                yield found
                block = SPLIT_CHARS
            else:
                block *= 2

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        fresh = list(set(pieces).difference(self.memo))
        if fresh:
            ids, count = self.encode_pieces([p.encode("utf-8") for p in fresh])
            self.memo.update(zip(fresh, range(len(self.memo), len(self.memo) + len(fresh)), strict=True))
            self.at = np.concatenate([self.at, np.cumsum(count) - count + len(self.ids)])
            self.size, self.ids = np.concatenate([self.size, count]), np.concatenate([self.ids, ids])
        code = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        got = self.ids[spread(self.at[code], self.size[code])], self.size[code]
        if len(self.memo) > MEMO_PIECES or len(self.ids) > MEMO_IDS:
            self._forget()
        return got

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        count, flat = np.zeros(len(texts), np.int64), []
        held: list[str] = []
        owner: list[tuple[int, int]] = []

        def flush() -> None:
            ids, size = self._ids(held)
            flat.append(ids)
            who, n = np.array(owner, np.int64).reshape(-1, 2).T
            np.add.at(count, np.repeat(who, n), size)
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for pieces in self.pieces_of(text or ""):
                held.extend(pieces)
                owner.append((i, len(pieces)))
                if len(held) >= FLUSH_PIECES:
                    flush()
        flush()
        return np.concatenate(flat), count

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[spread(self.token_at[ids], self.token_size[ids])].tobytes()


def _bpe(path: str | None) -> ByteBpe:
    return process_memo(("byte_bpe", path), lambda: ByteBpe(path))


def encode(docs: DataFrame, vocabulary: str | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, ids binary): every text's ids as little-endian unsigned 32-bit integers, the form training shards keep.

    With ``decoded`` the ids are decoded in the same task, into a binary column ``bytes``.
    """
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.BinaryType())])
    if decoded:
        schema = schema.add("bytes", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary)
        for batch in thrifty(batches):
            ids, count = bpe.encode(batch.column(1).to_pylist())
            lists = np.split(ids, np.cumsum(count)[:-1]) if len(count) else []
            columns = [batch.column(0), pa.array([x.astype("<u4").tobytes() for x in lists], pa.binary())]
            if decoded:
                columns.append(pa.array([bpe.decode(x) for x in lists], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Adds binary column ``bytes``: what the ids of each row stand for (null ids: null)."""

    @F.arrow_udf("binary")
    def bytes_of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _bpe(vocabulary)
        for column in columns:
            yield pa.array([None if x is None else bpe.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in column.to_pylist()], pa.binary())

    return encoded.withColumn("bytes", bytes_of("ids"))


def op13_byte_bpe(docs: DataFrame) -> DataFrame:
    out = encode(docs, decoded=True)
    return out.select(
        "doc_id",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
