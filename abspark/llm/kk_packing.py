"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents become token ids and are cut at the capacity: every full stretch is
a sequence of its own, the rest of the document is an item.  Items gather
until they fill ``WINDOWS`` sequences but for a small slack, the last 15 % of
them cut into short items that even out the rest; then the multiway differencing method
splits them into that many windows of near-equal size: each item starts as a
partial partition with one filled window, and the two partitions of largest
spread are merged, the fullest window of one with the emptiest of the other,
until one partition is left.  When its fullest window exceeds the capacity,
the window count rises by one and the differencing is done again.  A
partition's last group is packed alike; tokens beyond its whole windows fill
sequences of a power of two.

Each partition of the input is packed on its own as it streams by, so nothing
is shuffled, a hot key does not matter, and a task holds the ids of one
group and of one batch of documents.  A lost task is redone
alone: its sequence ids are its partition number and a counter.

A sequence is padded to the capacity unless its length is a power of two
(``padded_length``).

Defined cases: null text is the empty text, whose only id is the end id; a
text of any length is cut at the capacity; ties in the differencing go to the
earlier partition; repeated rows are packed one by one; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from abspark.llm.common import bounded_batches, thrifty
from abspark.llm.word_ids import word_ids

CAPACITY = 4096
END_ID = 2
WINDOWS = 256
#: Share of a group's tokens left free, share cut into short items, and their length.
SLACK, FINE_SHARE, FINE = 0.002, 0.15, 64
#: Shortest sequence made of a partition's last tokens (unless they fill no window at all).
LEAST_POWER = 64


def padded_length(length: int, capacity: int = CAPACITY) -> int:
    return length if length & (length - 1) == 0 else capacity


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window number of every item after multiway differencing into ``windows`` windows."""
    n = len(sizes)
    left, right = [], []  # inner nodes of the merge trees, numbered from n
    # A partial partition: sums in falling order and the tree that fills each window; missing windows are empty.
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i], np.int64)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, a, own_a = heapq.heappop(heap)
        _, _, b, own_b = heapq.heappop(heap)
        both = len(a) + len(b) - windows
        if both <= 0:
            sums, own = np.concatenate([a, b]), np.concatenate([own_a, own_b])
        else:
            # The emptiest of a (its last) meet the fullest of b, and the other way round.
            meet_a, meet_b = a[len(a) - both :], b[len(b) - both :][::-1]
            fresh = np.arange(n + len(left), n + len(left) + both)
            left.extend(own_a[len(a) - both :].tolist())
            right.extend(own_b[len(b) - both :][::-1].tolist())
            sums = np.concatenate([a[: len(a) - both], meet_a + meet_b, b[: len(b) - both]])
            own = np.concatenate([own_a[: len(a) - both], fresh, own_b[: len(b) - both]])
        order = np.argsort(-sums, kind="stable")
        sums, own = sums[order], own[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        heapq.heappush(heap, (-spread, turn, sums, own))
        turn += 1
    label = np.zeros(n + len(left), np.int64)
    if n:
        label[heap[0][3]] = np.arange(len(heap[0][3]))
    for i in range(len(left) - 1, -1, -1):
        label[left[i]] = label[right[i]] = label[n + i]
    return label[:n]


def windows_of(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window numbers, as few windows as the differencing fits within the capacity."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        label = differencing(sizes, count)
        if np.bincount(label, weights=sizes, minlength=1).max(initial=0) <= capacity:
            return label
        count += 1


def _cut(item: tuple, tokens: int) -> tuple[tuple, tuple]:
    doc, at, raw, total = item
    return (doc, at, raw[: 4 * tokens], total), (doc, at + tokens, raw[4 * tokens :], total)


def sequences(items: list[tuple], capacity: int = CAPACITY) -> Iterator[tuple[tuple, int]]:
    """(piece, window number) of all ``items`` (document, start, ids, tokens of the document)."""
    size = lambda item: len(item[2]) // 4
    total, usual = sum(map(size, items)), capacity * (1 - SLACK)
    count = int(total / usual + 1e-9)
    main = total if abs(total - count * usual) < 1 else int(count * usual)
    over = total - main
    # What is over whole windows fills sequences of a power of two, which need no padding; the last few tokens go to the windows.
    powers = [1 << b for b in range(over.bit_length() - 1, -1, -1) if over >> b & 1 and (count == 0 or 1 << b >= LEAST_POWER)]
    main = total - sum(powers)
    whole, fine = int(main * (1 - FINE_SHARE)), max(1, min(FINE, capacity))
    left, parts, done = list(reversed(items)), [], 0
    while done < main:
        item = left.pop()
        most = min(main - done, size(item) if done < whole else fine)
        if size(item) > most:
            item, rest = _cut(item, most)
            left.append(rest)
        parts.append(item)
        done += size(item)
    first = 0
    if parts:
        label = windows_of(np.array([size(x) for x in parts], np.int64), capacity)
        for at in np.argsort(label, kind="stable").tolist():
            yield parts[at], int(label[at])
        first = int(label.max()) + 1
    for n, power in enumerate(powers):
        while power:
            item = left.pop()
            if size(item) > power:
                item, rest = _cut(item, power)
                left.append(rest)
            power -= size(item)
            yield item, first + n


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, windows: int = WINDOWS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(c, T.LongType()) for c in longs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 33
        used, items, waiting = 0, [], 0  # items: (document, start, ids, tokens of the document)
        target = max(1, int(windows * capacity * (1 - SLACK)))

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True))
            ids = pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array([x]) for x in columns[0]])
            return pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in columns[1:]]], names=["doc_id", *longs])

        def packed() -> pa.RecordBatch:
            nonlocal used, items, waiting
            filled, pieces = [], []
            for piece, w in sequences(items, capacity):
                while w >= len(filled):
                    filled.append(0)
                doc, at, raw, total = piece
                pieces.append((doc, at, len(raw) // 4, zlib.crc32(raw), total, first + used + w, filled[w]))
                filled[w] += len(raw) // 4
            used, items, waiting = used + len(filled), [], 0
            return rows(pieces)

        for batch in thrifty(batches):
            ids = batch.column(0)
            full = []
            flat, begin = words.encode(batch.column(1))
            for i in range(len(ids)):
                encoded = flat[begin[i] : begin[i + 1]].tobytes() + end
                total = len(encoded) // 4
                doc = ids.slice(i, 1)
                at = 0
                while total - at >= capacity:
                    crc = zlib.crc32(memoryview(encoded)[4 * at : 4 * (at + capacity)])
                    full.append((doc, at, capacity, crc, total, first + used, 0))
                    used += 1
                    at += capacity
                while at < total:
                    size = min(total - at, target - waiting)
                    items.append((doc, at, encoded[4 * at : 4 * (at + size)], total))
                    waiting, at = waiting + size, at + size
                    if waiting >= target:
                        yield packed()
            if full:
                yield rows(full)
        if items:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op4_kk_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
