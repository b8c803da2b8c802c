"""The piece lattice of a fixed public vocabulary, for many words at a time.

No piece holds a newline, and none a space behind another character, so the
lattice of a text falls apart before each run of spaces and around each
newline.  A text's segmentations are thus the product of its chunks' ones, and
a chunk's lattice is built once however often it occurs.

Nodes are the positions of a word, edges its pieces; a character that is no
piece is one edge for its UTF-8 byte pieces (byte fallback).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _symbols(points: np.ndarray) -> np.ndarray:
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _small(x: np.ndarray) -> np.ndarray:
    """Short integers sort by radix."""
    return x.astype(np.int16) if len(x) and np.abs(x).max() < 1 << 15 else x


@dataclass
class Edges:
    """Edges sorted by end node; ``nodes[w]`` is word w's first node, the last entry is the node count."""

    nodes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    depth: np.ndarray  # the end's position in its word
    piece: np.ndarray  # a piece id, or -1 - code point for byte fallback
    size: np.ndarray  # characters

    def forward(self, logw: np.ndarray) -> np.ndarray:
        """Log sum over all segmentations from the word's begin to each node; logw (edges, models)."""
        alpha = np.full((int(self.nodes[-1]), logw.shape[1]), -np.inf)
        alpha[self.nodes[:-1]] = 0.0
        order = np.argsort(_small(self.depth), kind="stable")  # by position, then by end node
        self._sweep(alpha, order, self.depth[order], self.start[order], self.end[order], logw[order])
        return alpha

    def backward(self, logw: np.ndarray) -> np.ndarray:
        """Log sum over all segmentations from each node to the word's end."""
        beta = np.full((int(self.nodes[-1]), logw.shape[1]), -np.inf)
        beta[self.nodes[1:] - 1] = 0.0
        at = self.depth - self.size
        order = np.argsort(self.start, kind="stable")
        order = order[np.argsort(_small(-at[order]), kind="stable")]  # by falling position, then by start node
        self._sweep(beta, order, at[order], self.end[order], self.start[order], logw[order])
        return beta

    @staticmethod
    def _sweep(sums, order, level, source, target, logw) -> None:
        if not len(order):
            return
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(order)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            to = target[a:b]
            first = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1])
            # A level's sums only use nodes of finished levels.
            sums[to[first]] = np.logaddexp.reduceat(sums[source[a:b]] + logw[a:b], first, axis=0)


class Lattice:
    def __init__(self, path: str | None = None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.text: list[bytes] = [b""] * self.size
        self.byte = np.zeros(256, np.int32)
        prefixes: dict[int, int] = {}
        for i in range(self.size):
            if model.is_unknown(i) or model.is_control(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], self.text[i] = i, bytes([value])
                continue
            piece = piece.replace("▁", " ")
            if "\n" in piece or " " in piece.lstrip(" "):
                raise ValueError("a piece crosses a chunk's border")
            self.text[i] = piece.encode()
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for x in _symbols(_points(piece)):
                    h = h * _BASE + x
                    prefixes.setdefault(int(h), -1)
            prefixes[int(h)] = i
        self.width = np.fromiter(map(len, self.text), np.int64, self.size)
        self.place = np.cumsum(self.width) - self.width
        self.pool = np.frombuffer(b"".join(self.text), np.uint8)
        self.keys = np.array(sorted(prefixes), np.uint64)
        self.ids = np.array([prefixes[int(k)] for k in self.keys], np.int64)
        # Hash slots of the keys: the first key of a slot, then those behind it (few).
        slot = (self.keys >> np.uint64(44)).astype(np.int64)
        self.slots = []
        rest = np.arange(len(self.keys))
        while len(rest):
            table = np.full(1 << 20, -1, np.int32)
            table[slot[rest][::-1]] = rest[::-1]
            rest = rest[table[slot[rest]] != rest]
            self.slots.append(table)
        self.first_piece = int(min(i for i, t in enumerate(self.text) if len(t) > 1))

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each hash among the keys, and whether it is there."""
        slot = (h >> np.uint64(44)).astype(np.int64)
        found = self.slots[0][slot]
        known = self.keys[found] == h
        miss = np.flatnonzero(~known & (found >= 0))
        for table in self.slots[1:]:
            if not len(miss):
                break
            i = table[slot[miss]]
            same = (i >= 0) & (self.keys[i] == h[miss])
            found[miss[same]], known[miss[same]] = i[same], True
            miss = miss[~same & (i >= 0)]
        return found, known & (found >= 0)

    def edges(self, words: list[str]) -> Edges:
        points = _points("".join(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths)
        word = np.repeat(np.arange(len(words)), lengths)
        room = stops[word] - np.arange(len(points))  # characters left in the word
        symbol = _symbols(points)
        at, h, k = np.arange(len(points)), np.zeros(len(points), np.uint64), 0
        starts, sizes, pieces = [], [], []
        while len(at):
            h = h * _BASE + symbol[at + k]
            k += 1
            i, known = self._find(h)
            piece = np.where(known, self.ids[i], -1)
            if k == 1:
                alone = piece < 0
                piece = np.where(alone, -1 - points[at].astype(np.int64), piece)
                hit = np.ones(len(at), bool)
            else:
                hit = piece >= 0
            starts.append(at[hit])
            sizes.append(np.full(int(hit.sum()), k))
            pieces.append(piece[hit])
            on = known & (room[at] > k)
            at, h = at[on], h[on]
        nodes = np.concatenate([[0], stops + np.arange(1, len(words) + 1)])
        if not starts:
            none = np.zeros(0, np.int64)
            return Edges(nodes, none, none, none, none, none)
        start, size, piece = (np.concatenate(x[::-1]) for x in (starts, sizes, pieces))  # a node's longest edge first
        own = word[start]
        begin = start + own
        order = np.argsort(begin + size, kind="stable")
        begin, size, piece, own = begin[order], size[order], piece[order], own[order]
        return Edges(nodes, begin, begin + size, begin + size - nodes[own], piece, size)

    def rank_weights(self, power: float) -> tuple[np.ndarray, float]:
        """Log probabilities by Zipf's law on the merge rank, and that of a byte piece; nothing is trained."""
        rank = np.maximum(np.arange(self.size) - self.first_piece, 0) + 2.7
        logp = -power * np.log(rank)
        byte = float(logp[-1])
        kept = np.array([len(t) > 0 for t in self.text])
        kept[self.byte] = False
        total = np.logaddexp.reduce(np.append(logp[kept], byte + np.log(256)))
        return logp - total, byte - float(total)

    def log_weights(self, piece: np.ndarray, logp: np.ndarray, byte: float) -> np.ndarray:
        unknown = piece < 0
        if not unknown.any():
            return logp[piece]
        return np.where(unknown, byte * self.byte_count(piece), logp[np.where(unknown, 0, piece)])

    def byte_count(self, piece: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of byte-fallback edges (piece < 0)."""
        point = -1 - piece
        return 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)

    def byte_ids(self, piece: int) -> list[int]:
        return self.byte[list(chr(-1 - piece).encode("utf-8", "surrogatepass"))].tolist()

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> list[bytes]:
        """The bytes of every list ids[begin[i]:begin[i + 1]]."""
        stops = np.cumsum(self.width[ids])
        total = int(stops[-1]) if len(stops) else 0
        raw = self.pool[np.repeat(self.place[ids] - (stops - self.width[ids]), self.width[ids]) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], stops])[begin].tolist()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
