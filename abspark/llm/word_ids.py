"""Token ids of whole texts by a public word tokenizer, a word at a time with a bounded memo.

The tokenizer never joins characters across white space, so a text's ids are
the ids of its space- and newline-separated chunks in order.  A chunk is
encoded once per worker while it is in the memo, which keeps two generations
of at most ``MEMO`` chunks each: its memory does not grow with the corpus.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from abspark.llm.chunks import plain, spaced
from abspark.llm.common import process_memo

MEMO = 400_000
LONG_CHUNK = 200
_STOPS = ".,;:!?"


def word_ids(path: str | None = None) -> WordIds:
    """The worker process's own: its tasks follow each other and share the memo."""
    return process_memo(("word ids", path), lambda: WordIds(path))


class WordIds:
    def __init__(self, path: str | None = None, memo: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer, self.memo = Tokenizer.from_file(path), memo
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.marks = dict(zip(_STOPS, self._plain(list(_STOPS)), strict=True))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _lower(self, texts: pa.Array) -> pa.Array:
        """The tokenizer lowers letters itself; lowering A-Z before leaves fewer distinct chunks."""
        texts = plain(texts)
        for token in ("<|startoftext|>", "<|endoftext|>"):  # matched as written, before any lowering
            if pc.any(pc.match_substring(texts, token, ignore_case=True)).as_py():
                return texts
        return pc.ascii_lower(texts)

    def _plain(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of all-letter chunks: joined by spaces, each ends at a piece that closes a word."""
        out = []
        for at in range(0, len(words), 500):
            part = words[at : at + 500]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):  # a letter whose lower case is no letter alone
                out += self._plain(part)
                continue
            raw, stops = ids.tobytes(), (4 * stops).tolist()
            out += [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        return out

    def _fresh(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of new chunks; letters with one stop mark behind them are encoded as the letters and the mark."""
        stems, rest = {}, []
        for c in chunks:
            if c.isalpha():
                stems[c] = c
            elif c[-1:] in _STOPS and c[:-1].isalpha() and (c.isascii() or c[:-1].lower().isalpha()):
                stems[c] = c[:-1]
            else:
                rest.append(c)
        found = dict(zip(rest, self._plain(rest), strict=True)) if rest else {}
        known, words = {}, []
        for s in set(stems.values()):
            ids = self.young.get(s) or self.old.get(s)
            if ids is None:
                words.append(s)
            else:
                known[s] = ids
        known.update(zip(words, self._words(words), strict=True))
        for c, s in stems.items():
            found[c] = known[s] if len(s) == len(c) else known[s] + self.marks[c[-1]]
        found.update(known)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and where each text's begin (with the end behind the last)."""
        cut = spaced(self._lower(texts))
        young, old = self.young, self.old
        got = list(map(young.get, cut.words))
        missing = [i for i, x in enumerate(got) if x is None]
        if missing:
            lookup = {c: old[c] for i in missing if (c := cut.words[i]) in old}
            fresh = [c for i in missing if (c := cut.words[i]) not in lookup]
            for at in range(0, len(fresh), 20_000):
                lookup.update(self._fresh(fresh[at : at + 20_000]))
            for i in missing:
                got[i] = lookup[cut.words[i]]
            keep = {c: x for c, x in lookup.items() if len(c) <= LONG_CHUNK}
            if len(young) + len(keep) > self.memo:
                self.old, self.young = young, keep if len(keep) <= self.memo else {}
            else:
                young.update(keep)
        pool = np.frombuffer(b"".join(got), "<u4")
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        begin = np.cumsum(size) - size
        each = size[cut.codes]
        stops = np.cumsum(each)
        ids = pool[np.repeat(begin[cut.codes] - (stops - each), each) + np.arange(stops[-1] if len(stops) else 0)]
        return ids, np.concatenate([[0], stops])[cut.starts]
