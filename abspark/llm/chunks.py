"""Texts of an Arrow batch cut into chunks, each distinct chunk once (dictionary-encoded)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Marks cuts; a text that holds it is cut by a regular expression instead.
_MARK = "﷐"


@dataclass
class Chunks:
    words: list[str]  # the distinct chunks
    codes: np.ndarray  # the chunks of all texts in order, as indexes into words
    starts: np.ndarray  # text i holds codes[starts[i]:starts[i + 1]]

    @property
    def texts(self) -> np.ndarray:
        """The text number of every chunk."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def _encoded(lists: pa.LargeListArray | pa.ListArray) -> Chunks:
    values = lists.flatten().dictionary_encode()
    starts = lists.offsets.to_numpy().astype(np.int64)
    codes = values.indices.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return Chunks(values.dictionary.to_numpy(zero_copy_only=False).tolist(), codes, starts - starts[0])


def plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A large string array of its own without nulls (null: empty).

    A slice of a longer array is copied: some kernels of Arrow read a widened
    slice's bytes at the wrong place.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:
        return pa.array([x or "" for x in texts.to_pylist()], pa.large_string())
    return pc.fill_null(texts.cast(pa.large_string()), "")


def spaced(texts: pa.Array) -> Chunks:
    """Split at every space and newline, which go."""
    return _encoded(pc.split_pattern(pc.replace_substring(plain(texts), "\n", " "), " "))


def ascii_words(texts: pa.Array) -> Chunks:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased."""
    flat = pc.ascii_lower(plain(texts))
    for white in "\t\n\x0b\x0c\r":
        flat = pc.replace_substring(flat, white, " ")
    got = _encoded(pc.split_pattern(flat, " "))
    if "" in got.words:
        keep = got.codes != got.words.index("")
        kept = np.concatenate([[0], np.cumsum(keep)])
        got = Chunks(got.words, got.codes[keep], kept[got.starts])
    return got


def lossless(texts: pa.Array) -> Chunks:
    """Cut before each run of spaces and around each newline; the chunks joined are the text."""
    flat = plain(texts)
    odd = pc.any(pc.match_substring(flat, _MARK)).as_py()
    if odd:
        import re

        cut = re.compile(r"\n| +[^ \n]*|[^ \n]+")
        return _encoded(pa.array([cut.findall(x) for x in flat.to_pylist()], pa.large_list(pa.large_string())))
    flat = pc.replace_substring(flat, "\n", f"{_MARK}\n{_MARK}")
    if pc.any(pc.match_substring(flat, "  ")).as_py():
        flat = pc.replace_substring_regex(flat, " +", _MARK + r"\0")
    else:
        flat = pc.replace_substring(flat, " ", _MARK + " ")
    return _encoded(pc.split_pattern(flat, _MARK))
