"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

The forward pass sums the probabilities of all segmentations up to every
position of the piece lattice; the backward pass draws the last piece from its
exact conditional probability, then the one before it, and so on.  The result
is a sample from all segmentations of the text.

The vocabulary is a public one and nothing is trained: a piece's probability
follows its merge rank by Zipf's law, p ~ (rank + 2.7) ** -power, and a byte
piece has the probability of the last rank.  ``power`` plays the part of the
inverse temperature (larger: fewer, longer pieces).

The uniform number of a draw is a hash of (seed, row key, position in the
text), so a row's sample does not depend on its partition, batch or neighbours,
and a task that is run again gives the same ids.

Defined cases: a null text has null ids and decodes to null; the empty text
has no ids; characters outside the vocabulary (a literal U+2581 too) become
byte pieces, so decoding gives back every text exactly; equal texts under
equal keys (repeated rows) have equal ids; a null key is the key ''; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abspark.llm.chunks import lossless, plain
from abspark.llm.common import bounded_batches, thrifty, mix64, process_memo
from abspark.llm.lattice import Lattice

SEED = 17
POWER = 1.0
MEMO_WORDS = 200_000
BATCH_ROWS = 400
WORD_BLOCK = 16_384


class Sampler:
    """Cumulated backward probabilities of words: the first ``memo`` stay, those of a batch beyond them go after it."""

    def __init__(self, path: str | None = None, power: float = POWER, memo: int = MEMO_WORDS):
        self.lattice, self.memo = Lattice(path), memo
        self.logp, self.byte_logp = self.lattice.rank_weights(power)
        self.words: dict[str, int] = {}
        self.last = np.zeros(0, np.int32)  # a word's last node
        self.edge_of = np.zeros(1, np.int32)  # node n's edges: edge_of[n]:edge_of[n + 1]
        self.upto = np.zeros(0, np.float32)
        self.size = np.zeros(0, np.int8)
        self.piece = np.zeros(0, np.int32)

    def log_weights(self, piece: np.ndarray) -> np.ndarray:
        return self.lattice.log_weights(piece, self.logp, self.byte_logp)

    def _add(self, words: list[str]) -> None:
        found = [self._cumulated(words[at : at + WORD_BLOCK]) for at in range(0, len(words), WORD_BLOCK)]
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words)), strict=True))
        nodes, edges = len(self.edge_of) - 1, len(self.upto)
        lasts, ends = [], []
        for last, end, upto, _, _ in found:
            lasts.append(last + nodes)
            ends.append(end + edges)
            nodes, edges = nodes + len(end), edges + len(upto)
        more = lambda old, new: np.concatenate([old, *(x.astype(old.dtype) for x in new)])
        self.last, self.edge_of = more(self.last, lasts), more(self.edge_of, ends)
        self.upto, self.size, self.piece = (more(old, [x[i] for x in found]) for i, old in ((2, self.upto), (3, self.size), (4, self.piece)))

    def _cumulated(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Last node of each word, last edge of each node, and per edge the cumulated probability, size and piece."""
        e = self.lattice.edges(words)
        logw = self.log_weights(e.piece)
        alpha = e.forward(logw[:, None])[:, 0]
        p = np.exp(alpha[e.start] + logw - alpha[e.end])
        end, nodes = e.end, int(e.nodes[-1])
        first = np.searchsorted(end, np.arange(nodes + 1))
        # Summed node by node: a word's bounds do not depend on the words beside it.
        cum, width = p, np.diff(first)
        for k in range(1, int(width.max(initial=0))):
            at = first[:-1][width > k] + k
            cum[at] += cum[at - 1]
        cum[first[1:][first[1:] > first[:-1]] - 1] = 2.0  # a node's last edge takes what rounding leaves
        return e.nodes[1:] - 1, first[1:], cum.astype(np.float32), e.size.astype(np.int8), e.piece.astype(np.int32)

    def encode(self, texts: pa.Array, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, log probability of the sampled pieces) of the texts, whose keys are unsigned 64-bit hashes."""
        flat = plain(texts)
        # The vocabulary's words begin with a space: one goes before every text but the empty one.
        flat = pc.if_else(pc.equal(flat, ""), flat, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), flat, pa.scalar("", pa.large_string())))
        cut = lossless(flat)
        fresh = [w for w in cut.words if w not in self.words]
        kept = max(0, self.memo - len(self.words))
        if fresh[:kept]:
            self._add(fresh[:kept])
        known, nodes, edges, fresh = len(self.words), len(self.edge_of), len(self.upto), fresh[kept:]
        if fresh:
            self._add(fresh)
        code = np.array([self.words[w] for w in cut.words], np.int64)[cut.codes] if len(cut.words) else cut.codes
        text = cut.texts
        length = np.fromiter(map(len, cut.words), np.int64, len(cut.words))[cut.codes]
        behind = np.cumsum(length)
        where = behind - np.concatenate([[0], behind])[cut.starts[:-1]][text]  # characters of the text up to the chunk's end
        row = mix64(keys ^ mix64(np.full(len(keys), seed, np.uint64)))[text]
        node, on = self.last[code], np.flatnonzero(length > 0)
        node, where, row = node[on], where[on], row[on]
        owner, drawn, steps, scores = on, [], [], np.zeros(len(keys))
        left = length[on]
        count = np.zeros(len(code), np.int64)
        while len(node):
            u = (mix64(row + where.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = self.edge_of[node]
            on = np.flatnonzero(self.upto[e] <= u)
            while len(on):
                e[on] += 1
                on = on[self.upto[e[on]] <= u[on]]
            piece, size = self.piece[e], self.size[e]
            drawn.append(piece)
            steps.append(owner)
            count[owner] += 1
            node, where, left = node - size, where - size, left - size
            more = left > 0
            node, where, left, row, owner = node[more], where[more], left[more], row[more], owner[more]
        if fresh:
            for w in fresh:
                del self.words[w]
            self.last, self.edge_of = self.last[:known], self.edge_of[:nodes]
            self.upto, self.size, self.piece = self.upto[:edges], self.size[:edges], self.piece[:edges]
        stop = np.cumsum(count)
        pieces = np.zeros(int(stop[-1]) if len(stop) else 0, np.int64)
        done = np.zeros(len(code), np.int64)
        for piece, who in zip(drawn, steps, strict=True):
            done[who] += 1
            pieces[stop[who] - done[who]] = piece
        begin = np.concatenate([[0], stop])[cut.starts]
        logw = np.concatenate([[0.0], np.cumsum(self.log_weights(pieces))])
        scores = logw[begin[1:]] - logw[begin[:-1]]
        if len(pieces) and pieces.min() < 0:
            width = np.where(pieces < 0, self.lattice.byte_count(pieces), 1)
            out = np.repeat(pieces, width)
            at = np.cumsum(width) - width
            for i in np.flatnonzero(pieces < 0).tolist():
                out[at[i] : at[i] + width[i]] = self.lattice.byte_ids(int(pieces[i]))
            begin = np.concatenate([[0], np.cumsum(width)])[begin]
            pieces = out
        return pieces, begin, scores


def _sampler(path: str | None, power: float) -> Sampler:
    """The worker process's own: its tasks follow each other and share the memo."""
    return process_memo(("sampler", path, power), lambda: Sampler(path, power))


def encode(docs: DataFrame, seed: int = SEED, power: float = POWER, model: str | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, log_prob double): one sampled segmentation per row and its natural log probability as a piece sequence.

    With ``decoded`` the ids are decoded in the same task, into a column ``text``.
    """
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("log_prob", T.DoubleType())])
    if decoded:
        schema = schema.add("text", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(model, power)
        for batch in thrifty(batches):
            names = batch.column(0).cast(pa.large_string()).to_pylist()
            keys = np.fromiter((xxhash.xxh64_intdigest(n or "") for n in names), np.uint64, len(names))
            texts = batch.column(1)
            ids, begin, score = sampler.encode(texts, keys, seed)
            null = pc.is_null(texts).to_numpy(zero_copy_only=False)
            lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids.astype(np.int32)), mask=pa.array(null))
            columns = [batch.column(0), lists, pa.array(score, mask=null)]
            if decoded:
                columns.append(_texts(sampler.lattice, ids, begin, null))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _texts(lattice: Lattice, ids: np.ndarray, begin: np.ndarray, null: np.ndarray) -> pa.Array:
    """Texts of the id lists, without the space that encoding put before them."""
    return pa.array([None if missing else raw[1:].decode("utf-8", "surrogatepass") for raw, missing in zip(lattice.decode(ids, begin), null.tolist(), strict=True)], pa.string())


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """Adds column ``text``: the exact text of each row's ids."""

    @F.arrow_udf("string")
    def text_of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = process_memo(("lattice", model), lambda: Lattice(model))
        for ids in columns:
            if isinstance(ids, pa.ChunkedArray):
                ids = ids.combine_chunks()
            begin = ids.offsets.to_numpy()
            yield _texts(lattice, ids.flatten().to_numpy(), begin - begin[0], pc.is_null(ids).to_numpy(zero_copy_only=False))

    return encoded.withColumn("text", text_of("ids"))


def op1_sentencepiece_ffbs(docs: DataFrame) -> DataFrame:
    """The ids of every text, and whether they decode to it."""
    out = encode(docs, decoded=True)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return out.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "log_prob", digest.alias("decoded_sha256"))
