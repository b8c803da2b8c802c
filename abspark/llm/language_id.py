"""Language ID by segmentation-marginalised unigrams over a fixed public piece vocabulary.

Each language has one probability per piece.  A text's probability under a
language is the sum over all its segmentations into pieces, by the forward
algorithm; the prediction is the language of the largest posterior.

Training is one expectation-maximisation step from rank-based start weights:
the expected piece counts of every training text under the posterior of its
segmentations (forward-backward), summed by language over all training rows.
A task keeps one count per language and piece, so what is shuffled is bounded
by vocabulary x languages a task, and the model by vocabulary x languages.

Defined cases: text that is null or has no letter gets `und` with score 0, as
does every text when no row can be learned from; rows with null lang are not
learned from; a null doc_id counts as the text '' for the fold; letters are
compared in lower case; ties go to the language first in code point order;
repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abspark.llm.chunks import Chunks, lossless, plain
from abspark.llm.common import bounded_batches, thrifty, process_memo
from abspark.llm.lattice import Edges, Lattice

UNKNOWN = "und"
FOLDS = 5
POWER = 1.0
SMOOTHING = 0.05
FLUSH_WORDS = 150_000
WORD_BLOCK = 16_384
MEMO_WORDS = 300_000


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = 0) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _cut(texts: pa.Array) -> Chunks:
    flat = pc.utf8_lower(plain(texts))
    space = pa.scalar(" ", pa.large_string())
    return lossless(pc.binary_join_element_wise(space, flat, pa.scalar("", pa.large_string())))


@dataclass
class LanguageModel:
    langs: list[str]
    prior: np.ndarray  # log share of each language
    logp: np.ndarray  # (pieces, languages)
    path: str | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def _scorer(model: LanguageModel) -> _Scorer:
    """The worker process's own: its tasks follow each other and share the memo."""
    return process_memo(("language", model.name), lambda: _Scorer(model))


class _Expected:
    """Expected piece counts by language of the words added."""

    def __init__(self, lattice: Lattice, langs: int, power: float):
        self.lattice, self.langs = lattice, langs
        self.logp, self.byte = lattice.rank_weights(power)
        self.sums = np.zeros((langs, lattice.size))
        self.words: dict[str, int] = {}
        self.counts = np.zeros((0, langs))

    def add(self, cut: Chunks, lang: np.ndarray) -> None:
        by = np.bincount(cut.codes * self.langs + lang[cut.texts], minlength=len(cut.words) * self.langs).reshape(-1, self.langs)
        if len(self.words) > FLUSH_WORDS:
            self.flush()
        at = np.fromiter((self.words.setdefault(w, len(self.words)) for w in cut.words), np.int64, len(cut.words))
        if len(self.words) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros((2 * len(self.words) - len(self.counts), self.langs))])
        self.counts[at] += by

    def flush(self) -> None:
        words, counts = list(self.words), self.counts
        self.words, self.counts = {}, np.zeros((0, self.langs))
        for at in range(0, len(words), WORD_BLOCK):
            self._expect(words[at : at + WORD_BLOCK], counts[at : at + WORD_BLOCK])

    def _expect(self, words: list[str], counts: np.ndarray) -> None:
        e = self.lattice.edges(words)
        logw = self.lattice.log_weights(e.piece, self.logp, self.byte)[:, None]
        alpha, beta = e.forward(logw)[:, 0], e.backward(logw)[:, 0]
        word = np.repeat(np.arange(len(words)), np.diff(np.searchsorted(e.end, e.nodes)))
        share = np.exp(alpha[e.start] + logw[:, 0] + beta[e.end] - alpha[e.nodes[1:] - 1][word])
        used = counts[: len(words)] > 0
        for k in range(self.langs):  # most words are of one language: each pass takes that language's edges
            at = np.flatnonzero(used[word, k])
            piece, weight = e.piece[at], share[at] * counts[word[at], k]
            plain = piece >= 0
            self.sums[k] += np.bincount(piece[plain], weights=weight[plain], minlength=self.lattice.size)
            for p, w in zip(piece[~plain].tolist(), weight[~plain].tolist(), strict=True):
                np.add.at(self.sums[k], self.lattice.byte_ids(p), w)


def train(docs: DataFrame, path: str | None = None, power: float = POWER, smoothing: float = SMOOTHING) -> LanguageModel:
    """Learn from columns text and lang of every row of ``docs`` with both."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.filter("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    # One row per language label: the label set is the model's own size.
    shares = sorted((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    langs = [lang for lang, _ in shares]
    if not langs:
        return LanguageModel([], np.zeros(0), np.zeros((0, 0)), path)

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = process_memo(("lattice", path), lambda: Lattice(path))
        sums = _Expected(lattice, len(langs), power)
        for batch in thrifty(batches):
            lang = pc.index_in(batch.column(1), pa.array(langs, batch.column(1).type)).to_numpy(zero_copy_only=False)
            sums.add(_cut(batch.column(0)), lang.astype(np.int64))
        sums.flush()
        lang, piece = np.nonzero(sums.sums)
        if len(lang):
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums.sums[lang, piece])], names=["lang", "piece", "n"])

    parts = rows.mapInArrow(expected, "lang int, piece int, n double")
    table = parts.groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    size = Lattice(path).size
    sums = np.zeros((size, len(langs)))
    for r in table.toLocalIterator():  # at most vocabulary x languages rows
        sums[r.piece, r.lang] = r.n
    logp = np.log(sums + smoothing) - np.log(sums.sum(axis=0) + smoothing * size)
    count = np.array([n for _, n in shares], float)
    return LanguageModel(langs, np.log(count / count.sum()), logp, path)


class _Scorer:
    """Log probability under every language of the words met; the first ``MEMO_WORDS`` are kept."""

    def __init__(self, model: LanguageModel):
        self.model, self.lattice = model, Lattice(model.path)
        self.words: dict[str, int] = {}
        self.known = np.zeros((0, len(model.langs)))

    def _score(self, words: list[str]) -> np.ndarray:
        e: Edges = self.lattice.edges(words)
        logw = self.model.logp[np.maximum(e.piece, 0)]
        unknown = np.flatnonzero(e.piece < 0)
        if len(unknown):
            points, at = np.unique(e.piece[unknown], return_inverse=True)
            logw[unknown] = np.array([self.model.logp[self.lattice.byte_ids(int(p))].sum(axis=0) for p in points])[at]
        return e.forward(logw)[e.nodes[1:] - 1]

    def texts(self, texts: pa.Array) -> np.ndarray:
        """(texts, languages) log probabilities."""
        cut = _cut(texts)
        at = np.fromiter((self.words.get(w, -1) for w in cut.words), np.int64, len(cut.words))
        scores = self.known[at] if len(self.known) else np.zeros((len(at), len(self.model.langs)))
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            words = [cut.words[i] for i in fresh.tolist()]
            found = np.concatenate([self._score(words[i : i + WORD_BLOCK]) for i in range(0, len(words), WORD_BLOCK)])
            scores[fresh] = found
            room = MEMO_WORDS - len(self.words)
            if room > 0:
                n = len(self.words)
                self.words.update(zip(words[:room], range(n, n + len(words)), strict=False))
                self.known = np.concatenate([self.known, found[:room]])
        text = cut.texts
        n = len(cut.starts) - 1
        return np.stack([np.bincount(text, weights=scores[cut.codes, k], minlength=n) for k in range(scores.shape[1])], axis=1)


def predict(model: LanguageModel, spark):
    """Column function: struct(lang_pred, score) of a text column."""
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # vocabulary x languages doubles

    @F.arrow_udf("lang_pred string, score double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(sent.value) if sent.value.langs else None
        for texts in thrifty(columns):
            letters = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if scorer and letters.any():
                logp = scorer.texts(texts) + sent.value.prior
                best = logp.argmax(axis=1)
                top = np.exp(logp.max(axis=1) - np.logaddexp.reduce(logp, axis=1))
                names[letters] = np.array(sent.value.langs, object)[best[letters]]
                score[letters] = np.clip(top[letters], 0.0, 1.0)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], names=["lang_pred", "score"])

    return of


def op2_marginal_unigrams(docs: DataFrame) -> DataFrame:
    test = held_out(F.col("doc_id"))
    model = train(docs.filter(~test))
    out = docs.select("doc_id", test.alias("held_out"), predict(model, docs.sparkSession)("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def known_language(docs: DataFrame, languages: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` whose text op2 does not call ``und``; a null lang becomes the prediction.

    With ``languages`` only rows predicted as one of them stay.  With no label to
    learn from there is no prediction: texts with a letter stay as they are.
    """
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    # Not deterministic to the optimiser, which would otherwise predict again for the filter.
    rows = rows.withColumn("p", predict(model, docs.sparkSession).asNondeterministic()(F.col("row.text")))
    kept = rows.filter(F.col("p.lang_pred") != UNKNOWN if languages is None else F.col("p.lang_pred").isin(*languages))
    new = {"lang": F.coalesce("row.lang", "p.lang_pred")}
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
