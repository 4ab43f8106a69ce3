"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary.  Each language has a
probability for every piece; the probability of a word is the sum over all its
segmentations into pieces, found by a forward algorithm, and that of a text the
product over its words, its runs of letters with their marks (pieces don't cross
them).  The probabilities
are expected piece counts over all segmentations of every training word (one
forward-backward pass from pieces that all are alike), smoothed.

Training gathers word counts per language over the whole corpus with partial
aggregates; the model is pieces x languages, independent of the corpus.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when nothing was learned; rows with null text or null language aren't
learned from; an empty table gives an empty result; repeated rows count as
often as they stand; ties go to the first language by code point; other
columns may have any name.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import as_batches, bounded_batches

SMOOTHING = 0.5
MAX_MEMO = 200_000   # words of a memo; there are two
CELLS = 1_000_000    # of the forward table that is worked on at once
MARK = "▁"      # begins a word in the vocabulary


_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_ASCII_LETTERS = re.compile("[a-z]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters with their marks, lower-cased; digits, punctuation and white space say nothing about the language."""
    if not text:
        return []
    low = text.lower()
    return (_ASCII_LETTERS if low.isascii() else _LETTERS).findall(low)


def vocabulary(path: str) -> dict[str, int]:
    """Pieces of a public sentencepiece file that can stand in lower-cased text, numbered."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {p: n for n, p in enumerate(dict.fromkeys(p for p in pieces if p == p.lower() and MARK not in p[1:]))}


class Lattice:
    """All places of pieces in words; a character outside the vocabulary is the one unknown piece."""

    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: dict[str, int]):
        self.pieces, self.unknown = pieces, len(pieces)
        by_length: dict[int, list[str]] = {}
        for p in pieces:
            by_length.setdefault(len(p), []).append(p)
        self.longest = max(by_length)
        self.tables = {}  # length -> sorted hashes and the pieces' numbers in that order
        for n, some in by_length.items():
            h = np.zeros(len(some), np.uint64)
            for c in np.array([list(map(ord, p)) for p in some], np.uint64).T:
                h = h * self._BASE + c
            order = np.argsort(h)
            self.tables[n] = h[order], np.array([pieces[p] for p in some], np.int64)[order]

    def arcs(self, words: list[str]) -> np.ndarray:
        """Rows ``word, begin, end, piece`` over the marked words.

        Substrings of one length are hashed and looked up for all words at once.
        """
        text = "".join(MARK + w for w in words)
        c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        begin = np.arange(len(c)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        room = np.repeat(sizes, sizes) - begin
        at, h, found = np.arange(len(c)), np.zeros(len(c), np.uint64), []
        for n in range(1, self.longest + 1):
            keep = room[at] >= n
            at, h = at[keep], h[keep]
            if not len(at):
                break
            h = h * self._BASE + c[at + n - 1]
            hit, piece = np.zeros(len(at), bool), None
            if n in self.tables:
                known, numbers = self.tables[n]
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit, piece = known[place] == h, numbers[place]
                found.append((at[hit], n, piece[hit]))
            if n == 1:
                found.append((at[~hit], 1, np.full((~hit).sum(), self.unknown)))
        return np.concatenate([np.column_stack((word[x], begin[x], begin[x] + n, p)) for x, n, p in found]).astype(np.int64)


def _sums(arcs: np.ndarray, n_words: int, length: int, weight: np.ndarray, back: bool) -> np.ndarray:
    """Log of summed path weights to (or from) every place: an array ``word, place, language``."""
    table = np.full((n_words, length + 1, weight.shape[1]), -np.inf)
    far, near = (1, 2) if not back else (2, 1)
    if back:
        ends = np.zeros(n_words, dtype=np.int64)
        np.maximum.at(ends, arcs[:, 0], arcs[:, 2])
        table[np.arange(n_words), ends] = 0.0
    else:
        table[:, 0] = 0.0
    order = np.lexsort((arcs[:, 0], arcs[:, near]))
    a = arcs[order]
    places = np.flatnonzero(np.r_[True, a[1:, near] != a[:-1, near]]) if len(a) else np.empty(0, int)
    bounds = np.r_[places, len(a)]
    for k in (range(len(places)) if not back else reversed(range(len(places)))):
        g = a[bounds[k]: bounds[k + 1]]
        paths = table[g[:, 0], g[:, far]] + weight[g[:, 3]]
        first = np.flatnonzero(np.r_[True, g[1:, 0] != g[:-1, 0]])
        table[g[first, 0], g[first, near]] = np.logaddexp.reduceat(paths, first, axis=0)
    return table


def _slices(words: list[str], languages: int) -> Iterator[list[str]]:
    """Words by length, in lots whose forward table is of bounded size."""
    lot: list[str] = []
    for w in sorted(words, key=len):
        if lot and (len(lot) + 1) * (len(w) + 2) * languages > CELLS:
            yield lot
            lot = []
        lot.append(w)
    if lot:
        yield lot


def word_scores(lattice: Lattice, words: list[str], logp: np.ndarray) -> dict[str, np.ndarray]:
    """Log probability of each word in each language, summed over segmentations (forward algorithm)."""
    out = {}
    for lot in _slices(words, logp.shape[1]):
        table = _sums(lattice.arcs(lot), len(lot), max(map(len, lot)) + 1, logp, back=False)
        for k, w in enumerate(lot):
            out[w] = table[k, len(w) + 1]
    return out


def expected_pieces(lattice: Lattice, words: list[str], logp: np.ndarray) -> Iterator[tuple]:
    """For each lot of words ``(lot, word numbers, pieces, shares)``: every arc's share of all segmentations."""
    for lot in _slices(words, 1):
        arcs = lattice.arcs(lot)
        length = max(map(len, lot)) + 1
        ahead = _sums(arcs, len(lot), length, logp, back=False)[:, :, 0]
        behind = _sums(arcs, len(lot), length, logp, back=True)[:, :, 0]
        w, i, j, p = arcs.T
        yield lot, w, p, np.exp(ahead[w, i] + logp[p, 0] + behind[w, j] - behind[w, 0])


def train(docs: DataFrame, vocabulary_path: str, text_col: str = "text", lang_col: str = "lang") -> dict:
    """Learn from every row with text and language: ``{"languages": [...], "logp": pieces x languages}``."""
    bounded_batches(docs.sparkSession)
    src = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counted = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def rows() -> list[tuple]:
            return [(lang, w, n) for lang, own in held.items() for w, n in own.items()]

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > 200_000:
                yield from as_batches(rows(), counted)
                held.clear()
        yield from as_batches(rows(), counted)

    words = src.mapInArrow(count, "lang string, word string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    expected = pa.schema([("lang", pa.string()), ("piece", pa.int32()), ("n", pa.float64())])

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary(vocabulary_path))
        even = np.full((lattice.unknown + 1, 1), -np.log(lattice.unknown + 1.0))
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            rows: dict[str, list[tuple[str, int]]] = {}
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows.setdefault(word, []).append((lang, n))
            for lot, w, p, share in expected_pieces(lattice, list(rows), even):
                times: dict[str, np.ndarray] = {}
                for k, word in enumerate(lot):
                    for lang, n in rows[word]:
                        if lang not in times:
                            times[lang] = np.zeros(len(lot))
                        times[lang][k] += n
                for lang, n in times.items():
                    own = held.setdefault(lang, np.zeros(lattice.unknown + 1))
                    own += np.bincount(p, share * n[w], minlength=len(own))
        for lang, own in held.items():
            some = np.flatnonzero(own)
            yield from as_batches([(lang, int(i), float(own[i])) for i in some], expected)

    # at most pieces x languages rows, whatever the corpus
    counts = words.select("lang", "word", "n").mapInArrow(expect, "lang string, piece int, n double").groupBy(
        "lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    size = len(vocabulary(vocabulary_path)) + 1
    table = np.full((size, len(languages)), SMOOTHING)
    for k, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        table[own["piece"].to_numpy(), k] += np.round(own["n"].to_numpy(), 6)
    return {"languages": languages, "logp": np.log(table) - np.log(table.sum(axis=0)) if languages else table}


class Scorer:
    def __init__(self, model: dict, vocabulary_path: str):
        self.languages, self.logp = model["languages"], model["logp"]
        self.lattice = Lattice(vocabulary(vocabulary_path))
        self.place: dict[str, int] = {}
        self.scores = np.empty((1024, len(self.languages)))
        self.old = self.place, self.scores

    def learn(self, texts: list[list[str]]) -> None:
        """Scores the texts' words that aren't remembered."""
        if len(self.place) > MAX_MEMO:  # what is used again moves from the old memo to the new
            self.old = self.place, self.scores
            self.place, self.scores = {}, np.empty_like(self.scores)
        new = set().union(*texts) - self.place.keys()
        known = new & self.old[0].keys()
        found = {w: self.old[1][self.old[0][w]] for w in known} | word_scores(self.lattice, list(new - known), self.logp)
        while len(self.place) + len(found) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
        for w, row in found.items():
            self.place[w] = k = len(self.place)
            self.scores[k] = row

    def predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.languages:
            return "und", 0.0
        total = self.scores[list(map(self.place.__getitem__, words))].sum(axis=0)
        total = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.languages[best], float(total[best] / total.sum())


_scorers: dict[str, Scorer] = {}


def worker_scorer(name: str, model: dict, vocabulary_path: str) -> Scorer:
    """The scorer of the model ``name``, one a worker process, kept across its tasks."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(model, vocabulary_path)
    return _scorers[name]


def predict(docs: DataFrame, model: dict, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, lang_pred, score``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # pieces x languages: bounded by the vocabulary
    name = scratch_path(spark, "language-model")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(name, sent.value, vocabulary_path)
        for batch in batches:
            texts = [words_of(t) for t in batch.column(1).to_pylist()]
            scorer.learn(texts)
            rows = [scorer.predict(words) for words in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")

