"""Quality rules as a short-circuit cascade.

Each rule is measured on a bounded sample: its cost in seconds a document and
the share it rejects of what the rules before it leave.  Rules run in the order
of rejection per cost, the base rules among them, and a document that one rule
rejects is not shown to the next.  All rules must pass, so the verdict doesn't
depend on the order found.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged alike; an empty table gives an empty result (the
rules then keep their given order); other columns may have any name.
"""
from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, bounded_batches, text_bytes

#: Rows on which costs and selectivities are estimated.
SAMPLE_ROWS = 400

SYMBOLS = "#*$%&|<>"


class Page:
    """A text with the counts that rules ask for; each is computed once, when asked."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""
        self.text = self.raw.decode("utf-8", "replace")
        self.words = self.raw.split()
        self.n_words = len(self.words)
        self._made: dict[str, object] = {}

    def __getattr__(self, name):
        make = _COUNTS.get(name)
        if make is None:
            raise AttributeError(name)
        value = make(self)
        setattr(self, name, value)
        return value


def repeated_window_words(words: list[bytes], k: int = 3) -> int:
    """Words that stand in some k-word window found twice or more in the text."""
    n = len(words)
    if n <= k:
        return 0
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == n:
        return 0
    key = a[: n - k + 1].copy()
    for j in range(1, k):  # exact: window prefixes are renumbered before each further word
        if j > 1:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * len(ids) + a[j: n - k + 1 + j]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    again = np.zeros(n + 1, dtype=np.int64)
    hits = np.flatnonzero(count[back] > 1)
    np.add.at(again, hits, 1)
    np.add.at(again, hits + k, -1)
    return int(np.count_nonzero(np.cumsum(again[:n])))


def _lines(p: Page) -> tuple[int, int]:
    lines = [x for x in p.raw.split(b"\n") if x.split()]
    return len(lines), len(lines) - len(set(lines))


_COUNTS: dict[str, Callable[[Page], object]] = {
    "word_chars": lambda p: len(p.text) - sum(p.text.count(c) for c in " \t\n\x0b\x0c\r"),
    "n_symbols": lambda p: sum(p.raw.count(c.encode()) for c in SYMBOLS),
    "lines": _lines,
    "n_dup_lines": lambda p: p.lines[1],
    "n_repeat_words": lambda p: repeated_window_words(p.words),
    "top_word": lambda p: Counter(p.words).most_common(1)[0][1] if p.words else 0,
    "letters": lambda p: sum(map(str.isalpha, p.text)),
}

#: name -> rejects(page).  The first two are the base rules; the other thresholds leave room for every ordinary prose.
RULES: dict[str, Callable[[Page], bool]] = {
    "few_words": lambda p: p.n_words < 50,
    "repeated_windows": lambda p: 100 * p.n_repeat_words > 50 * p.n_words,
    "word_length": lambda p: not 2 * p.n_words <= p.word_chars <= 15 * p.n_words,
    "symbol_ratio": lambda p: 10 * p.n_symbols > p.n_words,
    "duplicate_lines": lambda p: 10 * p.n_dup_lines > 6 * p.lines[0],
    "top_word_share": lambda p: 10 * p.top_word > 2 * p.n_words,
    "letter_share": lambda p: 10 * p.letters < 5 * p.word_chars,
}


BASE = ("few_words", "repeated_windows")


def order_rules(texts: list[bytes | None], rules: dict[str, Callable[[Page], bool]]) -> list[str]:
    """Names of ``rules`` by rejection per cost, each among what those before it leave of ``texts``.

    A rule that rejected nothing keeps a chance of one half document, so cheap rules still go first.
    """
    order, rest, left = [], list(rules), texts
    while rest and left:
        best = None
        for name in rest:
            pages = [Page(t) for t in left]
            began = time.perf_counter()
            rejects = [rules[name](p) for p in pages]
            gain = (sum(rejects) + 0.5) / max(time.perf_counter() - began, 1e-9)
            if best is None or gain > best[0]:
                best = gain, name, rejects
        order.append(best[1])
        rest.remove(best[1])
        left = [t for t, gone in zip(left, best[2]) if not gone]
    return order + rest


def sample_texts(docs: DataFrame, text_col: str, rows: int = SAMPLE_ROWS) -> list[bytes | None]:
    """About ``rows`` texts (at most twice as many) drawn from the whole table, for the estimate; verdicts don't depend on which.

    Every row has the same chance, wherever it is stored; texts beyond a
    megabyte are left out, as their cost would drown the others'.
    """
    n = docs.count()
    short = docs.select(F.col(text_col).cast("binary").alias("raw")).where("raw is null or octet_length(raw) <= 1048576")
    drawn = short if n <= rows else short.sample(fraction=rows / n, seed=17)
    return [r[0] for r in drawn.limit(2 * rows).collect()]


def quality_cascade(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rules: dict[str, Callable[[Page], bool]] | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``."""
    bounded_batches(docs.sparkSession)
    rules = rules or RULES
    cascade = [rules[name] for name in order_rules(sample_texts(docs, text_col), rules)]
    base = [rules[name] for name in BASE if name in rules]
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    extra = pa.schema([(c, pa.int64()) for c in names] + [("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in text_bytes(batch, "text"):
                p = Page(raw)
                kept = not any(r(p) for r in cascade)
                rows.append((*(getattr(p, c) for c in names), not kept and any(r(p) for r in base), kept))
            for made in as_batches(rows, extra):
                yield pa.RecordBatch.from_arrays([batch.column(0), *made.columns], names=["doc_id", *extra.names])

    schema = "doc_id " + src.schema["doc_id"].dataType.simpleString() + ", " + ", ".join(
        f"{c} bigint" for c in names) + ", base_failed boolean, kept boolean"
    return src.mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_col: str = "text", rules: dict[str, Callable[[Page], bool]] | None = None) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with all their columns; one pass, no shuffle."""
    bounded_batches(docs.sparkSession)
    rules = rules or RULES
    cascade = [rules[name] for name in order_rules(sample_texts(docs, text_col), rules)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for raw in text_bytes(batch, text_col):
                p = Page(raw)
                keep.append(not any(r(p) for r in cascade))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
