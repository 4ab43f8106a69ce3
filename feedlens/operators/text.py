"""Text preparation: clean, stopwords, length filter, dedup, phrases.

All steps are narrow projections/filters except ``dedup_first`` (one shuffle
keyed by the cleaned text, with map-side partial aggregation so a hot group of
copies collapses before it is shuffled) and the phrase operators.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WORD_TOKEN_ANY, WS_CLASS, clean_text, strip_ws, word_tokens, ws_tokens

# The default domain stopwords, removed after segmentation.
DEFAULT_STOPWORDS = (
    "và", "những", "có", "vậy", "không", "gì", "nên", "ko", "shop", "cụ",
    "thể", "đã", "hay", "là", "tới", "được", "thì", "đây", "mặc", "buôn",
    "nhưng", "rồi", "k", "quá", "trời", "ạ", "thôi", "như", "z", "đc",
    "r", "sao", "hơi", "v", "mik", "sốp", "á", "hi", "chúc",
)

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_stopwords_col(c, stopwords: Iterable[str] = DEFAULT_STOPWORDS, assume_clean: bool = False) -> Column:
    """Whitespace tokens not in ``stopwords``, re-joined by one space.

    ``assume_clean``: the input is already collapsed to single spaces (output of
    ``clean_text``), so a literal split on " " gives the same tokens faster.
    """
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(stopwords)]) if stopwords else None
    if assume_clean:
        toks = F.filter(F.split(_col(c), " "), lambda t: t != F.lit(""))
    else:
        toks = ws_tokens(c)
    if stop is not None:
        toks = F.filter(toks, lambda t: ~F.array_contains(stop, t))
    return F.array_join(toks, " ")


def remove_stopwords(df: DataFrame, stopwords: Iterable[str] | DataFrame = DEFAULT_STOPWORDS,
                     col: str = "clean", out: str | None = None, id_col: str = "doc_id",
                     assume_clean: bool = False) -> DataFrame:
    """Exact-token stopword removal on an already segmented column.

    ``stopwords`` is a list (an array literal in the expression) or a
    one-column DataFrame ``word`` (tokens are exploded, anti-joined as the
    planner sees fit, and put together again in order).
    """
    out = out or col
    if not isinstance(stopwords, DataFrame):
        return df.withColumn(out, remove_stopwords_col(col, list(stopwords), assume_clean))
    words = stopwords.select("word").distinct()
    toks = df.select(id_col, F.posexplode(ws_tokens(col)).alias("pos", "word"))
    kept = toks.join(words, "word", "left_anti")
    rebuilt = kept.groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda s: s["word"]), " ").alias("__kept")
    )
    return (df.join(rebuilt, id_col, "left")
              .withColumn(out, F.coalesce(F.col("__kept"), F.lit("")))
              .drop("__kept"))


def remove_stopwords_words(df: DataFrame, stopwords: Iterable[str] = DEFAULT_STOPWORDS,
                           col: str = "text", out: str = "clean") -> DataFrame:
    """Notebook variant: lowercase, keep ``\\b\\w+\\b`` tokens, drop stopwords, join by space."""
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(stopwords)])
    toks = word_tokens(col, WORD_TOKEN_ANY)
    return df.withColumn(out, F.array_join(F.filter(toks, lambda t: ~F.array_contains(stop, t)), " "))


def min_chars_predicate(c, min_chars: int) -> Column:
    """Not blank, and at least ``min_chars`` characters once ``_`` reads as a space.

    Swapping ``_`` for a space keeps the character count, so the length is
    taken directly; "not blank" is a search for one non-whitespace character
    (stops at the first hit instead of rewriting the text).
    """
    x = _col(c)
    return F.regexp_like(x, F.lit("[^" + WS_CLASS[1:])) & (F.length(x) >= F.lit(min_chars))


def keep_rows(df: DataFrame, predicate) -> DataFrame:
    """``df.filter(predicate(row))`` evaluated on already computed columns.

    A plain ``filter`` on a computed column is pushed below its projection
    with the column's expression inlined, so an expensive expression (regex
    cleaning of whole texts) would run once per reference.  Filtering inside
    a one-element array and re-inlining it (a Generate, which predicates are
    not pushed through) evaluates the projection exactly once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.filter(F.array(row), predicate)))


def filter_min_chars(df: DataFrame, min_chars: int = 3, col: str = "clean") -> DataFrame:
    """Drop blank rows and rows shorter than ``min_chars`` (underscore counted as a space)."""
    return keep_rows(df, lambda r: min_chars_predicate(r[col], min_chars))


def dedup_first(df: DataFrame, key: str = "clean", order: str = "doc_id") -> DataFrame:
    """Exact dedup on ``key`` keeping the row with the smallest ``order``.

    ``min(struct(order, ...))`` is a total order, so the survivor is defined
    (``dropDuplicates`` keeps an arbitrary one).  Rows are grouped by the
    SHA-256 of the key, so sorts and hashes see 32 bytes and not whole texts;
    partial aggregation collapses copies inside each map task.
    """
    others = [c for c in df.columns if c != order]
    packed = F.min(F.struct(F.col(order), *[F.col(c) for c in others])).alias("__first")
    return (df.groupBy(F.sha2(F.encode(F.col(key), "utf-8"), 256).alias("__key")).agg(packed)
              .select(*[F.col("__first")[c].alias(c) for c in df.columns]))


def preprocess(df: DataFrame, *, lowercase: bool = True, min_chars: int = 3, dedup: bool = True,
               stopwords: Iterable[str] | DataFrame | None = DEFAULT_STOPWORDS,
               lexicon: DataFrame | None = None, text_col: str = "text", id_col: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """clean -> (segment) -> stopwords -> length filter -> dedup.  Returns (id, text, clean), or (id, clean)."""
    out = df.select(id_col, text_col).withColumn("clean", clean_text(text_col, lowercase))
    if lexicon is not None:
        from .phrases import segment_words
        out = segment_words(out, lexicon, col="clean", id_col=id_col)
    if stopwords:
        out = remove_stopwords(out, stopwords, col="clean", id_col=id_col, assume_clean=lexicon is None)
    out = filter_min_chars(out if keep_text else out.drop(text_col), min_chars, "clean")
    if dedup:
        out = dedup_first(out, "clean", id_col)
    return out
