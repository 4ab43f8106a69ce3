"""Phrase learning and word segmentation (multi-word units joined by "_").

``learn_phrases`` scores adjacent token pairs with
``(n_ab - delta) * N / (n_a * n_b)`` (Mikolov et al. 2013): two counting
aggregates and two joins.  ``learn_lexicon`` repeats it on text that is already
segmented, so that units of up to ``max_len`` tokens form.  ``segment_words``
takes, from left to right, the longest unit of the lexicon that begins at each
token; punctuation marks are tokens of their own and stay.

A lexicon of at most LEXICON_BYTES goes to every task, and texts are segmented
where they are read, in Arrow batches: nothing is shuffled.  The n-grams of a
document meet a larger one in a join; only the choice among its overlapping
matches is a loop then.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_TOKEN_ANY, word_tokens
from ..session import cut_lineage, scratch_but_last

#: A run of word characters, or one mark that is neither that nor white space.
UNIT_TOKEN = r"(?U)\w+|[^\w\s]"
MAX_LEN = 4
PASSES = 2
LEXICON_BYTES = 16 << 20   # of phrases that are sent to every task
ROWS = 256   # texts whose tokens are Python objects at a time


def _pairs(tokens: DataFrame) -> DataFrame:
    """(a, b) of adjacent tokens, from ``t``."""
    idx = F.sequence(F.lit(0), F.size("t") - 2)
    return (tokens.filter(F.size("t") >= 2)
                  .select(F.explode(F.transform(idx, lambda i: F.struct(F.col("t")[i].alias("a"), F.col("t")[i + 1].alias("b")))).alias("p"))
                  .select("p.a", "p.b"))


def _scored(tokens: DataFrame, min_count: int, delta: float, threshold: float, word=None) -> DataFrame:
    """(a, b, n_ab, score) of the pairs of ``t`` that pass, counting only tokens for which ``word`` holds."""
    uni = tokens.select(F.explode("t").alias("w"))
    pairs = _pairs(tokens)
    if word is not None:
        uni, pairs = uni.where(word(F.col("w"))), pairs.where(word(F.col("a")) & word(F.col("b")))
    uni = cut_lineage(uni.groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    total = uni.agg(F.sum("n")).scalar()
    bi = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_ab")).filter(F.col("n_ab") >= min_count)
    j = (bi.join(uni.select(F.col("w").alias("a"), F.col("n").alias("n_a")), "a")
           .join(uni.select(F.col("w").alias("b"), F.col("n").alias("n_b")), "b"))
    score = (F.col("n_ab") - F.lit(delta)) * total / (F.col("n_a") * F.col("n_b"))
    return j.select("a", "b", "n_ab", score.alias("score")).filter(F.col("score") > threshold)


def learn_phrases(df: DataFrame, min_count: int = 5, delta: float = 5.0, threshold: float = 10.0,
                  col: str = "clean", id_col: str = "doc_id") -> DataFrame:
    """(a, b, phrase, n_ab, score) for pairs with ``n_ab >= min_count`` and ``score > threshold``; punctuation is passed over."""
    tokens = cut_lineage(df.select(word_tokens(col, WORD_TOKEN_ANY).alias("t")))  # read by both counts
    return _scored(tokens, min_count, delta, threshold).select("a", "b", F.concat_ws("_", "a", "b").alias("phrase"), "n_ab", "score")


def _tokens(df: DataFrame, col: str) -> DataFrame:
    """The columns of ``df``, ``__rid`` and ``__t``, its tokens with marks."""
    text = F.coalesce(F.col(col), F.lit(""))
    return df.withColumns({"__rid": F.monotonically_increasing_id(), "__t": F.regexp_extract_all(text, F.lit(UNIT_TOKEN), 0)})


def _matches(tokens: DataFrame, lexicon: DataFrame, max_len: int) -> DataFrame:
    """``__rid, __m``: begin and length of every unit of ``lexicon(phrase)`` in the tokens, upper or lower case."""
    n = F.size("__t")
    at = lambda i, k: F.struct(i.alias("i"), k.alias("k"), F.lower(F.array_join(F.slice("__t", i + 1, k), " ")).alias("phrase"))
    grams = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(
        F.sequence(F.lit(2), F.least(F.lit(max_len), n - i)), lambda k: at(i, k))))
    every = tokens.where(n >= 2).select("__rid", F.explode(grams).alias("g")).select("__rid", "g.i", "g.k", "g.phrase")
    hit = every.join(lexicon.select("phrase").distinct(), "phrase", "left_semi")
    return hit.groupBy("__rid").agg(F.collect_list(F.struct("i", "k")).alias("__m"))  # of one text


def _units(tokens: DataFrame, lexicon: DataFrame, max_len: int, glue: str) -> DataFrame:
    """``tokens`` with ``__u``: its units, the longest match first from left to right."""
    phrases = cut_lineage(lexicon.select("phrase").where("phrase is not null").distinct())
    if (phrases.agg(F.sum(F.octet_length("phrase") + 8)).first()[0] or 0) <= LEXICON_BYTES:
        return _units_of_few(tokens, phrases, max_len, glue)
    tokens = cut_lineage(tokens)  # its ``__rid`` is read twice
    d = tokens.join(_matches(tokens, lexicon, max_len), "__rid", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            t, m = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__t", "__m"))
            units = []
            for toks, found in zip(t, m):
                out, at = [], 0
                for i, k in sorted(((x["i"], x["k"]) for x in found or []), key=lambda x: (x[0], -x[1])):
                    if i >= at:
                        out += toks[at:i]
                        out.append(glue.join(toks[i: i + k]))
                        at = i + k
                units.append(out + toks[at:])
            keep = [c for c in batch.schema.names if c not in ("__t", "__m")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(units, pa.list_(pa.string()))],
                                             names=[*keep, "__u"])

    kept = d.drop("__t", "__m")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "__u array<string>"])
    return d.mapInArrow(run, schema)


def _units_of_few(tokens: DataFrame, phrases: DataFrame, max_len: int, glue: str) -> DataFrame:
    """``_units`` with a lexicon that every task holds."""
    known: dict[str, set] = {}   # phrases by their first two tokens
    for r in phrases.collect():  # at most LEXICON_BYTES
        words = r["phrase"].split(" ")
        if 2 <= len(words) <= max_len:
            known.setdefault(" ".join(words[:2]), set()).add(tuple(words))
    sent = tokens.sparkSession.sparkContext.broadcast({k: sorted(v, key=len, reverse=True) for k, v in known.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            t, low = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__t", "__l"))
            units = []
            for toks, text in zip(t, low):
                out, at, lower = [], 0, text.split(" ")
                for i, pair in enumerate(map("{} {}".format, lower, lower[1:])):
                    if i >= at and pair in known:
                        for words in known[pair]:
                            if tuple(lower[i: i + len(words)]) == words:
                                out += toks[at:i]
                                out.append(glue.join(toks[i: i + len(words)]))
                                at = i + len(words)
                                break
                units.append(out + toks[at:])
            keep = [c for c in batch.schema.names if c not in ("__t", "__l")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(units, pa.list_(pa.string()))],
                                             names=[*keep, "__u"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.drop("__t").schema), "__u array<string>"])
    return tokens.withColumn("__l", F.lower(F.array_join("__t", " "))).mapInArrow(run, schema)


def learn_lexicon(df: DataFrame, max_len: int = MAX_LEN, passes: int = PASSES, min_count: int = 5, delta: float = 5.0,
                  threshold: float = 10.0, col: str = "clean") -> DataFrame:
    """(phrase, n_tokens): units of 2 to ``max_len`` lower-case tokens joined by spaces, for ``segment_words``.

    Each pass segments with the units found before and scores pairs of units
    that stand side by side with no mark between, so ``passes`` 2 reaches four
    tokens.
    """
    word = lambda w: w.rlike(r"(?U)^\w")
    lex = None
    with scratch_but_last(df.sparkSession):
        base = cut_lineage(_tokens(df.select(F.lower(F.col(col)).alias("clean")), "clean").drop("clean"))
        for _ in range(passes):
            now = base.select(F.col("__t").alias("t")) if lex is None else cut_lineage(_units(base, lex, max_len, " ").select(F.col("__u").alias("t")))
            new = _scored(now, min_count, delta, threshold, word).select(F.concat_ws(" ", "a", "b").alias("phrase"))
            new = new.select("phrase", F.size(F.split("phrase", " ")).alias("n_tokens")).where(F.col("n_tokens") <= max_len)
            lex = cut_lineage(new if lex is None else lex.unionByName(new).distinct())
    return lex


def segment_words(df: DataFrame, lexicon: DataFrame, col: str = "clean", id_col: str = "doc_id", out: str | None = None,
                  max_len: int = MAX_LEN) -> DataFrame:
    """``df`` with ``out`` (``col`` unless named): its tokens joined by spaces, units of the lexicon by "_".

    ``lexicon`` has ``phrase`` (tokens joined by spaces), or ``a, b`` from
    ``learn_phrases``.  A null text counts as empty.
    """
    phrase = F.concat_ws(" ", "a", "b") if {"a", "b"} <= set(lexicon.columns) else F.col("phrase")
    done = _units(_tokens(df, col), lexicon.select(F.lower(phrase).alias("phrase")), max_len, "_")
    return done.withColumn(out or col, F.array_join("__u", " ")).drop("__rid", "__u")
