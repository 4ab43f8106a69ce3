"""Line dedup by content-defined line chunks, in DataFrame expressions only.

A rolling hash over the hashes of the last two lines decides after which lines
a chunk ends, so a passage of lines is cut alike wherever it stands, and lines
added before or after it move no boundary inside.  Chunks of two lines or more
are compared over all documents: keys that occur once are put aside, what is
left is grouped by its bytes, and every occurrence but the first is removed.
The first is that in the smallest document id, then the earliest in its text.

Defined results: a null text stays null and has no lines; an empty text has
one empty line; chunks without a word are never removed; repeated rows are
separate documents, one of which counts as first; a null id ranks below all
others; an empty table gives an empty result; other columns may have any name.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: A chunk ends where the rolling hash's first hex digit is at most this: a quarter of the lines.
LAST_DIGIT = "3"
LEAST_LINES = 2


def _md5(c) -> F.Column:
    return F.md5(c.cast("binary"))


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written: ``rid, id, lines, starts, keys`` per row.

    ``starts`` are the first lines (from 1) of the chunks and one place beyond
    the last; ``keys`` the md5 of each chunk that can be removed, else null.
    """
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                    F.split(F.col(text_col), "\n").alias("lines"))
    d = d.select("*", F.transform("lines", _md5).alias("hashes"))
    n = F.size("hashes")
    ends = F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.substring(_md5(F.concat(
        F.when(i > 1, F.element_at("hashes", F.greatest(i - 1, F.lit(1)))).otherwise(F.lit("")),
        F.element_at("hashes", i))), 1, 1) <= LAST_DIGIT)
    inner = F.when(n >= 2, F.transform(ends, lambda i: i + 1)).otherwise(F.array().cast("array<int>"))
    d = d.select("rid", "id", "lines", F.when(F.col("lines").isNotNull(), F.concat(
        F.array(F.lit(1)), inner, F.array(n + 1))).alias("starts"))
    text = lambda k: F.array_join(F.slice("lines", F.element_at("starts", k), _length(k)), "\n")
    keys = F.transform(F.sequence(F.lit(1), F.greatest(F.size("starts") - 1, F.lit(1))), lambda k: F.when(
        (_length(k) >= LEAST_LINES) & F.exists(F.slice("lines", F.element_at("starts", k), _length(k)), _has_word),
        _md5(text(k))))
    return written(d.select("*", F.when(F.col("lines").isNotNull(), keys).alias("keys")), "line-chunks")


def _has_word(line) -> F.Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _length(k) -> F.Column:
    return F.element_at("starts", k + 1) - F.element_at("starts", k)


def marked(chunks: DataFrame) -> DataFrame:
    """Written: ``rid, id, lines, starts, maybe``: the chunks (from 1) whose key stands elsewhere too, null for none.

    Keys move alone until here; this is the one time that every text moves.
    The join is the same at every size.
    """
    keys = chunks.select("rid", F.posexplode("keys").alias("k", "key")).where("key is not null")
    again = written(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated-keys")
    maybe = keys.join(again, "key", "left_semi").groupBy("rid").agg(F.collect_list("k").alias("maybe"))  # of one text
    return written(chunks.select("rid", "id", "lines", "starts").join(maybe.hint("merge"), "rid", "left"), "marked-chunks")


def repeats(found: DataFrame) -> DataFrame:
    """``rid, removed``: the chunks whose bytes stand earlier in the corpus, from rows of ``marked``."""
    begin = F.element_at("starts", F.col("k") + 1)
    chunk = F.array_join(F.slice("lines", begin, F.element_at("starts", F.col("k") + 2) - begin), "\n")
    spots = found.select("rid", "id", "lines", "starts", F.explode("maybe").alias("k")).select("rid", "id", "k", chunk.alias("chunk"))
    spots = written(spots.withColumn("key", _md5(F.col("chunk"))), "repeated-chunks")
    # grouped by the bytes themselves; copies collapse in each map task
    first = written(spots.groupBy("key", "chunk").agg(F.min(F.struct("id", "rid", "k")).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("key", "chunk", F.col("first.rid").alias("r1"), F.col("first.k").alias("k1")), "first-chunks")
    later = spots.join(first.hint("merge"), ["key", "chunk"]).where("rid <> r1 or k <> k1")
    return later.groupBy("rid").agg(F.collect_set("k").alias("removed"))


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, text`` without its repeated chunks, ``n_lines, removed_lines, removed_chunks``."""
    table = marked(chunked(docs, id_col, text_col))
    hit = table.where("maybe is not null")
    gone_from = written(repeats(hit), "removals")
    some = hit.join(gone_from.hint("merge"), "rid", "left").drop("maybe")
    rest = table.where("maybe is null").withColumn("maybe", F.lit(None).cast("array<int>")).withColumnRenamed("maybe", "removed")
    d = some.unionByName(rest)
    every = F.sequence(F.lit(0), F.greatest(F.size("starts") - 2, F.lit(0)))
    length = lambda k: F.element_at("starts", k + 2) - F.element_at("starts", k + 1)
    left = F.filter(every, lambda k: ~F.array_contains("removed", k))
    kept = F.flatten(F.transform(left, lambda k: F.slice("lines", F.element_at("starts", k + 1), length(k))))
    gone = F.aggregate("removed", F.lit(0), lambda x, k: x + length(k))
    none = F.col("removed").isNull()
    return d.select(
        F.col("id").alias("doc_id"),
        F.when(none, F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.when(none, F.lit(0)).otherwise(gone).cast("long").alias("removed_lines"),
        F.when(none, F.lit(0)).otherwise(F.size("removed")).cast("long").alias("removed_chunks"))


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``rid, later``: the places (from 1) of the windows of two lines that stand earlier in the corpus, from ``rid, id, lines``."""
    n = F.size("lines")
    window = lambda i: F.concat_ws("\n", F.element_at("lines", i), F.element_at("lines", i + 1))
    keys = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.when(
        _has_word(window(i)), F.substring(F.unhex(F.sha2(window(i), 256)), 1, 16)))
    every = rows.where(n >= 2).select("rid", "id", F.posexplode(keys).alias("i", "key")).where("key is not null")
    # copies collapse in each map task
    first = written(every.groupBy("key").agg(F.min(F.struct("id", "rid", "i")).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("key", F.col("first.rid").alias("r1"), F.col("first.i").alias("i1")), "first-windows")
    later = every.select("rid", "i", "key").join(first.hint("merge"), "key").where("rid <> r1 or i <> i1")
    return later.groupBy("rid").agg(F.collect_set(F.col("i") + 1).alias("later"))


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, text`` without its repeated passages, ``n_lines, removed_lines, removed_passages``.

    A passage is a run of two lines or more.  Every window of two adjacent
    lines is compared, so no choice of boundaries can miss one: a line goes if
    a window that holds it stands earlier, and each line's first place in a
    repeated window stays.  Windows without a word are not compared; windows
    are equal if 128 bits of their SHA-256 are.  Lines repeated alone stay.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                               F.split(F.col(text_col), "\n").alias("lines")), "passage-lines")
    d = rows.join(written(repeated_windows(rows), "later-windows").hint("merge"), "rid", "left")
    none = F.col("later").isNull()
    gone = F.array_union("later", F.transform("later", lambda i: i + 1))
    d = d.withColumn("gone", F.when(none, F.array().cast("array<int>")).otherwise(gone))
    kept = F.filter("lines", lambda x, i: ~F.array_contains("gone", i + 1))
    return d.select(
        F.col("id").alias("doc_id"),
        F.when(none, F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("removed_lines"),
        F.size(F.filter("gone", lambda i: ~F.array_contains("gone", i - 1))).cast("long").alias("removed_passages"))
