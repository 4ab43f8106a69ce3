"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule: knots ``(t, weight)`` on training time 0..1,
linear between them.  Its integral, scaled to the source's target, is the
source's cumulative token demand; inverting it at a document's place in the
source gives the training position, and documents are range-sorted by position.

All of it is DataFrame expressions.  Places in a source are two-level prefix
sums: a document's bucket is the first hex digits of its order key, so a source
that holds most rows is spread over all buckets, and only bucket totals are
summed per source.

Defined results: a null text has size 0 and is never taken; the null source is
a source of its own, last in order; repeated rows are separate documents; an empty
table gives an empty mix; other columns of the input may have any name.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5           # of all words
MOST_PASSES = 2       # a source's target, and a document's copies, stop there
BUCKET_DIGITS = 3     # 16^3 buckets per source; a bucket's rows are sorted in one task and may spill

#: Knots of a source's schedule by its place in the order, repeating: the first
#: kind fades out, the second stays, the third comes in late.
SCHEDULES = (((0.0, 1.25), (1.0, 0.75)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``id, size, skey, order_key, content, bucket`` (and ``extra`` columns).

    ``skey`` is the source behind a mark that sorts the null source last, so
    keys are never null and compare by code point.
    """
    source = F.col(source_col).cast("string")
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("skey"),
        key.alias("order_key"), F.xxhash64(text_col).alias("content"),
        F.substring(key, 1, BUCKET_DIGITS).alias("bucket"), *extra)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_PASSES) -> DataFrame:
    """``skey, source_size, target, place`` from ``skey, source_size``: one row per source.

    Shares by weight, stopped at ``most`` times the source, the excess reshared
    until none is above.  Sources are filled in order of cap per weight; the
    last prefix whose level exceeds all its caps is the capped set, so no loop
    is needed.  Works on one row per source, not on documents.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     F.pmod(F.col("place"), F.lit(len(weights))).cast("int") + 1).cast("bigint")
    by_source = Window.orderBy("skey")
    s = (sizes.withColumn("place", F.row_number().over(by_source) - 1).withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * F.lit(most)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    every = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(every) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    s = s.withColumn("level", level)
    s = s.withColumn("capped", F.col("weight") * F.col("level") >= F.col("cap"))
    # levels fall from the first source that is not capped, so the largest is the one that holds
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    return s.withColumn("final", final).select(
        "skey", "source_size", "place", F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("final")).alias("target"))


def invert_schedule(u, knots) -> F.Column:
    """Training time at which the schedule through ``knots`` has spent the share ``u`` of its integral."""
    spent, parts = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        parts.append((spent, t0, w0, t1, w1))
        spent += (w0 + w1) / 2 * (t1 - t0)
    out = F.lit(None).cast("double")
    for begin, t0, w0, t1, w1 in parts:
        area, slope = u * F.lit(spent) - F.lit(begin), (w1 - w0) / (t1 - t0)
        # area = w0 x + slope x^2 / 2, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(float(w0 * w0)) + F.lit(2.0 * slope) * area, F.lit(0.0)))
        x = F.try_divide(F.lit(2.0) * area, F.lit(float(w0)) + root)  # null where nothing is spent yet
        inside = F.coalesce(F.lit(t0) + x, F.lit(t0))
        out = F.when(area >= 0, F.least(F.lit(t1), inside)).otherwise(out)
    return out


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, share: float = SHARE, most: int = MOST_PASSES, schedules=SCHEDULES,
         extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``id, size, skey, source_size, target, taken, positions`` (and ``extra`` columns).

    Pass p reads a source again from its start; a copy is taken when its middle
    lies before the source's target.  ``positions`` holds the training position
    (in words of the whole mix) of every copy taken.
    """
    src = written(sized(docs, id_col, text_col, source_col, extra), "mix-sized")
    totals = written(src.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    goal = written(targets(totals.groupBy("skey").agg(F.sum("bucket_size").alias("source_size")), weights, share, most),
                   "mix-targets")
    # at most 4,096 rows a source: where each bucket begins in its source
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).drop("bucket_size")
    offsets = written(begins.join(goal, "skey"), "mix-offsets")
    mix_size = F.lit(float(share)) * goal.agg(F.sum("source_size")).scalar()
    own = Window.partitionBy("skey", "bucket").orderBy("order_key", "id", "size", "content").rowsBetween(
        Window.unboundedPreceding, -1)
    d = src.withColumn("inner", F.coalesce(F.sum("size").over(own), F.lit(0))).join(offsets, ["skey", "bucket"])
    begin = F.col("offset") + F.col("inner")
    middles = F.array(*[begin + F.lit(p) * F.col("source_size") + F.col("size") / F.lit(2.0) for p in range(most)])
    chosen = F.when(F.col("size") > 0, F.filter(middles, lambda m: m <= F.col("target"))).otherwise(
        F.array().cast("array<double>"))
    d = d.withColumn("middles", chosen)

    def position(m):
        u = m / F.col("target")
        time = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            time = F.when(F.pmod(F.col("place"), F.lit(len(schedules))) == i, invert_schedule(u, knots)).otherwise(time)
        return time * F.col("mix_size")

    d = d.withColumn("mix_size", mix_size)
    cols = ["id", "size", "skey", "source_size", "target", (F.size("middles") * F.col("size")).cast("long").alias("taken"),
            F.transform("middles", position).alias("positions")]
    return d.select(*cols, *extra)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, once per copy taken, range-sorted by training position.

    Numbers alone go through the plan; whole rows move twice, to their
    positions and to their place in the order.
    """
    rows = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                               F.monotonically_increasing_id().alias("rid")), "mix-rows")
    slim = rows.select("rid", *[F.col("row").getField(c).alias(k) for c, k in ((id_col, "id"), (text_col, "text"), (source_col, "source"))])
    p = plan(slim, "id", "text", "source", extra=("rid",), **options)
    copies = written(p.select("rid", "id", F.explode("positions").alias("position")), "mix-positions")
    return rows.join(copies.hint("merge"), "rid").orderBy("position", "id").select("row.*")


def dealt(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options):
    """``(documents, order)``, both written but for the last join.

    ``order`` has ``rid, id, size, position`` of every copy taken, range-sorted
    by training position.  ``documents`` has one row per document: ``id, size,
    skey, source_size, target`` and from its copies found in ``order``
    ``taken``, their words, and ``first_position, last_position``.  Texts don't
    move; ``mix`` moves them.
    """
    p = written(plan(docs, id_col, text_col, source_col, **options).drop("taken")
                .withColumn("rid", F.monotonically_increasing_id()), "mix-plan")
    order = written(p.select("rid", "id", "size", F.explode("positions").alias("position")).orderBy("position", "id"), "mix-order")
    copies = order.groupBy("rid").agg(F.sum("size").alias("words"), F.min("position").alias("first_position"),
                                      F.max("position").alias("last_position"))
    rows = p.join(copies.hint("merge"), "rid", "left")
    return rows.select("id", "size", "skey", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
                       "first_position", "last_position"), order
