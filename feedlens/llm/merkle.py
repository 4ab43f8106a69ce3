"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf.  Leaves of a group (a language) stand in ascending id and
are numbered from 0, so a node's siblings have computed places: its run of
ARITY places, shifted by slot offsets 1..ARITY-1 around the run.  At each level
the nodes are equijoined with themselves on ``(group, place of the sibling)``;
the rows of slot zero, which so hold their whole run, emit the parents.  A node
at place 0 that finds no sibling is its group's subroot.  Subroots are numbered
in the order of their groups and folded in the same way into the root.

The siblings found on the way up are the proofs.  They go down again level by
level, a parent's chain to its children, and each row's chain is folded from
its own (or a tampered) leaf.  Only digests move, never texts; groups are
numbered by a range sort, so a group that holds most rows is spread over all
tasks, and no join has a key with more than ARITY rows.

Defined results: a null column counts as the mark ``-`` in its leaf, an empty
text as ``0:``; null ids come first in their group, the null group first of
all; a null id counts as the empty text where crc32 decides; rows with equal
ids stand in the order of their leaves, equal rows are leaves of their own; one
row alone is subroot and root at once; an empty table gives an empty result;
other columns may have any name.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_remainder, written

ARITY = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(c: Column) -> Column:
    """A value as bytes that can't run into the next one: ``-`` for null, else byte count, ``:``, value."""
    raw = c.cast("string")
    return F.when(raw.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(raw).cast("string"), F.lit(":"), raw))


def leaf(columns: list[Column]) -> Column:
    """The 32 bytes of a row's digest."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def as_hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def joined(digests: Column) -> Column:
    """An array of digests as one hex text."""
    return F.array_join(F.transform(digests, as_hex), "")


def numbered(leaves: DataFrame) -> DataFrame:
    """Written: ``leaves`` (``g, id, digest, ...``) with ``idx``, their place (from 0) in their group.

    A range sort, then per task and group a count; a group's places are offset
    by the counts of the tasks before, one row for each task that it is in.
    """
    s = written(leaves.orderBy("g", F.col("id").asc_nulls_first(), "digest").select(
        "*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid")), "merkle-sorted")
    part = s.groupBy("g", "pid").agg(F.count("*").alias("c"), F.min("mid").alias("first"))
    before = Window.partitionBy("g").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select("g", "pid", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return s.join(offsets, ["g", "pid"]).withColumn("idx", F.col("mid") + F.col("shift")).drop("pid", "mid", "shift")


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """Written: ``nodes`` (``g, idx, digest, ...``) with ``sibs``: the digests of the run's others, left to right."""
    carried = [c for c in nodes.columns if c not in ("g", "idx")]
    slot = F.pmod("idx", F.lit(arity))
    # every node under the places of its siblings: slot offsets within its run
    shifted = nodes.select("g", "idx", "digest", F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("o")).select(
        "g", (F.col("idx") - slot + F.pmod(slot + F.col("o"), F.lit(arity))).alias("at"), slot.cast("int").alias("slot"),
        F.col("digest").alias("sib"))
    met = nodes.join(shifted.withColumnRenamed("at", "idx"), ["g", "idx"], "left")
    # the join's partitioning serves the grouping; at most arity - 1 rows a node
    found = met.groupBy("g", "idx", *carried).agg(F.sort_array(F.collect_list(
        F.when(F.col("slot").isNotNull(), F.struct("slot", "sib")))).alias("s"))
    return written(found.select("g", "idx", *carried, F.col("s.sib").alias("sibs")), "merkle-level")


def alone() -> Column:
    """True for a node that is all that remains of its group."""
    return (F.col("idx") == 0) & (F.size("sibs") == 0)


def levels(nodes: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """The levels of every group's tree, from the leaves up, each with ``sibs``; log_arity of the largest group many."""
    out = [with_siblings(nodes, arity)]
    while True:
        runs = out[-1].where((F.pmod("idx", F.lit(arity)) == 0) & ~alone())
        if runs.isEmpty():
            return out
        parent = F.sha2(F.concat(as_hex(F.col("digest")), joined(F.col("sibs"))).cast("binary"), 256)
        out.append(with_siblings(runs.select("g", F.floor(F.col("idx") / arity).alias("idx"), F.unhex(parent).alias("digest")), arity))


def chained(tree: list[DataFrame], top: DataFrame, arity: int = ARITY) -> DataFrame:
    """The lowest level of ``tree`` with ``chain`` and ``subroot``.

    ``chain`` lists, from the node to the root, its slot and its siblings in
    each run; ``top`` has ``g, subroot, rest``: what the chain of a group's last
    node goes on with.  Chains go down a level at a time, a parent's to its
    children.
    """
    step = lambda: F.struct(F.pmod("idx", F.lit(arity)).cast("int").alias("slot"), F.col("sibs").alias("sibs"))
    above = None
    for k in range(len(tree) - 1, -1, -1):
        level = tree[k]
        own = [c for c in level.columns if c not in ("g", "idx", "sibs")]
        last = level.where(alone()).join(top, "g").select("g", "idx", *own, F.col("rest").alias("chain"), "subroot")
        below = last
        if above is not None:
            parents = above.select("g", F.col("idx").alias("up"), F.col("chain").alias("rest"), "subroot")
            inner = level.where(~alone()).withColumn("up", F.floor(F.col("idx") / arity)).join(parents, ["g", "up"])
            below = last.unionByName(inner.select("g", "idx", *own, F.concat(F.array(step()), "rest").alias("chain"), "subroot"))
        above = written(below, "merkle-chains") if k else below
    return above


def folded(start: Column, chain: Column) -> Column:
    """Hex of the root recomputed from a leaf's hex and its chain."""
    def up(cur, c):
        sibs = c["sibs"]
        left = F.slice(sibs, F.lit(1), c["slot"])
        right = F.slice(sibs, c["slot"] + 1, F.greatest(F.size(sibs) - c["slot"], F.lit(0)))
        return F.sha2(F.concat(joined(left), cur, joined(right)).cast("binary"), 256)
    return F.aggregate(chain, start, up)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns=COLUMNS, text_col: str = "text",
             arity: int = ARITY) -> DataFrame:
    """Per row: ``id, leaf, tampered, subroot, root`` (32 bytes each) and ``chain``, the proof from the leaf to the root.

    ``tampered`` is the leaf with the text's A-Z in lower case where 3 divides
    the crc32 of the id, else the leaf.
    """
    group = F.col(group_col).cast("string")
    other = [F.translate(F.col(c), _UPPER, _UPPER.lower()) if c == text_col else F.col(c) for c in columns]
    leaves = written(docs.select(
        F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group)).alias("g"), F.col(id_col).alias("id"),
        leaf([F.col(c) for c in columns]).alias("digest"),
        F.when(crc32_remainder(id_col, 3) == 0, leaf(other)).alias("changed")), "merkle-leaves")
    tree = levels(numbered(leaves), arity)
    subroots = None
    for level in tree:
        done = level.where(alone()).select("g", "digest")
        subroots = done if subroots is None else subroots.unionByName(done)
    # the groups' own tree: one group, in the order of their keys
    roots = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("id"), "digest"))
    upper = levels(roots, arity)
    whole = F.array().cast("array<struct<slot:int,sibs:array<binary>>>")
    crown = upper[-1].where(alone()).select("g", F.col("digest").alias("subroot"), whole.alias("rest"))
    top = chained(upper, crown, arity).select(F.col("id").alias("g"), F.col("digest").alias("subroot"), F.col("chain").alias("rest"))
    rows = chained(tree, written(top, "merkle-subroots"), arity)
    root = upper[-1].where(alone()).agg(F.max("digest")).scalar()
    return rows.select("id", F.col("digest").alias("leaf"), F.coalesce("changed", "digest").alias("tampered"), "subroot",
                       root.alias("root"), "chain")


def verified(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``; digests in hex."""
    m = manifest(docs, **options)
    proof = F.sha2(joined(F.flatten(F.col("chain.sibs"))).cast("binary"), 256)
    out = m.select(F.col("id").alias("doc_id"), *[as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                   proof.alias("proof_sha256"), folded(as_hex(F.col("tampered")), F.col("chain")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
