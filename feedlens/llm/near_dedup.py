"""MinHash near-dedup by a signature-coordinate inverted join.

A document's set is its distinct five-word shingles (ASCII letters lower-cased).
Equal sets form a class, which is one node however many copies it has.  Each
class is posted under its signature's coordinate-value pairs, rarest first:
two signatures that agree in at least MATCHES of COORDINATES places must share
one of the COORDINATES - MATCHES + 1 rarest places of either (the prefix), so
only those are posted, and values that occur once are skipped.  Collisions are
counted for pairs that meet in a list; pairs at or above the match threshold
are confirmed on their full shingle sets.

A list is not expanded into all its pairs.  In each of the hub rounds every
member of a list meets some of its members (``hub_pairs``); classes that are linked by then are one
component, a pair inside a component can't change the result, and lists that
lie in one component are closed, as are those in which hubs met everybody.  What is left are pairs between different
components in one list.  Those are dealt out in blocks of members outside the
list's largest component against blocks of all its members, a bounded number
of blocks a list until a block is as large as a task can hold.  Blocks hold
signatures; only for members that agree with somebody do texts travel to the
block, where full sets are compared, and only links leave it.  So no link
between components is lost, up to the chance that a pair with similarity 0.75
agrees in fewer than MATCHES places (2e-7, were the coordinates independent).

Sets are compared by 64-bit hashes of their shingles; two shingles of a pair of
texts of a million words share one with a chance of 1e-7.

Defined results: documents without words have an empty set, link with nothing
and are kept; a document with fewer than five words has its whole sequence as
its one shingle; rows repeating an id are one document if their sets are equal;
rows without an id take part like others, are told apart by their texts, name a
component (as null) only if none of it has an id, and one text of them is kept
then; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, discard, text_bytes, written

WORDS = 5
SIMILARITY = (75, 100)
COORDINATES, MATCHES = 48, 20
HUBS = (2, 16)   # of a list, in each hub round: in the later ones most members have left
HUBS_OF_LARGE = 4        # of a list of more members than hubs can meet all of
MEETS = 8                # hubs of large lists that a member meets in a round
BLOCK = 256      # members compared at a time in a task
SHARES = 8       # blocks on each side of a list, while blocks hold
MOST_BLOCK = 8192        # members and
MOST_WORDS = 4_000_000   # words at most
_SEED = 20240229
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(_SEED)
_FACTORS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def _word_hash(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def shingle_set(raw: bytes | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; the whole sequence for fewer words."""
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    w = _word_hash(words)
    n = len(w) - k + 1
    s = w[:n].copy()
    for j in range(1, k):
        s *= _MIX
        s ^= s >> np.uint64(29)
        s += w[j: n + j]
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(s: np.ndarray) -> np.ndarray:
    """The minimum of each of COORDINATES random linear maps of the set, as int64.

    A minimum of n hashes lies near 2^64 / n, so it is mixed once more, with its
    coordinate: all 64 bits then tell values apart, also those of two coordinates.
    """
    least = None
    for at in range(0, len(s), 1024):
        part = (s[None, at: at + 1024] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return _mixed(least ^ _SHIFTS).view(np.int64)


def class_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def nameless(id_col, text_col):
    """What tells rows without an id apart: null for rows that have one."""
    return F.when(id_col.isNull(), F.md5(F.coalesce(text_col, F.lit("")).cast("binary")))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written: ``id, mark, n, cls, sig`` per row; ``cls`` names the shingle set, null for an empty one."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), nameless(F.col(id_col), F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, sig = [], [], []
            for raw in text_bytes(batch, "text"):
                s = shingle_set(raw)
                n.append(len(s))
                cls.append(class_key(s) if len(s) else None)
                sig.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.list_(pa.int64()))],
                names=["id", "mark", "n", "cls", "sig"])

    kind = src.schema["id"].dataType.simpleString()
    return written(src.mapInArrow(run, f"id {kind}, mark string, n bigint, cls binary, sig array<bigint>"), "signatures")


def prefix_postings(classes: DataFrame) -> DataFrame:
    """``coord, value, num, n``: each class under its rarest shared coordinate values, values that occur once skipped."""
    every = classes.select("num", F.posexplode("sig").alias("coord", "value"))
    shared = written(every.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "coordinate-counts")
    own = every.join(shared, "value").groupBy("num").agg(
        F.sort_array(F.collect_list(F.struct("df", "coord", "value"))).alias("all"))  # at most COORDINATES a class
    # the coordinates that nothing else has come first in the prefix
    room = F.lit(COORDINATES - MATCHES + 1) - (F.lit(COORDINATES) - F.size("all"))
    kept = own.where(room > 0).select("num", F.explode(F.slice("all", 1, room)).alias("p"))
    post = written(kept.select(F.col("p.coord").alias("coord"), F.col("p.value").alias("value"), "num"), "prefixes")
    # near copies share most of their lists: of lists with the same members one is enough; members are told by two sums of hashes
    sets = post.groupBy("value").agg(F.count("*").alias("m"), F.sum(F.xxhash64("num").cast("decimal(20,0)")).alias("s1"),
                                     F.sum(F.xxhash64(F.lit(1), "num").cast("decimal(20,0)")).alias("s2")).where("m > 1")
    one = sets.groupBy("m", "s1", "s2").agg(F.min("value").alias("value")).select("value")
    return post.join(one, "value", "left_semi").join(classes.select("num", "n"), "num").select("coord", "value", "num", "n")


def confirm(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures agree often enough and whose full sets reach the similarity.

    ``nodes`` has ``num, sig`` and ``texts`` has ``num, text`` once per class.
    Collisions are counted before any text moves.
    """
    sig = nodes.select("num", "sig")
    near = (pairs.join(sig.withColumnsRenamed({"num": "a", "sig": "sa"}), "a")
            .join(sig.withColumnsRenamed({"num": "b", "sig": "sb"}), "b"))
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    near = near.where(agree >= MATCHES).select("a", "b")
    both = (near.join(texts.withColumnsRenamed({"num": "a", "text": "ta"}), "a")
            .join(texts.withColumnsRenamed({"num": "b", "text": "tb"}), "b"))
    num, den = SIMILARITY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[int, np.ndarray] = {}
        for batch in batches:
            hit = []
            for a, b, ta, tb in zip(*(batch.column(i).to_pylist() for i in range(2)),
                                    text_bytes(batch, "ta"), text_bytes(batch, "tb")):
                sets = []
                for key, raw in ((a, ta), (b, tb)):
                    s = memo.get(key)
                    if s is None:
                        if len(memo) > 256:
                            memo.clear()
                        s = memo[key] = shingle_set(raw)
                    sets.append(s)
                x, y = sets
                common = len(x) + len(y) - len(np.union1d(x, y))
                hit.append(den * common >= num * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def fewer_links(links: DataFrame) -> DataFrame:
    """Links ``a, b`` with the same components: each ``a`` to its smallest ``b``, and that one to the others.

    Members that are linked to the same hubs so share the links between those.
    """
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    between = links.join(least, "a").where("b <> least").select(F.col("least").alias("a"), "b").distinct()
    return written(least.withColumnRenamed("least", "b").union(between), "fewer-links")


def components(links: DataFrame) -> DataFrame:
    """Written: ``num, comp`` for every node of ``links`` (``a, b``): comp is the smallest node reachable.

    Each round a node takes the smallest label among its neighbours and then
    its label's own label, so paths halve; a written table ends each round.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    label = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp"))
                    .withColumnRenamed("a", "num"), "labels")
    while True:
        heard = (both.join(label.withColumnRenamed("num", "b"), "b").groupBy("a").agg(F.min("comp").alias("heard"))
                 .withColumnRenamed("a", "num"))
        best = written(label.join(heard, "num").select("num", F.col("comp").alias("old"), F.least("comp", "heard").alias("comp")), "labels")
        jump = best.select(F.col("num").alias("comp"), F.col("comp").alias("far"))
        new = written(best.join(jump, "comp").select("num", F.least("comp", "far").alias("comp"), "old"), "labels")
        discard(best, label)
        label = new
        if new.where("comp <> old").isEmpty():
            discard(both)
            return new


def hub_pairs(members: DataFrame, lists: DataFrame, turn: int) -> DataFrame:
    """Pairs ``a, b`` of members and hubs ``b`` of their lists, from different components.

    The hubs of a list of at most HUBS + 1 members meet all of them, and the
    list is done.  In a larger one they only look for links ahead of the
    blocks, where every pair that is still open is met, so a member meets
    those MEETS of them that it shares most lists with.
    """
    num, den = SIMILARITY
    first = Window.partitionBy("value").orderBy(F.xxhash64(F.lit(turn), "num"), "num")
    hubs = members.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= HUBS[turn]).join(
        lists.select("value", (F.col("all") > HUBS[turn] + 1).alias("large")), "value").where(
        ~F.col("large") | (F.col("rank") <= HUBS_OF_LARGE)).select(
        "value", "large", F.col("num").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("comp_b"))
    met = (members.join(written(hubs, "hubs"), "value").where("comp <> comp_b").where(den * F.least("n", "nb") >= num * F.greatest("n", "nb"))
           .groupBy(F.col("num").alias("a"), "b").agg(F.count("*").alias("shared"), F.min("large").alias("large")))
    best = Window.partitionBy("a", "large").orderBy(F.desc("shared"), "b")
    return met.withColumn("rank", F.row_number().over(best)).where(~F.col("large") | (F.col("rank") <= MEETS)).select("a", "b")


def block_links(members: DataFrame, lists: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components of a list, found block by block.

    ``members`` has ``value, coord, num, n, comp``; ``lists`` has per open list
    ``all`` (members), ``giant`` (its largest component) and ``outside``
    (members not in it); ``nodes`` has ``num, n, sig, posted``.  A pair is
    looked at in the first list that it shares only.  First signatures meet;
    texts follow the members that agree with another one of the block.

    A list has SHARES blocks a side, so a member moves that often however large
    its list is, until blocks reach MOST_BLOCK members or MOST_WORDS words;
    a list of few members has blocks of BLOCK * 4.
    """
    # near copies have about as many words each
    fit = members.groupBy("value").agg(F.floor(F.lit(MOST_WORDS) / F.avg("n")).alias("fit"))
    size = F.greatest(F.lit(BLOCK), F.least(F.lit(MOST_BLOCK), "fit", F.greatest(F.lit(4 * BLOCK), F.ceil(F.col("all") / SHARES))))
    lists = lists.join(fit, "value").withColumn("size", size).drop("fit")
    blocks = lambda c: F.ceil(F.col(c) / F.col("size")).cast("int")
    turn = F.xxhash64("num")
    keys = ["value", "lb", "rb"]
    m = members.join(lists, "value").withColumns({"lbs": blocks("outside"), "rbs": blocks("all")})
    left = m.where("comp <> giant").select(
        "coord", "value", "num", "comp", F.pmod(turn, "lbs").cast("int").alias("lb"),
        F.explode(F.sequence(F.lit(0), F.col("rbs") - 1)).alias("rb"), F.lit(True).alias("outer"), F.lit(True).alias("is_left"))
    right = m.select(
        "coord", "value", "num", "comp", F.explode(F.sequence(F.lit(0), F.col("lbs") - 1)).alias("lb"),
        F.pmod(turn, "rbs").cast("int").alias("rb"), (F.col("comp") != F.col("giant")).alias("outer"), F.lit(False).alias("is_left"))
    rows = left.select(*right.columns).union(right).join(nodes.select("num", "n", "sig", "posted"), "num")
    num, den = SIMILARITY

    def wanted(a: pd.DataFrame, b: pd.DataFrame, here: int) -> np.ndarray:
        """Which pairs of the two sides must be compared on their sets in this list."""
        sa, sb = np.stack(a["sig"].to_numpy()), np.stack(b["sig"].to_numpy())
        pa_, pb = a["posted"].to_numpy(), b["posted"].to_numpy()
        agree, earlier = np.zeros((len(a), len(b)), np.int16), np.zeros((len(a), len(b)), bool)
        for k in range(COORDINATES):
            same = sa[:, k, None] == sb[None, :, k]
            agree += same
            if k < here:
                earlier |= same & ((pa_ >> k) & 1).astype(bool)[:, None] & ((pb >> k) & 1).astype(bool)[None, :]
        na, nb = a["n"].to_numpy()[:, None], b["n"].to_numpy()[None, :]
        want = (agree >= MATCHES) & ~earlier & (den * np.minimum(na, nb) >= num * np.maximum(na, nb))
        want &= a["comp"].to_numpy()[:, None] != b["comp"].to_numpy()[None, :]
        # two outsiders meet twice
        return want & (~b["outer"].to_numpy()[None, :] | (a["num"].to_numpy()[:, None] < b["num"].to_numpy()[None, :]))

    def sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        return pdf[pdf["is_left"]].reset_index(drop=True), pdf[~pdf["is_left"]].reset_index(drop=True)

    def screen(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = sides(pdf)
        if not len(a) or not len(b):
            return pdf.iloc[:0]
        here, used_a, used_b = int(pdf["coord"].iloc[0]), [], np.zeros(len(b), bool)
        for at in range(0, len(a), BLOCK):
            want = wanted(a[at: at + BLOCK], b, here)
            used_a.append(want.any(axis=1))
            used_b |= want.any(axis=0)
        return pd.concat([a[np.concatenate(used_a)], b[used_b]])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = sides(pdf)
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": []})
        here, found = int(pdf["coord"].iloc[0]), []
        sets = [[shingle_set(t.encode()) for t in side["text"]] for side in (a, b)]
        n, name = [side["n"].to_numpy() for side in (a, b)], [side["num"].to_numpy() for side in (a, b)]
        for at in range(0, len(a), BLOCK):
            every = wanted(a[at: at + BLOCK], b, here)
            for to in range(0, len(b), BLOCK):
                want = every[:, to: to + BLOCK]
                i, j = np.flatnonzero(want.any(axis=1)), np.flatnonzero(want.any(axis=0))
                if not len(i):
                    continue
                want, i, j = want[np.ix_(i, j)], i + at, j + to
                common = shared_counts([sets[0][x] for x in i], [sets[1][y] for y in j])
                x, y = np.nonzero(want & (den * common >= num * (n[0][i, None] + n[1][None, j] - common)))
                found.append((name[0][i[x]], name[1][j[y]]))
        x, y = (np.concatenate(z) for z in zip(*found)) if found else ([], [])
        return pd.DataFrame({"a": x, "b": y})

    near = written(rows.groupBy(*keys).applyInPandas(screen, rows.schema), "block-members")
    return near.join(texts, "num").groupBy(*keys).applyInPandas(compare, "a bigint, b bigint")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by products of 0-1 matrices a slice of shingles at a time."""
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    out = np.zeros((len(left), len(right)))
    for at in range(0, len(both), 4096):
        part = both[at: at + 4096]
        out += table_of(left, part) @ table_of(right, part).T
    return out.round().astype(np.int64)


def table_of(sets: list[np.ndarray], shingles: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(shingles)), np.float32)
    for k, s in enumerate(sets):
        own = s[np.searchsorted(s, shingles[0]): np.searchsorted(s, shingles[-1], side="right")]
        place = np.searchsorted(shingles, own)
        out[k, place[shingles[place] == own]] = 1
    return out


def links(classes: DataFrame, texts_of) -> DataFrame | None:
    """``num, comp`` of the linked classes, or None if nothing is linked."""
    post = written(prefix_postings(classes), "postings")
    if post.isEmpty():
        return None
    posted = post.groupBy("num").agg(F.sum(F.expr("shiftleft(1L, coord)")).alias("posted"))
    nodes = written(classes.join(posted, "num"), "posted-classes")
    texts = written(texts_of(nodes), "posted-texts")
    found = comp = members = None
    for turn in range(len(HUBS) + 1):
        labelled = post.withColumn("comp", F.col("num")) if comp is None else post.join(comp.select("num", "comp"), "num", "left").withColumn(
            "comp", F.coalesce("comp", "num"))
        labelled = written(labelled, "labelled")
        discard(members)
        parts = labelled.groupBy("value", "comp").agg(F.count("*").alias("m"))
        # lists with pairs between different components: what is left to compare
        lists = written(parts.groupBy("value").agg(
            F.sum("m").alias("all"), F.count("*").alias("comps"), F.max_by("comp", "m").alias("giant"), F.max("m").alias("largest"))
            .where("comps > 1").where(F.col("all") > (0 if not turn else HUBS[turn - 1] + 1)).select("value", "all", "giant", (F.col("all") - F.col("largest")).alias("outside")), "open-lists")
        members = written(labelled.join(lists.select("value"), "value", "left_semi"), "members")
        discard(labelled, post)
        if members.isEmpty():
            break
        if turn < len(HUBS):
            new = confirm(written(hub_pairs(members, lists, turn), "hub-pairs"), nodes, texts)
        else:
            new = block_links(members, lists, nodes, texts)
        new = fewer_links(written(new, "confirmed"))
        found = new if found is None else found.union(new)
        if not found.isEmpty():
            comp = components(found)
            # what stands for the links from now on: each node with its component
            found = comp.where("num <> comp").select(F.col("num").alias("a"), F.col("comp").alias("b"))
        post = members.select("coord", "value", "num", "n")
    discard(texts)
    return comp


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``; see the module for defined results."""
    return _components(docs, id_col, text_col).drop("mark")


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    sigs = signatures(docs, id_col, text_col)
    classes = written(sigs.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("rep"), F.min("mark").alias("rep_mark"), F.first("sig").alias("sig"), F.first("n").alias("n"))
        .withColumn("num", F.monotonically_increasing_id()), "classes")

    def texts_of(wanted: DataFrame) -> DataFrame:
        # one text a class: rows of the representative whose set is the class's
        reps = wanted.select("num", "cls", F.col("rep").alias("id"), F.when(F.col("rep").isNull(), F.col("rep_mark")).alias("mark"))
        rows = docs.select(F.col(id_col).alias("id"), nameless(F.col(id_col), F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
        same_row = rows["id"].eqNullSafe(reps["id"]) & rows["mark"].eqNullSafe(reps["mark"])

        def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = [class_key(shingle_set(raw)) == c for raw, c in zip(text_bytes(batch, "text"), batch.column(2).to_pylist())]
                yield batch.filter(pa.array(ok, pa.bool_())).select(["num", "text"])

        met = rows.join(reps, same_row).select("num", "text", "cls")
        return met.mapInArrow(same, "num bigint, text string").dropDuplicates(["num"])

    comp = links(classes, texts_of)
    names = classes.select("cls", "rep", "rep_mark", "num")
    if comp is not None:
        names = names.join(comp.select("num", "comp"), "num", "left")
        low = names.where("comp is not null").groupBy("comp").agg(F.min("rep").alias("low"), F.min("rep_mark").alias("low_mark"))
        names = names.join(low, "comp", "left").select("cls", F.when(F.col("comp").isNull(), F.col("rep")).otherwise(F.col("low")).alias("rep"),
                                                       F.when(F.col("comp").isNull(), F.col("rep_mark")).otherwise(F.col("low_mark")).alias("rep_mark"))
    names = written(names.select("cls", "rep", "rep_mark"), "component-names")  # a table of its own, so that AQE can split a hot class's rows
    out = sigs.select("id", "mark", "n", "cls").join(names, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("rep"))
    kept = F.when(F.col("cls").isNull(), True).when(F.col("rep").isNull(), F.col("mark") == F.col("rep_mark")).otherwise(
        F.coalesce(F.col("id") == F.col("rep"), F.lit(False)))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), "mark")


def keep_first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Rows that share an id (without one: a text) share its fate: they stay if
    one of them is kept, so that no group loses its document.
    """
    drop = _components(docs, id_col, text_col).groupBy("doc_id", "mark").agg(F.max("kept").alias("any")).where(
        "not any").select(F.col("doc_id").alias("__near_id"), F.col("mark").alias("__near_mark"))
    same = F.col(id_col).eqNullSafe(F.col("__near_id")) & nameless(F.col(id_col), F.col(text_col)).eqNullSafe(F.col("__near_mark"))
    return docs.join(drop, same, "left_anti")
