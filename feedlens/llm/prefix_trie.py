"""Prefix trie of conversations in minimal-perfect-hash node tables.

A conversation is a path of turn tokens (128 bits of the SHA-256 of role and
text, and the text's length); a node is a distinct prefix, named by 128 bits of
the SHA-256 of its tokens.  Equal paths collapse into one row with a count, and
paths are range-sorted, so that all paths below a node are adjacent.  Sorted
paths are cut into shards of bounded size.  A shard enumerates its distinct
prefix digests, gives each a slot by a minimal perfect hash, verifies every
slot against the whole digest and its parent, scatters counts into flat arrays
by slot, and accumulates them through the array of parent slots, deepest first.

Only prefixes of a shard's first and last path (its seams) can be in other
shards too.  A shard passes on what it knows of those as two paths with partial
sums, which are sharded in the same way, until one shard holds all.  So a first
turn or a conversation that a third of the corpus shares is spread over all
shards, and the number of rounds grows with the logarithm of the corpus, not
with the depth.

Limits: the tokens of one path (40 bytes a turn) are one value, since a chain
of prefixes is one sequence by nature; a node's ``ends_sha256`` hashes its ids
as one stream, in a task that holds a chunk of them at a time.

Defined results: null roles and texts count as empty; a null turn comes first;
equal turns stand in the order of their role, then of their text's digest; rows
without a conversation id belong to none and are left out; a conversation
without any turn left is a member of the root alone; ids below zero keep the
remainder's sign, as in SQL; an empty table gives an empty result (no root);
other columns may have any name.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, written

TOKEN = 40                # characters of a turn's token: 32 of its digest, 8 of its length
SHARD_TURNS = 20_000      # a shard is closed at so many turns ...
SHARD_PATHS = 16          # ... if it has so many paths: seams are two of them
CHUNK = 4096              # ids of one chunk of a node's ends
GAMMA = 2.0
_EVERY = 100
_SHARED = 6
_FAR = np.iinfo(np.int64).max


class MinimalPerfectHash:
    """Slots 0..n-1 for n distinct 128-bit keys: levels of bits that one key alone has set."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, used = keys, 0
        while len(left):
            if len(self.levels) > 100:
                raise ValueError("the keys are not distinct")
            size = max(8, int(GAMMA * len(left)))
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, used + np.cumsum(alone) - 1))
            used += int(alone.sum())
            left = left[~alone[at]]
        self.n = used

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0] + np.uint64(level + 1) * (keys[:, 1] | np.uint64(1))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 if no level has it; a key that isn't in the table may get any slot."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (bits, rank) in enumerate(self.levels):
            at = self._place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def digests_of(paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``keys, depth, shared, lengths``: for every prefix of every path (sorted), path after path from the root.

    ``keys`` are its digest as two 64-bit numbers; ``shared`` tells prefixes
    that the path before has too; ``lengths`` are those of the last texts.
    """
    raw, depth, shared, lengths = [], [], [], []
    states, before, row, first = [hashlib.sha256()], "", [hashlib.sha256().digest()[:16]], True
    sizes = [0]
    for path in paths:
        n, same = len(path) // TOKEN, 0
        while same < min(n, len(before) // TOKEN) and path[TOKEN * same: TOKEN * (same + 1)] == before[TOKEN * same: TOKEN * (same + 1)]:
            same += 1
        del states[same + 1:], row[same + 1:], sizes[same + 1:]
        h = states[same].copy()
        for d in range(same, n):
            token = path[TOKEN * d: TOKEN * (d + 1)]
            h.update(token.encode())
            states.append(h.copy())
            row.append(h.digest()[:16])
            sizes.append(int(token[32:], 16))
        raw.extend(row)
        lengths.extend(sizes)
        depth.append(np.arange(n + 1))
        shared.append(np.arange(n + 1) <= (-1 if first else same))
        before, first = path, False
    keys = np.frombuffer(b"".join(raw), "<u8").reshape(-1, 2)
    return keys, np.concatenate(depth), np.concatenate(shared), np.array(lengths, np.int64)


class Shard:
    """The nodes of a run of sorted distinct paths, in flat arrays by slot."""

    def __init__(self, paths: list[str], n: list, first: list, below: list[tuple]):
        """``n``, ``first``: members and smallest member of every prefix of each path (arrays by depth);
        ``below``: children, leaves and saved tokens that were counted under it before."""
        keys, depth, again, lengths = digests_of(paths)
        enumerated = keys[~again]
        table = MinimalPerfectHash(enumerated)
        slot = table.slots(keys)
        self.keys = np.zeros((table.n, 2), np.uint64)
        self.keys[slot[~again]] = enumerated
        begins = np.flatnonzero(depth == 0)
        up = np.r_[-1, slot[:-1]]
        up[begins] = -1
        self.parent, self.depth, self.length = (np.full(table.n, -1) for _ in range(3))
        self.parent[slot], self.depth[slot], self.length[slot] = up, depth, lengths
        if (table.n != len(enumerated) or (self.keys[slot] != keys).any() or (self.parent[slot] != up).any()
                or (self.depth[slot] != depth).any() or (self.length[slot] != lengths).any()):
            raise ValueError("two prefixes share a digest")
        self.n, self.first = np.zeros(table.n, np.int64), np.full(table.n, _FAR)
        np.add.at(self.n, slot, np.concatenate(n))
        np.minimum.at(self.first, slot, np.concatenate(first))
        self.children, self.leaves, self.saved = (np.zeros(table.n, np.int64) for _ in range(3))
        for to, values in zip((self.children, self.leaves, self.saved), zip(*below)):
            np.add.at(to, slot, np.concatenate(values))
        ends = np.r_[begins[1:], len(slot)]
        self.seams = [slot[begins[0]: ends[0]], slot[begins[-1]: ends[-1]]]

    def accumulate(self, closed: bool) -> np.ndarray:
        """Sums through the parent slots, deepest nodes first; returns which nodes are final.

        Seams wait for the other shards unless this one is ``closed``: their
        own shares stay out, those of what is below them come in.
        """
        final = np.ones(len(self.n), bool)
        if not closed:
            final[np.concatenate(self.seams)] = False
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(self.depth.max() + 2))
        for d in range(int(self.depth.max()), -1, -1):
            here = order[cuts[d]: cuts[d + 1]]
            here = here[final[here]]
            self.leaves[here] += self.children[here] == 0
            self.saved[here] += (self.n[here] - 1) * self.length[here]
            if d:
                np.add.at(self.children, self.parent[here], 1)
                np.add.at(self.leaves, self.parent[here], self.leaves[here])
                np.add.at(self.saved, self.parent[here], self.saved[here])
        return final

    def names(self, slots: np.ndarray) -> list[bytes]:
        raw = self.keys[slots].astype("<u8").tobytes()
        return [raw[i: i + 16] for i in range(0, len(raw), 16)]


_NODE = pa.schema([("node", pa.binary()), ("up", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                   ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])
_LISTS = ("n", "first", "children", "leaves", "saved")
_PATH = pa.schema([("path", pa.string()), *[(c, pa.list_(pa.int64())) for c in _LISTS]])
#: A row is a final node, or a seam's path with what is known under each of its prefixes.
_OUT = pa.schema([("shard", pa.string()), pa.field("at", pa.struct(list(_NODE))), pa.field("seam", pa.struct(list(_PATH)))])
_OUT_SQL = ("shard string, at struct<node:binary,up:binary,conv_id:bigint,depth:bigint,parent_conv_id:bigint,n_convs:bigint,"
            "n_children:bigint,n_leaves:bigint,saved_tokens:bigint>, seam struct<path:string," + ",".join(f"{c}:array<bigint>" for c in _LISTS) + ">")


def shard_rows(name: str, rows: list[tuple], closed: bool) -> Iterator[pa.RecordBatch]:
    """The output of one shard, from ``path, n, first, children, leaves, saved`` rows."""
    paths, n, first = ([r[k] for r in rows] for k in range(3))
    s = Shard(paths, n, first, [r[3:] for r in rows])
    final = s.accumulate(closed)
    mine = np.flatnonzero(final)
    up = s.parent[mine]
    known = (up >= 0) & final[up]
    some = s.names(up[up >= 0])
    ups = iter(some)
    nodes = pa.StructArray.from_arrays([
        pa.array(s.names(mine), pa.binary()), pa.array([next(ups) if x else None for x in (up >= 0).tolist()], pa.binary()),
        pa.array(s.first[mine]), pa.array(s.depth[mine]), pa.array(s.first[up], mask=~known), pa.array(s.n[mine]),
        pa.array(s.children[mine]), pa.array(s.leaves[mine]), pa.array(s.saved[mine])], fields=list(_NODE))
    none = pa.nulls(len(mine), _OUT.field("seam").type)
    yield pa.RecordBatch.from_arrays([pa.array([name] * len(mine), pa.string()), nodes, none], schema=_OUT)
    if closed:
        return
    seams = []
    told = np.zeros(len(s.n), bool)
    for path, slots in list(zip((paths[0], paths[-1]), s.seams))[: 1 if len(paths) == 1 else 2]:
        fresh = ~told[slots]  # what both seams share is told once
        told[slots] = True
        values = [np.where(fresh, x[slots], far).tolist() for x, far in (
            (s.n, 0), (s.first, _FAR), (s.children, 0), (s.leaves, 0), (s.saved, 0))]
        seams.append(dict(zip(("path", *_LISTS), (path, *values))))
    yield pa.RecordBatch.from_arrays([pa.array([name] * len(seams), pa.string()), pa.nulls(len(seams), _OUT.field("at").type),
                                      pa.array(seams, _OUT.field("seam").type)], schema=_OUT)


def sharded(paths: DataFrame, level: int, closed: bool, shard_turns: int) -> DataFrame:
    """Written: the rows of ``shard_rows`` over ``path, n, first`` (level 0) or ``path`` and the lists, range-sorted by path."""
    if closed:
        ordered = paths.coalesce(1).sortWithinPartitions("path")
    else:
        ordered = paths.repartitionByRange("path").sortWithinPartitions("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held, turns, count = [], 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                path = row[0]
                if turns >= shard_turns and len(held) >= SHARD_PATHS and not closed:
                    yield from shard_rows(f"{level}-{TaskContext.get().partitionId()}-{count}", held, closed)
                    held, turns, count = [], 0, count + 1
                d = len(path) // TOKEN + 1
                if level:
                    row = (path, *(np.array(x, np.int64) for x in row[1:]))
                else:
                    nothing = np.zeros(d, np.int64)
                    row = (path, np.full(d, row[1]), np.full(d, row[2]), nothing, nothing, nothing)
                held.append(row)
                turns += d
        if held:
            yield from shard_rows(f"{level}-{TaskContext.get().partitionId()}-{count}", held, closed)

    return written(ordered.mapInArrow(run, _OUT_SQL), "trie-shards")


def rebuilt(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Written: ``conv_id, path``: every conversation after its first turns were replaced by those of conversation ``c - c % 100``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)
    token = F.concat(digest, F.lpad(F.hex(F.char_length(text).cast("bigint")), 8, "0"))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("c"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), token.alias("token")).alias("t"))
    own = written(turns.groupBy("c").agg(F.sort_array(F.collect_list("t"))["token"].alias("tokens")), "trie-turns")
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(_SHARED)).cast("int")
    heads = own.where(F.col("c") % _EVERY == 0).select(F.col("c").alias("base"), F.slice("tokens", 1, _SHARED - 1).alias("head"))
    met = own.withColumn("base", F.col("c") - F.col("c") % _EVERY).withColumn("h", h).join(heads, "base", "left")
    none = F.array().cast("array<string>")
    tokens = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                      F.slice("tokens", F.col("h") + 1, F.greatest(F.size("tokens") - F.col("h"), F.lit(0))))
    return written(met.select(F.col("c").alias("conv_id"), F.array_join(tokens, "").alias("path")), "trie-paths")


def ends(paths: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which conversations end, from ``conv_id, path``.

    Ids are range-sorted by node and id, joined to chunks where they land, and
    a node's chunks are hashed as one stream in the order of the tasks.
    """
    node = F.unhex(F.substring(F.sha2(F.col("path").cast("binary"), 256), 1, 32))
    at = paths.select(node.alias("node"), "conv_id")
    chunk_schema = pa.schema([("node", pa.binary()), ("pid", pa.int64()), ("k", pa.int64()), ("chunk", pa.string())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid, k, now, held = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            rows = []
            for name, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (name != now or len(held) >= CHUNK):
                    rows.append((now, pid, k, ",".join(map(str, held))))
                    held, k = [], k + 1
                now = name
                held.append(c)
            yield from as_batches(rows, chunk_schema)
        if held:
            yield from as_batches([(now, pid, k, ",".join(map(str, held)))], chunk_schema)

    cut = written(at.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        chunks, "node binary, pid bigint, k bigint, chunk string"), "trie-ends")
    end_schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for batch in batches:
            rows = []
            for name, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != now:
                    if h is not None:
                        rows.append((now, h.hexdigest()))
                    now, h = name, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(chunk.encode())
            yield from as_batches(rows, end_schema)
        if h is not None:
            yield from as_batches([(now, h.hexdigest())], end_schema)

    return cut.repartition("node").sortWithinPartitions("node", "pid", "k").select("node", "chunk").mapInArrow(
        stream, "node binary, ends_sha256 string")


def nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Per node of the trie of ``conv_id, path``: the columns of ``_NODE``."""
    now = written(paths.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("first")), "trie-distinct")
    made, level = [], 0
    while True:
        turns = now.agg(F.sum(F.length("path") / TOKEN + 1)).first()[0]
        closed = turns is not None and turns <= shard_turns
        made.append(sharded(now, level, closed, shard_turns))
        if closed or turns is None:
            break
        now, level = made[-1].where("seam is not null").select("seam.*"), level + 1
    out = None
    for part in reversed(made):
        rows = part.where("at is not null").select("shard", "at.*")
        if out is not None:
            above = written(out, "trie-crown")  # small: two paths of each shard below
            # the parent is a seam: its smallest member is known by now; keys are of one shard, so none is hot
            waiting = (F.col("depth") > 0) & F.col("parent_conv_id").isNull()
            seams = rows.where(waiting).select("shard", "up").distinct()
            known = seams.join(above.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv")), "up")
            rows = rows.join(known, ["shard", "up"], "left").withColumn(
                "parent_conv_id", F.coalesce("parent_conv_id", "up_conv")).drop("up_conv")
        rows = rows.select(*_NODE.names)
        out = rows if out is None else above.unionByName(rows)
    return out


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node``."""
    paths = rebuilt(conversations, id_col, turn_col, role_col, text_col)
    found = nodes(paths, shard_turns).join(ends(paths), "node", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "node")
