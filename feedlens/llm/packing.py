"""Best-fit packing of token pieces by minimum bin slack.

Texts are encoded once; each becomes pieces of at most ``capacity`` tokens.
What is packed is the histogram of their lengths, at most ``capacity`` numbers
whatever the corpus: for the longest piece left, a bitset subset-sum over the
lengths left (with their multiplicities) finds the fullest combination that
fits beside it.  The combination is removed as often as the counts allow, which
is what doing it bin by bin would give, and the next one is sought.

A piece's rank among those of its length is the number counted in its own task
plus that of the tasks before; ranks say which copy of which combination holds
it.  So no group of pieces meets in one task, however common its length, and
token ids stay where they were written until ``sequences`` gathers them.

Defined results: a null text counts as empty and has its end id only; repeated
and null ids are documents of their own; a text of any length is cut into full
pieces and a rest; an empty table gives an empty result; other columns may have
any name.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_batches, bounded_batches, written
from .token_store import worker_encoder

CAPACITY = 2048
END_ID = 0
#: Places of a plan's keys: length and rank in one 64-bit number.
_RANK_BITS = 48


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Written: ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit), and ``lot, turn``.

    ``turn`` counts the pieces of that length which the task ``lot`` met before.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    schema = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("lot", pa.int64()), ("turn", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        lot, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, owner = [], []
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                wide = np.append(np.frombuffer(ids, f"<u{encoder.width}").astype("<u4"), np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(wide), capacity)):
                    part = wide[at: at + capacity]
                    rows.append((k, at, len(part), part.tobytes(), lot, int(met[len(part)])))
                    met[len(part)] += 1
                    owner.append(i)
            for made in as_batches(rows, schema):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *made.columns], names=["doc_id", *schema.names])

    kind = src.schema["doc_id"].dataType.simpleString()
    return written(src.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary, lot bigint, turn bigint"), "pieces")


def fullest(left: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The combination of ``left`` (length, count; longest first) that fills ``room`` best: length -> copies.

    Bit b of ``reach`` says that the lengths seen so far can add up to b.
    Longer ones are seen first, and the search ends where nothing is left over.
    """
    reach, mask, trail = 1, (1 << (room + 1)) - 1, []
    for length, count in left:
        if length > room:
            continue
        trail.append((length, reach))
        copies, some = min(count, room // length), 1
        while copies:  # binary splitting: any number of copies up to the count
            some = min(some, copies)
            reach |= reach << (length * some) & mask
            copies -= some
            some *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        k = 0
        while not before >> at & 1:
            at -= length
            k += 1
        if k:
            chosen[length] = k
    return chosen


def combinations(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """``(length -> copies, times)`` until every piece is in one, by minimum bin slack from the longest piece left."""
    counts = {n: c for n, c in sorted(counts.items(), reverse=True) if c}
    while counts:
        longest = next(iter(counts))
        rest = [(n, c - (n == longest)) for n, c in counts.items()]
        found = fullest([(n, c) for n, c in rest if c], capacity - longest)
        found[longest] = found.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in found.items())
        yield found, times
        for n, k in found.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]


def plan(histogram: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written: ``length, begin, per, sequence, offset`` from ``length, n``, at most ``capacity`` rows.

    Pieces of ``length`` with ranks from ``begin`` on go to sequences from
    ``sequence`` on, ``per`` in each, side by side from ``offset``.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("length", "begin", "per", "sequence", "offset")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {}
        for batch in batches:
            counts.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        begin, sequence, rows = dict.fromkeys(counts, 0), 0, []
        for found, times in combinations(counts, capacity):
            offset = 0
            for n, k in sorted(found.items(), reverse=True):
                rows.append((n, begin[n], k, sequence, offset))
                begin[n] += k * times
                offset += n * k
            sequence += times
        yield from as_batches(rows, schema)

    return written(histogram.select("length", "n").coalesce(1).mapInArrow(
        run, "length bigint, begin bigint, per bigint, sequence bigint, offset bigint"), "packing-plan")


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (``length, lot, turn, ...``, from a written table) with ``sequence_id`` and ``offset``."""
    if capacity >= 1 << (62 - _RANK_BITS):
        raise ValueError(f"capacity must be below {1 << (62 - _RANK_BITS)}")
    spark = cut.sparkSession
    by_lot = written(cut.groupBy("lot", "length").agg(F.count("*").alias("n")), "piece-counts")
    found = plan(by_lot.groupBy("length").agg(F.sum("n").alias("n")), capacity)
    # its rows are bounded by the capacity alone: a combination uses up a length, and holds few lengths
    p = found.orderBy("length", "begin").toPandas()
    sent = spark.sparkContext.broadcast({c: p[c].to_numpy(np.int64) for c in p})
    earlier = Window.partitionBy("length").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    before = by_lot.select("lot", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before.hint("merge"), ["lot", "length"]).withColumn("rank", F.col("before") + F.col("turn")).drop("before")
    at = ranked.columns.index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        keys = (t["length"] << _RANK_BITS) + t["begin"]
        for batch in batches:
            n, rank = (batch.column(at(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            e = np.searchsorted(keys, (n << _RANK_BITS) + rank, side="right") - 1
            q = rank - t["begin"][e]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(t["sequence"][e] + q // t["per"][e]), pa.array(t["offset"][e] + q % t["per"][e] * n)],
                names=[*batch.schema.names, "sequence_id", "offset"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(run, f"{types}, sequence_id bigint, offset bigint").drop("rank")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``; the checksum is that of the written ids."""
    cut = pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    slim = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "lot", "turn")
    return place(slim, capacity).drop("lot", "turn")


def sequences(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, n_tokens, spans, ids`` from ``pieces``: the packed rows, ids as little-endian unsigned 32-bit.

    ``spans`` has offset, length, document, piece and start of what a row holds;
    a row holds at most ``capacity`` tokens, so the one shuffle has no large group.
    """
    placed = place(cut.drop("ids"), capacity).join(cut.select("lot", "length", "turn", "ids"), ["lot", "length", "turn"])
    rows = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "length", "piece", "start", "doc_id", "ids"))).alias("spans"))
    whole = F.aggregate("spans", F.lit(b""), lambda x, s: F.concat(x, s["ids"]))
    return rows.select("sequence_id", F.aggregate("spans", F.lit(0).cast("bigint"), lambda x, s: x + s["length"]).alias("n_tokens"),
                       F.transform("spans", lambda s: s.dropFields("ids")).alias("spans"), whole.alias("ids"))
