"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

Merging greedily by rank has two properties that make it a finite-state task.
A token sequence is the encoding of its bytes exactly if every adjacent pair is
the encoding of its own bytes; and the encoding of every prefix of a text is a
chain of such pairs, so it has one last token.  A state is therefore the list of
boundaries that can still grow, from which the bytes read since are the
beginning of some token, each with its last token.  A byte moves every live
boundary along the vocabulary's trie, adds the one boundary whose last token
fits, and drops boundaries that died.  A state is made when it first appears
and each (state, byte) is worked out once, so later text only looks moves up.
What a state's last token is says where the chain goes on, so the tokens of a
match are read off the states it passed, from its end.

The pattern's matches are encoded separately.  A match that is a token itself
is that token, as the public rank-file library does it.

Defined results: a null text counts as empty and has no tokens; bytes that are
not UTF-8 decode to U+FFFD; empty tables give empty results; repeated rows are
encoded alike; other columns of the input may have any name.
"""
from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import getitem

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, text_bytes

NEVER = 1 << 60        # a rank beyond all
MAX_STATES = 250_000       # then the transducer starts over; a bound on memory, not on results
MEMO_BYTES = 40 << 20      # of units of text with their ids; there are two generations
_ENTRY = 150               # bytes that an entry takes besides
NODE_BITS = 32
NODE_MASK = (1 << NODE_BITS) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class State(dict):
    """The next states by byte, each made when first asked for.

    ``live`` has a number for each boundary: its last token plus one (0 where
    the match begins), then NODE_BITS for the trie node; the last boundary is
    the end of what was read, so its token is ``last``.
    """
    __slots__ = ("machine", "live", "last")

    def __missing__(self, byte: int) -> State:
        state = self[byte] = self.machine.move(self, byte)
        return state


class Transducer:
    """Encodes one match of the pattern at a time; see the module."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self._pair_ok: dict[tuple[int, int], bool] = {}
        self._grown: dict[int, tuple] = {}
        # trie: node -> {byte: node}; node 0 is the root
        self._next: list[dict[int, int]] = [{}]
        self._token: list[int] = [-1]
        for b, r in ranks.items():
            node = 0
            for c in b:
                at = self._next[node].get(c)
                if at is None:
                    at = len(self._next)
                    self._next.append({})
                    self._token.append(-1)
                    self._next[node][c] = at
                node = at
            self._token[node] = r
        self._length = {r: len(b) for r, b in self.bytes_of.items()}
        self._states: dict[tuple[int, ...], State] = {}
        self._start_over()

    def _start_over(self) -> None:
        for state in self._states.values():
            state.clear()   # they refer to each other
        self._states.clear()
        self._pair_ok.clear()
        self._first = self._state((0,))

    def merge(self, b: bytes) -> list[int]:
        """Greedy merging by rank, the definition; for short byte strings."""
        parts = [b[i: i + 1] for i in range(len(b))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(x + y, NEVER), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _edges(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]], bool]:
        """How a token's first and last part grow while it is merged: ``(part, rank of the merge that
        ends it)``, and whether merging gives the token at all."""
        made = self._grown.get(token)
        if made is None:
            parts = [self.bytes_of[token][i: i + 1] for i in range(len(self.bytes_of[token]))]
            first, last = [], []
            while len(parts) > 1:
                rank, i = min((self.ranks.get(x + y, NEVER), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
                if rank == NEVER:
                    break  # its own bytes are encoded otherwise
                if i == 0:
                    first.append((parts[0], rank))
                if i == len(parts) - 2:
                    last.append((parts[-1], rank))
                parts[i: i + 2] = [parts[i] + parts[i + 1]]
            whole = len(parts) == 1
            made = self._grown[token] = (first + [(parts[0], NEVER)], last + [(parts[-1], NEVER)], whole)
        return made

    def _fits(self, left: int, right: int) -> bool:
        """Whether the pair is the encoding of its own bytes (``left`` -1: whether ``right`` alone is).

        Both are merged as if alone, in order of rank; they fit unless at some
        time the parts that touch would merge first.  Of equal ranks the
        leftmost goes first.
        """
        key = (left, right)
        ok = self._pair_ok.get(key)
        if ok is None:
            first, _, ok = self._edges(right)
            if ok and left >= 0:
                _, last, ok = self._edges(left)
                i = j = 0
                while ok:
                    (x, x_ends), (y, y_ends) = last[i], first[j]
                    touch = self.ranks.get(x + y, NEVER)
                    if touch < x_ends and (touch < y_ends or touch == y_ends != NEVER):
                        ok = False
                    elif x_ends == y_ends == NEVER:
                        break
                    elif x_ends <= y_ends:
                        i += 1
                    else:
                        j += 1
            self._pair_ok[key] = ok
        return ok

    def _state(self, live: tuple[int, ...]) -> State:
        state = self._states.get(live)
        if state is None:
            state = self._states[live] = State()
            state.machine, state.live, state.last = self, live, (live[-1] >> NODE_BITS) - 1
        return state

    def move(self, state: State, byte: int) -> State:
        """The state after one more byte."""
        trie, made = self._next, self._token
        live, last = [], -1
        for boundary in state.live:
            at = trie[boundary & NODE_MASK].get(byte)
            if at is not None:
                if last < 0 <= made[at] and self._fits((boundary >> NODE_BITS) - 1, made[at]):
                    last = made[at]
                if trie[at]:
                    live.append(boundary & ~NODE_MASK | at)
        live.append(last + 1 << NODE_BITS)
        return self._state(tuple(live))

    def encode_piece(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        if whole is not None:
            return [whole]
        if len(self._states) > MAX_STATES:
            self._start_over()
        path, length = list(accumulate(b, getitem, initial=self._first)), self._length
        out, at = [], len(b)
        while at:
            token = path[at].last
            out.append(token)
            at -= length[token]
        out.reverse()
        return out


#: A place where a match must begin whatever stands around: a space between two characters that are not white space.
_UNIT = re.compile(r"(?<=\S) (?=\S)")


class Memo:
    """Ids by text, of bounded size: a full table becomes the old one, and what is used again moves from it to the new."""

    def __init__(self, make):
        self.make, self.most, self.now, self.old, self.held = make, MEMO_BYTES, {}, {}, 0

    def add(self, key: str) -> bytes:
        """The ids of ``key``, which the table doesn't have."""
        made = self.old.get(key)
        if made is None:
            made = self.make(key)
        if self.held > self.most:
            self.old, self.now, self.held = self.now, {}, 0
        self.now[key] = made
        self.held += 4 * len(key) + len(made) + _ENTRY
        return made


class Encoder:
    """Encodes whole texts, cut into units at single spaces and into the pattern's matches in them.

    The ids of units (without the space before them) are remembered.  Most texts hold no white space beside a space, so they are cut
    at every space; a unit that is new tells whether its text is one of them.
    """

    def __init__(self, ranks_path: str, pattern: str):
        self.machine = Transducer(load_ranks(ranks_path))
        self.pattern = regex.compile(pattern)
        self._units = Memo(lambda unit: self._matches(" " + unit))

    def _matches(self, text: str) -> bytes:
        ids = []
        for x in self.pattern.findall(text):
            ids += self.machine.encode_piece(x.encode("utf-8"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        ids = list(map(self._units.now.get, rest))
        if not first or first[-1].isspace():
            return self._encode_slowly(text)
        if None in ids:
            for i, made in enumerate(ids):
                if made is None:
                    unit = rest[i]
                    if not unit or unit[0].isspace():
                        return self._encode_slowly(text)
                    if unit[-1].isspace():
                        if i + 1 < len(rest):
                            return self._encode_slowly(text)
                        ids[i] = self._matches(" " + unit)
                    else:
                        ids[i] = self._units.now.get(unit) or self._units.add(unit)
        return self._matches(first) + b"".join(ids)

    def _encode_slowly(self, text: str) -> bytes:
        first, *rest = _UNIT.split(text)
        out = [self._matches(first)]
        for unit in rest:
            if unit[-1].isspace():  # the end of the text; elsewhere it would be no unit
                out.append(self._matches(" " + unit))
            else:
                out.append(self._units.now.get(unit) or self._units.add(unit))
        return b"".join(out)


class Utf8Stream:
    """Incremental UTF-8: bytes in, text out; holds back an unfinished character (at most 3 bytes).

    The state is the bytes of the character begun; a lead byte says how many
    must follow, and whatever cannot continue becomes U+FFFD.
    """

    def __init__(self):
        self.held = b""

    def feed(self, more: bytes) -> str:
        b = self.held + more
        cut = len(b)
        for back in range(1, min(3, len(b)) + 1):
            c = b[-back]
            if c >= 0xC0:
                need = 2 if c < 0xE0 else 3 if c < 0xF0 else 4
                if back < need and c < 0xF5:
                    cut = len(b) - back
                break
            if c < 0x80:
                break
        self.held = b[cut:]
        return b[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


class Decoder:
    def __init__(self, ranks_path: str):
        ranks = load_ranks(ranks_path)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.bytes_of[r] = b

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])

    def stream(self, ids: list[int], step: int = 4096) -> Iterator[str]:
        """The text of ``ids``, piece by piece, never cutting a character."""
        out = Utf8Stream()
        for i in range(0, len(ids), step):
            yield out.feed(self.decode_bytes(ids[i: i + step]))
        yield out.end()


_loaded: dict[tuple, object] = {}


def _once(kind, *args):
    """One encoder or decoder per worker process, kept across its tasks."""
    key = (kind, *args)
    if key not in _loaded:
        _loaded[key] = kind(*args)
    return _loaded[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, ids`` (little-endian unsigned 32-bit integers as binary)."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once(Encoder, ranks_path, pattern)
        for batch in batches:
            ids = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``doc_id, ids, text``; the text is decoded as a stream of id chunks."""
    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _once(Decoder, ranks_path)
        for batch in batches:
            texts = ["".join(decoder.stream(np.frombuffer(b or b"", dtype="<u4").tolist()))
                     for b in text_bytes(batch, "ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return src.mapInArrow(run, T.StructType([*src.schema, T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` from encoding and then decoding the ids.

    Both run in one pass over the texts, so ids don't travel between workers.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _once(Encoder, ranks_path, pattern), _once(Decoder, ranks_path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                raw = encoder.encode(text or "")
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                decoded = hashlib.sha256()
                for piece in decoder.stream(ids):
                    decoded.update(piece.encode("utf-8"))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                             names=schema.names)

    return src.mapInArrow(run, schema)
