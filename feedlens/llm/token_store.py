"""Token ids in binary shards with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by id, encoded where they land, and
appended to one shard a partition:

    ids            n_ids little-endian unsigned integers of ``width`` bytes
    ends           Elias-Fano: end of each document in the id array
    names          Elias-Fano: document ids less the smallest, ascending
    trailer        JSON of sizes and places, then its length in 4 bytes

An Elias-Fano sequence keeps ``l`` low bits of each value packed and the high
parts in unary, about 2 + l bits a value, with the 32-bit place of every 256th
one so that select scans at most a few dozen bytes.  A written table lists the
shards that count and how many ids come before each.

Defined results: a null text counts as empty and has its end id only; null ids
come first in the order; repeated ids follow each other, their texts in order;
an empty table has no shards and reads back empty; other columns may have any
name.
"""
from __future__ import annotations

import bisect
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import as_batches, bounded_batches, written
from .files import filesystem, new_file, one_task_each

END_ID = 1
MEMO_BYTES = 128 << 20  # of words, their ids and the table, in each of two generations
_ENTRY = 150            # bytes that an entry takes besides
_EVERY = 256
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class EliasFano:
    """A non-decreasing sequence of unsigned integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.marks = n, low_bits, low, high, marks

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, *(np.empty(0, t) for t in (np.uint8, np.uint8, np.uint32)))
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (v >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        unary = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        unary[places] = 1
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little"), places[::_EVERY].astype(np.uint32))

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        at = i * self.low_bits
        part = int.from_bytes(self.low[at >> 3: (at + self.low_bits + 7) >> 3].tobytes(), "little")
        return part >> (at & 7) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Place of the i-th one in the unary part."""
        at = int(self.marks[i // _EVERY])
        left = i % _EVERY
        byte = at >> 3
        here = int(self.high[byte]) >> (at & 7) << (at & 7)
        while True:
            ones = int(_ONES[here])
            if left < ones:
                for _ in range(left):
                    here &= here - 1
                return byte * 8 + (here & -here).bit_length() - 1
            left -= ones
            byte += 1
            here = int(self.high[byte])

    def __getitem__(self, i: int) -> int:
        return (self.select(i) - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every value, decoded in bulk."""
        if not self.n:
            return np.empty(0, dtype=np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little")).astype(np.uint64)
        high = ones - np.arange(self.n, dtype=np.uint64)
        bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return high << np.uint64(self.low_bits) | low

    def parts(self) -> tuple[dict, bytes]:
        blobs = [self.low.tobytes(), self.high.tobytes(), self.marks.astype("<u4").tobytes()]
        return {"n": self.n, "low_bits": self.low_bits, "bytes": [len(b) for b in blobs]}, b"".join(blobs)

    @classmethod
    def read(cls, about: dict, blob: bytes) -> EliasFano:
        a, b, _ = about["bytes"]
        return cls(about["n"], about["low_bits"], np.frombuffer(blob[:a], np.uint8),
                   np.frombuffer(blob[a: a + b], np.uint8), np.frombuffer(blob[a + b:], "<u4"))


class ShardWriter:
    """Appends documents to one shard; only boundaries and ids of documents stay in memory."""

    def __init__(self, out, width: int):
        self.out, self.width, self.n_ids, self.ends, self.names, self.nulls = out, width, 0, [], [], 0

    def add(self, name: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.n_ids += len(ids) // self.width
        self.ends.append(self.n_ids)
        if name is None:
            self.nulls += 1
        else:
            self.names.append(name)

    def close(self) -> dict:
        least = self.names[0] if self.names else 0
        about = {"width": self.width, "n_ids": self.n_ids, "nulls": self.nulls, "least": least}
        at = self.n_ids * self.width
        for key, values in (("ends", self.ends), ("names", [x - least for x in self.names])):
            about[key], blob = EliasFano.of(np.array(values, dtype=np.uint64)).parts()
            about[key]["at"] = at
            self.out.write(blob)
            at += len(blob)
        tail = json.dumps(about).encode()
        self.out.write(tail + len(tail).to_bytes(4, "little"))
        self.out.close()
        return about


class ShardReader:
    """Documents of one shard by place, without reading the others."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = int.from_bytes(file.read_at(4, size - 4), "little")
        self.about = json.loads(file.read_at(tail, size - 4 - tail))
        self.width = self.about["width"]
        self.ends, self.names = (EliasFano.read(a, file.read_at(sum(a["bytes"]), a["at"]))
                                 for a in (self.about["ends"], self.about["names"]))

    def __len__(self) -> int:
        return self.ends.n

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def ids(self, begin: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``name, begin, ids`` of every document in order."""
        names = [None] * self.about["nulls"] + [int(x) + self.about["least"] for x in self.names.all()]
        ends, begin, block, held = self.ends.all().tolist(), 0, 0, np.empty(0, "<u4")
        for i, (name, end) in enumerate(zip(names, ends)):
            if end > block + len(held):  # the next documents of about a million ids, in one read
                block = begin
                last = max(end, ends[min(bisect.bisect_right(ends, begin + (1 << 20), i), len(ends)) - 1])
                held = self.ids(block, last)
            yield name, begin, held[begin - block: end - block]
            begin = end


#: Between a letter or digit and closing punctuation a match of the vocabulary's pattern always ends.
#: Stated from the punctuation, which is rare, so that the search skips from one to the next.
_TAIL = re.compile(rb"[.,;:!?](?<=[a-z0-9].)[.,;:!?]*(?=\s|\Z)")


#: Letters below this have no other normal form, and are small if they say so.
_LATIN = "\u0250"
#: What byte-level vocabularies write for a byte: itself if it is printable, else the next of the characters from U+0100.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {**{b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}, **{b: b for b in _PRINTABLE}}


class WordEncoder:
    """The tokenizers library over whole texts, each distinct word once while it is remembered.

    The vocabulary lower-cases, drops white space, and no rule of it looks
    across ASCII white space, so a text's ids are its words' ids in order, and
    words may be told apart after ASCII lower-casing.  Words that are new in a
    batch go to the library as one text; offsets tell whose ids are whose.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # texts are cut at them here, what is left may only look so in lower case
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._code = {2: "H", 4: "I"}[self.width]
        self._merges = self.tokenizer.model.tokenize
        probe = "straßeéo"  # whether the vocabulary's rules are those that the short way relies on
        self._plain = sys.byteorder == "little" and [t.id for t in self._merges(probe.encode().decode("latin-1").translate(_BYTES))] == (
            self.tokenizer.encode(probe, add_special_tokens=False).ids)
        self._memo: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._held = 0
        # with a space before them: no word has one
        self._special = {b" " + t.content.encode(): int(i).to_bytes(self.width, "little")
                         for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self._cut = re.compile(b"(" + b"|".join(re.escape(t[1:]) for t in sorted(self._special, reverse=True)) + b")")

    def _words(self, raw: bytes) -> list[bytes]:
        """The words of a text in lower case, and its special tokens, which are told by case."""
        if not any(t[1:] in raw for t in self._special):
            return _TAIL.sub(rb" \g<0>", raw.lower()).split()
        parts = self._cut.split(raw)
        words = _TAIL.sub(rb" \g<0>", parts[0].lower()).split()
        for token, after in zip(parts[1::2], parts[2::2]):
            words.append(b" " + token)
            words += _TAIL.sub(rb" \g<0>", after.lower()).split()
        return words

    def _learn(self, words: list[bytes]) -> None:
        """Ids of new words; a word of plain small letters is one match of the pattern and goes to the merges alone."""
        other = []
        for w in words:
            text = w.decode("utf-8")
            if self._plain and text.isalpha() and text.islower() and max(text) < _LATIN:
                ids = array(self._code, [t.id for t in self._merges(w.decode("latin-1").translate(_BYTES))]).tobytes()
                self._memo[w] = ids
                self._held += len(w) + len(ids) + _ENTRY
            else:
                other.append(w)
        if other:
            self._learn_others(other)

    def _learn_others(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8") for w in words]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        made = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        owner = np.searchsorted(begins, [x for x, _ in made.offsets], side="right") - 1
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) * self.width if len(owner) else np.zeros(len(words), int)
        ids = np.array(made.ids, dtype=f"<u{self.width}").tobytes()
        begin = 0
        for w, end in zip(words, ends.tolist()):
            self._memo[w] = ids[begin:end]
            begin = end
        self._held += sum(map(len, words)) + len(ids) + _ENTRY * len(words)

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        if self._held > MEMO_BYTES:  # what is used again moves from the old memo to the new
            self._old, self._memo, self._held = self._memo, {}, 0
        self._memo.update(self._special)
        new = [w for w in words if w not in self._memo]
        rest = []
        for w in new:
            ids = self._old.get(w)
            if ids is None:
                rest.append(w)
            else:
                self._memo[w] = ids
                self._held += len(w) + len(ids) + _ENTRY
        for at in range(0, len(rest), 2000):
            self._learn(rest[at: at + 2000])
        return [self._memo[w] for w in words]

    def _is_special(self, raw: bytes) -> bool:
        return any(t[1:] in raw for t in self._special)

    def encode(self, raws: list[bytes | None]) -> list[bytes]:
        """Ids of each text, ``width`` bytes each.

        A batch is cut into words and its distinct words are numbered in Arrow;
        their ids are gathered by those numbers in NumPy.
        """
        out: list[bytes] = [b""] * len(raws)
        plain = [i for i, raw in enumerate(raws) if raw and not self._is_special(raw)]
        for i in set(range(len(raws))) - set(plain):
            if raws[i]:
                words = self._words(raws[i])
                distinct = list(dict.fromkeys(words))
                ids = dict(zip(distinct, self._known(distinct)))
                out[i] = b"".join([ids[w] for w in words])
        if not plain:
            return out
        texts = pa.array([_TAIL.sub(rb" \g<0>", raws[i].lower()) for i in plain], pa.large_binary()).cast(pa.large_string())
        cut = pc.ascii_split_whitespace(texts)
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.cast(pa.large_binary()).to_pylist()
        made = self._known([w for w in distinct if w])
        if len(made) < len(distinct):  # white space at an end leaves an empty word
            made.insert(distinct.index(b""), b"")
        size = np.fromiter(map(len, made), np.int64, len(made)) // self.width
        first = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(made), f"<u{self.width}")
        code = numbered.indices.to_numpy()
        n = size[code]
        end = np.cumsum(n)
        ids = pool[np.repeat(first[code] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)].tobytes()
        bounds = np.concatenate(([0], end))[np.asarray(cut.offsets) - cut.offsets[0].as_py()] * self.width
        for i, begin, stop in zip(plain, bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = ids[begin:stop]
        return out


_encoders: dict[str, WordEncoder] = {}


def worker_encoder(path: str) -> WordEncoder:
    """One encoder a worker process, kept across its tasks.

    A function of the module, so tasks share its table: what a nested function
    names directly travels with it as a copy.
    """
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write; returns the written table of shards: ``path, first, n_docs, n_ids, base``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = scratch_path(spark, "token-shards")
    ordered = (docs.select(F.col(id_col).cast("long").alias("name"), F.col(text_col).cast("binary").alias("raw"))
               .repartitionByRange("name").sortWithinPartitions("name", "raw"))
    schema = pa.schema([("path", pa.string()), ("first", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        end = int(end_id).to_bytes(encoder.width, "little")
        writer = path = first = None
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                if writer is None:
                    fs, at = filesystem(folder)
                    path, first = new_file(fs, at, "shard", ".ids"), name
                    writer = ShardWriter(fs.open_output_stream(path, compression=None), encoder.width)
                writer.add(name, ids + end)
        if writer is not None:
            about = writer.close()
            yield from as_batches([(path.rsplit("/", 1)[1], first, len(writer.ends), about["n_ids"])], schema)

    made = written(ordered.mapInArrow(run, "path string, first bigint, n_docs bigint, n_ids bigint"), "shards")
    # one row a partition: the ids before each shard
    earlier = Window.orderBy(F.col("first").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return written(made.select(F.concat(F.lit(folder + "/"), "path").alias("path"), "first", "n_docs", "n_ids",
                               F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base")), "shard-list")


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document from the files: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = filesystem(path)
                rows, held = [], 0
                with fs.open_input_file(at) as file:
                    for name, begin, ids in ShardReader(file).documents():
                        rows.append((name, base + begin, len(ids), ids.tobytes()))
                        held += ids.nbytes
                        if held > 4 << 20 or len(rows) >= 2000:
                            yield from as_batches(rows, schema)
                            rows, held = [], 0
                yield from as_batches(rows, schema)

    return one_task_each(shards.select("path", "base")).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def stored(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write and read back, per document: ``doc_id, start, n_tokens, ids_crc32``."""
    back = read_shards(write_shards(docs, tokenizer, end_id, id_col, text_col))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


