"""WARC archives: writing, normalising and reading web pages.

A crawl is written as one gzip stream per archive, every page a response.  The
normaliser inflates each archive once, from its first byte to its last, and
rewrites every record as a gzip member of its own, with a sidecar index of
their offsets, so that a reader can fetch any record alone.  On the way,
records whose payload another record holds become revisits without payload.

Only ids, sizes and digests are shuffled to decide which; payloads stay in
their archive.  File names belong to a task attempt, and written tables list
the files that count, so lost executors leave nothing behind that is read.

Defined results: a null payload is empty; rows that share the largest id of a
payload are all responses; a null id ranks below all others; a null url leaves
its header out; an empty table has no archives and reads back empty; payloads
are streamed in pieces while archives are rewritten; other columns may have
any name.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import as_batches, bounded_batches, written
from .files import filesystem, new_file, one_task_each

ARCHIVE_BYTES = 64 << 20   # of records before compression; a new archive begins beyond it
PIECE = 1 << 20
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    name = record_id[len("<urn:page:"):-1]
    return None if name == "none" else int(name)


def http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record_head(fields: list[tuple[str, str]], size: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {size}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def response_record(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    block = http_head(len(payload)) + payload
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", _id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    fields += [("WARC-Payload-Digest", "sha1:" + payload_digest(payload)), ("Content-Type", "application/http; msgtype=response")]
    return record_head(fields, len(block)) + block + b"\r\n\r\n"


def read_head(stream) -> tuple[list[tuple[str, str]], int] | None:
    """Header fields and block length of the next record, None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields, size = [], None
    while (line := stream.readline().rstrip(b"\r\n")):
        key, _, value = line.decode("utf-8").partition(":")
        if key.lower() == "content-length":
            size = int(value)
        else:
            fields.append((key, value.strip()))
    if size is None:
        raise ValueError("a record without Content-Length")
    return fields, size


def blocks(stream, size: int) -> Iterator[bytes]:
    while size:
        piece = stream.read(min(size, PIECE))
        if not piece:
            raise EOFError("a record ends early")
        size -= len(piece)
        yield piece


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each partition's pages as monolithic archives.

    Returns a written table, one row per record: ``archive, seq, page_id, size, key``.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = scratch_path(spark, "warc-crawl")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(payload_col).cast("binary").alias("payload"))
    schema = pa.schema([("archive", pa.string()), ("seq", pa.int64()), ("page_id", pa.int64()), ("size", pa.int64()),
                        ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(folder)
        out = None
        for batch in batches:
            rows = []
            for page_id, url, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                payload = payload or b""
                if out is None:
                    path = new_file(fs, at, "crawl", ".warc.gz")
                    out, deflate, seq, held = fs.open_output_stream(path, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                record = response_record(page_id, url, payload)
                out.write(deflate.compress(record))
                rows.append((folder + "/" + path.rsplit("/", 1)[1], seq, page_id, len(payload), hashlib.sha256(payload).digest()))
                seq, held = seq + 1, held + len(record)
                if held >= archive_bytes:
                    out.write(deflate.flush())
                    out.close()
                    out = None
            yield from as_batches(rows, schema)
        if out is not None:
            out.write(deflate.flush())
            out.close()

    return written(src.mapInArrow(run, "archive string, seq bigint, page_id bigint, size bigint, key binary"), "crawl-records")


def revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """One row per archive: ``archive, seqs, refers`` of the records that revisit another page's payload."""
    large = records.where(F.col("size") >= least_bytes)
    first = written(large.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
                    .where("n > 1 and refers_to is not null").drop("n"), "payload-owners")
    again = large.join(first, "key").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    # an archive's records are bounded by its size
    lists = again.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("seq", "refers_to"))).alias("again"))
    every = records.groupBy("archive").agg(F.count("*").alias("n"))
    return every.join(lists, "archive", "left").select("archive", "again.seq", "again.refers_to").toDF("archive", "seqs", "refers")


def rewrite(stream, out, refers: dict[int, int], level: int = 6) -> list[tuple[int, int, str, str]]:
    """Rewrite the records of ``stream`` as members of ``out``; returns ``offset, length, type, record id`` of each."""
    index, offset, seq = [], 0, 0
    while (head := read_head(stream)) is not None:
        fields, size = head
        names = dict(fields)
        member = zlib.compressobj(level, zlib.DEFLATED, 31)
        length = 0

        def put(data: bytes) -> int:
            made = member.compress(data)
            out.write(made)
            return len(made)

        kind, refers_to = names["WARC-Type"], refers.get(seq)
        if refers_to is None:
            length += put(record_head(fields, size))
            for piece in blocks(stream, size):
                length += put(piece)
        else:  # the http header stays, with the payload's size
            kind = "revisit"
            rest, kept = size, b""
            for piece in blocks(stream, rest):
                if b"\r\n\r\n" not in kept:
                    kept += piece
            kept = kept[: kept.index(b"\r\n\r\n") + 4]
            fields = [("WARC-Type", kind), *(f for f in fields if f[0] != "WARC-Type"),
                      ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _id(refers_to))]
            length += put(record_head(fields, len(kept)) + kept)
        length += put(b"\r\n\r\n")
        tail = member.flush()
        out.write(tail)
        length += len(tail)
        index.append((offset, length, kind, names["WARC-Record-ID"]))
        offset, seq = offset + length, seq + 1
    return index


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite monolithic archives (``archive, seqs, refers``); returns a written table: ``warc, index, n``.

    The index is a text file: offset, length, type and record id, tab-separated, a line per record.
    """
    spark = archives.sparkSession
    folder = scratch_path(spark, "warc")
    schema = pa.schema([("warc", pa.string()), ("index", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(folder)
        for batch in batches:
            for archive, seqs, refers in zip(*(batch.column(i).to_pylist() for i in range(3))):
                source, path = filesystem(archive)
                warc = new_file(fs, at, "pages", ".warc.gz")
                with source.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream, \
                        fs.open_output_stream(warc, compression=None) as out:
                    index = rewrite(stream, out, dict(zip(seqs or (), refers or ())))
                with fs.open_output_stream(warc + ".idx", compression=None) as out:
                    out.write("".join("\t".join(map(str, x)) + "\n" for x in index).encode())
                name = folder + "/" + warc.rsplit("/", 1)[1]
                yield from as_batches([(name, name + ".idx", len(index))], schema)

    return written(one_task_each(written(archives, "warc-plan")).mapInArrow(run, "warc string, index string, n bigint"), "warc-list")


def read_archives(warcs: DataFrame) -> DataFrame:
    """Per record: ``page_id, record_type, refers_to, payload_bytes, payload_digest, payload`` (null for revisits).

    Records are fetched by the index; a response's digest is computed anew and must match its header.
    """
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def parse(member: bytes) -> tuple:
        data = zlib.decompress(member, 31)
        head, _, block = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = block[: int(fields["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            if payload_digest(payload) != digest or len(payload) != size:
                raise ValueError(f"{fields['WARC-Record-ID']}: payload and header differ")
            return _page(fields["WARC-Record-ID"]), "response", None, size, digest, payload
        return _page(fields["WARC-Record-ID"]), "revisit", _page(fields["WARC-Refers-To"]), size, digest, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for warc, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = filesystem(warc)
                with fs.open_input_stream(filesystem(index)[1], compression=None) as f:
                    entries = [line.split("\t") for line in f.read().decode().splitlines()]
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for offset, length, _, _ in entries:
                        rows.append(parse(file.read_at(int(length), int(offset))))
                        held += rows[-1][3]
                        if held > 8 * PIECE or len(rows) >= 1000:
                            yield from as_batches(rows, schema)
                            rows, held = [], 0
                yield from as_batches(rows, schema)

    return one_task_each(warcs.select("warc", "index")).mapInArrow(
        run, "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
             least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write, normalise and read back ``pages``; one row per page as ``read_archives`` gives it."""
    records = write_archives(pages, id_col, url_col, payload_col, archive_bytes)
    return read_archives(normalise(revisits(records, least_bytes)))
