"""WARC archives of pages, and their normaliser.

Archives often arrive as one gzip stream around many records, which can only be read from the start. The normaliser
inflates such a stream once, piece by piece, rewrites each record as a gzip member of its own, and writes a sidecar
index with the place of every member, so that any record can be read alone afterwards.

An archive is one task's work and has a bounded size: pages are dealt to so many archives that each holds about
`ARCHIVE_BYTES` of payload. Files appear under their name only when complete, so a task that is run again replaces them.
Archives lie where all executors see them: under a folder in any store that pyarrow's file systems can write.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import math
import posixpath
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import ship, table
from beaconlake.storage import pin, scratch_path

ARCHIVE_BYTES = 64 << 20
#: Equal payloads of at least so many bytes are stored once and revisited.
REVISIT_BYTES = 0
PIECE = 1 << 20
LEVEL = 4
_CRLF = b"\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "archive string, page_id long, record_type string, offset long, length long"


def file_system(folder: str):
    """A pyarrow file system for `folder` and the folder's path in it."""
    from pyarrow import fs

    if urlsplit(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(folder).path
    return fs.FileSystem.from_uri(folder)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int, url: str | None, payload: bytes, kind: str, sha: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record; a revisit has no block of its own and names the record that has."""
    block = payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", "".join((url or "").split())), ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("X-Payload-Length", str(len(payload))), ("Content-Type", "text/html"), ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    return head.encode("utf-8", "replace") + _CRLF + block + _CRLF + _CRLF


def header(lines: bytes) -> dict[str, str]:
    """The named fields of a record's head, names in lower case."""
    first, *rest = lines.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest if x)}


def _pieces(source: io.RawIOBase) -> Iterator[bytes]:
    """The inflated stream, whether one gzip member or several; a stream that breaks off raises."""
    inflate, fed = zlib.decompressobj(31), False
    while piece := source.read(PIECE):
        while piece:
            fed = True
            out = inflate.decompress(piece, PIECE)
            if out:
                yield out
            if inflate.eof:
                piece, inflate, fed = inflate.unused_data, zlib.decompressobj(31), False
            else:
                piece = inflate.unconsumed_tail
    if fed:
        raise ValueError("the gzip stream breaks off")


def normalise(source: io.RawIOBase, target: io.RawIOBase) -> Iterator[tuple[dict[str, str], int, int]]:
    """Copies the records of a gzip stream to `target`, one member each: (header fields, offset, length) per record.

    Only a head and one piece of a block are held at a time.
    """
    pieces, held, offset = _pieces(source), b"", 0
    while True:
        while (end := held.find(_CRLF * 2)) < 0:
            piece = next(pieces, None)
            if piece is None:
                if held.strip():
                    raise ValueError("the last record breaks off")
                return
            held += piece
        fields = header(held[:end])
        left = end + 4 + int(fields["content-length"]) + 4
        deflate, length = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
        while left:
            if not held:
                held = next(pieces, None)
                if held is None:
                    raise ValueError("the last record breaks off")
            part, held = held[:left], held[left:]
            left -= len(part)
            length += target.write(deflate.compress(part))
        length += target.write(deflate.flush())
        yield fields, offset, length
        offset += length


def _replacing(folder: str, name: str, write: Callable) -> None:
    """Writes a file that appears under its name only when it is complete."""
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    path = posixpath.join(root, name)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as out:
        write(out)
    store.move(part, path)


def _page_of(identity: str) -> int:
    return int(identity.strip("<>").rpartition(":")[2])


def _write(folder: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A partition, sorted by archive, as one gzip stream per archive."""
        rows = (r for b in batches for r in b.itertuples(index=False))
        row = next(rows, None)
        while row is not None:
            archive, count = row.archive, 0

            def stream(out) -> None:
                nonlocal row, count
                deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                while row is not None and row.archive == archive:
                    payload = (row.html or "").encode("utf-8", "replace")
                    out.write(deflate.compress(record(row.page_id, row.url, payload, row.record_type, digest(payload), row.refers_to)))
                    count += 1
                    row = next(rows, None)
                out.write(deflate.flush())

            _replacing(folder, f"{archive}.warc.gz", stream)
            yield pd.DataFrame({"archive": [archive], "records": [count]})

    return write


def _normalise(folder: str, to: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["archive"]:
                store, root = file_system(folder)
                found: list[tuple] = []
                with store.open_input_stream(posixpath.join(root, f"{archive}.warc.gz"), compression=None) as source:
                    _replacing(to, f"{archive}.warc.gz", lambda out: found.extend((archive, _page_of(f["warc-record-id"]), f["warc-type"], o, n) for f, o, n in normalise(source, out)))
                index = pd.DataFrame(found, columns=["archive", "page_id", "record_type", "offset", "length"])
                lines = "".join(json.dumps(dict(zip(index.columns[1:], x[1:]))) + "\n" for x in found)
                _replacing(to, f"{archive}.idx", lambda out: out.write(lines.encode()))
                yield index

    return run


def _read(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for archive, rows in batch.groupby("archive", sort=False):
                store, root = file_system(folder)
                with store.open_input_file(posixpath.join(root, f"{archive}.warc.gz")) as source:
                    for r in rows.sort_values("offset").itertuples(index=False):
                        source.seek(r.offset)
                        raw = zlib.decompress(source.read(r.length), 31)
                        end = raw.index(_CRLF * 2)
                        fields, block = header(raw[:end]), raw[end + 4 : -4]
                        sha, size = fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-length"])
                        if fields["warc-type"] == "response" and (digest(block) != sha or len(block) != size):
                            raise ValueError(f"record {r.page_id} of {archive} does not match its digest")
                        refers = fields.get("warc-refers-to")
                        made.append((_page_of(fields["warc-record-id"]), size, sha, fields["warc-type"], _page_of(refers) if refers else None))
            yield pd.DataFrame(made, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]).astype({"refers_to": "Int64"})

    return read


def typed(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """`pages` (page_id, url, html) with `record_type` and `refers_to`.

    Of equal payloads of at least `revisit_bytes` bytes the one with the largest page_id is the response. The largest
    id per payload is found before the join, so that a payload that a third of all pages have is one row of it.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", "html", F.sha1(payload).alias("sha"), F.length(payload).alias("bytes"))
    largest = pages.where(F.col("bytes") >= revisit_bytes).groupBy("sha").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1")
    # only payloads that repeat; written out first, so that few of them are joined without moving the pages
    pages = pages.join(pin(largest.select("sha", "top"), "repeated"), "sha", "left")
    again = F.col("page_id") < F.col("top")
    return pages.select("page_id", "url", "html", "bytes", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("top")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes `typed` pages as whole-stream archives under `folder`: (archive, records), read back from a table."""
    total = pages.agg(F.sum("bytes")).first()[0] or 0
    least = pages.sparkSession.sparkContext.defaultParallelism
    archives = max(min(least, math.ceil(total / (1 << 20))), math.ceil(total / archive_bytes), 1)
    # without nulls the ids stay whole numbers on their way through pandas
    pages = pages.withColumn("refers_to", F.coalesce("refers_to", "page_id"))
    dealt = pages.withColumn("archive", F.format_string("pages-%06d", F.pmod(F.xxhash64("page_id"), F.lit(archives))))
    dealt = dealt.repartition(archives, "archive").sortWithinPartitions("archive")
    return pin(dealt.mapInPandas(_write(folder), "archive string, records long"), "archives")


def normalise_archives(archives: DataFrame, folder: str, to: str) -> DataFrame:
    """Rewrites each archive of `folder` under `to`, record by record, with its index: the index rows of all archives."""
    count = max(1, archives.count())
    dealt = archives.select("archive").repartition(count, "archive")
    return pin(dealt.mapInPandas(_normalise(folder, to), _INDEX), "index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every indexed record, each read on its own."""
    shape = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return index.mapInPandas(_read(folder), shape)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes `pages` as whole-stream archives, normalises them, and reads all records back through the index.

    A null html is an empty payload, a null url an empty one. Repeated rows are all responses, as none has a larger
    page_id than the other. Rows without page_id have no record and don't come back. Other columns are ignored.
    """
    spark = pages.sparkSession
    raw, clean = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    kept = typed(pages.select("page_id", "url", "html").where("page_id is not null"))
    return read_records(normalise_archives(write_archives(kept, raw), raw, clean), clean)


def op2_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


ship(__name__)
