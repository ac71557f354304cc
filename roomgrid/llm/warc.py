"""WARC archives: a writer with revisit records and a reader that splits gzip files.

Archives are files of gzip members, one record each, in a folder that driver and executors
share. A task writes files of its own under new names and returns what it has written; only
what finished tasks return is in the manifest, so files of a lost or repeated task are not
part of the archive.

The reader deals byte ranges of the files to tasks. A task looks for the magic number of gzip
from the start of its range, takes a candidate for a member only if it inflates to the head
of a WARC record, and from there follows member after member. It owns the records that start
inside its range, and reads the last one beyond its end.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import stored, table
from roomgrid.session import shared_dir

MIN_REVISIT_BYTES = 100
FILE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 23
MAX_TASKS = 10_000  # of a reading job
_CHUNK = 1 << 18
_MAGIC = b"\x1f\x8b\x08"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _line(name: str, value: object) -> str:
    """A header line, or nothing for a null; line ends in the value would end the line."""
    if value is None:
        return ""
    return f"{name}: {str(value).replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n"


def _value(head: dict[str, str], name: str) -> str | None:
    value = head.get(name.lower())
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest}')}>"


def render_record(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {_record_id(page, digest)}\r\nWARC-Date: {_DATE}\r\n"
        + _line("WARC-Target-URI", url)
        + f"WARC-Payload-Digest: sha256:{digest}\r\nContent-Type: application/http; msgtype=response\r\n"
        + _line("X-Page-Id", page)
        + _line("X-Payload-Length", len(payload))
    )
    if kind == "revisit":
        head += f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: {_record_id(refers_to, digest)}\r\n" + _line("X-Refers-To-Page", refers_to)
    return f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; an error if it is damaged."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record has not the length it says")
    payload = block.partition(b"\r\n\r\n")[2]
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("a WARC record's payload has not the digest it says")
    number = lambda name: None if _value(fields, name) is None else int(_value(fields, name))
    return {
        "page_id": number("X-Page-Id"), "url": _value(fields, "WARC-Target-URI"), "record_type": kind, "refers_to": number("X-Refers-To-Page"),
        "payload_bytes": len(payload) if kind == "response" else number("X-Payload-Length"), "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _write_files(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    system, base = _open(folder)
    out, path, size, records = None, "", 0, 0
    done: list[tuple[str, int, int]] = []
    for batch in batches:
        for row in batch.to_pylist():
            if out is None:
                system.create_dir(base, recursive=True)
                path, size, records = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                out = system.open_output_stream(f"{base}/{path}", compression=None)
            member = zlib.compressobj(4, zlib.DEFLATED, 31)
            data = member.compress(render_record(row["page_id"], row["url"], row["payload"], row["digest"], row["kind"], row["refers_to"])) + member.flush()
            out.write(data)
            size, records = size + len(data), records + 1
            if size >= file_bytes:
                out.close()
                done.append((path, size, records))
                out = None
    if out is not None:
        out.close()
        done.append((path, size, records))
    columns = zip(*done) if done else [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["file", "bytes", "records"])


def write_warc(
    df: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES, min_revisit: int = MIN_REVISIT_BYTES
) -> DataFrame:
    """Write a record per row below ``folder``; the manifest: (file, bytes, records).

    The payload is the html in UTF-8, nothing for a null. Of rows with equal payloads of at
    least ``min_revisit`` bytes, those with the smallest id are responses, all others revisits
    of it; a row without an id never is the smallest, unless all are. Other columns are
    ignored. An empty table gives no file.

    Equal payloads are found by digest, with one row per digest that occurs again; pages stay
    where they are unless those rows are too many to hand to every task.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = df.select(F.col(page).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    again = (
        rows.where(F.octet_length("payload") >= min_revisit)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null").select("digest", "first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = rows.join(again, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("first")).alias("refers_to")
    )
    return stored(typed.mapInArrow(lambda batches: _write_files(batches, folder, file_bytes), "file string, bytes long, records long"), "manifest")


class _Source:
    """Bytes of a file from a place on, in chunks."""

    def __init__(self, file: pa.NativeFile, size: int) -> None:
        self.file, self.size = file, size

    def at(self, place: int, n: int = _CHUNK) -> bytes:
        return self.file.read_at(min(n, self.size - place), place) if place < self.size else b""


def _is_member(source: _Source, place: int) -> bool:
    """Whether the bytes there inflate to the head of a WARC record."""
    inflate, head = zlib.decompressobj(31), b""
    while len(head) < 8:
        data = source.at(place, 4096)
        if not data:
            return False
        try:
            head += inflate.decompress(data, 64)
        except zlib.error:
            return False
        if inflate.eof:
            break
        place += len(data)
    return head.startswith(b"WARC/1.")


def find_member(source: _Source, start: int, end: int) -> int | None:
    """The first member that starts in [start, end)."""
    place = start
    while place < end:
        data = source.at(place, min(_CHUNK, end - place) + len(_MAGIC) - 1)
        k = data.find(_MAGIC)
        while k >= 0 and place + k < end:
            if _is_member(source, place + k):
                return place + k
            k = data.find(_MAGIC, k + 1)
        place += _CHUNK
    return None


def members(source: _Source, start: int, end: int) -> Iterator[bytes]:
    """The inflated members that start in [start, end), in order."""
    place = find_member(source, start, end)
    while place is not None and place < end:
        inflate, parts, at = zlib.decompressobj(31), [], place
        while not inflate.eof:
            data = source.at(at)
            if not data:
                raise ValueError("a gzip member ends with the file")
            parts.append(inflate.decompress(data))
            at += len(data)
        place = at - len(inflate.unused_data)
        yield b"".join(parts)


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row per record of the files (file, bytes) below ``folder``; revisits have no payload.

    The rows that name ranges are tiny, so Spark would put them all into one task. The number of
    partitions follows the number of ranges instead, up to ``MAX_TASKS``; beyond it a task
    reads several ranges one after the other.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = manifest.where("bytes > 0").select("file", F.col("bytes").alias("size"), F.explode(starts).alias("start"))
    n = ranges.count()
    ranges = ranges.repartition(min(max(n, 1), MAX_TASKS), "file", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [part.split()[0] for part in _RECORD.split(", ")]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for part in batch.to_pylist():
                rows, held = [], 0
                with system.open_input_file(f"{base}/{part['file']}") as file:
                    for raw in members(_Source(file, part["size"]), part["start"], min(part["start"] + split_bytes, part["size"])):
                        rows.append(parse_record(raw))
                        held += len(raw)
                        if held > 1 << 22:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return ranges.mapInArrow(run, _RECORD)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = shared_dir(spark, "warc")
    manifest = write_warc(table(spark, folder, "pages"), archive)
    return read_warc(spark, archive, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


OP10_SQL = """
with sized as (
  select page_id, url, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (select payload_digest, min(page_id) as first from sized where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest, case when page_id <> first then 'revisit' else 'response' end as record_type,
  case when page_id <> first then first end as refers_to, url
from sized left join firsts using (payload_digest)
"""
