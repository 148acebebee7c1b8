"""WARC archives with segmented records and their reassembly.

Writing: each task appends its records to compressed archives of bounded size in a shared folder. A block
longer than the segment size becomes a first segment and continuation records that carry the identifier of
their origin and a segment number; the last one states the total length. Archive names are new in every
attempt of a task, and only those that a successful task reported are read, so a lost executor leaves
nothing but an unread file.

Reading: records from all archives are grouped by origin identifier, put in the order of their segment
numbers, checked against the total length and freed from chunked transfer framing. A group is one record.

Of records with equal payloads the one with the largest id is stored and the others are revisits, whose
HTTP head states the length of the payload. Which is which is decided on digests alone; payloads are not
shuffled for it. A response is named after its id and digest, so a revisit can name the response that it stands for.

Defined cases: a null payload is empty; a null address is left out of the record; rows with one id and equal
payloads are all stored as responses if the id is the largest, some of one name, and come back as many records; an empty table writes no record; a record with missing segments, a
wrong total length, framing or digest is returned with a ``fault`` and without payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, stored
from corpusmill.session import scratch_path
from corpusmill.sources.filesystem import filesystem_of

# A fifth of usual pages is longer.
SEGMENT_BYTES = 4 * 1024
ARCHIVE_BYTES = 16 << 20
CHUNK_BYTES = 4096
# Names of responses that a task remembers, of some 100 bytes.
KNOWN_NAMES = 100_000
# (id, id) pairs of 16 bytes: up to this many revisits are sent to the tasks, more are joined by shuffle.
MOST_SENT_REVISITS = 2_000_000
RECORDS = (
    "record_id string, record_type string, refers_to string, digest string, origin_id string, segment int, "
    "total_length long, block binary"
)
PAYLOADS = (
    "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, "
    "fault string, segments long, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes, chunk: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    cuts = (payload[i : i + chunk] for i in range(0, len(payload), chunk))
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in cuts) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if its framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n%b%b: %d\r\n\r\n%b\r\n\r\n" % (head.encode(), b"Content-Length", len(block), block)


# Fixed value: why a revisit has no payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def response_name(id: int, payload: bytes) -> str:
    return f"<urn:page:{id}:{payload_digest(payload)}>"


def page_records(record_id: str, url: str | None, payload: bytes, refers_to: str | None, segment: int) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response with continuations."""
    uri = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    fields = [("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        own = [("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), ("WARC-Refers-To", refers_to), ("WARC-Profile", SAME_PAYLOAD)]
        yield record(own + fields, http + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + framed(payload)
    cuts = range(0, len(block), segment)
    for number, at in enumerate(cuts, 1):
        first = number == 1
        own = [
            ("WARC-Type", "response" if first else "continuation"),
            ("WARC-Record-ID", record_id if first else f"{record_id[:-1]}:{number}>"),
            ("WARC-Segment-Number", str(number) if len(cuts) > 1 else None),
            ("WARC-Segment-Origin-ID", None if first else record_id),
            ("WARC-Segment-Total-Length", str(len(block)) if number == len(cuts) > 1 else None),
        ]
        yield record(own + (fields if first else fields[:1]), block[at : at + segment])


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds ``refers_to`` to (doc_id, url, payload): the largest id with an equal payload, null if it is the row's own."""
    keys = pages.select("doc_id", F.sha1("payload").alias("_digest"))
    groups = keys.groupBy("_digest").agg(F.max("doc_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    revisits = stored(
        keys.join(groups.where("_n > 1"), "_digest").where("doc_id < refers_to").select("doc_id", "refers_to", "_digest").distinct(),
        "revisits",
    )
    few = revisits.count() <= MOST_SENT_REVISITS
    keyed = pages.withColumn("_digest", F.sha1("payload"))
    return keyed.join(F.broadcast(revisits) if few else revisits, ["doc_id", "_digest"], "left").drop("_digest")


def written(pages: DataFrame, folder: str, segment: int = SEGMENT_BYTES, archive: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (doc_id, url, payload, refers_to) to archives below ``folder``; returns (path, n_records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem_of(folder)
        fs.create_dir(root, recursive=True)
        part, out, done, path, n, size, row = TaskContext.get().partitionId(), None, [], "", 0, 0, 0
        known: set[str] = set()
        for batch in batches:
            for doc_id, url, payload, refers_to in zip(*batch.columns):
                row += 1
                link, body = refers_to.as_py(), payload.as_py() or b""
                # Nothing refers to a revisit, so the place where it is written is name enough.
                name = f"<urn:page:{doc_id.as_py()}:{part}:{row}>" if link is not None else response_name(doc_id.as_py(), body)
                # Of repeated rows a task gives one the name that revisits use, so no name gathers all of them.
                if name in known:
                    name = f"{name[:-1]}:{part}:{row}>"
                elif link is None:
                    if len(known) >= KNOWN_NAMES:
                        known.clear()
                    known.add(name)
                target = None if link is None else response_name(link, body)
                for data in page_records(name, url.as_py(), body, target, segment):
                    if out is None:
                        path = f"{root}/part-{part:05d}-{len(done):05d}-{uuid.uuid4().hex}.warc.gz"
                        out, n, size = fs.open_output_stream(path, compression=None), 0, 0
                    data = gzip.compress(data, 1)
                    out.write(data)
                    n, size = n + 1, size + len(data)
                    if size >= archive:
                        out.close()
                        out = None
                        done.append((path, n))
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_pylist([{"path": p, "n_records": n} for p, n in done], schema=names)

    names = pa.schema([("path", pa.string()), ("n_records", pa.int64())])
    return pages.select("doc_id", "url", "payload", "refers_to").mapInArrow(write, "path string, n_records long")


def archive_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record; field names in lower case."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
        block = stream.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]):
            raise ValueError("an archive ends within a record")
        yield fields, block


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """The records of all archives; one task may read several archives, one record at a time."""
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def rows(fields: dict[str, str], block: bytes) -> tuple:
        own = fields["warc-record-id"]
        return (
            own,
            fields["warc-type"],
            fields.get("warc-refers-to"),
            fields.get("warc-payload-digest"),
            fields.get("warc-segment-origin-id", own),
            int(fields.get("warc-segment-number", 0)),
            int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
            block,
        )

    def out(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem_of(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found, size = [], 0
                with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for fields, block in archive_records(stream):
                        found.append(rows(fields, block))
                        size += len(block)
                        if size >= 4 << 20:
                            yield out(found)
                            found, size = [], 0
                if found:
                    yield out(found)

    # A stated number, as rows this small would otherwise be merged into one task.
    n_tasks = max(1, archives.count())
    return archives.select("path").repartition(n_tasks, "path").mapInArrow(read, RECORDS)


def restored(parts: list[dict]) -> tuple:
    """(payload_bytes, payload_digest, fault, payload) of one record from its segments in order."""
    first, last = parts[0], parts[-1]
    digest = (first["digest"] or "").removeprefix("sha1:")
    block = b"".join(p["block"] for p in parts)
    head, _, body = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if first["record_type"] == "revisit":
        return int(http.get(b"content-length", 0)), digest, None, None
    numbers = [p["segment"] for p in parts]
    if first["record_type"] == "continuation" or numbers != [0] and numbers != list(range(1, len(parts) + 1)):
        return None, digest, "missing segment", None
    if numbers != [0] and last["total_length"] != len(block):
        return None, digest, "total length", None
    payload = unframed(body) if http.get(b"transfer-encoding") == b"chunked" else body
    if payload is None:
        return None, digest, "framing", None
    own = payload_digest(payload)
    return (None, digest, "digest", None) if digest and digest != own else (len(payload), own, None, payload)


def same_named(parts: list[dict]) -> list[list[dict]]:
    """The records of one name, which are equal, from their segments in order."""
    n = sum(p["segment"] == parts[0]["segment"] for p in parts)
    return [parts[i::n] for i in range(n)]


def reassembled(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record: (record_id, record_type, refers_to, payload_bytes, payload_digest, fault, segments, payload)."""
    names = [c.split()[0] for c in PAYLOADS.split(", ")]
    types = [pa.string()] * 3 + [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    part = F.struct("segment", "record_type", "refers_to", "digest", "total_length", "block")
    # A bare list of one record's segments; they are put in order where they are read.
    groups = records.groupBy("origin_id").agg(F.collect_list(part).alias("parts"))

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for origin, scalars in zip(batch.column(0).to_pylist(), batch.column(1)):
                for parts in same_named(sorted(scalars.as_py(), key=lambda p: p["segment"])):
                    size, digest, fault, payload = restored(parts)
                    first = parts[0]
                    rows.append(
                        (origin, first["record_type"], first["refers_to"], size, digest, fault, len(parts), payload if with_payload else None)
                    )
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return groups.mapInArrow(restore, PAYLOADS)


def pages_to_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", **sizes: int
) -> DataFrame:
    """Archives of all pages: (path, n_records), kept in the shared folder."""
    rows = rows_of(pages, id, url=url, payload=F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8"))
    return stored(written(with_revisits(rows), folder, **sizes), "warc-archives")


def op7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` written to archives and read back."""
    folder = scratch_path(spark, "warc")
    archives = pages_to_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    number = lambda c: F.regexp_extract(c, "urn:page:(-?[0-9]+)", 1)
    return reassembled(read_records(archives, folder), with_payload=False).select(
        F.expr("try_cast(regexp_extract(record_id, 'urn:page:(-?[0-9]+)', 1) AS bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("refers_to").isNotNull(), number("refers_to").cast("long")).alias("refers_to"),
        "segments",
        "fault",
    )
