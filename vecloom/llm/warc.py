"""WARC archives: written with segmented records and chunked bodies, read back and put together.

A record longer than a segment continues in records that carry the first one's id and a
number. Reading brings the segments of one origin together, orders them, holds the total
against the length the last one states, and takes the chunked framing off the body. Equal
payloads are written once; later ones are revisit records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded
from vecloom.llm.groups import HOT_SHARE, attach
from vecloom.llm.shared_files import new_file, open_stream
from vecloom.session import cut_lineage, scratch_path

SLICE_BYTES = 8 << 20
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_BYTES = 256 << 20
REVISIT_BYTES = 100
LEVEL = 1
_CRLF = b"\r\n"
_DATE = "2024-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken. Extensions and trailers are left out."""
    parts, at = [], 0
    while True:
        end = body.index(_CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        part = body[end + 2 : end + 2 + size]
        if len(part) < size or body[end + 2 + size : end + 4 + size] != _CRLF:
            raise ValueError("chunk breaks off")
        parts.append(part)
        at = end + 4 + size


def record(kind: str, record_id: str, fields: dict[str, Any], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": _DATE} | fields | {"Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + _CRLF + block + _CRLF + _CRLF


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int, again: int | None = None) -> Iterator[bytes]:
    """The records of one page: a response with its continuations, or a revisit. ``again`` numbers a repeated row."""
    name = record_name(page_id, digest, again)
    target = " ".join((url or "").split()) or None
    fields = {"WARC-Target-URI": target, "WARC-Page-ID": page_id, "WARC-Payload-Digest": f"sha256:{digest}"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        yield record("revisit", name, fields | {"WARC-Refers-To": f"<{record_name(refers_to, digest)}>", "WARC-Refers-To-Page-ID": refers_to}, head)
        return
    block = head + chunked(payload)
    if len(block) <= segment:
        yield record("response", name, fields, block)
        return
    parts = [block[k : k + segment] for k in range(0, len(block), segment)]
    yield record("response", name, fields | {"WARC-Segment-Number": 1}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = {"WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Number": n}
        if n == len(parts):
            more["WARC-Segment-Total-Length"] = len(block)
        yield record("continuation", f"{name}:{n}", more, part)


def record_name(page_id: int | None, digest: str, again: int | None = None) -> str:
    name = f"urn:page:{'none' if page_id is None else page_id}:{digest}"
    return name if again is None else f"{name}:row{again}"


def name_column() -> Column:
    """``record_name`` of page_id and digest."""
    return F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.col("digest"))


def payload_facts(pages: DataFrame) -> DataFrame:
    """(page_id, digest, n, name) of every row, a written table; ``name`` is the record's without a row number."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return cut_lineage(pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("n")).withColumn("name", name_column()))


def revisits(facts: DataFrame, total: int, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload a page of smaller id has, from ``min_bytes`` on."""
    long = facts.filter(F.col("n") >= min_bytes).select("page_id", "digest")
    groups = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("group_size"))
    groups = cut_lineage(groups.filter("group_size > 1 and refers_to is not null"))
    return attach(long, groups, "digest", total).filter("not (page_id <=> refers_to)").select("page_id", "digest", "refers_to").distinct()


def numbered(rows: DataFrame, facts: DataFrame, total: int) -> DataFrame:
    """Adds ``again``: null for the first row of a record name, a number of its own for each further row.

    Names that several rows share are split off and their rows written; as a rule there are
    none. Each row then has its place in that table, and the smallest one keeps the bare name.
    """
    shared = cut_lineage(facts.groupBy("name").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"))
    if shared.isEmpty():
        return rows.withColumn("again", F.lit(None).cast("bigint"))
    repeated = cut_lineage(attach(rows, shared, "name", total).drop("group_size").withColumn("_at", F.monotonically_increasing_id()))
    first = cut_lineage(repeated.groupBy("name").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("group_size")))
    repeated = attach(repeated, first, "name", total).withColumn("again", F.when(F.col("_at") != F.col("_first"), F.col("_at")))
    hot = F.broadcast(shared.filter(F.col("group_size") * HOT_SHARE > total).select("name"))
    alone = rows.join(hot, "name", "left_anti").join(shared.select("name"), "name", "left_anti").withColumn("again", F.lit(None).cast("bigint"))
    return alone.unionByName(repeated.select(alone.columns))


def write(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes gzip archives of all pages and returns the manifest (uri, n_records).

    Null html is an empty payload, a null url leaves its field out. Of pages with equal long
    payloads, the smallest id is a response, repeated rows of that id too; the others revisit
    it. Every row is a record of its own id; a revisit names the first response of the page it
    refers to.
    """
    facts = payload_facts(pages)
    total = facts.count()
    found = cut_lineage(revisits(facts, total)).withColumnsRenamed({"page_id": "_page", "digest": "_of"})
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest")).withColumn("name", name_column())
    rows = numbered(rows, facts, total)
    rows = rows.join(found, rows["page_id"].eqNullSafe(found["_page"]) & (F.col("digest") == F.col("_of")), "left")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, uri, n, size = None, "", 0, 0
        for batch in bounded(batches, "payload", SLICE_BYTES):
            for row in batch.to_pylist():
                if stream is None:
                    uri, stream = new_file(folder, ".warc.gz")
                    n = size = 0
                for part in page_records(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], segment_bytes, row["again"]):
                    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    packed = member.compress(part) + member.flush()
                    stream.write(packed)
                    n, size = n + 1, size + len(packed)
                if size >= file_bytes:
                    stream.close()
                    yield pa.RecordBatch.from_pydict({"uri": [uri], "n_records": pa.array([n], pa.int64())})
                    stream = None
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_pydict({"uri": [uri], "n_records": pa.array([n], pa.int64())})

    return cut_lineage(rows.select("page_id", "url", "payload", "digest", "refers_to", "again").mapInArrow(archives, "uri string, n_records bigint"))


class Members:
    """Bytes of a gzip file of many members, read as they are asked for."""

    def __init__(self, stream: Any, step: int = 1 << 20):
        self.stream, self.step = stream, step
        self.open, self.held, self.rest = zlib.decompressobj(31), bytearray(), b""

    def _more(self) -> bool:
        raw = self.rest or self.stream.read(self.step)
        if not raw:
            return False
        if self.open.eof:
            self.open = zlib.decompressobj(31)
        self.held += self.open.decompress(raw)
        self.rest = self.open.unused_data
        return True

    def read(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("archive breaks off")
        part = bytes(self.held[:n])
        del self.held[:n]
        return part

    def head(self) -> bytes | None:
        """Up to the empty line that ends a record's fields; None at the end of the archive."""
        at = 0
        while (found := self.held.find(b"\r\n\r\n", max(0, at - 3))) < 0:
            at = len(self.held)
            if not self._more():
                if self.held:
                    raise ValueError("archive breaks off")
                return None
        return self.read(found + 4)


def parsed(stream: Any) -> Iterator[dict[str, Any]]:
    """The records of one archive; ``origin`` is the id that a record's segments share."""
    members = Members(stream)
    while (head := members.head()) is not None:
        lines = head.decode().split("\r\n")[1:-2]
        fields = {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        block = members.read(int(fields["content-length"]))
        members.read(4)

        def number(name: str, fields: dict[str, str] = fields) -> int | None:
            return int(fields[name]) if name in fields else None

        yield {
            "type": fields["warc-type"],
            "origin": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
            "page_id": number("warc-page-id"),
            "url": fields.get("warc-target-uri"),
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            "refers_record": fields.get("warc-refers-to"),
            "refers_to": number("warc-refers-to-page-id"),
            "segment": number("warc-segment-number"),
            "total": number("warc-segment-total-length"),
            "block": block,
        }


_RECORD = "type string, origin string, page_id bigint, url string, digest string, refers_record string, refers_to bigint, segment bigint, total bigint, block binary"
_RECORD_ARROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in _RECORD.split(", "))])


def records(manifest: DataFrame, rows_at_once: int = 500) -> DataFrame:
    """All records of the archives, in streams of bounded size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                with open_stream(uri) as stream:
                    held: list[dict[str, Any]] = []
                    for row in parsed(stream):
                        held.append(row)
                        if len(held) == rows_at_once:
                            yield pa.RecordBatch.from_pylist(held, _RECORD_ARROW)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, _RECORD_ARROW)

    return manifest.select("uri").repartition(max(1, manifest.count()), "uri").mapInArrow(read, _RECORD)


def reassembled(found: DataFrame) -> DataFrame:
    """One row per origin: its fields, ``segments`` and ``block`` put together; ``whole`` tells whether nothing is missing.

    Records without a segment number pass by; the others meet by origin. A group is the
    segments of one record. ``whole`` needs the numbers 1 to n once each and the length that
    the last segment states.
    """
    single = found.filter("segment is null").withColumn("whole", F.lit(True)).withColumn("segments", F.array("block")).drop("segment", "total", "block")
    first = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("type", "page_id", "url", "digest", "refers_record", "refers_to")]
    parts = F.sort_array(F.collect_list(F.struct("segment", "block")))
    many = found.filter("segment is not null").groupBy("origin").agg(*first, F.max("total").alias("total"), parts.alias("parts"))
    lengths = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.length(p["block"]))
    numbers = F.col("parts.segment") == F.sequence(F.lit(1).cast("bigint"), F.size("parts").cast("bigint"))
    whole = F.coalesce(numbers & (lengths == F.col("total")), F.lit(False))
    many = many.withColumn("whole", whole).withColumn("segments", F.col("parts.block")).drop("total", "parts")
    return single.unionByName(many)


def payloads(whole: DataFrame) -> DataFrame:
    """type, origin, page_id, url, refers_record, refers_to, payload, payload_bytes, payload_digest and ``intact``.

    A broken record (missing segments, wrong length, bad framing, other digest than stated)
    gives a null payload and ``intact`` false. Revisits have no payload of their own.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                payload = None
                if row["type"] == "response" and row["whole"]:
                    head, _, body = b"".join(row["segments"]).partition(b"\r\n\r\n")
                    try:
                        payload = unchunked(body) if b"chunked" in head.lower() else body
                    except ValueError:
                        payload = None
                digest = None if payload is None else hashlib.sha256(payload).hexdigest()
                good = row["type"] == "revisit" or (digest is not None and row["digest"] in (None, digest))
                out.append({**{k: row[k] for k in ("type", "origin", "page_id", "url", "refers_record", "refers_to")}, "payload": payload if good else None, "payload_bytes": len(payload) if good and payload is not None else None, "payload_digest": digest if good else None, "intact": good})
            yield pa.RecordBatch.from_pylist(out, _PAGE_ARROW)

    return whole.select("type", "origin", "page_id", "url", "digest", "refers_record", "refers_to", "whole", "segments").mapInArrow(decoded, _PAGE)


_PAGE = "type string, origin string, page_id bigint, url string, refers_record string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string, intact boolean"
_PAGE_ARROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[t]) for n, t in (c.split() for c in _PAGE.split(", "))])


def read(manifest: DataFrame) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    A revisit takes size and digest from the response that it names.
    """
    pages = cut_lineage(payloads(reassembled(records(manifest))).drop("payload", "url"))
    names = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to", "intact"]
    own = pages.filter("type <> 'revisit'").select(*names)
    again = pages.filter("type = 'revisit'").select("type", "page_id", "refers_record", "refers_to")
    sizes = again.groupBy("refers_record").agg(F.count(F.lit(1)).alias("group_size"))
    first = pages.filter("type = 'response'").groupBy("origin").agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"), F.min("intact").alias("intact"))
    named = cut_lineage(sizes.join(first.withColumnRenamed("origin", "refers_record"), "refers_record", "left"))
    return own.unionByName(attach(again, named, "refers_record", pages.count()).select(*names))


def archive(pages: DataFrame, folder: str | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes all pages and reads the archives back."""
    return read(write(pages, folder or scratch_path(pages.sparkSession, "warc"), segment_bytes))
