"""WARC archives, index first: records are written with their place, and read by coalesced byte ranges."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.session import materialize, shared_path

#: Ranges with gaps up to GAP bytes are read at once, up to RANGE bytes together.
GAP, RANGE = 64 << 10, 4 << 20
#: Groups of copies with their URLs are broadcast up to this many bytes; more are joined by shuffle.
MAX_BROADCAST_BYTES = 48 << 20
#: Bytes of archives aimed at in a reading task, and most tasks; larger selections have larger tasks.
TASK_BYTES, MOST_TASKS = 4 << 20, 20_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(value: str | None) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value or "")


def record(page: object, url: str | None, payload: bytes, digest: str, target: object, target_url: str | None, date: str) -> tuple[str, bytes]:
    """(type, bytes) of one record; a target makes it a revisit, which keeps the HTTP headers alone."""
    kind = "response" if target is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if target is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Target-URI: {_line(url)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if target is not None:
        head[5:5] = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{target}>", f"WARC-Refers-To-Target-URI: {_line(target_url)}"]
    return kind, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(value: str | None) -> int | None:
    digits = (value or "")[len("<urn:page:"):-1]
    return int(digits) if digits else None


def parse(raw: bytes) -> dict:
    """The fields of one record's bytes; a response's payload is measured and hashed anew."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\ncontent-length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        length, got = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if got != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} has another payload than its digest says")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": length, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": _page(fields.get("WARC-Refers-To")), "payload": payload,
    }


def write_archives(
    pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 0, level: int = 3, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page, gzip member by member, and return the index of all records:
    (file, offset, length, url, payload_digest, record_type).

    Of equal payloads of at least `least_bytes` bytes the one with the largest key is a response and the
    others revisit it; rows that repeat the largest key are responses too, and so are rows without a key
    when no equal payload has one. Null html is an empty payload, a null url an empty one. Other columns
    are not read. An empty table gives no file and an empty index.

    Each task writes a file of its own and each attempt another, so a retried task never mixes with a
    lost one; only files named in the index count. The index is a table in the shared folder, written
    once, so archives aren't written again when it is read.
    """
    import pyarrow as pa

    folder = folder or shared_path(pages.sparkSession, "warc")
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("k"), F.col(url).cast("string").alias("u"), body.alias("b"), F.sha1(body.cast("binary")).alias("d"))
    groups = rows.where((F.octet_length("b") >= least_bytes)).groupBy("d").agg(F.count("*").alias("n"), F.max(F.when(F.col("k").isNotNull(), F.struct("k", "u"))).alias("top"))
    groups = materialize(groups.where("n > 1 and top is not null").select("d", F.col("top.k").alias("top"), F.col("top.u").alias("top_url")), "warc-groups")
    held = groups.agg(F.sum(F.octet_length("d") + F.coalesce(F.octet_length("top_url"), F.lit(0)) + 24)).first()[0] or 0
    if held <= MAX_BROADCAST_BYTES:
        groups = F.broadcast(groups)
    placed = rows.join(groups, "d", "left").select("k", "u", "b", "d", F.when(F.col("k").isNull() | (F.col("k") < F.col("top")), F.col("top")).alias("to"), "top_url")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder)
        name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        names = ["file", "offset", "length", "url", "payload_digest", "record_type"]
        try:
            for b in it:
                rows = []
                for r in b.to_pylist():
                    if out is None:
                        store.create_dir(top, recursive=True)
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                    payload = r["b"].encode("utf-8", "surrogatepass")
                    digest = base64.b32encode(bytes.fromhex(r["d"])).decode()
                    kind, raw = record(r["k"], r["u"], payload, digest, r["to"], r["top_url"], date)
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    rows.append((name, offset, len(member), r["u"], digest, kind))
                    offset += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()])], names)
        finally:
            if out is not None:
                out.close()

    index = placed.mapInArrow(write, "file string, offset long, length long, url string, payload_digest string, record_type string")
    return materialize(index, "warc-index").withColumn("file", F.concat(F.lit(folder.rstrip("/") + "/"), "file"))


def coalesced(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, start, end, positions) of byte ranges that cover sorted (file, offset, length)."""
    now = None
    for i, (file, offset, length) in enumerate(places):
        if now and now[0] == file and offset - now[2] <= GAP and offset + length - now[1] <= RANGE:
            now[2] = max(now[2], offset + length)
            now[3].append(i)
        else:
            if now:
                yield tuple(now)
            now = [file, offset, offset + length, [i]]
    if now:
        yield tuple(now)


def read_records(index: DataFrame, payload: bool = False) -> DataFrame:
    """Read the selected records of an index: (page_id, url, payload_bytes, payload_digest, record_type,
    refers_to[, payload]). Any filter on the index selects records; the rest of an archive isn't read. An
    empty selection gives no rows, and a record selected twice is read twice."""
    import pyarrow as pa

    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if payload:
        kinds["payload"] = pa.binary()

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files: dict = {}
        for b in it:
            places = list(zip(*[b.column(c).to_pylist() for c in ("file", "offset", "length")]))
            for file, start, end, at in coalesced(places):
                if file not in files:
                    files.clear()
                    store, path = fs.FileSystem.from_uri(file)
                    files[file] = store.open_input_file(path)
                raw = files[file].read_at(end - start, start)
                rows = [parse(zlib.decompress(raw[places[i][1] - start: places[i][1] - start + places[i][2]], 31)) for i in at]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], list(kinds))

    # tasks are cut by the bytes they'll read, not by the size of the index
    places = index.select("file", "offset", "length")
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(MOST_TASKS, -(-total // TASK_BYTES)))
    sorted_rows = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    text = ", ".join(f"{n} {'long' if t == pa.int64() else 'string' if t == pa.string() else 'binary'}" for n, t in kinds.items())
    return sorted_rows.mapInArrow(read, text)
