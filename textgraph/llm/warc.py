"""WARC archives: a deduplicating writer and a splittable reader (operator 3).

The writer puts each record into a gzip member of its own.  Of records with equal payloads of at least
``revisit_bytes``, the one with the largest id is written as a response, the others as revisits that refer to it, by
WARC-Refers-To and by page id.  What is a revisit is decided on ids and digests alone; while the digests that stand more
than once are few, they are broadcast and no payload is shuffled.

The reader's tasks get byte ranges.  Each scans its range for gzip magic, checks a candidate by decoding it up to a
complete WARC header, and owns the records that start inside the range; from the first record on it follows the
members' ends.  A response's payload digest is recomputed from its payload and compared with the header's; a revisit has
no payload, so its header's digest is given.

Files lie in the shared folder and are reached through the file system of its URI.  A task writes under a name of its
own, so a repeated or lost attempt leaves at most a file that no manifest names: the manifest is a table that Spark
commits once.

Defined cases: a null payload is empty; a null or empty url is left out and read back as null; control characters and
spaces in a url are percent-encoded; rows with equal ids and payloads are responses if theirs is the largest id, and share
a record id; a null id ranks below all others and is read back as null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.llm.common import is_small, map_arrow, new_folder, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a split, of a read beyond it, and that are decoded at a time; rounds of salt for copies of one payload.
SPLIT_BYTES, AHEAD, FED, SALT = 4 << 20, 1 << 18, 1 << 14, 32
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_READ = "record_id string, record_type string, page_id long, url string, refers_to long, payload_digest string, payload_bytes long, payload binary, digest_ok boolean"


def record_id(page_id, digest: bytes) -> str:
    """The id of a response: anyone who knows its page and payload digest can name it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest.hex()}')}>"


def record(page_id, url: str | None, payload: bytes, full_bytes: int, digest: bytes, refers_to, own_id: str | None = None) -> bytes:
    """One record as a gzip member.  digest: SHA-1 of the payload; refers_to: the response's id, for a revisit, which then
    takes own_id."""
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if refers_to is not None else b"response"),
        f"WARC-Record-ID: {own_id if refers_to is not None and own_id else record_id(page_id, digest)}".encode(),
        f"WARC-Date: {DATE}".encode(),
        b"WARC-Payload-Digest: sha1:" + base64.b32encode(digest),
        b"Content-Type: application/http; msgtype=response",
    ]
    if url:
        head.append(b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url).encode())
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}".encode())
    http = _HTTP + f"Content-Length: {full_bytes}\r\n\r\n".encode()
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}".encode(), f"X-Refers-To-Page-ID: {refers_to}".encode()]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}".encode())
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(b"\r\n".join(head) + b"\r\n\r\n" + http + payload + b"\r\n\r\n") + pack.flush()


def decided(pages: DataFrame, revisit_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest, bytes, refers_to.  Copies of one payload are spread over SALT keys."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8").alias("payload")
    ).withColumns({"digest": F.unhex(F.sha1("payload")), "bytes": F.length("payload").cast("long")})
    # only payloads that stand more than once are sought, by narrow rows; the counts are pre-aggregated
    large = rows.select("page_id", "digest", "bytes").where(F.col("bytes") >= revisit_bytes)
    copies = stored(large.groupBy("digest", "bytes").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    if is_small(copies):
        rows = rows.join(F.broadcast(copies), ["digest", "bytes"], "left")
    else:
        copies = copies.select("digest", "bytes", "response", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int"))
        rows = rows.join(copies, ["digest", "bytes", "salt"], "left")
    revisit = F.col("response").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("response")))
    return rows.select("page_id", "url", "payload", "digest", "bytes", F.when(revisit, F.col("response")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 1000, **columns: str) -> DataFrame:
    """Write the archives and give their manifest: path, bytes, records."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n = None, "", 0
        for batch in rows:
            for page_id, url, payload, digest, size, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    store, at = fs.FileSystem.from_uri(folder)
                    store.create_dir(at, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", store.open_output_stream(f"{at}/{name}", compression=None)
                out.write(record(page_id, url, payload, size, digest, refers_to, f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}:{n}')}>"))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([n])], ["path", "bytes", "records"])

    return stored(map_arrow(decided(pages, revisit_bytes, **columns), run, "path string, bytes long, records long"), "manifest")


def member(data: memoryview, at: int, limit: int | None = None):
    """Decode the gzip member at this place: its content and end, (None, None) if data ends first, False if it is none.
    With a limit, only so many decoded bytes are wanted, and the end is not."""
    unpack, parts = zlib.decompressobj(31), []
    try:
        if limit:
            return unpack.decompress(data[at : at + 4096], limit), None
        for k in range(at, len(data), FED):  # all the rest at once would be copied for each member
            parts.append(unpack.decompress(data[k : k + FED]))
            if unpack.eof:
                return b"".join(parts), min(k + FED, len(data)) - len(unpack.unused_data)
    except zlib.error:
        return False
    return None, None


def header(content: bytes) -> dict[str, str] | None:
    end = content.find(b"\r\n\r\n")
    if not content.startswith(b"WARC/1.") or end < 0:
        return None
    lines = content[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


def parsed(content: bytes) -> tuple:
    fields = header(content)
    body = content[content.find(b"\r\n\r\n") + 4 :][: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2])
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    revisit = fields["warc-type"] == "revisit"
    full = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    own = digest if revisit else hashlib.sha1(payload).digest()
    return (
        fields.get("warc-record-id"), fields["warc-type"], int(page) if page else None, fields.get("warc-target-uri"),
        int(refers) if refers else None, own.hex(), int(full[1]) if revisit and full else len(payload),
        None if revisit else payload, None if revisit else own == digest,
    )


def owned(path: str, start: int, end: int) -> Iterator[bytes]:
    """The contents of the records that start in [start, end) of a file."""
    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_file(at) as f:
        size = f.size()
        base = start
        f.seek(base)
        data = f.read(min(size, end + AHEAD) - base)

        def more() -> bool:
            nonlocal data
            if base + len(data) >= size:
                return False
            data += f.read(max(AHEAD, len(data)))
            return True

        def decoded(where: int):
            while (got := member(memoryview(data), where)) and got[0] is None and more():
                pass
            return got or (None, None)

        def first(where: int) -> int:
            """The first true member start at or after this place, by trying each gzip magic."""
            while 0 <= (where := data.find(MAGIC, where)) < end - base or (base + len(data) < end and more()):
                if where < 0:
                    where = max(0, len(data) - 2)
                    continue
                if len(data) - where < 4096:
                    more()
                head = member(memoryview(data), where, 64)
                if head and head[0].startswith(b"WARC/1.") and (content := decoded(where)[0]) is not None and header(content):
                    return where
                where += 1
            return -1

        where = first(0)
        while 0 <= where < end - base:
            content, after = decoded(where)
            if content is None or not header(content):
                where = first(where + 1)  # a damaged member: go on with the next sound one
                continue
            yield content
            if after > AHEAD:  # let go of what has been read
                data, base, after = data[after:], base + after, 0
            where = after
            if where >= len(data) and not more():
                return


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the manifest's archives, read by byte ranges."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    splits = manifest.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    n = int(manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
        names = [x.split()[0] for x in _READ.split(", ")]

        def batch(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

        held, size = [], 0
        for path, start, end in (x for b in rows for x in zip(*(c.to_pylist() for c in b.columns))):
            for content in owned(path, start, end):
                held.append(parsed(content))
                size += len(content)
                if size > AHEAD * 16:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    # a split is one row, dealt to as many tasks as there are splits, 10,000 at most
    return map_arrow(splits.repartition(min(max(n, 1), 10_000)), run, _READ)


def round_trip(spark: SparkSession, pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    return read(write(pages, revisit_bytes=revisit_bytes))


__all__ = ["decided", "member", "owned", "parsed", "read", "record", "round_trip", "write"]
