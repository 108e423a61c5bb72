"""WARC archives, index first.

Writing gives each task archives of its own in a folder that all machines share, one gzip member for
each record, and an index row (file, offset, length, url, digest, type) for each record. The index is
written as a table before anything is read. Reading selects index rows, deals them out in ranges of
(file, offset), sorts, and joins neighbours into byte-range reads of bounded size.

A response's block is an HTTP response, its payload the html behind the HTTP head; a revisit's is the head alone, so
readers of the standard take both. Ids are UUIDs: of page and payload for what revisits refer to (exact repeats of such
a row share it), else drawn for each record; the page's own id is in X-Page-ID.

Of records with equal payloads of at least LEAST bytes, the one with the largest page_id is the
response and the others are revisits of it; smaller payloads and copies that share that largest id are
all responses. A null page_id is never the largest, so it revisits where there is another. Null html
is an empty payload and a null url is written as an empty target. Equal payloads are those of equal
SHA-1 and length. An archive's name holds a number of its attempt, so a task that is run again after a
loss writes anew and the index names only archives of tasks that ended. An empty table gives an empty
index. A long payload is one record, and a read of its own where it is larger than MOST_READ. Columns of
the input other than key, url and html are not read, so none clashes. Archives may lie in any folder that
both Spark and Arrow can open (s3a:// is read as s3://).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from sitefold.llm.common import materialise, new_dir

LEAST = 1000
#: Bytes of one archive, of one read, and of a gap that a read passes over.
MOST_FILE, MOST_READ, MOST_GAP = 1 << 30, 8 << 20, 64 << 10
#: Bytes of archives that one task reads.
TASK_BYTES = 32 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id bigint, url string, file string, offset bigint, length bigint, payload_digest string, record_type string, refers_to bigint"


def opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder, and the folder's path there."""
    scheme, sep, rest = folder.partition("://")
    if sep and scheme.lower() in ("s3a", "s3n"):
        folder = f"s3://{rest}"
    return pa.fs.FileSystem.from_uri(folder if sep or folder.startswith("file:") else f"file://{folder}")


def record_uri(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member of its own."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{uuid.uuid4().urn if revisit or len(payload) < LEAST else record_uri(page_id, digest)}>",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <{record_uri(refers_to, digest)}>", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + squeeze.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block. Raises ValueError if the record isn't whole."""
    raw = zlib.decompress(member, 31)
    head, sep, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    if not version.startswith("WARC/") or not sep or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, rest[:n]


def http_payload(block: bytes) -> bytes:
    """What stands behind the HTTP head. Raises ValueError if the block is no HTTP response."""
    head, sep, payload = block.partition(b"\r\n\r\n")
    if not head.startswith(b"HTTP/") or not sep:
        raise ValueError("not an HTTP response")
    return payload


def plan(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """(page_id, url, html, payload_digest, refers_to): which record each page will have.

    Digests are grouped after a partial aggregation; only those with several pages come back.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("html"))
    rows = rows.withColumns({"payload_digest": F.sha1("html"), "_bytes": F.octet_length("html")})
    groups = rows.where(F.col("_bytes") >= least).groupBy(F.col("payload_digest").alias("_d"), F.col("_bytes").alias("_n"))
    groups = groups.agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    rows = rows.join(groups, (F.col("payload_digest") == F.col("_d")) & (F.col("_bytes") == F.col("_n")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.select("page_id", "url", "html", "payload_digest", refers.alias("refers_to"))


def write(planned: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", most: int = MOST_FILE) -> DataFrame:
    """Writes the archives under folder and returns the index, itself a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        fs.create_dir(root, recursive=True)
        out = name = None
        offset = 0
        try:
            for b in batches:
                index = []
                for page, url, html, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None or offset > most:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    member = record(page, url, html.encode(), digest, refers, date)
                    out.write(member)
                    index.append((page, url, name, offset, len(member), digest, "response" if refers is None else "revisit", refers))
                    offset += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), _TYPES)] if index else [pa.array([], t) for t in _TYPES], names=_NAMES)
        finally:
            if out is not None:
                out.close()

    return materialise(planned.select("page_id", "url", "html", "payload_digest", "refers_to").mapInArrow(run, INDEX), "warc-index")


_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_TYPES = [pa.int64() if x.endswith("bigint") else pa.string() for x in INDEX.split(", ")]
READ = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that index selects, read and checked against their digests.

    A revisit's payload_bytes and payload_digest are those of the full payload it stands for.
    """
    names = [x.split()[0] for x in READ.split(", ")]
    types = [pa.int64() if x.endswith("bigint") else pa.binary() if x.endswith("binary") else pa.string() for x in READ.split(", ")]

    def one(member: bytes) -> tuple:
        fields, block = parse(member)
        body = http_payload(block)
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        refers, size = None, len(body)
        if fields["warc-type"] == "revisit":
            refers, size, body = int(fields["x-refers-to-page-id"]), int(fields["x-payload-length"]), None
        elif hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} doesn't have its digest")
        page = fields["x-page-id"]
        return int(page) if page else None, fields["warc-target-uri"], body if payloads else None, size, digest, fields["warc-type"], refers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name = source = None

        def fetched(run_of: list[tuple[str, int, int]]) -> pa.RecordBatch:
            nonlocal name, source
            file, first = run_of[0][:2]
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, fs.open_input_file(f"{root}/{file}")
            data = source.read_at(run_of[-1][1] + run_of[-1][2] - first, first)
            rows = [one(data[o - first : o - first + n]) for _, o, n in run_of]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        waiting: list[tuple[str, int, int]] = []
        try:
            for b in batches:
                for at in zip(*(c.to_pylist() for c in b.columns)):
                    if waiting:
                        file, offset, length = waiting[-1]
                        far = at[0] != file or at[1] > offset + length + MOST_GAP or at[1] + at[2] - waiting[0][1] > MOST_READ
                        if far:
                            yield fetched(waiting)
                            waiting = []
                    waiting.append(at)
            if waiting:
                yield fetched(waiting)
        finally:
            if source is not None:
                source.close()

    total = index.agg(F.sum("length")).first()[0] or 0  # the index is small; what it stands for decides the number of tasks
    dealt = index.select("file", "offset", "length").repartitionByRange(total // TASK_BYTES + 1, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, READ)


def op9(spark, sf_dir: str) -> DataFrame:
    folder = new_dir(spark, "warc")
    index = write(plan(spark.read.parquet(f"{sf_dir}/pages.parquet")), folder)
    out = read(index, folder, payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT payload_bytes, sha1(coalesce(html, '')) payload_digest FROM pages),
g AS (SELECT payload_digest, payload_bytes, max(page_id) first FROM p WHERE payload_bytes >= {LEAST} GROUP BY ALL HAVING count(*) > 1)
SELECT p.*, CASE WHEN g.first IS NOT NULL AND page_id IS DISTINCT FROM g.first THEN 'revisit' ELSE 'response' END record_type,
       CASE WHEN page_id IS DISTINCT FROM g.first THEN g.first END refers_to
FROM p LEFT JOIN g USING (payload_digest, payload_bytes)"""
