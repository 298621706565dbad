"""WARC archives: records in monolithic gzip, and a normaliser that gives each record its own member.

Archives are rows of a Spark writer, one file each. The writer's line separator is an
empty gzip member, so every file is plain multi-member gzip to its last byte.
"""

import gzip
import hashlib
import json
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.llm.common import scratch

REVISIT_FROM = 1000
ARCHIVE_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
CHUNK = 1 << 20


def decide(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
           least: int = REVISIT_FROM) -> DataFrame:
    """Rows page_id, url, packed (the body, deflated), digest, refers_to: null refers_to is a response.

    Of rows with equal bodies of at least ``least`` bytes, those with the largest page_id
    are responses and the others refer to it; a null page_id is never the largest unless
    all are null. A null body is empty. Bodies are deflated before they are shuffled.
    """
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                          F.coalesce(F.col(html), F.lit("")).alias("body"))

    def deflate(batches):
        for batch in batches:
            bodies = batch.column("body").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"),
                 pa.array([zlib.compress(b, 1) for b in bodies], pa.binary()),
                 pa.array([hashlib.sha1(b).hexdigest() for b in bodies], pa.string())],
                names=["page_id", "url", "packed", "digest"])

    rows = source.mapInArrow(deflate, "page_id long, url string, packed binary, digest string")
    winners = (source.where(F.octet_length("body") >= least).groupBy(F.sha1(F.encode("body", "UTF-8")).alias("same"))
               .agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n"))
               .where("n > 1").select("same", "winner"))
    joined = rows.join(winners, F.col("digest") == F.col("same"), "left")
    other = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return joined.select("page_id", "url", "packed", "digest", F.when(other, F.col("winner")).alias("refers_to"))


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, which states the full payload's length, and no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    block = http + body if refers_to is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe='%/:?#[]@!$&()*+,;=~')}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def split_records(pieces):
    """Whole records out of a stream of bytes; holds one record at a time."""
    held = bytearray()
    need = 0
    for piece in pieces:
        held += piece
        while len(held) >= need:
            stop = held.find(b"\r\n\r\n")
            if stop < 0:
                break
            size = next(int(line[15:]) for line in bytes(held[:stop]).split(b"\r\n")
                        if line.lower().startswith(b"content-length:"))
            need = stop + 4 + size + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(content: bytes):
    """The whole stream of a file, in pieces; empty and further members are read through."""
    while content:
        stream = zlib.decompressobj(31)
        while not stream.eof:
            piece = stream.decompress(content, CHUNK)
            content = stream.unconsumed_tail
            if piece:
                yield piece
            elif not content and not stream.eof:
                raise ValueError("the archive ends inside its stream")
        content = stream.unused_data


def _save(rows: DataFrame, path: str, by: list[str]) -> None:
    (rows.select(F.col("content").cast("string").alias("value"), *by).write.partitionBy(*by)
     .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))


def write_monolithic(decided: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
                     archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of about ``archive_bytes`` before compression, each one gzip stream."""
    def run(batches):
        stream, out, size = zlib.compressobj(6, wbits=31), [], 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "packed", "digest", "refers_to")))
            for page_id, url, packed, digest, refers_to in rows:
                raw = record(page_id, url, zlib.decompress(packed), digest, refers_to, date)
                out.append(stream.compress(raw))
                size += len(raw)
                if size >= archive_bytes:
                    yield _content(b"".join(out) + stream.flush())
                    stream, out, size = zlib.compressobj(6, wbits=31), [], 0
        if size:
            yield _content(b"".join(out) + stream.flush())

    _save(decided.mapInArrow(run, "content binary"), path, [])


def _content(raw: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["content"])


def normalise(spark: SparkSession, source: str, path: str) -> None:
    """Inflates each archive below ``source`` once and rewrites every record as its own member.

    ``kind=archives`` below ``path`` has a folder per archive, ``kind=index`` its sidecar:
    a gzip file of a JSON line per record with offset, length, type, record, digest.
    """
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content")):
                out, at, index = [], 0, []
                for raw in split_records(inflate(content.as_buffer().to_pybytes())):
                    fields, _ = parse(raw)
                    deflate = zlib.compressobj(6, wbits=31)
                    member = deflate.compress(raw) + deflate.flush()
                    index.append({"offset": at, "length": len(member), "type": fields["WARC-Type"],
                                  "record": fields["WARC-Record-ID"], "digest": fields["WARC-Payload-Digest"]})
                    out.append(member)
                    at += len(member)
                lines = "".join(json.dumps(entry) + "\n" for entry in index).encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["archives", "index"]), pa.array([name, name]),
                     pa.array([b"".join(out), gzip.compress(lines, mtime=0)], pa.binary())],
                    names=["kind", "archive", "content"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select(
        F.regexp_extract("path", r"([^/]+?)(?:\.txt)?$", 1).alias("archive"), "content")
    _save(files.mapInArrow(run, "kind string, archive string, content binary"), path, ["kind", "archive"])


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record, read at its offset: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * with_payload)
    names = [c.split()[0] for c in schema.split(", ")]

    def number(urn):
        text = urn.rsplit(":", 1)[1].rstrip(">")
        return None if text == "null" else int(text)

    def run(batches):
        for batch in batches:
            for content, index in zip(batch.column("content"), batch.column("index").to_pylist()):
                view, rows = memoryview(content.as_buffer()), []
                for entry in map(json.loads, gzip.decompress(index).splitlines()):
                    fields, block = parse(gzip.decompress(view[entry["offset"]:entry["offset"] + entry["length"]]))
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = fields["WARC-Type"] == "response"
                    if whole and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    refers = fields.get("WARC-Refers-To")
                    row = (number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"],
                           None if refers is None else number(refers))
                    rows.append(row + (payload if whole else None,) * with_payload)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows else
                    [pa.array([], k) for k in kinds[:len(names)]], names=names)

    def files(kind, column):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return found.where(F.contains(F.col("path"), F.lit(f"/kind={kind}/"))).select(F.regexp_extract("path", r"archive=([^/]+)/[^/]+$", 1).alias("archive"),
                            F.col("content").alias(column))

    both = files("archives", "content").join(files("index", "index"), "archive")
    return both.select("content", "index").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, path: str | None = None, with_payload: bool = False) -> DataFrame:
    """Writes a record per page, normalises the archives and reads them back.

    Repeated rows are records of their own. Empty tables give no rows.
    """
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_monolithic(decide(pages), f"{path}/monolithic")
    normalise(spark, f"{path}/monolithic", f"{path}/normal")
    return read_archives(spark, f"{path}/normal", with_payload)
