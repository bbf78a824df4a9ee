"""WARC archives without repeated payloads.

Pages with equal payloads of at least ``least`` bytes are one response record and
revisit records that refer to it. Only headers (id, digest, size) are shuffled by
the digest; the decisions then meet the payloads by page, each task writes an
archive of records with fresh headers, and reading an archive joins revisit
records to the responses they refer to.

The page with the smallest page_id of a digest is the response; rows that repeat
that id and payload are responses as well. A null page_id revisits the smallest id
and is a response where there is none. A null html is an empty payload, a null url
an empty header. An empty table gives no archives; other columns are not written.
"""

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage

LEAST = 100
#: Bytes read from an archive at once.
_BLOCK = 1 << 20

#: Names and forms of the WARC 1.1 format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_RECORD = "page_id long, record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def _record_id(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, so that a revisit names its response without a lookup."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}/{digest}'.encode()).digest()[:16], version=5)}>"


def _clean(value: str | None) -> str:
    return " ".join((value or "").split())


def record(page: dict, date: str) -> bytes:
    """One record as a gzip member."""
    revisit = page["refers_to"] is not None
    body = _HTTP.encode() + (b"" if revisit else page["payload"])
    own = _record_id(page["page_id"], page["digest"])
    if page["copy"]:
        own = f"<urn:uuid:{uuid.uuid4()}>"
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": own,
        "WARC-Date": date,
        "WARC-Target-URI": _clean(page["url"]),
        "WARC-Payload-Digest": f"sha256:{page['digest']}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(body)),
    }
    if revisit:
        head |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _record_id(page["refers_to"], page["digest"])}
    if page["page_id"] is not None:
        head["X-Page-ID"] = str(page["page_id"])
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    squeezed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeezed.compress(f"{_VERSION}\r\n{lines}\r\n".encode() + body + b"\r\n\r\n") + squeezed.flush()


def members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of an archive, one after the other."""
    rest = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest and not (rest := stream.read(_BLOCK)):
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(unpack.decompress(rest))
            rest = unpack.unused_data
        yield b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    body = rest[: int(fields["content-length"])]
    if first != _VERSION or rest[len(body) :] != b"\r\n\r\n" or not body.startswith(_HTTP.encode()):
        raise ValueError(f"not a record of these archives: {first}")
    return fields, body[len(_HTTP) :]


def decide(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, digest, first): the page whose record holds the payload; one row per page_id and digest."""
    heads = pages.select("page_id", payload(F.col("html")).alias("raw"))
    heads = heads.select("page_id", F.sha2("raw", 256).alias("digest"), F.octet_length("raw").alias("size"))
    heads = cut_lineage(heads, "warc-heads")
    firsts = heads.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"))
    # every page of a digest has one decision, so equal rows go together
    return heads.join(cut_lineage(firsts, "warc-firsts"), "digest", "left").select("page_id", "digest", "first").distinct()


def write_archives(pages: DataFrame, folder: str, date: str = "2026-01-01T00:00:00Z", least: int = LEAST) -> DataFrame:
    """Writes the archives to a shared folder and gives their paths, one row per file.

    An attempt that is lost or repeated leaves a file of another name; only files
    named in the returned table, which is stored, belong to the result.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n = None, f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            for page in batch.to_pylist():
                if out is None:
                    store, place = fs.FileSystem.from_uri(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place, compression=None)
                out.write(record(page, date))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": n}])

    decided = decide(pages, least).withColumnRenamed("page_id", "p").withColumnRenamed("digest", "d")
    raw = pages.select("page_id", "url", payload(F.col("html")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    joined = raw.join(decided, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")))
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    joined = joined.withColumn("refers_to", refers).withColumn("copy", F.col("refers_to").isNotNull() | F.col("page_id").isNull())
    bare = F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")
    rows = joined.select("page_id", "url", "digest", "refers_to", "copy", bare)
    return cut_lineage(rows.mapInArrow(write, "path string, records long"), "warc-files")


def read_archives(files: DataFrame) -> DataFrame:
    """Every record with the size and digest of its full payload: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
            + [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        )
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                rows = []
                with store.open_input_stream(place, compression=None) as stream:
                    for member in members(stream):
                        head, body = parse(member)
                        kind, page = head["warc-type"], head.get("x-page-id")
                        own = kind == "response"
                        rows.append(
                            {
                                "page_id": None if page is None else int(page),
                                "record_id": head["warc-record-id"],
                                "record_type": kind,
                                "refers_to": head.get("warc-refers-to"),
                                "payload_bytes": len(body) if own else None,
                                "payload_digest": hashlib.sha256(body).hexdigest() if own else None,
                            }
                        )
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = max(files.count(), 1)
    records = cut_lineage(files.select("path").repartition(tasks).mapInArrow(read, _RECORD), "warc-records")
    responses = records.where("record_type = 'response'")
    named = responses.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("first"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d")
    )
    named = cut_lineage(named.distinct(), "warc-responses")
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to").join(named, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", F.col("first").alias("refers_to"))
    )
