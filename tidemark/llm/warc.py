"""WARC archives compressed with Zstandard: one frame per record, after a dictionary in a leading skippable frame.

``write_archives`` turns pages into records and rolls files of about ``FILE_BYTES`` within each task. Pages with equal
payloads are told by length and SHA-256 and grouped on those alone; the one with the smallest page_id becomes a response,
the others revisits that refer to it. ``read_archives`` reads the files back as Spark reads binary files, decodes frame
by frame, and validates the version line, the mandatory fields, the lengths, the closing blank lines and the digests.

A file that a lost task left behind isn't in the manifest, which is written last, and so isn't read. The dictionary is
trained on a sample of ``SAMPLE_PAGES`` pages at most; any dictionary gives the same records.

A null html is an empty payload; a null or empty url leaves the target field out, and control characters in it are
percent-encoded. Rows that tie for the smallest page_id of a payload are all responses. Where equal payloads have null
ids only, all are responses; a null id is greater than any other. Empty tables give no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import small, staged
from tidemark.session import work_dir

FILE_BYTES = 8 << 20
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 4096, 64 << 10
# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    """A record or an archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def identity(page_id) -> str:
    """The same for the same page, so that a revisit can name a record that another task wrote."""
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id, url, payload: bytes, first) -> bytes:
    """A response, or a revisit of page ``first`` if that isn't None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", identity(page_id)), ("WARC-Date", DATE)]
    if url:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if first is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", identity(first)), ("WARC-Refers-To-Page-ID", str(first))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise WarcError(f"not a field: {line[:80]!r}")
        found[name.strip()] = value.strip()
    return found


def parse(data: bytes) -> dict:
    """A decoded record's fields and payload, validated."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or lines[0] != VERSION:
        raise WarcError(f"no version line: {data[:40]!r}")
    fields = _fields(lines[1:])
    if missing := [k for k in MANDATORY if k not in fields]:
        raise WarcError(f"fields missing: {missing}")
    if not fields["Content-Length"].isdigit() or int(fields["Content-Length"]) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("the block isn't as long as Content-Length says")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    own = _fields(http.split(b"\r\n")[1:])
    if not blank or not http.startswith(b"HTTP/") or not own.get("Content-Length", "").isdigit():
        raise WarcError("no HTTP header")
    kind, said = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "")
    if kind not in ("response", "revisit") or not re.fullmatch("sha1:[A-Z2-7]{32}", said):
        raise WarcError(f"type {kind!r} or digest {said!r}")
    if kind == "response" and (len(payload) != int(own["Content-Length"]) or digest(payload) != said[5:]):
        raise WarcError("the payload isn't what its length and digest say")
    if kind == "revisit" and (payload or "WARC-Refers-To-Page-ID" not in fields):
        raise WarcError("a revisit with a payload, or of nothing")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": int(own["Content-Length"]),
        "payload_digest": said[5:], "record_type": kind, "refers_to": number("WARC-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


def skippable(dictionary: bytes) -> bytes:
    return SKIPPABLE.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one decoded frame each. The dictionary may be stored as it is or as a frame."""
    kept = None
    view, at = memoryview(data), 0
    if int.from_bytes(view[:4], "little") == SKIPPABLE:
        at = 8 + int.from_bytes(view[4:8], "little")
        if at > len(data):
            raise WarcError("the dictionary is cut off")
        raw = bytes(view[8:at])
        if int.from_bytes(raw[:4], "little") == FRAME:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        kept = zstandard.ZstdCompressionDict(raw) if raw else None
    decoder = zstandard.ZstdDecompressor(dict_data=kept) if kept else zstandard.ZstdDecompressor()
    while at < len(data):
        one = decoder.decompressobj()
        try:
            out = one.decompress(view[at:])
        except zstandard.ZstdError as e:
            raise WarcError(f"no frame at byte {at}: {e}") from e
        if not one.eof:
            raise WarcError(f"the frame at byte {at} is cut off")
        at = len(data) - len(one.unused_data)
        yield out


def train(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample, drawn by hashes."""
    share = min(1.0, 2 * SAMPLE_PAGES / max(1, pages.count()))
    by_hash = F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = pages.where(by_hash & (F.length("html") > 0)).select(F.substring("html", 1, SAMPLE_CHARS)).limit(SAMPLE_PAGES)
    texts = [r[0].encode() for r in sample.collect()]
    if sum(map(len, texts)) < 100 * 1024 or len(texts) < 20:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()


def _writer(folder: str, dictionary: bytes):
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches):
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        kept = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=3, dict_data=kept, write_checksum=True)
        task, made, out, held, n = TaskContext.get(), 0, [], 0, 0

        def close():
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{made:04d}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(skippable(dictionary))
                for x in out:
                    f.write(x)
            return pa.RecordBatch.from_pylist([{"path": name, "n_records": n, "n_bytes": held}], schema)

        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c) for c in ("page_id", "url", "html", "first")), strict=True):
                payload = (html.as_py() or "").encode()
                out.append(encoder.compress(record(page_id.as_py(), url.as_py(), payload, first.as_py())))
                held, n = held + len(out[-1]), n + 1
                if held >= FILE_BYTES:
                    yield close()
                    made, out, held, n = made + 1, [], 0, 0
        if out:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write page_id, url and html of all pages below ``folder``; the manifest, written too, has a row per file."""
    spark = pages.sparkSession
    own = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), F.coalesce(pages["html"], F.lit("")).alias("html"))
    same = F.struct(F.octet_length("html").alias("n"), F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("sha"))
    groups = own.groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    groups = staged(groups.where("n > 1").select("same.*", "first"), "payloads")
    labelled = own.select("*", same.alias("same")).select("page_id", "url", "html", "same.*").join(small(groups, 96), ["n", "sha"], "left")
    first = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base)
    base.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(base)
    uri = base.toString().replace("file:/", "file:///", 1) if re.match("file:/[^/]", base.toString()) else base.toString()
    rows = labelled.select("page_id", "url", "html", first.alias("first"))
    return staged(rows.mapInArrow(_writer(uri, train(own)), MANIFEST), "manifest")


def _reader(batches):
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])
    for batch in batches:
        for content, n in zip(batch.column("content"), batch.column("n_records"), strict=True):
            rows, size, seen = [], 0, 0
            for data in frames(content.as_py()):
                rows.append(parse(data))
                size, seen = size + len(data), seen + 1
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if n.as_py() is not None and seen != n.as_py():
                raise WarcError(f"{seen} records where the manifest has {n}")
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """All records below ``folder``, or those of the files in a manifest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.select(F.regexp_extract("path", "[^/]*$", 0).alias("path"), "content")
    files = files.join(small(manifest, 64), "path") if manifest is not None else files.withColumn("n_records", F.lit(None).cast("long"))
    return files.select("content", "n_records").mapInArrow(_reader, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    folder = work_dir(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, manifest)
