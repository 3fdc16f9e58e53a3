"""WARC archives, Zstandard-compressed record by record with an embedded dictionary.

Each task writes its share of the pages as archives of bounded size.  An archive
holds, first, a skippable frame (magic number 0x184D2A5D) with a dictionary
trained on records of that archive, then one frame per record, so any record can
be read by itself.  Of pages with equal payloads (by SHA-1 and length) the one
with the smallest id is a ``response`` with the payload; the others are
``revisit`` records that name it.

Scale: digests are worked out in one pass and the first page of each digest is
a map-side minimum.  Only digests that several pages share are joined back to
the pages; payloads are shuffled once at most, not at all where that list is
small enough for a broadcast, and a digest that a third of all pages share is
split by the adaptive skew join.  A task holds one archive in memory.  Files
are written under names of their own and count only if the task that wrote them
commits its manifest rows, so a lost or repeated task leaves nothing behind that
is read.  They go to the shared folder through Arrow's filesystem layer, which
reaches local, HDFS and object stores alike.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import keep_table, slices
from strata.session import scratch_path

SKIPPABLE = 0x184D2A5D
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES, TRAINING_BYTES, LEVEL = 32 << 10, 1 << 20, 3
DATE = "2024-01-31T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block but all its headers."""
    block = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The bytes of one archive: dictionary frame and a frame per record.  The
    dictionary is trained on evenly spaced records of up to TRAINING_BYTES; too few
    or too alike records give an archive without one."""
    import zstandard
    step = max(1, sum(map(len, records)) // TRAINING_BYTES)
    frame, options = b"", {}
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records[::step], k=200, d=8, level=LEVEL)
        frame = struct.pack("<II", SKIPPABLE, len(trained.as_bytes())) + trained.as_bytes()
        options["dict_data"] = trained
    except zstandard.ZstdError:
        pass
    squeeze = zstandard.ZstdCompressor(level=LEVEL, **options)
    return frame + b"".join(squeeze.compress(r) for r in records)


def records_of(data: bytes):
    """The records of an archive, in order."""
    import zstandard
    options, at = {}, 0
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        at = 8 + struct.unpack_from("<I", data, 4)[0]
        options["dict_data"] = zstandard.ZstdCompressionDict(data[8:at])
    expand = zstandard.ZstdDecompressor(**options)
    view = memoryview(data)
    while at < len(data):
        one = expand.decompressobj()
        out = one.decompress(view[at:])
        at = len(data) - len(one.unused_data)
        yield out


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in head.decode().split("\r\n")[1:])
    return headers, rest[:int(headers["Content-Length"])]


def _payloads(batch, max_bytes):
    for rows, buf, offsets in slices(batch, "html", max_bytes):
        data = buf.tobytes()
        yield rows, [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _digests(batches):
    for batch in batches:
        for rows, payloads in _payloads(batch, 4 << 20):
            yield pa.RecordBatch.from_arrays([rows.column("page_id"), pa.array([len(p) for p in payloads], pa.int64()),
                                              pa.array([digest(p) for p in payloads])],
                                             ["page_id", "payload_bytes", "sha1"])


def _digested(batches):
    for batch in batches:
        for rows, payloads in _payloads(batch, 4 << 20):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([len(p) for p in payloads], pa.int64()),
                                              pa.array([digest(p) for p in payloads])],
                                             ["page_id", "url", "html", "payload_bytes", "sha1"])


def firsts(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(sha1, payload_bytes, first_id)``: digests that several ids share, with the smallest."""
    rows = pages.select("page_id", "html").mapInArrow(_digests, "page_id long, payload_bytes long, sha1 string")
    return (rows.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
            .groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
            .where("first_id < last_id").drop("last_id"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` to ``folder`` and
    return the manifest ``(path, records, bytes)``.  A null html counts as empty;
    rows with a null id are responses; rows that repeat an id and payload are
    alike.  Other columns are not read."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    shared = keep_table(firsts(pages, min_bytes), "firsts")
    rows = pages.mapInArrow(_digested, "page_id long, url string, html string, payload_bytes long, sha1 string")
    typed = rows.join(shared, ["sha1", "payload_bytes"], "left").select(
        "page_id", "url", "html", "sha1", F.coalesce(F.col("page_id") <= F.col("first_id"), F.lit(True)).alias("own"),
        "first_id")

    def run(batches):
        fs, base = pa.fs.FileSystem.from_uri(folder)
        held, size = [], 0

        def flush():
            name = f"{uuid.uuid4().hex}.warc.zst"
            data = archive(held)
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(data)
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64()),
                                              pa.array([len(data)], pa.int64())], ["name", "records", "bytes"])
            held.clear()
            return out
        for batch in batches:
            for part, payloads in _payloads(batch, 4 << 20):
                page, url, sha1, own, first = (part.column(c).to_pylist() for c in ("page_id", "url", "sha1", "own", "first_id"))
                for i, payload in enumerate(payloads):
                    r = record(page[i], url[i], payload, sha1[i], "response" if own[i] else "revisit", first[i])
                    held.append(r)
                    size += len(r)
                    if size >= archive_bytes:
                        yield flush()
                        size = 0
        if held:
            yield flush()
    fs, base = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    return keep_table(typed.mapInArrow(run, "name string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that ``manifest`` names: ``(page_id, url,
    record_type, refers_to, payload_bytes, payload_digest, payload)``.  Length and
    digest of a response are worked out from its payload and must agree with its
    headers; those of a revisit are its headers' (its payload is null)."""
    def run(batches):
        fs, base = pa.fs.FileSystem.from_uri(folder)

        def page(urn):
            text = urn.strip("<>").rpartition(":")[2] if urn else ""
            return int(text) if text else None
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    data = f.read()
                out, size = [], 0
                for raw in records_of(data):
                    h, block = parse(raw)
                    kind, sha1, length = h["WARC-Type"], h["WARC-Payload-Digest"][5:], int(h["X-Payload-Length"])
                    if kind == "response" and (digest(block), len(block)) != (sha1, length):
                        raise ValueError(f"damaged record {h['WARC-Record-ID']} in {name}")
                    out.append((page(h["WARC-Record-ID"]), h["WARC-Target-URI"], kind, page(h.get("WARC-Refers-To")),
                                length, sha1, block if kind == "response" else None))
                    size += len(block)
                    if size > 4 << 20 or len(out) >= 5000:
                        yield rows(out)
                        out, size = [], 0
                if out:
                    yield rows(out)
    schema = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
              "payload_digest string, payload binary")
    names = manifest.select("name")
    spread = max(2, 2 * manifest.sparkSession.sparkContext.defaultParallelism)
    return names.repartition(spread).mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
