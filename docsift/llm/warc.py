"""Deterministic sharded WARC writer and reader.

Records are dealt to ranges of page ids and sorted inside (the ranges' bounds
are percentiles of the ids, so the same table gives the same files, whatever
the cluster).  A range's file rolls to the next number once it holds
``roll_bytes`` compressed bytes; every record is a gzip member of its own.
WARC and HTTP headers and digests are regenerated from the payload; nothing in
a file depends on the time or place of writing.

Payloads of at least ``REVISIT_MIN`` bytes that occur more than once are stored
once, with the smallest page id; the others become revisit records.  Which
page refers to which is found on narrow rows (id and digest) and sent along in
the same range shuffle as marker rows just before their page.

Commit: a task writes under a temporary name and renames the file when it is
complete, so a lost executor leaves temporary files only; the files that count
are listed in a manifest (name, records, bytes, SHA-256 of the file), which is
itself written under a temporary name and renamed.  The reader takes the files
of the manifest, checks their digests and streams them record by record.

Defined results: a null html is an empty payload; a null url becomes
``urn:page:<id>``, control characters and spaces in it are percent-encoded;
rows that repeat the smallest id of a payload are all responses; a null id
sorts first and refers to the smallest id with its payload, if there is one;
an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import dealt, key_bounds, range_number, shuffle_width

REVISIT_MIN = 100
ROLL_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "file string, range int, number int, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


@lru_cache(maxsize=4)
def _store(root: str):
    from pyarrow import fs

    # Hadoop's names of the S3 scheme
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", root))


def _record(kind: str, name: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", DATE), *fields,
            ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))]
    raw = "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def page_record(page_id, url, payload: bytes, refers_to) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    fields = [("WARC-Target-URI", target), ("Page-Id", "null" if page_id is None else str(page_id)), ("WARC-Payload-Digest", "sha256:" + digest),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return _record("response", f"page:{page_id}:{target}:{digest}", fields, http + payload)
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Refers-To-Page-Id", str(refers_to))]
    return _record("revisit", f"page:{page_id}:{target}:{digest}", fields, http)


def write_archives(pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``root``; the manifest."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    bounds = key_bounds(rows, "id", 2 * shuffle_width(spark))
    rng = range_number(F.col("id"), bounds)
    narrow = rows.where(F.octet_length("html") >= REVISIT_MIN).select("id", F.sha2("html", 256).alias("digest"))
    first = narrow.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    marks = (narrow.join(first.select("digest", "refers_to"), "digest").where("id is null or id <> refers_to").distinct()
             .select(rng.alias("rng"), "id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                     F.lit(None).cast("string").alias("html"), "digest", "refers_to"))
    own = rows.select(rng.alias("rng"), "id", F.lit(1).alias("kind"), "url", "html",
                      F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to"))

    def run(batches):
        store, base = _store(root)
        store.create_dir(base, recursive=True)
        out = None                                  # the open file
        page, marked = object(), {}

        def begin(r, number):
            temp = f"{base}/.{uuid.uuid4().hex}.tmp"
            o = {"range": r, "number": number, "temp": temp, "to": store.open_output_stream(temp), "records": 0, "bytes": 0, "sha": hashlib.sha256()}
            put(o, _record("warcinfo", f"info:{r}:{number}", [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            return o

        def put(o, data):
            o["to"].write(data)
            o["sha"].update(data)
            o["bytes"] += len(data)

        def end(o):
            o["to"].close()
            name = f"part-{o['range']:06d}-{o['number']:05d}.warc.gz"
            store.move(o["temp"], f"{base}/{name}")
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([o["range"]], pa.int32()), pa.array([o["number"]], pa.int32()), pa.array([o["records"]], pa.int64()),
                 pa.array([o["bytes"]], pa.int64()), pa.array([o["sha"].hexdigest()])], names=["file", "range", "number", "records", "bytes", "sha256"])

        for b in batches:
            cols = [b.column(i).to_pylist() for i in (0, 1, 2, 3, 5, 6)]
            for i, (r, page_id, kind, url, digest, refers_to) in enumerate(zip(*cols)):
                if page_id != page:
                    page, marked = page_id, {}
                if kind == 0:
                    marked[digest] = refers_to
                    continue
                if out is not None and (out["range"] != r or out["bytes"] >= roll_bytes):
                    number = out["number"] + 1 if out["range"] == r else 0
                    yield end(out)
                    out = begin(r, number)
                elif out is None:
                    out = begin(r, 0)
                payload = b.column(4)[i].as_py().encode("utf-8")
                to = marked.get(hashlib.sha256(payload).hexdigest()) if marked else None
                put(out, page_record(page_id, url, payload, to))
                out["records"] += 1
        if out is not None:
            yield end(out)

    ranges = dealt(own.unionByName(marks), "rng", len(bounds)).sortWithinPartitions("rng", "id", "kind", "url", "html")
    temp, final = f"{root}/_manifest-{uuid.uuid4().hex}.tmp", f"{root}/_manifest"
    ranges.mapInArrow(run, MANIFEST).write.parquet(temp)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(temp).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(temp), path(final)):
        raise RuntimeError(f"{final} exists already")
    return spark.read.schema(MANIFEST).parquet(final)


def read_records(stream):
    """(header fields, block) of every record of a gzip-member stream."""
    buffer, z = b"", zlib.decompressobj(31)
    parts: list[bytes] = []
    while True:
        data = buffer or stream.read(1 << 20)
        buffer = b""
        if not data:
            if parts:
                raise ValueError("the file ends inside a record")
            return
        parts.append(z.decompress(data))
        if z.eof:
            raw, buffer = b"".join(parts), z.unused_data
            parts, z = [], zlib.decompressobj(31)
            head, _, rest = raw.partition(b"\r\n\r\n")
            lines = head.decode("utf-8").split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            block = rest[:int(fields["Content-Length"])]
            if "sha256:" + hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"]:
                raise ValueError(f"digest of {fields['WARC-Record-ID']}")
            yield fields, block


def read_archives(manifest: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """Page records of the manifest's files, as :data:`RECORDS`."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        store, base = _store(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                out, size = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for fields, block in read_records(f):
                        kind = fields["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response":
                            n, digest = len(payload), hashlib.sha256(payload).hexdigest()
                            if digest != stated:
                                raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
                        else:
                            n, digest, payload = int(re.search(rb"Content-Length: (\d+)", http)[1]), stated, None
                        page, to = fields["Page-Id"], fields.get("Refers-To-Page-Id")
                        out.append({"page_id": None if page == "null" else int(page), "url": fields["WARC-Target-URI"], "payload_bytes": n,
                                    "payload_digest": digest, "record_type": kind, "refers_to": None if to is None else int(to),
                                    "payload": payload if payloads else None})
                        size += len(payload or b"") if payloads else 100
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    # an explicit number, or the few short rows would be coalesced to one task
    return manifest.select("file").repartition(shuffle_width(manifest.sparkSession), "file").mapInArrow(run, RECORDS)
