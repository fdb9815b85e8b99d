"""WARC archives with an index: written per record, read back by byte ranges.

Writing: each task writes its records, one gzip member each, to archive files
of its own (a new one after ``file_bytes``) and returns an index row per
record: file, offset, length, id, URL, digest, type. File names are unique per
attempt and only the index of committed attempts is stored, so a lost executor
or a repeated task leaves unreferenced bytes at most. Equal payloads of at
least ``min_revisit`` bytes are stored once, under the smallest id; the others
are ``revisit`` records that name it and keep the HTTP header.

Reading: selected index rows are sorted by offset within their file and
coalesced into ranges (gaps up to ``max_gap``, about ``range_bytes`` each);
each range is one read, from which the records are cut, parsed and verified.

Archives live on a file system that the executors' Arrow library opens (a
shared mount, HDFS, an object store); the pages themselves are read by Spark.

Defined results: null html is an empty payload; null URL leaves the header out;
a null id is kept (records of null ids are never originals of others); rows
that share an id and a payload are written once each, all as originals; an
empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.session import keep

MIN_REVISIT = 100
FILE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
MAX_GAP = 64 << 10
DATE = "1970-01-01T00:00:00Z"            # pages carry no date; archives are reproducible
RECORD_ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, id long, url string, payload_digest string, record_type string"


def file_system(path: str) -> tuple[FileSystem, str]:
    """The Arrow file system of a folder and the folder's path on it."""
    return FileSystem.from_uri(path)


def record(page: int | None, url: str | None, payload: bytes, size: int, digest: str,
           refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record as a gzip member; a revisit has the HTTP header without the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "revisit" if refers_to is not None else "response"),
              ("WARC-Record-ID", f"<{RECORD_ID}{'' if page is None else page}>"),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,-./:;=?@[]_~")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """The record in one gzip member; raises ValueError when it is damaged."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("truncated WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    payload_bytes = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != payload_bytes or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def number(field: str) -> int | None:
        text = fields.get(field, "").strip("<>").removeprefix(RECORD_ID)
        return int(text) if text else None

    return {"id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "payload": payload if kind == "response" else None, "payload_bytes": payload_bytes,
            "payload_digest": digest, "refers_to": number("WARC-Refers-To")}


def originals(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
              min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(id, digest, refers_to): the pages, by id and payload, whose payload another page of smaller id has."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    found = keep(pages.select(F.col(id_col).cast("long").alias("id"), F.sha2(payload, 256).alias("digest"))
                 .where((F.octet_length(payload) >= min_revisit) & F.col("id").isNotNull()), "payload-digests")
    # stored, so that Spark can split the join on a payload that very many pages share
    shared = keep(found.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last")).where(
        "refers_to < last").select("digest", "refers_to"), "shared-payloads")
    return found.join(shared, "digest").where("id <> refers_to").select("id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", file_bytes: int = FILE_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write archives below ``folder``; the stored index, one row per record."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    again = originals(pages, id_col, html_col, min_revisit)
    # ids may repeat with other payloads: a page revisits only when its own payload is the shared one
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        payload.alias("html"), F.sha2(payload, 256).alias("digest")).join(again, ["id", "digest"], "left")
    rows = rows.select("id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"),
                       F.octet_length("html").alias("size"), "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = {k: [] for k in ("file", "offset", "length", "id", "url", "digest", "type")}
                for page, url, html, size, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = record(page, url, (html or "").encode(), size, digest, refers_to)
                    out.write(data)
                    for column, value in zip(index.values(), (
                            name, at, len(data), page, url, digest,
                            "response" if refers_to is None else "revisit")):
                        column.append(value)
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["file"], pa.string()), pa.array(index["offset"], pa.int64()),
                     pa.array(index["length"], pa.int64()), pa.array(index["id"], pa.int64()),
                     pa.array(index["url"], pa.string()), pa.array(index["digest"], pa.string()),
                     pa.array(index["type"], pa.string())],
                    names=["file", "offset", "length", "id", "url", "payload_digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    return keep(rows.mapInArrow(run, INDEX), "warc-index")


def ranges(index: DataFrame, max_gap: int = MAX_GAP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, start, stop, records): coalesced byte ranges of the selected ``index`` rows."""
    by_file = Window.partitionBy("file").orderBy("offset", "length")      # a file is bounded by file_bytes
    end = F.col("offset") + F.col("length")
    fresh = F.coalesce((F.col("offset") - F.lag(end).over(by_file) > max_gap)
                       | (F.floor(F.col("offset") / range_bytes)
                          != F.floor(F.lag("offset").over(by_file) / range_bytes)), F.lit(True))
    return (index.withColumn("fresh", fresh.cast("int"))
            .withColumn("range", F.sum("fresh").over(by_file.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("file", "range")
            .agg(F.min("offset").alias("start"), F.max(end).alias("stop"),
                 F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))
            .select("file", "start", "stop", "records"))


def read(index: DataFrame, folder: str, payloads: bool = True, max_gap: int = MAX_GAP,
         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of ``index`` rows, read from the archives below ``folder`` and verified.

    (id, url, record_type, payload, payload_bytes, payload_digest, refers_to);
    ``payload`` is null for revisits, and everywhere without ``payloads``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        for batch in batches:
            for file, start, stop, records in batch.itertuples(index=False):
                with fs.open_input_file(f"{root}/{file}") as source:
                    source.seek(start)
                    data = source.read(stop - start)
                found = [parse(data[r["offset"] - start:r["offset"] - start + r["length"]]) for r in records]
                frame = pd.DataFrame(found)
                if not payloads:
                    frame["payload"] = None
                yield frame.astype({"id": "Int64", "refers_to": "Int64"})

    return ranges(index, max_gap, range_bytes).mapInPandas(
        run, "id long, url string, record_type string, payload binary, payload_bytes long, "
             "payload_digest string, refers_to long")
