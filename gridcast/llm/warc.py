"""WARC archives with a two-level capture index.

Archives: each task writes its records to files of its own, one gzip member
per record, and reports where they lie.  The report is the commit: files of
a lost or repeated task are named by nothing.  The first record (smallest
page_id) of equal payloads is a response, the others are revisits of it.

Index: captures are sorted by their reversed-host URL key and cut into
shards by range; a shard is a file of gzip blocks of ``BLOCK`` captures with
a directory that has a line per block.  The shards' first and last keys (one
row per sorted partition) go to every task; a look-up searches them, then
the directory of the shard, both by binary search, reads the block's bytes
by range, searches the block, and reads the records by range.  A key with
very many captures covers many blocks; these are dealt out before they are
read.

Files are reached through ``pyarrow.fs`` (local, HDFS, S3, GCS paths), at
the shared folder of the cluster.

Cases: a null html is an empty payload; a null url has the key ``-``; rows
with equal page_id are records of their own and are all responses if the
page_id is the smallest of its payload; a null page_id counts as the largest;
white space in a url is percent-encoded in key and header; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.config import scratch_path

from .common import staged

BLOCK = 2000
FILE_BYTES = 1 << 30
READ_BYTES = 4 << 20
#: Archived bytes that one task reads back.
TASK_BYTES = 64 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"

CAPTURE = "page_id long, key string, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"


def url_key(url: Column) -> Column:
    """Reversed-host key: ``http://www.a.org/x?y`` gives ``org,a,www)/x?y``."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1), r"[\x00-\x20]", "%20")
    key = F.concat(F.array_join(F.reverse(F.split(F.regexp_replace(host, r"[\x00-\x20]", "%20"), r"\.")), ","), F.lit(")"), path)
    return F.coalesce(key, F.lit("-"))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _record(page_id, url, html, digest, first) -> tuple[bytes, bytes]:
    """One WARC record."""
    payload = html.encode()
    name = "null" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {name}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None:
        block += payload
    else:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{first}>")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _parse(raw: bytes) -> tuple:
    """A row of RECORD from one record; checks length and digest."""
    head, block = raw.split(b"\r\n\r\n", 1)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    page = fields["X-Page-Id"]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    refers = None
    if fields["WARC-Type"] == "response":
        payload = block.split(b"\r\n\r\n", 1)[1]
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"record of page {page} is damaged")
    else:
        refers = int(fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">"))
    return (None if page == "null" else int(page), size, digest, fields["WARC-Type"], refers, fields.get("WARC-Target-URI"))


def _write(root: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(root)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(r["sha"])).decode()
                raw = gzip.compress(_record(r["page_id"], r["url"], r["html"], digest, r["first"]), LEVEL, mtime=0)
                out.write(raw)
                rows.append((r["page_id"], r["key"], name, at, len(raw)))
                at += len(raw)
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "key", "file", "offset", "length"])
        if out is not None:
            out.close()

    return run


def write_archive(pages: DataFrame, root: str, min_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row under ``root``; rows of CAPTURE."""
    system, path = _open(root)
    system.create_dir(path, recursive=True)
    html = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    slim = pages.select(pages["page_id"].cast("long").alias("p"), F.sha1(html.cast("binary")).alias("s"))
    firsts = staged(slim.groupBy("s").agg(F.min("p").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-firsts")
    again = F.col("least").isNotNull() & (F.octet_length("html") >= min_revisit_bytes) & (F.col("page_id").isNull() | (F.col("page_id") > F.col("least")))
    typed = rows.join(firsts, F.col("sha") == F.col("s"), "left").select("page_id", "url", "html", "sha", url_key(F.col("url")).alias("key"), F.when(again, F.col("least")).alias("first"))
    return staged(typed.mapInArrow(_write(root, file_bytes), CAPTURE), "warc-captures")


def _index(root: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(root)
        lines: list[bytes] = []
        directory: list[str] = []
        name, out, at, count, low, high = uuid.uuid4().hex, None, 0, 0, None, None

        def flush():
            nonlocal at
            raw = gzip.compress(b"\n".join(lines), LEVEL, mtime=0)
            out.write(raw)
            directory.append(json.dumps([lines[0].split(b" ", 1)[0].decode(), lines[-1].split(b" ", 1)[0].decode(), at, len(raw)]))
            at += len(raw)
            lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    out = system.open_output_stream(f"{path}/{name}.idx", compression=None)
                    low = r["key"]
                lines.append(f"{r['key']} {json.dumps([r['page_id'], r['file'], r['offset'], r['length']])}".encode())
                high, count = r["key"], count + 1
                if len(lines) >= block:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with system.open_output_stream(f"{path}/{name}.dir", compression=None) as d:
                d.write("\n".join(directory).encode())
            yield pa.RecordBatch.from_pylist([{"shard": name, "low": low, "high": high, "captures": count}])

    return run


def build_index(captures: DataFrame, root: str, block: int = BLOCK) -> DataFrame:
    """Write the index under ``root``; one row per shard: ``shard, low,
    high, captures``."""
    system, path = _open(root)
    system.create_dir(path, recursive=True)
    order = ["key", "file", "offset"]
    ordered = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ordered.mapInArrow(_index(root, block), "shard string, low string, high string, captures long"), "warc-shards")


def _find_blocks(root: str, shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(root)
        names, lows, highs = shards.value
        open_name, directory, firsts, lasts = None, [], [], []
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                raw = key.encode()
                for s in range(bisect_left(highs, raw), bisect_right(lows, raw)):
                    if open_name != names[s]:
                        open_name = names[s]
                        with system.open_input_file(f"{path}/{open_name}.dir") as d:
                            directory = [json.loads(x) for x in d.read().decode().split("\n")]
                        firsts, lasts = [x[0].encode() for x in directory], [x[1].encode() for x in directory]
                    for b in range(bisect_left(lasts, raw), bisect_right(firsts, raw)):
                        rows.append({"key": key, "shard": open_name, "at": directory[b][2], "size": directory[b][3]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    return run


def _find_captures(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(root)
        held, keys, lines = None, [], []
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if held != (r["shard"], r["at"]):
                    held = (r["shard"], r["at"])
                    with system.open_input_file(f"{path}/{r['shard']}.idx") as f:
                        f.seek(r["at"])
                        lines = gzip.decompress(f.read(r["size"])).split(b"\n")
                    keys = [x.split(b" ", 1)[0] for x in lines]
                raw = r["key"].encode()
                for x in lines[bisect_left(keys, raw) : bisect_right(keys, raw)]:
                    page, file, offset, length = json.loads(x.split(b" ", 1)[1])
                    rows.append((page, r["key"], file, offset, length))
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "key", "file", "offset", "length"])

    return run


def lookup(urls: DataFrame, shards: DataFrame, root: str) -> DataFrame:
    """Captures of the given urls (column ``url``): rows of CAPTURE."""
    spark = urls.sparkSession
    # one row per sorted partition of the index
    top = sorted(shards.collect(), key=lambda r: (r["low"].encode(), r["high"].encode()))
    held = spark.sparkContext.broadcast(([r["shard"] for r in top], [r["low"].encode() for r in top], [r["high"].encode() for r in top]))
    keys = urls.select(url_key(urls["url"]).alias("key")).distinct()
    blocks = keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_find_blocks(root, held), "key string, shard string, at long, size long")
    dealt = blocks.repartitionByRange("shard", "at", "key").sortWithinPartitions("shard", "at", "key")
    return dealt.mapInArrow(_find_captures(root), CAPTURE)


def _read(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(root)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        for batch in batches:
            rows, todo = [], [(r["file"], r["offset"], r["length"]) for r in batch.to_pylist()]
            i = 0
            while i < len(todo):
                # records that lie side by side are read at once
                file, low, length = todo[i]
                j, end = i + 1, low + length
                while j < len(todo) and todo[j][0] == file and todo[j][1] == end and end - low < READ_BYTES:
                    end += todo[j][2]
                    j += 1
                with system.open_input_file(f"{path}/{file}") as f:
                    f.seek(low)
                    raw = f.read(end - low)
                rows += [_parse(zlib.decompress(raw[o - low : o - low + n], 31)) for _, o, n in todo[i:j]]
                i = j
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return run


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """Rows of RECORD, read by range from the archives under ``root``.

    Capture rows are small and the records behind them are not, so the number
    of tasks follows from the bytes to read; ``captures`` is read twice and
    should be a staged table."""
    order = ["file", "offset"]
    total = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return captures.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(_read(root), RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages``, index the archive, look every url up, read back."""
    root = scratch_path(pages.sparkSession, "warc")
    captures = write_archive(pages, f"{root}/data")
    shards = build_index(captures, f"{root}/index")
    found = staged(lookup(pages.select(pages["url"].alias("url")), shards, f"{root}/index"), "warc-found")
    return read_records(found, f"{root}/data").drop("target_uri")
