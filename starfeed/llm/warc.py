"""WARC archives with a two-level capture index.

Level one: sorted lines, one for each record, in compressed blocks; level two: a sparse directory with
the first key of each block. A look-up searches the directory, reads one block by its byte range, searches that,
and reads the record by its own byte range. Keys are URLs with the host reversed, so a
domain's captures lie together.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from starfeed.llm.text import chunks, map_batches
from starfeed.workspace import work_dir, written

LEAST_REVISIT = 1000  # bytes; equal payloads below it are all stored
BLOCK_LINES = 2000
READ_AHEAD = 1 << 20
#: Fixed value: the time of all records, which are made in one go, so that archives do not depend on the clock.
DATE = "2024-01-01T00:00:00Z"
CAPTURES = "key string, page_id long, digest string, payload_bytes long, record_type string, refers_to long, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """Reversed-host key: ``http://www.a.org:80/x?y`` becomes ``org,a,www:80)/x?y``. Of a URL
    without ``://`` the key is the URL itself, of a null one it is empty."""
    rest = F.regexp_extract(url, r"(?s)^[^/?#]*?://(.*)$", 1)
    place = F.regexp_extract(rest, r"(?s)^([^/?#]*)(.*)$", 1)
    path = F.regexp_extract(rest, r"(?s)^([^/?#]*)(.*)$", 2)
    host, port = F.lower(F.regexp_extract(place, r"(?s)^(.*?)(:[0-9]*)?$", 1)), F.regexp_extract(place, r"(?s)^(.*?)(:[0-9]*)?$", 2)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.concat(reversed_host, port, F.lit(")"), path)).otherwise(url), F.lit(""))


def _payloads(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), html.alias("payload"),
        F.sha1(html).alias("digest"), F.length(html).cast("long").alias("payload_bytes"),
    )


def _revisits(payloads: DataFrame) -> DataFrame:
    """(of_id, of_digest, refers_to) of the pages whose payload another page's record holds.

    Digests are counted in each task first. Keys that many pages share are split by Spark's skew join, as
    either side is narrow and comes straight from an exchange.
    """
    long_ones = payloads.where(F.col("payload_bytes") >= LEAST_REVISIT).select("page_id", "digest")
    holders = long_ones.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    both = long_ones.join(holders.select(F.col("digest").alias("of_digest"), "refers_to"), F.col("digest") == F.col("of_digest"))
    other = both.where(F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to")))
    return other.select(F.col("page_id").alias("of_id"), "of_digest", "refers_to").distinct()


def _record(url: str | None, page_id: int | None, digest: str, size: int, payload: bytes, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    target = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~|^`{}\"\\<>")  # no spaces, controls or line ends in a header
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers, HTTP head, payload) of one compressed record."""
    head, _, block = gzip.decompress(raw).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes each row of ``pages`` (page_id, url, html) as a record and returns the captures, one for each record.

    Of equal payloads of ``LEAST_REVISIT`` bytes or more the row with the largest page_id is a
    response and the others revisit it; shorter ones, and rows that repeat the largest page_id, are responses. A null html is
    empty; a row without page_id revisits any that has one. Each task streams into a file of its own under a
    new name, and only files of tasks that finished are ever referred to, so retries leave nothing but unread files.
    """
    folder = folder or work_dir(pages.sparkSession, "warc")
    payloads, at = _payloads(pages), folder
    revisits = written(_revisits(payloads), "revisits")
    same = payloads["page_id"].eqNullSafe(revisits["of_id"]) & (payloads["digest"] == revisits["of_digest"])
    records = payloads.join(revisits, same, "left").select(
        url_key(F.col("url")).alias("key"), "page_id", "digest", "payload_bytes", "refers_to", "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: BinaryIO | None = None
        for batch in chunks(batches, "payload"):
            if out is None:
                store, base = pafs.FileSystem.from_uri(at)
                store.create_dir(base)
                name = f"{uuid.uuid4().hex}.warc.gz"
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                offset = 0
            lines: list[tuple] = []
            key, ids, digests, sizes, refers, urls, bodies = (batch.column(i).to_pylist() for i in range(7))
            for k, page_id, digest, size, refers_to, url, payload in zip(key, ids, digests, sizes, refers, urls, bodies):
                raw = _record(url, page_id, digest, size, payload, refers_to)
                out.write(raw)
                kind = "response" if refers_to is None else "revisit"
                lines.append((k, page_id, digest, size, kind, refers_to, name, offset, len(raw)))
                offset += len(raw)
            yield pa.RecordBatch.from_pylist([dict(zip(_CAPTURE_SCHEMA.names, x)) for x in lines], _CAPTURE_SCHEMA)
        if out is not None:
            out.close()

    return written(map_batches(records, run, CAPTURES), "captures")


_CAPTURE_SCHEMA = pa.schema(
    [(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in CAPTURES.split(", "))]
)


class Index:
    """Where an index lies: its folder, the archives', and the shards in order with their first keys.
    There are as many shards as sorting tasks, whatever the number of records."""

    def __init__(self, folder: str, archives: str, shards: list[tuple[str, int, str]]):
        self.folder, self.archives, self.shards = folder, archives, shards
        self.firsts = [(k, p) for k, p, _ in shards]

    def shard(self, key: str, page_id: int) -> str | None:
        at = bisect.bisect_right(self.firsts, (key, page_id)) - 1
        return self.shards[at][2] if at >= 0 else None


def _id(page_id: int | None) -> int:
    return -(2**63) if page_id is None else page_id


def build_index(captures: DataFrame, archives: str, folder: str | None = None) -> Index:
    """Sorts the captures by (key, page_id) over many tasks; each writes a shard of compressed blocks and its directory.

    Captures of one URL may span blocks and shards, since page_id is part of the order.
    """
    folder = folder or work_dir(captures.sparkSession, "capture-index")
    at = folder
    ordered = captures.withColumn("sort_id", F.coalesce("page_id", F.lit(-(2**63)))).repartitionByRange("key", "sort_id").sortWithinPartitions("key", "sort_id").drop("sort_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(at)
        out, name, offset, directory, lines = None, uuid.uuid4().hex, 0, [], []

        def flush() -> None:
            nonlocal offset
            raw = gzip.compress("\n".join(map(json.dumps, lines)).encode(), 6, mtime=0)
            out.write(raw)
            directory.append([lines[0][0], _id(lines[0][1]), offset, len(raw)])
            offset += len(raw)
            lines.clear()

        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(base)
                out = store.open_output_stream(f"{base}/{name}.cdx.gz", compression=None)
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(line)
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with store.open_output_stream(f"{base}/{name}.directory", compression=None) as f:
                f.write("\n".join(map(json.dumps, directory)).encode())
            yield pa.record_batch([pa.array([directory[0][0]]), pa.array([directory[0][1]], pa.int64()), pa.array([name])], ["key", "page_id", "name"])

    shards = written(map_batches(ordered, run, "key string, page_id long, name string"), "shards").collect()
    return Index(folder, archives, sorted((r["key"], r["page_id"], r["name"]) for r in shards))


class _Shard:
    """A shard's directory, and the block read last: sorted look-ups read each block once."""

    def __init__(self, store: pafs.FileSystem, base: str, name: str):
        with store.open_input_stream(f"{base}/{name}.directory", compression=None) as f:
            self.directory = [json.loads(x) for x in f.read().decode().split("\n")]
        self.firsts = [(k, p) for k, p, _, _ in self.directory]
        self.file, self.at, self.lines, self.keys = store.open_input_file(f"{base}/{name}.cdx.gz"), -1, [], []

    def find(self, key: str, page_id: int) -> list[list]:
        wanted, found = (key, page_id), []
        block = max(bisect.bisect_left(self.firsts, wanted) - 1, 0)
        while block < len(self.firsts) and self.firsts[block] <= wanted:
            if block != self.at:
                _, _, offset, length = self.directory[block]
                self.file.seek(offset)
                self.lines = [json.loads(x) for x in gzip.decompress(self.file.read(length)).decode().split("\n")]
                self.keys, self.at = [(x[0], _id(x[1])) for x in self.lines], block
            low, high = bisect.bisect_left(self.keys, wanted), bisect.bisect_right(self.keys, wanted)
            found += self.lines[low:high]
            block += 1
        return found


def look_up(wanted: DataFrame, index: Index) -> DataFrame:
    """The captures of each distinct (key, page_id) of ``wanted``. A null page_id finds records without one."""
    shared = wanted.sparkSession.sparkContext.broadcast(index)  # one entry for each shard
    distinct = wanted.select(F.coalesce("key", F.lit("")).alias("key"), F.coalesce("page_id", F.lit(-(2**63))).alias("page_id")).distinct()
    ordered = distinct.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        store, base = pafs.FileSystem.from_uri(place.folder)
        name, shard = None, None
        for batch in batches:
            out = []
            for key, page_id in zip(*(c.to_pylist() for c in batch.columns)):
                # equal keys may begin at the end of the shard before; from there on they are consecutive
                at = max(bisect.bisect_left(place.firsts, (key, page_id)) - 1, 0)
                while at < len(place.firsts) and place.firsts[at] <= (key, page_id):
                    if place.shards[at][2] != name:
                        name = place.shards[at][2]
                        shard = _Shard(store, base, name)
                    out += shard.find(key, page_id)
                    at += 1
            yield pa.RecordBatch.from_pylist([dict(zip(_CAPTURE_SCHEMA.names, x)) for x in out], _CAPTURE_SCHEMA)

    return map_batches(ordered, run, CAPTURES)


def read_records(captures: DataFrame, archives: str) -> DataFrame:
    """Reads captured records back by their byte ranges and returns what the records themselves say:
    page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits).

    Captures are grouped by file and place, so that neighbouring records are read in one go. The digest
    of a response is taken from its payload and must be the one that its headers state.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    urn = re.compile(r"<urn:page:(-?\d*)>")

    def number(text: str | None) -> int | None:
        found = urn.fullmatch(text or "")
        return int(found[1]) if found and found[1] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(archives)
        name, file, begin, ahead, out, held = None, None, 0, b"", [], 0

        def made() -> pa.RecordBatch:
            columns = zip(*out) if out else [()] * len(names)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            for new, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if new != name:
                    name, file, begin, ahead = new, store.open_input_file(f"{base}/{new}"), 0, b""
                if not begin <= offset <= offset + length <= begin + len(ahead):
                    file.seek(offset)
                    begin, ahead = offset, file.read(max(length, READ_AHEAD))
                headers, http, payload = parse_record(ahead[offset - begin : offset - begin + length])
                refers_to = number(headers.get("WARC-Refers-To"))
                size, stated = int(re.search(rb"Content-Length: (\d+)", http)[1]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if headers["WARC-Type"] == "response":
                    if hashlib.sha1(payload).hexdigest() != stated or len(payload) != size:
                        raise ValueError(f"{name} at {offset}: the payload is not the one that its headers state")
                else:
                    payload = None
                out.append((number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], size, stated, headers["WARC-Type"], refers_to, payload))
                held += size
                if held > READ_AHEAD * 4:
                    yield made()
                    out, held = [], 0
        yield made()

    near = captures.select("file", "offset", "length", F.floor(F.col("offset") / (16 * READ_AHEAD)).alias("stretch"))
    return map_batches(near.repartition("file", "stretch").sortWithinPartitions("file", "offset"), run, schema)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives, indexes them, looks every page up by its URL key and reads its record back."""
    archives = work_dir(pages.sparkSession, "warc")
    index = build_index(write_archives(pages, archives), archives)
    wanted = pages.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    return read_records(look_up(wanted, index), archives)
