"""Deterministic sharded WARC archives, written and read by Spark tasks.

``write_archives`` range-sorts the pages into shards by (page_id, digest, url);
the shards' bounds are quantiles, by bytes, of a hash-chosen sample and depend
on the data alone. Each task streams its shard into gzip members, one record
each, and rolls to a new file once the compressed size reaches ``roll_bytes``.
Files get temporary names of their attempt; the tasks' results, written as a
table, name the attempts that count. A second job renames those and the
manifest is written last: readers see the files of a complete manifest or
none. Files that lost attempts left behind are not in it.

Records carry regenerated headers: ids derived from their content, digests of
block and payload, a fixed date. Payloads of at least ``min_bytes`` that occur
again are revisits of the one with the largest page_id.

Rows equal in all columns are counted before they are placed, and a group of
them is dealt out in chunks of ``COPIES`` records, so neither an id nor a page
that most rows repeat fills a shard. The html of a page travels once per map
task at most where pages repeat much, and the shard that needs it is the one
that holds the group's first chunk.

Nulls and repeats: a null html is an empty payload; a null url becomes
``urn:page:<page_id>``; a null page_id sorts first, takes part and is written
as ``-``. Of rows equal in page_id and payload the one with the largest url is
the response (of equal ones the first), the others revisit it. No rows: a
manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, settled, ship, smallest
from boardwalk.session import shared_dir

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NO_ID = -(1 << 63)

#: Copies of a row that are written together; shards at most, and sampled
#: places per shard (and at least) that choose their bounds.
COPIES, SHARDS, PER_SHARD, SAMPLE = 4096, 1 << 16, 16, 10_000
#: From so many copies on, tasks drop the html that they have sent already;
#: keys that they remember for it.
REPEATED, REMEMBERED = 64, 1 << 14

# Hadoop's names of stores, and pyarrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3"}

_MANIFEST = "shard int, part int, name string, temporary string, bytes long, records long, sha256 string"
_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def mapped(uri: str) -> str:
    """A Hadoop folder name as pyarrow writes it. Credentials come from the
    executors' environment."""
    scheme, sep, rest = uri.partition("://")
    if sep and scheme not in (*SCHEMES, "s3", "gs", "hdfs", "file", "abfs", "abfss"):
        raise ValueError(f"archives can't be written to {scheme}:// folders; give an s3a, gs, abfs, hdfs or file folder")
    return f"{SCHEMES.get(scheme, scheme)}://{rest}" if sep else uri


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(mapped(uri))


# --- records -----------------------------------------------------------------


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, url: str | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{nth}:{url}')}>"


def _uri(url: str | None, page_id: int | None) -> str:
    return quote(url, safe="/:?#[]@!$&'()*+,;=%~") if url else f"urn:page:{'-' if page_id is None else page_id}"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, refers_to: tuple[int | None, str | None] | None, nth: int, size: int = 0, digest: str = "") -> bytes:
    """A response record or, with ``refers_to`` (id and url of the page that
    holds the payload), a revisit record, for which ``size`` and ``digest`` of
    the payload will do."""
    if payload is not None:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    headers = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", _record_id(page_id, url, digest, nth)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("WARC-Page-ID", "-" if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to:
        there, its_url = refers_to
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(there, its_url, digest, 0)),
            ("WARC-Refers-To-Target-URI", _uri(its_url, there)),
            ("WARC-Refers-To-Date", DATE),
            ("WARC-Refers-To-Page-ID", "-" if there is None else str(there)),
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record(headers, http if refers_to else http + payload)


def file_record(name: str) -> bytes:
    """The warcinfo record that opens a file."""
    block = b"format: WARC File Format 1.1\r\n"
    rid = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'file:' + name)}>"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", rid), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# --- writing -----------------------------------------------------------------


class _Roller:
    """Writes a shard's records to files of bounded compressed size."""

    def __init__(self, fs: pafs.FileSystem, folder: str, shard: int, roll_bytes: int):
        self.fs, self.folder, self.shard, self.roll_bytes = fs, folder, shard, roll_bytes
        self.attempt, self.part, self.out, self.rows = uuid.uuid4().hex, 0, None, []

    def write(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.name}.{self.attempt}.tmp"
            self.out = self.fs.open_output_stream(f"{self.folder}/_tmp/{self.temporary}", compression=None)
            self.bytes, self.records, self.sha = 0, 0, hashlib.sha256()
            self._put(_member(file_record(self.name)))
        self._put(_member(record))
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.part, self.name, self.temporary, self.bytes, self.records, self.sha.hexdigest()))
            self.out, self.part = None, self.part + 1


def _records(rows: Iterator[dict]) -> Iterator[tuple[int, bytes]]:
    """``shard, record`` of placed rows in order: a chunk says how many copies
    of which row there are; the page that follows the chunk of a response has
    its html, any other page's html is not needed."""
    due = None
    for r in rows:
        group = (r["page_id"], r["digest"], r["url"])
        if not r["chunk"]:
            if due is not None and due["group"] == group:
                yield r["shard"], page_record(r["page_id"], r["url"], r["html"] or b"", None, 0)
                yield from _copies(due, range(1, due["copies"]))
                due = None
            continue
        if due is not None:
            raise ValueError(f"the html of page {due['page_id']} is missing")
        if r["awaits"]:
            due = r | {"group": group}
        else:
            yield from _copies(r, range(r["start"], r["start"] + r["copies"]))
    if due is not None:
        raise ValueError(f"the html of page {due['page_id']} is missing")


def _copies(r: dict, which: range) -> Iterator[tuple[int, bytes]]:
    refers = (r["first_id"], r["first_url"]) if r["large"] else None
    payload = None if r["large"] else r["html"] or b""
    for nth in which:
        yield r["shard"], page_record(r["page_id"], r["url"], payload, refers, nth, r["n"], r["digest"])


def _write(uri: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _store(uri)
        roller = None
        for shard, record in _records(r for b in batches for r in b.to_pylist()):
            if roller is None or shard != roller.shard:
                if roller is not None:
                    roller.close()
                    yield _manifest_rows(roller.rows)
                roller = _Roller(fs, folder, shard, roll_bytes)
            roller.write(record)
        if roller is not None:
            roller.close()
            yield _manifest_rows(roller.rows)

    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows less those that the task has sent shortly before."""
    seen: set[tuple] = set()
    for b in batches:
        keep = []
        for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
            if key not in seen:
                keep.append(i)
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
        yield b.take(pa.array(keep, pa.int64()))


def _manifest_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in _MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _commit(uri: str):
    """Gives the files of finished attempts their names; may be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _store(uri)
        for b in batches:
            for r in b.to_pylist():
                temporary, final = f"{folder}/_tmp/{r['temporary']}", f"{folder}/{r['name']}"
                there = fs.get_file_info([temporary, final])
                if there[0].type == pafs.FileType.File:
                    fs.move(temporary, final)
                elif there[1].type != pafs.FileType.File or there[1].size != r["bytes"]:
                    raise OSError(f"neither {temporary} nor {final} is there")
            yield b

    return run


def _place(start: Column) -> Column:
    """Where a chunk goes in the order of all: text that sorts by page_id (null
    first), digest, url and start."""
    page = F.lpad(F.hex(F.coalesce("page_id", F.lit(NO_ID)).bitwiseXOR(F.lit(NO_ID))), 16, "0")
    return F.concat_ws("-", page, "digest", F.lpad(F.hex(F.xxhash64("url")), 16, "0"), F.lpad(start.cast("string"), 19, "0"))


def _bounds(chunks: DataFrame, shards: int) -> np.ndarray:
    """Places at which shards begin: quantiles by bytes of a sample that grows
    with the number of shards."""
    if shards == 1:
        return np.array([], "S")
    sample = smallest(chunks.select("place", "weight"), max(SAMPLE, PER_SHARD * shards), F.xxhash64("place"), "place")
    sample = sorted((r["place"], r["weight"]) for r in sample)
    before = np.cumsum([0, *(w for _, w in sample)])
    cuts = np.searchsorted(before, before[-1] * np.arange(1, shards) / shards)
    return np.array(sorted({sample[min(c, len(sample) - 1)][0].encode() for c in cuts.tolist() if c}), "S")


def write_archives(pages: DataFrame, uri: str, min_bytes: int = 1000, shard_bytes: int = 64 << 20, roll_bytes: int = 16 << 20) -> str:
    """Writes ``pages (page_id, url, html)`` as archives under the folder
    ``uri`` (new, on storage that executors share) and returns it.

    ``shard_bytes`` is the payload a shard holds on average; beyond ``SHARDS``
    shards, they hold more. ``PER_SHARD`` sampled places for each shard, a
    million at most, reach the driver to choose the bounds."""
    spark = pages.sparkSession
    ship(spark)
    fs, folder = _store(uri)
    fs.create_dir(f"{folder}/_tmp", recursive=True)
    html = F.col("html").cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("n", F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")).withColumn("digest", F.sha1(F.coalesce("html", F.lit(b""))))
    large = F.col("n") >= min_bytes
    group = ["page_id", "digest", "url"]

    # Equal rows once, with their number, and without large html; combined
    # before the shuffle. Then the page that holds each payload, by an
    # equi-join that can be split where a digest is hot.
    few = rows.select(*group, "n", large.alias("large"), F.when(~large, F.col("html")).alias("html"))
    few = few.groupBy(*group).agg(F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("large").alias("large"), F.first("html").alias("html"))
    first = few.where("large").groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"))
    few = few.join(first, "digest", "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    few = few.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(COPIES).cast("long"))))
    awaits = F.col("large") & is_first & (F.col("start") == 0)
    copies = F.least(F.col("times") - F.col("start"), F.lit(COPIES).cast("long"))
    written_html = F.when(~F.col("large"), copies * F.col("n")).when(awaits, F.col("n")).otherwise(F.lit(0))
    chunks = few.select(
        _place(F.col("start")).alias("place"), *group, F.lit(True).alias("chunk"), "start", copies.alias("copies"), "n", "large",
        awaits.alias("awaits"), "html", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), (written_html + 256 * copies).alias("weight"),
    )
    chunks = settled(chunks)

    total, most = chunks.agg(F.sum("weight"), F.max("start")).first()
    repeated = chunks.where(F.col("copies") >= REPEATED).limit(1).count() > 0
    shards = min(SHARDS, max(1, -(-int(total or 0) // shard_bytes)))
    bounds = _bounds(chunks, shards)

    @F.pandas_udf("int")
    def shard_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy().astype("S"), side="right").astype(np.int32))

    payloads = rows.where(large).select(*group, "html")
    if repeated or most:
        payloads = arrow_rows(payloads, _once, "page_id long, digest string, url string, html binary")
    none = {"start": "long", "copies": "long", "n": "long", "large": "boolean", "awaits": "boolean", "first_id": "long", "first_url": "string", "weight": "long"}
    payloads = payloads.withColumn("place", _place(F.lit(0))).withColumn("chunk", F.lit(False)).withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
    placed = chunks.unionByName(payloads).drop("weight").withColumn("shard", shard_of("place"))
    ordered = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "url", F.col("chunk").desc())
    written = arrow_rows(ordered, _write(uri, roll_bytes), _MANIFEST)
    written.write.mode("overwrite").parquet(f"{uri}/_written")
    done = arrow_rows(spark.read.schema(_MANIFEST).parquet(f"{uri}/_written"), _commit(uri), _MANIFEST)
    done.drop("temporary").write.mode("error").parquet(f"{uri}/manifest")
    fs.delete_dir(f"{folder}/_tmp")
    return uri


# --- reading -----------------------------------------------------------------


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    data, z, out = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(size)
            if not data:
                break
        out.append(z.decompress(data))
        data = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(out)
            z, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("the last record is cut off")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block; raises if the block's digest doesn't fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if not lines[0].startswith("WARC/1.") or _sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError("not a record, or a changed one")
    return headers, block


def _read(uri: str, with_payload: bool):
    def number(x: str) -> int | None:
        return None if x == "-" else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _store(uri)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for data in members(stream):
                        headers, block = parse_record(data)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                        digest, kind = headers["WARC-Payload-Digest"], headers["WARC-Type"]
                        if kind == "response" and (len(payload) != size or _sha1(payload) != digest):
                            raise ValueError(f"the payload of {headers['WARC-Record-ID']} has changed")
                        there = headers.get("WARC-Refers-To-Page-ID", "-")
                        rows.append((number(headers["WARC-Page-ID"]), headers["WARC-Target-URI"], size, base64.b32decode(digest[5:]).hex(), kind, number(there), payload if with_payload and kind == "response" else None))
                        if len(rows) >= 1000:
                            yield _read_rows(rows)
                            rows = []
                yield _read_rows(rows)

    return run


def _read_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in _READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def read_archives(spark: SparkSession, uri: str, with_payload: bool = False) -> DataFrame:
    """The records of the files in the manifest under ``uri``: page_id, url,
    payload_bytes and payload_digest (of the full payload, for revisits too),
    record_type, refers_to, and the payload of responses if asked for."""
    files = spark.read.schema(_MANIFEST).parquet(f"{uri}/manifest").select("name")
    n = max(1, files.count())
    return arrow_rows(files.repartition(n), _read(uri, with_payload), _READ)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives beside the checkpoints."""
    base = shared_dir(spark)
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/boardwalk-warc-{uuid.uuid4().hex}"
