"""Web archives from page rows, written as deterministic shards, and read back.

Pages are cut into ranges of page_id of about equal bytes, headers included. The cuts come from a histogram of the
ids, refined where a bin is too large, so the same pages give the same shards on any cluster. Each range
is sorted and written by one task as gzip members, one per record; a file is closed when its compressed
size passes the limit. Files are written under a temporary name of the task attempt and then renamed, so an
attempt that is lost leaves no visible file, and one that is repeated replaces files by equal ones. The
list of files with their sizes and digests, the manifest, is written last; readers open what it names.

Of pages with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id keeps the
payload (response), the others name it (revisit). Every header is made anew: record ids from page_id and
digest, SHA-1 digests of block and payload in base 32, lengths, dates.

Results for special inputs: a null html is an empty payload; a null url becomes ``urn:page:<id>``; rows
with a null page_id are always responses and have shards of their own, over which they are spread with the number of
each copy, so that equal ones part, too; repeated rows (equal page_id and
payload) are as many records of the same type, in one shard; texts of any length are one record; an empty table gives an
archive without files; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.positions import dense_positions

#: Least and most bins of the first histogram of page ids, collected at the driver.
BINS, MOST_BINS = 4096, 1 << 20
#: Bytes that the headers of a record count for when shards are cut.
HEADER_BYTES = 700
MANIFEST = "shard int, number int, name string, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
_SPACE = re.compile(r"[\x00-\x20\x7f]")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page-records")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uri(page_id: int | str | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}:{copy}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


def _headers(kind: str, uri: str, date: str, block: bytes) -> list[tuple[str, str]]:
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", uri),
        ("WARC-Date", date),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, copy: int, date: str) -> bytes:
    """One compressed record; a revisit (refers_to given) has the HTTP head only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = f"urn:page:{page_id}" if url is None else _SPACE.sub(lambda m: f"%{ord(m.group()):02X}", url)
    if refers_to is None:
        block += payload
    kind = "response" if refers_to is None else "revisit"
    # Pages without id are told apart by their addresses.
    headers = _headers(kind, record_uri(f"None {url}" if page_id is None else page_id, digest, copy), date, block)
    headers += [
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", record_uri(refers_to, digest, 0)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    return _member(headers, block)


class RollingFiles:
    """The files of one shard, in order; each becomes visible by its rename."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str) -> None:
        self.store, self.path = pyarrow.fs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.attempt = uuid.uuid4().hex
        self.done: list[tuple[int, int, str, int, int, str]] = []
        self.stream = None

    def add(self, member: bytes) -> None:
        if self.stream is None:
            self.name = f"pages-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{self.attempt}"
            self.stream = self.store.open_output_stream(self.temporary, compression=None)
            self.records, self.size, self.digest = 0, 0, hashlib.sha256()
            info = f"software: page archive writer\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {self.shard}\r\n".encode()
            uri = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, self.name)}>"
            fields = ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")
            self._write(_member([*_headers("warcinfo", uri, self.date, info), *fields], info))
        self._write(member)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.stream is None:
            return
        self.stream.close()
        self.stream = None
        final = f"{self.path}/{self.name}"
        if self.store.get_file_info(final).type != pyarrow.fs.FileType.NotFound:
            self.store.delete_file(final)  # left by an earlier attempt
        self.store.move(self.temporary, final)
        self.done.append((self.shard, len(self.done), self.name, self.records, self.size, self.digest.hexdigest()))


@dataclass(frozen=True)
class Ranges:
    """Shards as ranges of page ids: where bins begin, their width, and for each bin that has pages the shard
    of its first id and the ids inside it at which a further shard begins."""

    low: int
    width: int
    bins: list[tuple[int, int, list[int]]]
    shards: int


def _bin(low: int, width: int) -> Column:
    return F.expr(f"(page_id - CAST({low} AS BIGINT)) div CAST({width} AS BIGINT)")


def shard_ranges(facts: DataFrame, shard_bytes: int) -> Ranges:
    """Ranges of page_id of about ``shard_bytes`` bytes, from histograms of all ids.

    The first histogram has several bins per shard, a million at most; bins that hold more than a shard are
    cut into 64 again and again, all of one width in one job, so that clustered ids are cut as well. What
    comes to the driver is a number per bin.
    """
    spark = facts.sparkSession
    size = F.col("size") if "size" in facts.columns else F.col("bytes")
    known = facts.where(F.col("page_id").isNotNull()).withColumn("size", size)
    span = known.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high"), F.sum("size").alias("bytes")).first()
    if span["low"] is None:
        return Ranges(0, 1, [], 1)
    low, wanted = span["low"], min(MOST_BINS, max(BINS, 8 * span["bytes"] // shard_bytes))
    width = first_width = 1 << max(0, -(-(span["high"] - low + 1) // wanted) - 1).bit_length()
    rows, pieces, occupied = known, [], []
    while True:
        sums = rows.groupBy(_bin(low, width).alias("bin")).agg(F.sum("size").alias("bytes")).collect()
        occupied = occupied or sorted(r["bin"] for r in sums)
        large = [r["bin"] for r in sums if r["bytes"] > shard_bytes and width > 1]
        kept = set(large)
        pieces += [(r["bin"] * width, r["bytes"]) for r in sums if r["bin"] not in kept]
        if not large:
            break
        # As many as the shards they fill at most.
        inside = F.broadcast(spark.createDataFrame([(b,) for b in large], "large long"))
        rows = known.join(inside, _bin(low, width) == F.col("large"), "left_semi")
        width = max(1, width // 64)
    cuts, filled = [], 0
    for begin, size in sorted(pieces):
        if filled and filled + size > shard_bytes:
            cuts.append(begin)
            filled = 0
        filled += size
    bins = []
    for b in occupied:
        first, end = bisect_right(cuts, b * first_width), bisect_right(cuts, (b + 1) * first_width - 1)
        bins.append((b, first, [low + c for c in cuts[first:end]]))
    return Ranges(low, first_width, bins, len(cuts) + 1)


def _with_shard(records: DataFrame, ranges: Ranges, nameless: int = 1) -> DataFrame:
    """Add the shard of each record; records without page id are spread over ``nameless`` further shards."""
    bins = records.sparkSession.createDataFrame(ranges.bins, "bin long, first int, cuts array<long>")
    # At most MOST_BINS rows.
    placed = records.withColumn("bin", _bin(ranges.low, ranges.width)).join(F.broadcast(bins), "bin", "left")
    further = F.size(F.filter("cuts", lambda cut: cut <= F.col("page_id")))
    told = [c for c in ("url", "digest", "copy") if c in records.columns]
    spread = (ranges.shards + F.pmod(F.xxhash64(*told), F.lit(max(1, nameless)))).cast("int")
    return placed.withColumn("shard", F.when(F.col("page_id").isNull(), spread).otherwise(F.col("first") + further))


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = 256 << 20, roll_bytes: int = 64 << 20, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archive and its manifest below a new folder that all executors share; returns the manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    size = F.octet_length("html") + F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES
    facts = rows.select(
        "page_id", "digest", F.octet_length("html").cast("long").alias("bytes"), size.cast("long").alias("size")
    )
    facts.write.parquet(f"{folder}/facts")
    facts = spark.read.schema(facts.schema).parquet(f"{folder}/facts")

    ranges = shard_ranges(facts, shard_bytes)
    keepers = (
        facts.where((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least"))
        .where("least < keeper")
        .select("digest", "bytes", "keeper")
    )
    revisits = facts.join(keepers, ["digest", "bytes"]).where("page_id < keeper")
    none = F.lit(None).cast("string")
    marks = revisits.select("page_id", none.alias("url"), none.alias("html"), "digest", F.col("keeper").alias("refers_to"))
    number = F.lit(None).cast("long")
    records = rows.withColumns({"refers_to": number, "copy": number}).where(F.col("page_id").isNotNull())
    records = records.unionByName(marks.withColumn("copy", number))
    # Copies of pages without id are numbered, so that a large group of them is not one shard.
    unnamed = rows.where(F.col("page_id").isNull()).withColumns({"refers_to": number, "row": F.monotonically_increasing_id()})
    part = F.shiftright("row", 12)
    unnamed = dense_positions(unnamed, ["digest", "url"], ["row"], part, "copy").withColumn("copy", F.col("copy") - 1)
    records = records.unionByName(unnamed.drop("row"))
    without = facts.where(F.col("page_id").isNull()).agg(F.sum("size")).first()[0] or 0
    nameless = -(-without // shard_bytes)
    dealt = (
        _with_shard(records, ranges, nameless)
        .repartitionById(ranges.shards + nameless, F.col("shard"))
        .sortWithinPartitions("page_id", F.col("refers_to").isNull(), "digest", "url", "copy")
        .select("shard", "page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "refers_to", "copy")
    )
    target = f"{folder}/records"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pyarrow.fs.FileSystem.from_uri(target)
        store.create_dir(path, recursive=True)
        files: RollingFiles | None = None
        page, refers, copies = None, {}, {}
        for batch in batches:
            for row in range(batch.num_rows):
                shard, page_id, url, payload, digest, refers_to, numbered = (c[row].as_py() for c in batch.columns)
                if files is None or files.shard != shard:
                    if files:
                        files.close()
                        yield _listed(files)
                    files = RollingFiles(target, shard, roll_bytes, date)
                if page_id != page:
                    page, refers, copies = page_id, {}, {}
                if payload is None:  # says that this payload of this page is kept elsewhere
                    refers[digest] = refers_to
                    continue
                spelled = base64.b32encode(bytes.fromhex(digest)).decode()
                copy = copies[digest] = copies.get(digest, -1) + 1
                copy = copy if numbered is None else numbered
                files.add(page_record(page_id, url, payload, spelled, refers.get(digest), copy, date))
        if files:
            files.close()
            yield _listed(files)

    manifest = dealt.mapInArrow(run, MANIFEST)
    manifest.write.json(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def _listed(files: RollingFiles) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array([x[i] for x in files.done], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "number", "name", "records", "bytes", "sha256"])


def members(stream) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one by one."""
    inflater, out = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            out.append(inflater.decompress(data))
            data = inflater.unused_data
            if inflater.eof:
                yield b"".join(out)
                inflater, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("the archive ends inside a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record; digests and lengths are verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n" or headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {headers.get('warc-record-id')}")
    return headers, block


def page_fields(headers: dict[str, str], block: bytes) -> tuple[int | None, str, str, int, str, int | None]:
    """The fields of RECORDS for a page record."""
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.split(b"\r\nContent-Length: ")[1].split(b"\r\n")[0])
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload in {headers['warc-record-id']}")
    number = lambda name: int(headers[name]) if name in headers else None
    return number("x-page-id"), headers["warc-target-uri"], kind, size, digest, number("x-refers-to-page-id")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The page records of an archive (RECORDS), from the files its manifest names."""
    manifest = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    files = manifest.repartition(max(1, manifest.count()), "name").select("name", "records", "bytes")
    source = f"{folder}/records"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pyarrow.fs.FileSystem.from_uri(source)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
        for batch in batches:
            for file in batch.to_pylist():
                with store.open_input_stream(f"{path}/{file['name']}", compression=None) as stream:
                    parsed = (parse(m) for m in members(stream))
                    rows = [page_fields(*p) for p in parsed if p[0]["warc-type"] != "warcinfo"]
                if len(rows) != file["records"]:
                    raise ValueError(f"{file['name']} has {len(rows)} records; its manifest says {file['records']}")
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return files.mapInArrow(run, RECORDS)
