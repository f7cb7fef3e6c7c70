"""Deterministic sharded WARC writer, and a reader.

Records are sorted by page id and cut into shards of SHARD_BYTES of payload: from a sorted table of ids and
their bytes, whatever the ids' spread, so the id ranges of files meet in one id at most. An id heavier than a shard (one
may have a third of all rows) has several, dealt by a hash of the content. A task writes its
shards one after the other as files of gzip members, one per record, and begins a new file once the
compressed size has reached ROLL_BYTES. Headers and digests are made anew from the payload, and there is no
clock or random id in them, so the same rows give the same files byte for byte.

Payloads move once, to their shard. Which records are revisits is found without payloads; each such record's notice
is sorted into the shard right before it.

A file is written under a temporary name, then renamed to one that ends in a hash of its content; a retried or doubled
task writes the same bytes, and a name that is taken already holds them. The names, sizes and digests of finished
files are the manifest, a table written last; the reader takes the files that the manifest names, checks sizes and
digests, and hands records on in batches of bounded bytes.

Of records with equal payloads of REVISIT_BYTES or more, that of the largest page id is a response (if
that id is repeated, each of its rows is) and the others are revisits of it: HTTP headers without the payload.
Smaller ones are all responses. Null html is an empty payload. A null url, or what a header can't hold, is
replaced by urn:page:ID or percent-encoded; a null page id is written as `null`. Repeated rows are all
written, under ids that count them. Payloads of any length are written whole. An empty table gives an empty manifest.
Only the named columns are read; others may have any name. The folder is any that pyarrow's file systems reach.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm.shared import removed, small, written

SHARD_BYTES, ROLL_BYTES = 64 << 20, 16 << 20
#: Beyond so many shards (200 TB), they are made larger: their first ids are broadcast, 24 bytes each.
MOST_SHARDS = 3 << 20
REVISIT_BYTES = 1000
#: Payload bytes of the records that the reader hands on at once, unless one alone is larger.
BATCH_BYTES = 16 << 20
#: Compressed bytes handed to the decoder at once.
PIECE_BYTES = 1 << 13
#: Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_UNSAFE = re.compile(r"[^\x21-\x7E]")


def sha1_base32(hexdigest: str) -> str:
    return base64.b32encode(bytes.fromhex(hexdigest)).decode()


def target_uri(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{'null' if page_id is None else page_id}"
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record_id(page_id: int | None, url: str | None, digest: str, copy: int = 0) -> str:
    """copy counts the rows that are alike in all of these."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{'null' if page_id is None else page_id}:{url}:{digest}:{copy}").urn


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: tuple | None, copy: int = 0) -> bytes:
    """One uncompressed record; a revisit if refers_to, the page id and url of the response, is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id(page_id, url, digest, copy)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target_uri(url, page_id)}",
        f"WARC-Page-ID: {'null' if page_id is None else page_id}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(digest)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(hashlib.sha1(block).hexdigest())}",
    ]
    if refers_to is not None:
        of, at = refers_to
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(of, at, digest)}>", f"WARC-Refers-To-Target-URI: {target_uri(at, of)}", f"WARC-Refers-To-Page-ID: {of}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """Without a time stamp or name."""
    coder = zlib.compressobj(6, zlib.DEFLATED, 31)
    return coder.compress(data) + coder.flush()


class _Roll:
    """The files of one shard."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None

    def add(self, page_id: int | None, member: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.temporary = f"{self.path}/_temporary/{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.sha, self.first = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha1(), page_id
        self.out.write(member)
        self.sha.update(member)
        self.size, self.records, self.last = self.size + len(member), self.records + 1, page_id
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            sha1 = self.sha.hexdigest()
            name = f"part-{self.shard:06d}-{self.number:05d}-{sha1[:16]}.warc.gz"
            try:
                self.fs.move(self.temporary, f"{self.path}/{name}")
            except OSError:
                if self.fs.get_file_info(f"{self.path}/{name}").size != self.size:
                    raise
                self.fs.delete_file(self.temporary)  # another attempt has written these bytes
            self.out, self.number = None, self.number + 1
            yield name, self.records, self.size, sha1, self.first, self.last


def _write(folder: str, roll_bytes: int):
    names = ["file", "records", "bytes", "sha1", "first_page_id", "last_page_id"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, done, noted, last, copy = None, [], None, None, 0
        for batch in small(batches, 256):
            for shard, page_id, digest, url, payload, of, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = shard, page_id, digest, url
                if payload is None:
                    noted = key, (of, at)
                    continue
                if roll is None or roll.shard != shard:
                    done += roll.close() if roll else []
                    roll = _Roll(folder, shard, roll_bytes)
                last, copy = key, copy + 1 if key == last else 0
                refers_to = noted[1] if noted and noted[0] == key else None
                done += roll.add(page_id, gzip_member(record(page_id, url, payload, digest, refers_to, copy)))
            if done:
                yield table(done)
                done = []
        if roll and (done := list(roll.close())):
            yield table(done)

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, page_id, w, before): the sum of w over the partition's rows before each row. batches: page_id, w."""
    part, held = TaskContext.get().partitionId(), 0
    for batch in batches:
        w = batch.column(1).to_numpy()
        upto = held + np.cumsum(w)
        held = int(upto[-1]) if len(upto) else held
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), part, np.int32)), batch.column(0), batch.column(1), pa.array(upto - w)], ["part", "page_id", "w", "before"])


def shard_plan(sizes: DataFrame, shard_bytes: int = SHARD_BYTES):
    """A function that gives rows with page_id, digest and url a column shard, in the order of page_id; nulls come first.

    sizes: page_id and payload_bytes of all records. In the order of ids, an id begins in the shard that the bytes before it
    lead to. One that is heavier than a shard has as many shards as it fills, by a hash of the content; no other
    rows are dealt by a hash. Ids and their weights are sorted by range; what reaches the driver is the partitions' totals and
    the first id of each shard, of at most MOST_SHARDS: beyond that, shards are made larger.
    """
    spark = sizes.sparkSession
    ids = sizes.groupBy("page_id").agg(F.sum(F.col("payload_bytes") + 500).alias("w"))
    ids = ids.repartitionByRange(F.col("page_id").asc_nulls_first()).sortWithinPartitions(F.col("page_id").asc_nulls_first())
    ids = written(ids.mapInArrow(_running, "part int, page_id long, w long, before long"), "ids")
    offsets, total = [], 0
    for r in sorted(ids.groupBy("part").agg(F.max(F.col("before") + F.col("w")).alias("w")).collect()):
        offsets.append((r["part"], total))
        total += r["w"]
    while total > shard_bytes * MOST_SHARDS:
        shard_bytes *= 2
    placed = ids.join(F.broadcast(spark.createDataFrame(offsets, "part int, offset long")), "part")  # a row a partition
    start = F.floor((F.col("offset") + F.col("before")) / F.lit(shard_bytes).cast("decimal(20,0)")).cast("int")
    placed = placed.select("page_id", start.alias("start"), F.when(F.col("w") > shard_bytes, F.ceil(F.col("w") / F.lit(shard_bytes).cast("decimal(20,0)"))).otherwise(1).cast("int").alias("parts"))
    light = placed.filter("parts = 1").groupBy("start", "parts").agg(F.min("page_id").alias("page_id"))
    first = light.unionByName(placed.filter("parts > 1")).select("page_id", "start", "parts").toPandas()
    removed(ids)
    null = first[first["page_id"].isna()]
    first = first[first["page_id"].notna()].sort_values("page_id")
    plan = first["page_id"].to_numpy(np.int64), first["start"].to_numpy(np.int64), first["parts"].to_numpy(np.int64)
    of_null = int(null["parts"].max()) if len(null) else 1
    shared = spark.sparkContext.broadcast(plan)

    @F.arrow_udf("int")
    def place(ids: pa.Array, hashed: pa.Array) -> pa.Array:
        begins, start, parts = shared.value
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        at = np.searchsorted(begins, ids.fill_null(0).to_numpy(), side="right") - 1
        wide = np.where(missing, of_null, parts[at] if len(begins) else 1)
        low = np.where(missing, 0, start[at] if len(begins) else 0)
        return pa.array((low + hashed.to_numpy() % wide).astype(np.int32))

    return lambda rows: rows.withColumn("shard", place("page_id", F.xxhash64("digest", "url")))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write the archives of all pages below the folder; returns the manifest, which is written there last."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.col(url_col).alias("url"), payload.alias("payload"))
    sizes = written(rows.select("page_id", "digest", "url", F.octet_length("payload").cast("long").alias("payload_bytes")), "sizes")
    sharded = shard_plan(sizes, shard_bytes)
    # the response of each payload that several rows have; ties of its page id go to the last url
    heavy = sizes.filter(F.col("payload_bytes") >= revisit_bytes)
    known = heavy.groupBy("digest").agg(F.max("page_id").alias("of"), F.count("*").alias("n")).filter("n > 1 and of is not null").drop("n")
    urls = heavy.groupBy("digest", F.col("page_id").alias("of")).agg(F.max("url").alias("at"))
    known = written(known.join(urls, ["digest", "of"]), "revisited")
    notices = heavy.join(known, "digest").filter(~F.col("page_id").eqNullSafe(F.col("of"))).select("page_id", "digest", "url", "of", "at").distinct()
    names = ["shard", "page_id", "digest", "url", "payload", "of", "at"]
    both = sharded(rows.withColumns({"of": F.lit(None).cast("long"), "at": F.lit(None).cast("string")})).select(names).union(sharded(notices.withColumn("payload", F.lit(None).cast("binary"))).select(names))
    # a null payload is a notice, and comes before the records that it is about
    dealt = both.repartition("shard").sortWithinPartitions("shard", "page_id", "digest", "url", F.col("payload").isNotNull())
    found = dealt.mapInArrow(_write(folder, roll_bytes), "file string, records long, bytes long, sha1 string, first_page_id long, last_page_id long")
    found.write.parquet(f"{folder}/_manifest")
    return spark.read.schema(found.schema).parquet(f"{folder}/_manifest")


_FIELD = re.compile(rb"^([^:\r\n]+): *(.*?)\r?$", re.M)


def parsed(data: bytes) -> Iterator[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload) of a file's records."""
    view, at = memoryview(data), 0
    while at < len(view):
        coder, parts = zlib.decompressobj(31), []
        while at < len(view) and not coder.eof:
            piece = view[at : at + PIECE_BYTES]  # what lies behind a member's end is copied, so little is handed over
            parts.append(coder.decompress(piece))
            at += len(piece) - len(coder.unused_data)
        if not coder.eof:
            raise ValueError("a file ends within a record")
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(head)}
        block = rest[: int(fields["content-length"])]
        if "sha1:" + sha1_base32(hashlib.sha1(block).hexdigest()) != fields["warc-block-digest"]:
            raise ValueError(f"block digest of {fields['warc-record-id']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int({k.decode().lower(): v.decode() for k, v in _FIELD.findall(http)}["content-length"])
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"payload digest of {fields['warc-record-id']}")
        number = lambda name, f=fields: int(f[name]) if f.get(name, "null") != "null" else None
        yield number("warc-page-id"), size, digest, fields["warc-type"], number("warc-refers-to-page-id"), fields["warc-target-uri"], payload if fields["warc-type"] == "response" else None


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files in the folder's manifest, with payloads (null for revisits); a missing file is an error."""
    manifest = spark.read.parquet(f"{folder}/_manifest")
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.withColumn("file", F.substring_index("path", "/", -1))
    # a listing alone: files lost after it fail the scan itself
    if lost := [r["file"] for r in manifest.join(files.select("file"), "file", "left_anti").select("file").limit(5).collect()]:
        raise ValueError(f"files of the manifest are missing: {', '.join(lost)}")
    files = files.select("file", "content").join(manifest.select("file", "bytes", "sha1"), "file")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1):
            for content, size, sha1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(content) != size or hashlib.sha1(content).hexdigest() != sha1:
                    raise ValueError("a file differs from its manifest")
                rows, held = [], 0
                for row in parsed(content):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held >= BATCH_BYTES:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    return files.select("content", "bytes", "sha1").mapInArrow(run, schema)
