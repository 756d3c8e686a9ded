"""WARC archives of pages and a capture index of two levels.

Pages become WARC records, each a gzip member of its own, in files of about ``FILE_BYTES``. Of pages with equal payloads
of at least ``REVISIT_BYTES`` the one with the largest page_id is a response record and the others are revisit records,
which hold the response's HTTP headers and no payload. The index is sorted by the URL with its host reversed: blocks of
``BLOCK`` entries, compressed, one after the other in a file for each range of keys, and a sparse directory with the first
key and the place of each block. A look-up finds the range by bisection, the block by bisection in the range's part of the
directory, reads and searches that block, and reads the records' bytes. Many records are read in the order of their places,
in long stretches.

File names carry the number of the task's attempt, and only files of successful attempts are in the manifest.

Defined results: null html is an empty payload; a null url has the empty key; a null page_id stays null and is a revisit
where its payload has another response; rows that repeat a page_id and its payload are responses each if that page_id is
the largest; a page of any length is one record; an empty table gives an empty archive. Other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.llm.common import settled, shared_folder, slices

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
BLOCK = 1000
#: How many keys a task looks up in a range of the index.
KEYS = 100_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "surt string, page_id long, file string, offset long, length long"


def surt(url):
    """The key of a URL column: host labels in reverse, then port, path and query; no scheme, user or fragment."""
    part = lambda k: F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?)?([^#]*)", k)
    host = F.array_join(F.reverse(F.split(F.lower(part(1)), r"\.")), ",")
    return F.when(url.isNull(), "").otherwise(F.concat(host, part(2), F.lit(")"), part(3)))


def deduplicated(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, surt, html, and refers_to for the pages that revisit another. Only digests meet in the aggregate; the
    pages themselves move once, for the join, whose large partitions Spark can split."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), surt(F.col("url")).alias("surt"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = F.octet_length("html") >= least
    answers = rows.where(long).groupBy("digest").agg(F.max("page_id").alias("answer"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("answer").isNotNull()).drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("answer")), F.col("answer"))
    # short payloads have no answer; a key of their own keeps equal ones from meeting in one task
    rows = rows.withColumn("digest", F.when(long, F.col("digest")).otherwise(F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string"))))
    return rows.join(answers, "digest", "left").select("page_id", "url", "surt", "html", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: {digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    made = zlib.compressobj(3, zlib.DEFLATED, 31)
    return made.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + made.flush()


def parse(member: bytes) -> dict:
    """What a record says, its payload checked against its digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line[15:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    number = lambda urn: int(urn[10:-1]) if urn and urn[10:-1] else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't that of its digest")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload}


def attempt_name(path: str, number: int, ending: str) -> str:
    c = TaskContext.get()
    return f"{path}/{c.partitionId():06d}-{number:05d}-{c.taskAttemptId()}.{ending}"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of ``deduplicated`` and returns the manifest: surt, page_id, file, offset and length of each record."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        number, out, name, at = 0, None, "", 0
        try:
            for b in slices(batches, "html"):
                rows = []
                for page_id, url, key, html, refers_to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "surt", "html", "refers_to")), strict=True):
                    if out is None:
                        name = attempt_name(path, number, "warc.gz")
                        out, at = store.open_output_stream(name, compression=None), 0
                    data = record(page_id, url, html.encode(), refers_to)
                    out.write(data)
                    rows.append((key, page_id, name, at, len(data)))
                    at += len(data)
                    if at >= FILE_BYTES:
                        out.close()
                        out, number = None, number + 1
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["surt", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return settled(pages.mapInArrow(write, ENTRY), "captures")


def write_index(manifest: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Writes the index and returns its directory: part, first_key, path, offset, length and entries of each block."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name, part, at, rows, held = attempt_name(path, 0, "idx"), TaskContext.get().partitionId(), 0, [], []
        with store.open_output_stream(name, compression=None) as out:

            def close() -> None:
                nonlocal at
                data = zlib.compress("\n".join(held).encode(), 6)
                out.write(data)
                rows.append((part, json.loads(held[0])[0], name, at, len(data), len(held)))
                at += len(data)
                held.clear()

            for b in batches:
                for entry in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    held.append(json.dumps(entry, ensure_ascii=False))
                    if len(held) >= block:
                        close()
            if held:
                close()
        kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "first_key", "path", "offset", "length", "entries"])

    order = ["surt", "page_id", "file", "offset"]
    entries = manifest.select("surt", "page_id", "file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return settled(entries.mapInArrow(write, "part int, first_key string, path string, offset long, length long, entries long"), "directory")


def block_entries(store, path: str, offset: int, length: int) -> list[list]:
    with store.open_input_file(path) as f:
        f.seek(offset)
        return [json.loads(line) for line in zlib.decompress(f.read(length)).decode().split("\n")]


def read_records(entries: DataFrame, folder: str, with_payload: bool = False, files: int | None = None) -> DataFrame:
    """The records of index entries, read in the order of their places. files: over how many tasks they are spread."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        name, f = None, None
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
        for batch in batches:
            for b in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                got, start, ahead = [], 0, b""
                places = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
                for k, (file, offset, length) in enumerate(places):
                    if file != name:
                        if f is not None:
                            f.close()
                        name, f, start, ahead = file, store.open_input_file(file), 0, b""
                    if not start <= offset <= offset + length <= start + len(ahead):
                        stop = offset + length  # what follows without a gap comes with the same read
                        for next_file, next_offset, next_length in places[k + 1 :]:
                            if next_file != file or next_offset != stop or stop - offset > 4 << 20:
                                break
                            stop += next_length
                        f.seek(offset)
                        start, ahead = offset, f.read(stop - offset)
                    said = parse(ahead[offset - start : offset - start + length])
                    got.append([said[n] for n in names])
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*got, strict=True), kinds, strict=True)], names)
        if f is not None:
            f.close()

    near = entries.repartition(files, "file") if files else entries.repartition("file")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    return near.sortWithinPartitions("file", "offset").select("file", "offset", "length").mapInArrow(read, schema)


def look_up(urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The entries for the column url of urls. The first keys of the index's ranges, one for each task that wrote it, are
    all that is broadcast; within a range its own directory is searched by bisection. A range with many wanted keys is
    searched by several tasks."""
    ranges = sorted((r.first, r.part) for r in directory.groupBy("part").agg(F.min("first_key").alias("first")).collect())
    keys = urls.select(surt(F.col("url")).alias("surt")).distinct()
    firsts = keys.sparkSession.sparkContext.broadcast(ranges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = [first for first, _ in firsts.value]
        for b in batches:
            rows = []
            for key in b.column("surt").to_pylist():  # a key's entries may begin in the range before the first that starts with it
                lo, hi = max(0, bisect.bisect_left(starts, key) - 1), bisect.bisect_right(starts, key)
                rows += [(key, firsts.value[i][1]) for i in range(lo, hi)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], ["surt", "part"])

    def search(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        store, _ = pafs.FileSystem.from_uri(folder)
        own = sorted(zip(*(blocks.column(c).to_pylist() for c in ("first_key", "offset", "length", "path")), strict=True))
        starts, found, held, kept = [x[0] for x in own], [], None, {}
        for key in sorted(wanted.column("surt").to_pylist()):
            for i in range(max(0, bisect.bisect_left(starts, key) - 1), bisect.bisect_right(starts, key)):
                if i != held:
                    held, kept = i, {}
                    for e in block_entries(store, own[i][3], own[i][1], own[i][2]):
                        kept.setdefault(e[0], []).append(e)
                found += kept.get(key, [])
        return pa.Table.from_arrays([pa.array([e[k] for e in found], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["surt", "page_id", "file", "offset", "length"])

    placed = settled(keys.mapInArrow(place, "surt string, part int"), "wanted")
    tasks = F.ceil(F.col("n") / KEYS).cast("int")
    many = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", tasks.alias("tasks"))
    wanted = settled(placed.join(many, "part").withColumn("task", F.expr("pmod(xxhash64(surt), tasks)").cast("int")), "wanted").drop("tasks")
    blocks = directory.join(many, "part").withColumn("task", F.expr("explode(sequence(0, tasks - 1))")).drop("tasks")
    return wanted.groupBy("part", "task").cogroup(blocks.groupBy("part", "task")).applyInArrow(search, ENTRY)


def round_trip(pages: DataFrame) -> DataFrame:
    """pages written to archives with an index in the shared folder, and the records of every page's URL looked up in the
    index and read back."""
    folder = shared_folder(pages.sparkSession, "warc")
    manifest = write_archives(deduplicated(pages), f"{folder}/archives")
    directory = write_index(manifest, f"{folder}/index")
    files = manifest.select("file").distinct().count()
    return read_records(look_up(pages.select("url"), directory, f"{folder}/index"), f"{folder}/archives", files=max(1, min(files, 10_000)))
