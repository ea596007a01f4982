"""Web archives: WARC 1.1 files of one gzip member per record, written and read by tasks.

Writing marks repeats: of records with equal payloads only one holds the bytes, the others are
``revisit`` records that name it. Reading is sequential: compressed bytes come in pieces, each
gzip member is inflated piece by piece, a record's block is as long as its header says, and the
digests of payload and block are added up on the way and compared with the header's.
"""

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.cluster import scratch_path, written
from docvec.llm.kernels import utf8

# Fixed values of the format.
VERSION = b"WARC/1.1"
RESPONSE, REVISIT, INFO = "response", "revisit", "warcinfo"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK, HEAD_END, RECORD_END = b"\r\n", b"\r\n\r\n", b"\r\n\r\n"

# Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
# Compressed bytes after which an archive ends with the record it is in.
ARCHIVE_BYTES = 1 << 28
# A payload that one row in so many has counts as frequent; so there are no more than so many frequent ones.
FREQUENT = 1000
# Bytes read or inflated at a time, of a header at most, and of payloads in one batch unless one alone is longer.
PIECE, LONGEST_HEADER, BATCH_BYTES = 1 << 16, 1 << 20, 4 << 20
LEVEL = 6
ID = "urn:page:"


def marked(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``pages(key, uri, payload)`` with ``digest``, ``size`` and, for revisits, ``first``: the smallest key with that payload.

    A payload that many rows share is no hot key: what at least one row in ``FREQUENT`` has is at
    most ``FREQUENT`` digests, which are broadcast; rows that have them are dealt out by key, the
    others by digest.
    """
    digest, size = F.sha2("payload", 256), F.octet_length("payload").cast("long")
    pages = pages.withColumns({"digest": digest, "size": size})
    groups = pages.where(F.col("size") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    groups = written(groups.where("n > 1 AND first IS NOT NULL"), "copies")
    total = pages.count()
    frequent = groups.where(F.col("n") * FREQUENT >= total).select("digest", "first")
    others = groups.where(F.col("n") * FREQUENT < total).select(F.col("digest").alias("meet"), F.col("first").alias("rare_first"))
    pages = pages.join(F.broadcast(frequent), "digest", "left")
    meet = F.when(F.col("first").isNull(), F.col("digest")).otherwise(F.concat(F.lit("frequent:"), F.col("key").cast("string")))
    pages = pages.withColumn("meet", meet).join(others, "meet", "left")
    first = F.coalesce("first", "rare_first")
    return pages.withColumn("first", F.when(F.col("key") > first, first)).drop("meet", "rare_first")


def record_id(key: int | None) -> str:
    return f"<{ID}{'' if key is None else key}>"


def key_of(identifier: str | None) -> int | None:
    found = re.fullmatch(rf"<{ID}(-?\d+)>", identifier or "")
    return int(found[1]) if found else None


def member(data: list[bytes]) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join([*(packer.compress(d) for d in data), packer.flush()])


def record(fields: list[tuple[str, str | None]], block: list[bytes]) -> bytes:
    """A record as a gzip member; fields without a value are left out."""
    sha = hashlib.sha256()
    for part in block:
        sha.update(part)
    named = [*fields, ("WARC-Block-Digest", f"sha256:{sha.hexdigest()}"), ("Content-Length", str(sum(map(len, block))))]
    head = BREAK.join([VERSION, *(utf8(f"{k}: {v}") for k, v in named if v is not None)]) + HEAD_END
    return member([head, *block, RECORD_END])


def page_record(key: int | None, uri: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """The record of a page: a response with its payload, or a revisit of the page ``first`` without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    repeat = first is not None
    fields = [
        ("WARC-Type", REVISIT if repeat else RESPONSE),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", date),
        # What is no printable ASCII is escaped, so that no address can add a line to the header.
        ("WARC-Target-URI", None if uri is None else quote(utf8(uri), safe="!#$%&'()*+,-./:;<=>?@[]^_`{|}~\"\\")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", PROFILE if repeat else None),
        ("WARC-Refers-To", record_id(first) if repeat else None),
        ("X-Payload-Length", str(len(payload))),
    ]
    return record(fields, [http] if repeat else [http, payload])


def write(df: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html", folder: str | None = None,
          least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row; one row per archive: ``path``, ``records`` and ``bytes``.

    Of rows with equal payloads of ``least`` bytes or more, those with the smallest integer key are
    responses and the others revisits of them; a row without a key, or with a shorter payload, is a
    response. Rows that repeat a key have records with the same id. A null payload is empty, a null
    address has no field, other columns are not written. A payload must stay below 2 GB; a task holds
    one batch of rows. Every task starts archives of its own, ended after ``archive_bytes``; a table
    without rows gives none. The result is a written table, so files of attempts that failed stay
    unnamed and unread.
    """
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "archives")
    pages = df.select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = marked(pages, least).select("key", "uri", F.col("payload").cast("binary").alias("payload"), "digest", "first")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, out, state = TaskContext.get().partitionId(), None, {}

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([state], schema=ARCHIVES)

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "uri", "payload", "digest", "first")]
            for i in range(batch.num_rows):
                if out is None:
                    name = f"pages-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, state = store.open_output_stream(f"{base}/{name}", compression=None), {"path": f"{folder}/{name}", "records": 0, "bytes": 0}
                    info = [("WARC-Type", INFO), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
                    state["bytes"] += out.write(record(info, [b"format: WARC File Format 1.1\r\n"]))
                values = [c[i].as_py() for c in columns]
                state["bytes"] += out.write(page_record(*values, date))
                state["records"] += 1
                if state["bytes"] >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(rows.mapInArrow(archives, "path string, records long, bytes long"), "archives-written")


ARCHIVES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


class Broken(ValueError):
    """An archive that ends early or is not framed as its headers say."""


class Members:
    """The inflated bytes of a file of gzip members, some at a time; ``member`` is where the current one begins."""

    def __init__(self, file):
        self.file, self.packed, self.at, self.member = file, b"", 0, 0
        self.held, self.inflater = bytearray(), None

    def more(self) -> bool:
        """Inflate the next piece of the current member, or begin the next one; false at the end of the file."""
        while True:
            if not self.packed:
                self.packed = self.file.read(PIECE)
            if self.inflater is None:
                if not self.packed:
                    return False
                self.inflater, self.member = zlib.decompressobj(31), self.at
            elif not self.packed:
                raise Broken(f"gzip member at {self.member} is cut off")
            try:
                found = self.inflater.decompress(self.packed, PIECE)
            except zlib.error as error:
                raise Broken(f"gzip member at {self.member}: {error}") from error
            rest = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            self.at += len(self.packed) - len(rest)
            self.packed = rest
            if self.inflater.eof:
                self.inflater = None
            if found:
                self.held += found
                return True

    def until(self, mark: bytes, most: int) -> bytes | None:
        """The bytes before ``mark``, which is passed; None if the file ends before any byte."""
        place, seen = -1, 0
        while place < 0:
            place = self.held.find(mark, max(0, seen - len(mark) + 1))
            if place < 0:
                seen = len(self.held)
                if seen > most:
                    raise Broken(f"no end of a header in {most} bytes at {self.member}")
                if not self.more():
                    if self.held:
                        raise Broken(f"a header at {self.member} is cut off")
                    return None
        found = bytes(self.held[:place])
        del self.held[: place + len(mark)]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.held and not self.more():
                raise Broken(f"a block at {self.member} is cut off")
            found = bytes(self.held[:n])
            del self.held[: len(found)]
            n -= len(found)
            yield found


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.split(BREAK)
    if not lines[0].startswith(b"WARC/"):
        raise Broken(f"not a WARC record: {lines[0][:20]!r}")
    found: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Broken(f"not a field: {name[:40]!r}")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def records(file, with_payload: bool = True) -> Iterator[dict]:
    """The records of an archive in their order; a block of any length is held once, and only if its payload is wanted.

    ``problem`` names digests that differ. A record of several members or a member of several
    records is read all the same: framing is by ``Content-Length``.
    """
    stream = Members(file)
    while (head := stream.until(HEAD_END, LONGEST_HEADER)) is not None:
        offset, fields = stream.member, fields_of(head)
        size = fields.get("content-length", "")
        if not re.fullmatch(r"\d+", size):
            raise Broken(f"record at {offset} has no length")
        block, payload, kept = hashlib.sha256(), hashlib.sha256(), []
        http, start, length = "application/http" in fields.get("content-type", ""), b"", 0
        for part in stream.take(int(size)):
            block.update(part)
            if http:  # up to the empty line it is the answer's own header
                start += part
                end = start.find(HEAD_END)
                if end < 0:
                    if len(start) > LONGEST_HEADER:
                        raise Broken(f"no end of an answer's header at {offset}")
                    continue
                part, http = start[end + len(HEAD_END) :], False
            payload.update(part)
            length += len(part)
            if with_payload:
                kept.append(part)
        if b"".join(stream.take(len(RECORD_END))) != RECORD_END:
            raise Broken(f"record at {offset} does not end where its length says")
        own = {"block": block.hexdigest(), "payload": payload.hexdigest()}
        if fields.get("warc-type") == REVISIT:
            del own["payload"]  # it is that of the record it refers to
        wrong = [k for k, v in own.items() if (given := fields.get(f"warc-{k}-digest")) and given.lower().startswith("sha256:") and given.lower()[7:] != v]
        yield {"fields": fields, "offset": offset, "payload": b"".join(kept), "payload_size": length, "payload_digest": payload.hexdigest(),
               "problem": f"wrong digest of {' and '.join(wrong)}" if wrong else None}


READ = "path string, offset long, record_type string, key long, uri string, payload_bytes long, payload_digest string, refers_to long, payload binary, problem string"
READ_SCHEMA = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("key", pa.int64()), ("uri", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())]
)


def row_of(path: str, found: dict) -> dict:
    fields = found["fields"]
    kind = fields.get("warc-type")
    size, digest = found["payload_size"], found["payload_digest"]
    if kind == REVISIT:
        size = fields.get("x-payload-length", "")
        size = int(size) if re.fullmatch(r"\d+", size) else None
        digest = fields.get("warc-payload-digest", "").lower().removeprefix("sha256:") or None
    return {"path": path, "offset": found["offset"], "record_type": kind, "key": key_of(fields.get("warc-record-id")),
            "uri": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "refers_to": key_of(fields.get("warc-refers-to")), "payload": None if kind == REVISIT else found["payload"], "problem": found["problem"]}


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record but ``warcinfo`` of the archives in column ``path``, read by one task per archive at a time.

    Columns: ``path``, ``offset`` of its gzip member, ``record_type``, ``key``,
    ``uri`` as written, ``payload_bytes`` and ``payload_digest`` of the full payload (of a revisit: what its header says),
    ``refers_to``, ``payload`` (null for revisits, or without ``with_payload``) and ``problem``: null,
    or what is wrong. An archive that is cut off or broken gives its records up to there and a
    last row with the problem only. A payload must stay below 2 GB.
    """
    spark = archives.sparkSession

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as file:
                    try:
                        for one in records(file, with_payload):
                            if one["fields"].get("warc-type") == INFO and not one["problem"]:
                                continue
                            rows.append(row_of(path, one if with_payload else one | {"payload": None}))
                            size += len(one["payload"]) + 500
                            if size >= BATCH_BYTES:
                                yield pa.RecordBatch.from_pylist(rows, schema=READ_SCHEMA)
                                rows, size = [], 0
                    except Broken as error:
                        rows.append({"path": path, "problem": str(error)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=READ_SCHEMA)

    paths = archives.select("path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return paths.mapInArrow(found, READ)


def resolved(found: DataFrame) -> DataFrame:
    """``found`` by ``read`` with every revisit's payload filled in from the response it refers to.

    Revisits meet the payloads that any of them refers to, by digest, so that the copies of one
    payload are spread by a salt over as many tasks as there are partitions.
    """
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    revisits = found.where(F.col("record_type") == REVISIT).drop("payload").withColumn("salt", F.pmod(F.xxhash64("key", "offset"), F.lit(n)).cast("int"))
    wanted = revisits.select(F.col("refers_to").alias("key"), "payload_digest", "salt").distinct()
    have = found.where(F.col("record_type") == RESPONSE).select("key", "payload_digest", "payload").dropDuplicates(["key", "payload_digest"])
    have = wanted.join(have, ["key", "payload_digest"]).withColumnRenamed("key", "refers_to")
    filled = revisits.join(have, ["refers_to", "payload_digest", "salt"], "left").select(found.columns)
    return found.where(~F.col("record_type").eqNullSafe(REVISIT)).unionByName(filled)


def sound(found: DataFrame) -> Column:
    """The record type of each row; a row with a problem stops the job."""
    return F.when(found["problem"].isNotNull(), F.raise_error(F.concat_ws(" ", found["path"], found["problem"]))).otherwise(found["record_type"])
