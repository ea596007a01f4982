"""Every object of a store, listed by tasks: as a table, and as a stream that misses none.

A store is walked in units: a folder with all below it, a folder's own entries only, or a share of
the entries of a folder that has very many. Names never pass the driver, apart from those it needs
to plan the first units. Hidden names and empty files are objects like all others; the checksums
that Hadoop keeps beside local files are none.
"""

import json
import os
import time
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from docvec.cluster import written

FORMAT = "docvec_objects"
SCHEMA = "path string, modificationTime timestamp, length bigint"
ARROW = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())])

# Units that a plan has at least, if the tree has as many folders, and tasks that list them at most; entries of a folder beyond which
# it is dealt out in shares; objects that a task of a walk lists before it hands folders on.
SPLITS, MANY, SHARES, BUDGET = 64, 20_000, 32, 50_000
# Objects of a batch of rows.
ROWS = 10_000
# Seconds that an object must be old before a stream reads it, so that a clock's steps and uploads that become visible late do no harm.
SETTLE = 2.0

# The names of S3, and settings of its file system that Hadoop and Arrow both have.
S3_SCHEMES = ("s3a", "s3n", "s3")
S3_SETTINGS = {
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
}
S3_PLAIN, S3_PROVIDER, S3_ANONYMOUS = "fs.s3a.connection.ssl.enabled", "fs.s3a.aws.credentials.provider", "AnonymousAWSCredentialsProvider"


class Unit(NamedTuple):
    """A folder to list: all below it if ``deep``, else its own objects; of shares, only the entries of one."""

    folder: str
    deep: bool = True
    share: int = 0
    shares: int = 1

    def has(self, name: str) -> bool:
        return self.shares == 1 or zlib.crc32(name.encode("utf-8", "surrogateescape")) % self.shares == self.share


class Entry(NamedTuple):
    """An object or folder. ``arrived`` is when it came to its place, as far as the store knows; times are in microseconds."""

    path: str
    folder: bool
    modified: int
    size: int
    arrived: int


def s3_options(settings: dict[str, str]) -> dict:
    """Arguments of Arrow's S3 file system from Hadoop's settings."""
    found: dict = {ours: settings[theirs] for theirs, ours in S3_SETTINGS.items() if settings.get(theirs)}
    if settings.get(S3_PLAIN, "true").lower() == "false":
        found["scheme"] = "http"
    if S3_ANONYMOUS in settings.get(S3_PROVIDER, ""):
        found["anonymous"] = True
    return found


def options_of(spark: SparkSession, root: str) -> dict | None:
    """Arguments of Arrow's file system for ``root`` from the session's settings; None where it needs none."""
    if root.partition("://")[0].lower() not in S3_SCHEMES:
        return None
    conf = spark._jsc.hadoopConfiguration()
    return s3_options({k: conf.get(k) for k in [*S3_SETTINGS, S3_PLAIN, S3_PROVIDER] if conf.get(k)})


class Store:
    """A store that tasks can list and read: the local disk, S3 under any of its names, and what Arrow knows by its address."""

    def __init__(self, root: str, options: dict | None = None):
        from pyarrow import fs

        scheme, colon, rest = root.partition("://")
        if colon and scheme.lower() in S3_SCHEMES:
            self.files, self.base, self.scheme = fs.S3FileSystem(**(options or {})), rest.strip("/"), f"{scheme}://"
        else:
            self.files, self.base = fs.FileSystem.from_uri(root)
            known = root.rstrip("/").endswith(self.base.rstrip("/"))
            self.scheme = root[: len(root.rstrip("/")) - len(self.base.rstrip("/"))] if known else ""
            self.base = self.base.rstrip("/") or "/"
        self.local = self.files.type_name == "local"

    @staticmethod
    def of(spark: SparkSession, root: str) -> "Callable[[], Store] | None":
        """What opens the store of ``root`` in a task; None if only Hadoop knows it."""
        options = options_of(spark, root)
        try:
            Store(root, options)
        except (ValueError, OSError, NotImplementedError):
            return None
        return lambda: Store(root, options)

    def entries(self, unit: Unit) -> Iterator[Entry]:
        """Entries of the unit's folder, without what is below them. A folder that does not exist has none."""
        return self.local_entries(unit) if self.local else self.other_entries(unit)

    def local_entries(self, unit: Unit) -> Iterator[Entry]:
        """Only the names of a whole folder are read; what is asked of an object is asked in its share."""
        try:
            found = os.scandir(unit.folder)
        except FileNotFoundError:
            return
        with found:
            for x in found:
                if not unit.has(x.name):
                    continue
                if x.name.startswith(".") and x.name.endswith(".crc") and os.path.exists(os.path.join(unit.folder, x.name[1:-4])):
                    continue
                try:
                    stat = x.stat()
                except FileNotFoundError:  # gone meanwhile
                    continue
                if not self.readable(x.path):
                    raise ValueError(f"a name below {unit.folder!r} is no UTF-8")
                yield Entry(x.path, x.is_dir(), stat.st_mtime_ns // 1000, stat.st_size, max(stat.st_mtime_ns, stat.st_ctime_ns) // 1000)

    @staticmethod
    def readable(name: str) -> bool:
        return name.isascii() or not any("\udc80" <= c <= "\udcff" for c in name)

    def other_entries(self, unit: Unit) -> Iterator[Entry]:
        from pyarrow import fs

        for x in self.files.get_file_info(fs.FileSelector(unit.folder, recursive=False, allow_not_found=True)):
            if unit.has(x.base_name):
                modified = (x.mtime_ns or 0) // 1000
                yield Entry(x.path, x.type == fs.FileType.Directory, modified, x.size or 0, modified)

    def below(self, units: Iterator[Unit] | list[Unit]) -> Iterator[Entry]:
        """All objects of the units, depth first."""
        open_units = list(units)
        while open_units:
            unit = open_units.pop()
            for x in self.entries(unit):
                if not x.folder:
                    yield x
                elif unit.deep:
                    open_units.append(Unit(x.path))

    def plan(self, splits: int = SPLITS, many: int = MANY, shares: int = SHARES) -> list[Unit]:
        """Units that together are the whole tree, from as few folders as give ``splits`` of them.

        The highest folders are opened first; no more than ``many`` names of one are read.
        """
        found: list[Unit] = []
        folders = deque([self.base])
        while folders and len(found) + len(folders) < splits:
            folder = folders.popleft()
            first = list(islice(self.entries(Unit(folder)), many + 1))
            if len(first) > many:
                found += [Unit(folder, True, i, shares) for i in range(shares)]
                continue
            if any(not x.folder for x in first):
                found.append(Unit(folder, False))
            folders += [x.path for x in first if x.folder]
        return found + [Unit(f) for f in folders]

    def batches(self, entries: Iterator[Entry]) -> Iterator[pa.RecordBatch]:
        while some := list(islice(entries, ROWS)):
            paths = pa.array([self.scheme + x.path for x in some], pa.string())
            times = pa.array([x.modified for x in some], pa.int64()).cast(pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([paths, times, pa.array([x.size for x in some], pa.int64())], schema=ARROW)


def walk(spark: SparkSession, root: str, budget: int = BUDGET, many: int = MANY, shares: int = SHARES) -> DataFrame | None:
    """Every object below ``root``: ``path``, ``modificationTime`` and ``length``; None if only Hadoop knows the store.

    Rounds of tasks share the work: a task that has listed ``budget`` objects hands the folders it
    has not opened on to the next round, where they are dealt out anew, and a folder of more than
    ``many`` entries is handed on in shares. Each round is a written table. A root that does not
    exist has no objects.
    """
    store_of = Store.of(spark, root)
    if store_of is None:
        return None
    fields = [*ARROW, pa.field("folder", pa.string()), pa.field("share", pa.int32()), pa.field("shares", pa.int32())]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = store_of()
        for batch in batches:
            units = [Unit(r["folder"], True, r["share"], r["shares"]) for r in batch.to_pylist()]
            seen, handed = 0, []

            def objects() -> Iterator[Entry]:
                nonlocal seen
                while units:
                    unit = units.pop()
                    if seen >= budget:
                        handed.append(unit)
                        continue
                    found = store.entries(unit)
                    first = list(islice(found, many + 1)) if unit.shares == 1 else []
                    if len(first) > many:
                        handed.extend(Unit(unit.folder, True, i, shares) for i in range(shares))
                        continue
                    for some in (first, found):
                        for x in some:
                            seen += 1
                            if x.folder:
                                units.append(Unit(x.path))
                            else:
                                yield x

            for rows in store.batches(objects()):
                none = [pa.nulls(rows.num_rows, f.type) for f in fields[3:]]
                yield pa.RecordBatch.from_arrays([*rows.columns, *none], schema=pa.schema(fields))
            for begin in range(0, len(handed), ROWS):
                some = handed[begin : begin + ROWS]
                columns = [pa.nulls(len(some), f.type) for f in ARROW]
                columns += [pa.array([getattr(u, f.name) for u in some], f.type) for f in fields[3:]]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    todo = spark.createDataFrame([(store_of().base, 0, 1)], "folder string, share int, shares int")
    rounds = []
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        rounds.append(written(todo.mapInArrow(listed, f"{SCHEMA}, folder string, share int, shares int"), "walk"))
        todo = rounds[-1].where("folder IS NOT NULL").select("folder", "share", "shares")
        if todo.isEmpty():
            break
        todo = todo.repartition(partitions, "folder", "share")
    objects = rounds[0]
    for more in rounds[1:]:
        objects = objects.unionByName(more)
    return objects.where("folder IS NULL").select("path", "modificationTime", "length")


class UnitPartition(InputPartition):
    def __init__(self, units: list[Unit], until: int | None, after: int | None):
        self.units, self.until, self.after = units, until, after


class ObjectReader(DataSourceReader):
    """All objects of a store, its units dealt out to ``splits`` tasks, however many folders there are."""

    def __init__(self, options: dict):
        self.root, self.s3 = options["path"], json.loads(options.get("s3", "null"))
        self.splits, self.many = int(options.get("splits", SPLITS)), int(options.get("many", MANY))

    def units(self, until: int | None = None, after: int | None = None) -> list[UnitPartition]:
        store = Store(self.root, self.s3)
        found = store.plan(self.splits, self.many) or [Unit(store.base)]
        return [UnitPartition(found[i :: self.splits], until, after) for i in range(min(self.splits, len(found)))]

    def partitions(self) -> list[UnitPartition]:
        return self.units()

    def read(self, partition: UnitPartition) -> Iterator[pa.RecordBatch]:
        store, until, after = Store(self.root, self.s3), partition.until, partition.after
        found = store.below(partition.units)
        yield from store.batches(x for x in found if (until is None or x.arrived <= until) and (after is None or x.arrived > after))


class ObjectStreamReader(ObjectReader, DataSourceStreamReader):
    """What a store holds at a time. An offset is that time; a batch lists what had arrived by its end.

    With ``lookback`` (seconds) a batch leaves out what had arrived so long before its begin;
    without it, it lists all, and the stream behind it drops what it has seen.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.settle, self.lookback = float(options.get("settle", SETTLE)), options.get("lookback")

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": int((time.time() - self.settle) * 1e6)}

    def partitions(self, start: dict, end: dict) -> list[UnitPartition]:
        after = None if self.lookback is None else start["until"] - int(float(self.lookback) * 1e6)
        return self.units(end["until"], after)


class Objects(DataSource):
    """``spark.read.format("docvec_objects").load(root)`` and the same of ``readStream``.

    Options: ``splits`` and ``many`` of the plan, ``s3`` (arguments of Arrow's S3 file system as
    JSON), and for streams ``settle`` and ``lookback``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ObjectReader:
        return ObjectReader(dict(self.options))

    def streamReader(self, schema) -> ObjectStreamReader:
        return ObjectStreamReader(dict(self.options))


def stream(spark: SparkSession, root: str, settle: float = SETTLE, late: str | None = None, splits: int = SPLITS, many: int = MANY) -> DataFrame:
    """Every object of a store once, as a stream of ``path``, ``modificationTime`` and ``length``.

    An object that is written anew comes again. What was seen is Spark's own state, dealt out by
    path, so nothing is missed whatever its name, its time, its size or the folder it was moved
    with. That state has a row per object. With ``late``, such as ``7 days``, only what arrived
    within that time before a batch is listed again, and older state is forgotten; an object that
    becomes visible later than that, counted from its own time, is missed then.

    A batch that is replayed lists what had arrived by its end; on the local disk that is told by
    the time of the last change of a name too, not only by the time in the listing. The store must
    be one that tasks can read, not one that only Hadoop knows.
    """
    store_of = Store.of(spark, root)
    if store_of is None:
        raise ValueError(f"tasks cannot list {root!r}")
    spark.dataSource.register(Objects)
    reader = spark.readStream.format(FORMAT).options(settle=str(settle), splits=str(splits), many=str(many))
    reader = reader.option("s3", json.dumps(options_of(spark, root)))
    if late is None:
        return reader.load(root).dropDuplicates(["path", "modificationTime", "length"])
    seconds = spark.range(1).select(F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {late}"))).first()[0]
    found = reader.option("lookback", str(seconds)).load(root).withColumn("listed", F.current_timestamp())
    # State is kept twice as long as anything is listed again.
    return found.withWatermark("listed", f"{2 * seconds} seconds").dropDuplicatesWithinWatermark(["path", "modificationTime", "length"]).drop("listed")
