"""The life of files on a stream: a file that stays ``processing`` beyond its time limit becomes ``failed``.

Each file's state and its timer are keyed state, so any number of files are waited for at once and
a stopped stream goes on with its timers where it was.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from docvec.operators import usage
from docvec.operators.usage import FAILED, PROCESSING

# Fixed value: the time limit of a step.
LIMIT_MINUTES = 300

LIFE = "file_id string, status string, at long, error string"
PROVIDER, ROCKS = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


def overdue(minutes: float) -> str:
    return f"no end within {minutes:g} minutes"


class FileLife(StatefulProcessor):
    """Keeps a file's newest state, and a timer while that is ``processing``; times are milliseconds.

    Each call of the state or of a timer is an exchange with the JVM, so a key has as few as it
    needs: one where nothing changes, three or four otherwise.
    """

    def __init__(self, minutes: float, keep_minutes: float):
        self.minutes, self.limit, self.keep = minutes, int(minutes * 60_000), int(keep_minutes * 60_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "status string, at long, timer long")

    def put(self, status: str, at: int, due: int, earlier: int | None) -> None:
        """Remember the state, and be called at ``due``; the ``earlier`` timer no longer counts."""
        if earlier != due:
            if earlier is not None:
                self.handle.deleteTimer(earlier)
            self.handle.registerTimer(due)
        self.newest.update((status, at, due))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.newest.get()
        at, status = (-1, "") if before is None else (before[1], before[0])
        # Of states of one time the last one in the order of their names counts.
        new_at, new_status = max((r.at, r.status) for r in rows)
        if (new_at, new_status) <= (at, status):
            return
        due = new_at + (self.limit if new_status == PROCESSING else self.keep)
        self.put(new_status, new_at, due, None if before is None else before[2])
        yield Row(file_id=key[0], status=new_status, at=new_at, error=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        status, _, due = self.newest.get()
        if status == PROCESSING:
            self.put(FAILED, due, due + self.keep, None)  # the timer that was due is gone
            yield Row(file_id=key[0], status=FAILED, at=due, error=overdue(self.minutes))
        else:
            self.newest.clear()


def changes(log: DataFrame, minutes: float = LIMIT_MINUTES, delay: str = "10 minutes", keep_minutes: float = LIMIT_MINUTES) -> DataFrame:
    """``file_id``, ``status``, ``timestamp`` and ``error`` of each change of a file's state, from a stream with the first three.

    A batch's states of one file are one change, to the newest. When the stream's time, which is
    ``delay`` behind its newest row, passes a file's time limit, the file fails at that time; a
    state that comes later still counts. A file that has ended is forgotten after ``keep_minutes``.
    Start the stream within ``rocks``: timers need that store of state.
    """
    rows = log.select(F.col("file_id").cast("string").alias("file_id"), "status", F.col("timestamp").cast("timestamp").alias("timestamp"))
    rows = rows.where("file_id IS NOT NULL AND status IS NOT NULL AND timestamp IS NOT NULL").withWatermark("timestamp", delay)
    told = rows.withColumn("at", F.unix_millis("timestamp")).groupBy("file_id").transformWithState(
        FileLife(minutes, keep_minutes), outputStructType=LIFE, outputMode="Update", timeMode="EventTime"
    )
    return told.select("file_id", "status", F.timestamp_millis("at").alias("timestamp"), "error")


@contextmanager
def rocks(spark: SparkSession):
    """Streams started within keep their state in RocksDB; the session's setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def run(log: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, **limits) -> StreamingQuery:
    """Hand the changes of each micro-batch to ``write``, and stop when no input is left."""
    with rocks(log.sparkSession):
        query = (
            changes(log, **limits).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .outputMode("update").trigger(availableNow=True).start()
        )
        query.processAllAvailable()
    return query


def states(log: DataFrame, now, minutes: float = LIMIT_MINUTES) -> DataFrame:
    """The state of each file of a whole log at the time ``now``: what ``changes`` has told by then."""
    newest = usage.latest_status(log, at="timestamp", tie="status")
    due = F.col("timestamp") + F.make_dt_interval(mins=F.lit(0), secs=F.lit(minutes * 60).cast("decimal(18,6)"))
    late = (F.col("status") == PROCESSING) & (due <= now)
    return newest.select(
        "file_id", F.when(late, FAILED).otherwise(F.col("status")).alias("status"), F.when(late, due).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(late, overdue(minutes)).alias("error"),
    )
