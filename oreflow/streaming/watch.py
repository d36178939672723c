"""Watching streams: stop when idle, count what is lost, go on after a failure, and let go of what is read."""

from __future__ import annotations

import logging
import re
import threading
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from oreflow.sources.topics import FILES_READ, Topic, admitted

log = logging.getLogger("oreflow")


class _Listener(StreamingQueryListener):
    """A listener with nothing to say; the ones below take what they need."""

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


class IdleStop(_Listener):
    """Tells when a query has found nothing new at a trigger, or has ended."""

    def __init__(self, run_id: str, triggers: int):
        self.run_id, self.left, self.done = run_id, triggers, threading.Event()

    def onQueryIdle(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.left -= 1
            if self.left <= 0:
                self.done.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.done.set()


@contextmanager
def listening(spark: SparkSession, listener: StreamingQueryListener) -> Iterator[StreamingQueryListener]:
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def run_until_idle(spark: SparkSession, query: StreamingQuery, triggers: int = 1, seconds: float | None = None) -> bool:
    """Let a query with a repeating trigger work off what is there, then stop it; raises if it failed.

    It is stopped at the ``triggers``-th trigger that found nothing to do, so never between the rows
    that are there, whatever the time that takes.  False if ``seconds`` went by before: the query
    then goes on.
    """
    with listening(spark, IdleStop(str(query.runId), triggers)) as idle:
        if not query.isActive:
            query.awaitTermination()
            return True
        if not idle.done.wait(seconds):
            return False
    if not query.isActive:
        query.awaitTermination()
    # Between an idle trigger and this line new rows may have come; what is there now is taken in.
    query.processAllAvailable()
    query.stop()
    return True


def _source_batch(offset: str | None) -> int:
    """The number of a file source's batch in an offset; -1 before the first."""
    found = re.search(r"logOffset\D*(\d+)", offset or "")
    return int(found.group(1)) if found else -1


class LossCounter(_Listener):
    """Counts, by query name or id, the rows that operators with state dropped as late, and lost files.

    A stream over a Parquet log passes over files that are gone when it comes to read them; they are
    those that its checkpoint lists and that gave no row (``lost_files``).
    """

    def __init__(self) -> None:
        self.late: Counter[str] = Counter()
        self.rows: Counter[str] = Counter()
        self.files: Counter[str] = Counter()
        self.offsets: dict[str, tuple[int, int]] = {}
        self.started: set[str] = set()
        self.ended: set[str] = set()
        self._told = threading.Condition()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self.rows[name] += progress.numInputRows
        self.late[name] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        seen = progress.observedMetrics.get(FILES_READ)
        if seen is not None:
            self.files[name] += seen.files
            first, last = (_source_batch(x) for x in (progress.sources[0].startOffset, progress.sources[0].endOffset))
            self.offsets[name] = (min(self.offsets.get(name, (first,))[0], first), last)

    def lost_files(self, spark: SparkSession, query: StreamingQuery, checkpoint: str) -> int:
        """Files that the query took up while this listened and did not find."""
        name = query.name or str(query.id)
        if name not in self.offsets:
            return 0
        return admitted(spark, checkpoint, *self.offsets[name]).count() - self.files[name]

    def onQueryTerminated(self, event) -> None:
        with self._told:
            self.ended.add(str(event.runId))
            self._told.notify_all()

    def onQueryStarted(self, event) -> None:
        with self._told:
            self.started.add(str(event.runId))

    def wait_idle(self, spark: SparkSession, seconds: float = 60.0) -> None:
        """Until the events of all queries seen to start and no longer active have come, which is after the fact."""
        active = {str(query.runId) for query in spark.streams.active}
        with self._told:
            if not self._told.wait_for(lambda: self.started - active <= self.ended, seconds):
                raise TimeoutError("no word of the end of some queries")


def supervised(start: Callable[[], StreamingQuery], attempts: int = 3) -> StreamingQuery:
    """Run the query that ``start`` makes to its end; where it fails, start it again from its checkpoint.

    The rows of a batch that failed are taken in once: sinks know the batches they have, and what a
    failed attempt left behind is not read.
    """
    for left in range(attempts - 1, -1, -1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException as failure:
            if not left:
                raise
            log.warning("query failed, %d more attempts: %s", left, str(failure).splitlines()[0])
    raise ValueError("attempts must be at least 1")


def _newest_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """The newest batch that a checkpoint holds as done; None where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return max((int(name) for name in names if name.isdigit()), default=None)


def uncommitted(spark: SparkSession, checkpoint: str) -> int | None:
    """Takes back the commit of the newest batch; its number, or None where there is none.

    The checkpoint is then as if the process had died when the sink had its rows and before the
    batch was marked as done: the next start runs that batch again.  For recovery drills.
    """
    batch = _newest_commit(spark, checkpoint)
    if batch is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{batch}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)
    return batch


def drop_read(spark: SparkSession, topic: Topic, checkpoint: str) -> int:
    """Deletes the files of a Parquet log that the stream with this checkpoint is done with; how many they were.

    For a log without another reader, as Kafka lets go of records before an offset.  Files that the stream has
    not taken up stay, and so do those of a batch that it would run again after a failure.
    """
    if not topic.path:
        raise ValueError("the records of a Kafka topic go by its own retention")
    batch = _newest_commit(spark, checkpoint)
    if batch is None:
        return 0
    offset = "\n".join(row.value for row in spark.read.text(f"{checkpoint}/offsets/{batch}").collect())
    # The two write the scheme differently (``file:/`` and ``file:///``); all files are in one file system.
    at = F.try_parse_url("path", F.lit("PATH")).alias("at")
    there = spark.read.format("binaryFile").load(topic.path).select(F.col("_metadata.file_path").alias("path"))
    read = admitted(spark, checkpoint, -1, _source_batch(offset)).select(at)
    done = there.select("path", at).join(read, "at", "left_semi").collect()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for row in done:
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.path))
        place.getFileSystem(conf).delete(place, False)
    return len(done)
