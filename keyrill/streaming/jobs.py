"""Running streams: where their files go, with which settings they run, and how they end."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from keyrill.folders import shared_folder, work_folder

__all__ = ["Job", "TapLog", "finish", "job_session", "shared_folder", "stop", "work_folder"]

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KEPT = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.autoBroadcastJoinThreshold")


def job_session(spark: SparkSession, partitions: int | None = None, idle_batches: bool = True) -> SparkSession:
    """A session for one streaming job, with its own settings.

    The number of state partitions is fixed for the life of a checkpoint, so it belongs to the job: by default the
    shuffle partitions the caller's session is set to, whatever the machine. State is kept in RocksDB, on local disk instead of the executor heap. A batch without new records only
    moves the watermark; append-mode windows need it, inner joins can do without `idle_batches`.
    """
    session = spark.newSession()
    for name in _KEPT:
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.shuffle.partitions", partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    # sessions are merged before the shuffle as well, for the sake of hot keys
    session.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return session


@dataclass(frozen=True)
class Job:
    """A named streaming job with its checkpoint and output below one folder.

    The same folder resumes the job where it stopped; another one (`Job.fresh`) starts it over from the first record.
    """

    name: str
    folder: str

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> Job:
        return cls(name, work_folder(spark, name))

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    @property
    def output(self) -> str:
        return f"{self.folder}/output"

    def _writer(self, df: DataFrame, mode: str, available_now: bool):
        writer = df.writeStream.outputMode(mode).queryName(self.name).option("checkpointLocation", self.checkpoint)
        return writer.trigger(availableNow=True) if available_now else writer

    def append(self, df: DataFrame, available_now: bool = True):
        """Start writing finished rows to Parquet, each exactly once."""
        return self._writer(df, "append", available_now).format("parquet").option("path", self.output).start()

    def for_each_batch(self, df: DataFrame, write: Callable[[DataFrame, int], None], mode: str, available_now: bool = True):
        """Start handing each micro-batch, with its number, to `write`; the same number may come again after a failure."""
        return self._writer(df, mode, available_now).foreachBatch(write).start()


class TapLog(StreamingQueryListener):
    """Adds up what the taps of streaming queries saw; register it with `spark.streams.addListener`."""

    def __init__(self) -> None:
        self.records: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, seen in event.progress.observedMetrics.items():
            self.records[name] = self.records.get(name, 0) + seen.records

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def finish(query, timeout: float | None = None) -> None:
    """Wait for the end of a query that stops by itself; a failed query raises `StreamingQueryException`."""
    query.awaitTermination(timeout) if timeout else query.awaitTermination()


def stop(query, seconds: float = 2.0) -> bool:
    """Stop a query, giving the batch in progress some time. True if it ended before it had to be stopped."""
    ended = query.awaitTermination(seconds) if query.isActive else True
    if not ended:
        query.stop()
    return ended
