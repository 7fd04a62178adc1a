"""Topics: partitioned record logs, kept in a directory of Parquet files or in Kafka."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.folders import exists
from keyrill.schemas import ENVELOPE
from keyrill.sources.codecs import decode_text

PARTITIONS = 6  # fixed value: partitions of a topic


@dataclass(frozen=True)
class Topic:
    """A directory topic (`path`) or, with `servers`, a Kafka topic of that name.

    A directory holds `load=<id>/partition=<n>/` folders, one `load` per bulk load or micro-batch of a writer. A load
    counts once it is complete: a load that broke off is written over, a repeated one is left as it is, so that readers of the topic
    never see its records twice. Two loads at the same time would give out the same offsets: start one after the other. Kafka has no such
    ids: there a repeated load or micro-batch is appended again.
    Kafka needs the spark-sql-kafka package on the class path.
    """

    path: str
    servers: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, schema: T.StructType = ENVELOPE, streaming: bool = False) -> DataFrame:
        """The records, oldest first available; on a stream also those still to come."""
        reader = spark.readStream if streaming else spark.read
        if self.servers is not None:
            # unlike a batch read, a stream would start at the newest records
            records = (
                reader.format("kafka")
                .option("kafka.bootstrap.servers", self.servers)
                .option("subscribe", self.path)
                .option("startingOffsets", "earliest")
                .options(**self.options)
                .load()
            )
            return decode_text(records).select(*schema.names)
        stored = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        return reader.schema(stored).options(**self.options).parquet(self.path).select(*schema.names)

    def load(self, df: DataFrame, load: str, partitions: int = PARTITIONS, replace: bool = False) -> None:
        """Append the records once: a complete load of the same id is left as it is, or with `replace` written anew.

        Records without an offset get one beyond all offsets of the topic, rising in the order they come in.
        """
        if self.servers is not None:
            kafka_sink(df).write.format("kafka").options(**self._sink_options()).save()
            return
        folder = f"{self.path}/load={load}"
        if not replace and exists(df.sparkSession, f"{folder}/_SUCCESS"):
            return
        if "offset" not in df.columns:
            df = self._with_offsets(df, load)
        laid_out(df, partitions).write.mode("overwrite").partitionBy("partition").parquet(folder)

    def _with_offsets(self, df: DataFrame, load: str) -> DataFrame:
        spark, last = df.sparkSession, None
        if exists(spark, self.path):
            kept = T.StructType([T.StructField("offset", T.LongType()), T.StructField("load", T.StringType())])
            # a broken load of this id is about to go
            last = spark.read.schema(kept).parquet(self.path).where(F.col("load") != load).agg(F.max("offset")).first()[0]
        first = 0 if last is None else last + 1
        return df.withColumn("offset", F.monotonically_increasing_id() + F.lit(first))

    def write_stream(self, df: DataFrame, checkpoint: str, name: str, available_now: bool = True):
        """Start writing a stream to the topic; with `available_now` it ends once the records there are written.

        A directory gets one load per micro-batch, named by the query's id in the checkpoint and the batch, so writers of the same
        name with other checkpoints do not disturb each other.
        """
        if self.servers is not None:
            writer = kafka_sink(df).writeStream.format("kafka").options(**self._sink_options())
        else:
            writer = df.writeStream.foreachBatch(lambda batch, number: self.load(batch, f"{name}-{query_id(batch)}-{number}"))
        writer = writer.outputMode("append").queryName(name).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def _sink_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.path, **self.options}


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query a micro-batch belongs to; it lives as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def partition_of(key: Column, partitions: int = PARTITIONS) -> Column:
    """The partition of a key; records without one go to partition 0."""
    return F.when(key.isNull(), F.lit(0)).otherwise(F.pmod(F.hash(key), F.lit(partitions)))


def with_partition(df: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """Fill in the partition of records that do not name one."""
    chosen = partition_of(F.col("key"), partitions)
    if "partition" in df.columns:
        chosen = F.coalesce("partition", chosen)
    return df.withColumn("partition", chosen.cast("int"))


def laid_out(df: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """Records gathered by partition for writing.

    Rebalancing keeps the files of a partition few and, unlike a plain repartition, splits a partition that holds much
    more than the others.
    """
    return with_partition(df, partitions).hint("rebalance", "partition")


def kafka_sink(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ("key", "value", "partition") if c in df.columns])
