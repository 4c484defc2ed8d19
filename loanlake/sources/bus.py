"""Message-bus sink and source (A1, I2) through Spark's Kafka connector.

Message key = tenant_id, so one tenant's events stay in order on one topic
partition; value = the event JSON with nulls written. Producer settings
mirror an all-replica ack, 3 retries, one request in flight, gzip. The
connector jar (spark-sql-kafka) must be on the classpath; without it these
functions raise ``BusUnavailable``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.sources.landing import publish_records

PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.compression.type": "gzip",
}


class BusUnavailable(RuntimeError):
    pass


def _guard(fn):
    try:
        return fn()
    except AnalysisException as e:
        if "kafka" in str(e).lower() and ("find data source" in str(e).lower() or "not found" in str(e).lower()):
            raise BusUnavailable("the Kafka connector is not installed in this Spark session") from e
        raise


def publish(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Batch-publish events (key = tenant_id, value = JSON)."""
    w = publish_records(df).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers) \
        .option("topic", topic).options(**PRODUCER_OPTIONS)
    _guard(w.save)


def bus_documents(spark: SparkSession, bootstrap_servers: str, topic: str,
                  starting_offsets: str = "earliest") -> DataFrame:
    """Streaming (doc, source) frame from the topic, in the shape the landing
    file stream produces, so the same foreachBatch loader applies."""
    def load():
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
                .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    raw = _guard(load)
    return raw.select(F.col("value").cast("string").alias("doc"),
                      F.concat_ws(":", F.col("topic"), F.col("partition").cast("string"),
                                  F.col("offset").cast("string")).alias("source"))
