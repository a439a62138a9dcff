"""Sales messages: encode + route, decode, and a replay-safe sink.

* ``sales_messages`` – JSON value ``{"product": .., "date": "yyyy-MM-dd"}`` plus the
  target partition: 1 when the sale's instant lies after the middle of the period, else 0.
  Works on batch and streaming frames; the Kafka sink takes ``value``/``partition`` as is.
* ``decode_sales`` – value bytes/text -> typed (product, date); undecodable rows go to a
  reject frame instead of stopping the stream.
* ``run_message_stream`` – the producer side as a stream: sales rows in, routed messages out, through the file
  (or Kafka) sink and its commit log, so a restart publishes nothing twice.
* ``run_sales_sink`` – readStream -> decode -> ``foreachBatch``: each micro-batch
  overwrites its own ``batch_id`` partitions (decoded rows and rejects, in one pass), so a
  batch replayed after a failure replaces its earlier output – effectively exactly once,
  with progress in the checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sluice.functions.records import decode_json, encode_json

SALES_SCHEMA = StructType([StructField("product", StringType()),
                           StructField("date", StringType())])
MESSAGE_SCHEMA = StructType([StructField("value", StringType()),
                             StructField("partition", IntegerType())])

# The sink id is batch_id * 2^64 + the per-batch row id (monotonically_increasing_id uses
# all 64 bits: partition index << 33 | row), computed exactly as decimal(38,0): unique for
# any number of partitions per batch and any number of batches.
_ID_BASE = 2 ** 64


def _micros(c) -> F.Column:
    return F.unix_micros(c.cast("timestamp"))


def period_bounds(events: DataFrame, ts: str = "ts") -> tuple[F.Column, F.Column]:
    """First instant of the first day and last second of the last day, as scalar subqueries: one aggregate
    of the events inside the query that uses them, nothing read while it is built.  Null for no
    events.  For batch frames; a stream gets its period as literals."""
    first = events.select(F.min(F.to_date(ts)).cast("timestamp_ntz").alias("t0")).scalar()
    last = events.select((F.max(F.to_date(ts)).cast("timestamp_ntz") + F.expr("INTERVAL 86399 SECONDS"))
                         .alias("t1")).scalar()
    return first, last


def _instant(bound: dt.datetime | F.Column) -> F.Column:
    if isinstance(bound, dt.datetime):
        return F.lit(bound.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return bound


def choose_partition(ts: F.Column, start: dt.datetime | F.Column, end: dt.datetime | F.Column) -> F.Column:
    """1 when ``ts`` is strictly after start + (end - start) / 2, else 0 (exact, in µs)."""
    lo, hi = _micros(_instant(start)), _micros(_instant(end))
    return F.when(_micros(ts) * 2 > lo + hi, F.lit(1)).otherwise(F.lit(0))


def sales_messages(sales: DataFrame, start: dt.datetime | F.Column, end: dt.datetime | F.Column,
                   product: str = "product", ts: str = "ts") -> DataFrame:
    """(value, partition) messages for sales rows with a product and an instant."""
    value = encode_json(F.col(product).alias("product"),
                        F.date_format(ts, "yyyy-MM-dd").alias("date"))
    return sales.select(value.alias("value"),
                        choose_partition(F.col(ts), start, end).alias("partition"))


def _decoded(messages: DataFrame) -> DataFrame:
    """Messages plus ``__product``, ``__date`` and ``__ok`` – one JSON parse per row."""
    parsed = messages.withColumn("__m", decode_json("value", SALES_SCHEMA))
    day = F.try_to_date(F.col("__m.date"), "yyyy-MM-dd")
    ok = F.coalesce(F.col("__m.product").isNotNull() & day.isNotNull(), F.lit(False))
    return parsed.select("*", F.col("__m.product").alias("__product"), day.alias("__date"),
                         ok.alias("__ok")).drop("__m")


def decode_sales(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good = product, date, partition; bad = the raw value of rows whose JSON,
    product or date does not parse."""
    rows = _decoded(messages)
    good = rows.filter("__ok").select(F.col("__product").alias("product"),
                                      F.col("__date").alias("date"), F.col("partition"))
    bad = rows.filter(~F.col("__ok")).select(F.col("value").cast("string").alias("value"),
                                             F.col("partition"))
    return good, bad


def sales_source(spark: SparkSession, fmt: str = "json", path: str | None = None,
                 max_files_per_trigger: int | None = None, topic: str | None = None,
                 **options) -> DataFrame:
    """Streaming message source with ``value``/``partition`` columns.

    ``fmt='kafka'`` subscribes to ``topic`` from the earliest offset unless told otherwise
    (``kafka.bootstrap.servers`` and other options pass through); progress lives in the
    query's checkpoint, not in consumer-group commits.  The connector must be on the
    classpath.  Any file format reads message files from ``path``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
        if topic:
            options["subscribe"] = topic
    for key, value in options.items():
        reader = reader.option(key, value)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"),
                                    F.col("partition").cast("int").alias("partition"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(MESSAGE_SCHEMA).load(path)


class RejectLimit(ValueError):
    """A micro-batch with more rejects than allowed."""


def write_batch(root: str, max_reject_rate: float | None = None,
                after_write: Callable[[int, dict], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The sink's ``foreachBatch`` function: a replayed batch replaces what it wrote before.

    Rows and rejects are counted in the pass that writes them.  ``after_write`` gets the batch id and the counts
    (``rows``, ``rejects``) when the batch is written and its progress is not yet committed: what it raises fails the query, and
    a restart replays the batch.  More rejects than ``max_reject_rate`` of the rows raise ``RejectLimit``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = _decoded(batch)
        ok = F.col("__ok")
        counts = Observation(f"sales-batch-{batch_id}")
        # one pass over the micro-batch: good rows and rejects land in sibling partitions
        rows = decoded.select(
            (F.lit(batch_id).cast("decimal(38,0)") * F.lit(str(_ID_BASE)).cast("decimal(38,0)")
             + F.monotonically_increasing_id().cast("decimal(38,0)")).cast("decimal(38,0)")
            .alias("id"),
            F.when(ok, F.col("__product")).alias("product"),
            F.when(ok, F.col("__date")).alias("date"),
            F.current_date().alias("created_at"),
            F.col("partition"),
            F.when(~ok, F.col("value").cast("string")).alias("value"),
            F.when(ok, F.lit("good")).otherwise(F.lit("rejected")).alias("kind"),
            F.lit(batch_id).cast("long").alias("batch_id")) \
            .observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("kind") == "rejected").alias("rejects"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("kind", "batch_id").parquet(root))
        found = counts.get
        if max_reject_rate is not None and found["rejects"] > max_reject_rate * found["rows"]:
            raise RejectLimit(f"batch {batch_id}: {found['rejects']} rejects in {found['rows']} rows")
        if after_write:
            after_write(batch_id, found)
    return write


class RateListener(StreamingQueryListener):
    """Reports the observed rows and rejects of every finished micro-batch of the queries it sees: ``batches`` holds
    (query id, batch id, rows, rejects).  Add it with ``spark.streams.addListener``."""

    NAME = "sales_rates"

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, int, int]] = []

    @staticmethod
    def observed(messages: DataFrame) -> DataFrame:
        """A message stream that carries the listener's metrics."""
        decoded = _decoded(messages)
        return decoded.observe(RateListener.NAME, F.count(F.lit(1)).alias("rows"),
                               F.count_if(~F.col("__ok")).alias("rejects")).select(*messages.columns)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        """Nothing is counted before the first batch."""

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(self.NAME)
        if found is not None:
            self.batches.append((str(event.progress.id), event.progress.batchId, found["rows"], found["rejects"]))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """An idle trigger writes nothing."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        """What was reported stays."""


SINK_SCHEMA = ("id decimal(38,0), product string, date date, created_at date, partition int, value string, "
               "kind string, batch_id bigint")


def _sink_rows(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.schema(SINK_SCHEMA).parquet(root).where(F.col("kind") == kind)


def read_sink(spark: SparkSession, root: str) -> DataFrame:
    """The sink table: id, product, date, created_at, partition, batch_id."""
    return _sink_rows(spark, root, "good").select("id", "product", "date", "created_at", "partition", "batch_id")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Raw values that did not decode, with their partition and batch (none on a clean stream)."""
    return _sink_rows(spark, root, "rejected").select("value", "partition", "batch_id")


def _started(writer, available_now: bool, processing_time: str | None) -> StreamingQuery:
    """Start a writer; with ``available_now`` wait until the source is drained (a failure raises)."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def run_sales_sink(stream: DataFrame, sink_root: str, checkpoint: str,
                   available_now: bool = True, processing_time: str | None = None,
                   max_reject_rate: float | None = None,
                   after_write: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """Start the sink query; with ``available_now`` it drains the source and returns.  After a failure, start it again
    with the same checkpoint: the batch that was not committed is replayed and replaces its own output.
    Read the results with ``read_sink`` / ``read_rejects``; the last two arguments are those of ``write_batch``."""
    writer = (stream.writeStream.foreachBatch(write_batch(sink_root, max_reject_rate, after_write))
              .option("checkpointLocation", checkpoint))
    return _started(writer, available_now, processing_time)


def sales_rows_source(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming sales rows from a folder of files that grows."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_message_stream(sales: DataFrame, start: dt.datetime, end: dt.datetime, checkpoint: str, fmt: str = "kafka",
                       path: str | None = None, topic: str | None = None, product: str = "product", ts: str = "ts",
                       available_now: bool = True, processing_time: str | None = None, **options) -> StreamingQuery:
    """Stream of sales rows -> routed messages (the period is given as literals: a stream has no last row).

    ``fmt='kafka'`` sends ``value`` to the partition the ``partition`` column names; a file format writes one folder per
    partition under ``path`` with the sink's commit log, so files of an uncommitted batch are never read."""
    messages = sales_messages(sales, start, end, product, ts)
    writer = messages.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).options(**options)
    if fmt == "kafka":
        writer = writer.option("topic", topic) if topic else writer
    else:
        writer = writer.partitionBy("partition").option("path", path)
    return _started(writer, available_now, processing_time)


def publish_messages(messages: DataFrame, fmt: str = "kafka", path: str | None = None,
                     topic: str | None = None, **options) -> None:
    """Batch-publish (value, partition) messages.

    ``fmt='kafka'`` hands both columns to the Kafka sink, which honours the ``partition``
    column (options such as ``kafka.bootstrap.servers``, ``kafka.compression.type='gzip'``,
    ``kafka.enable.idempotence='true'``; connector on the classpath).  Any other format
    writes message files, one folder per target partition.
    """
    if fmt == "kafka":
        writer = messages.select("value", "partition").write.format("kafka")
        if topic:
            writer = writer.option("topic", topic)
        for key, value in options.items():
            writer = writer.option(key, value)
        writer.save()
        return
    (messages.write.mode("append").partitionBy("partition").format(fmt)
     .options(**options).save(path))
