"""The streaming jobs. Each takes its input stream and places as parameters.

A checkpoint directory is never cleared: a restarted job goes on where it stopped. The
`trigger` holds the arguments of `DataStreamWriter.trigger`; None runs micro-batches back to
back, `AVAILABLE_NOW` takes what has arrived and ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerlake.operators.enrichment import enrich_transactions, repeat_by_account
from ledgerlake.operators.fraud import daily_activity, flag_activity, fraud_alerts
from ledgerlake.operators.insights import HOURLY_LATENESS, hourly_activity
from ledgerlake.operators.lookups import BROADCAST_LIMIT, SALT_BUCKETS, measured_bytes
from ledgerlake.operators.messages import (
    counted,
    fraud_rows,
    lake_rows,
    parse_messages,
    rejected_messages,
)
from ledgerlake.sinks import snapshots
from ledgerlake.sources.files import DAY

AVAILABLE_NOW = {"availableNow": True}
EVERY_MINUTE = {"processingTime": "1 minute"}

# Session settings for state larger than the executors' memory. They hold from the first run of
# a checkpoint on, as does spark.sql.shuffle.partitions, which fixes the number of state stores.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: The same for a job that is started again and again. A start takes the last snapshot of the state; from
#: a log of changes it would apply again all that came since the last one, which a short run does not
#: take, so that starts would grow with all that ever came. Each micro-batch ends with a snapshot.
RESTARTED_STATE = LARGE_STATE | {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
}

#: To be added where no one reads off the progress how many rows the state has (`numRowsTotal`): counting
#: them takes a lookup for each row that is put or removed.
UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

#: `lateness` of a job that keeps every day in its state for ever, so that any late row counts.
KEEP_ALL = None

BatchFunction = Callable[[DataFrame, int], None]

#: The name under which a stream's progress tells how many messages were read, kept and rejected.
MESSAGES = "messages"
#: The column that tells which snapshot of the dimension a transaction was joined with.
SNAPSHOT = "dimension_snapshot"


@contextmanager
def set_for(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold for a while."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def drain(query: StreamingQuery) -> None:
    """Let a running stream take all that has arrived, then stop it between two micro-batches."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def append_to_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Append rows to a Parquet table, each exactly once."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    return _start(writer, checkpoint, trigger)


def ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    by_day: bool = False,
) -> StreamingQuery:
    """Store the complete transactions of a message stream.

    How many messages were read, kept and rejected, and why, is observed under `MESSAGES` in the
    progress of each micro-batch. `by_day` adds `transaction_date` and a directory per day, so that
    reports on some days read only those.
    """
    rows = lake_rows(counted(parse_messages(messages), MESSAGES))
    if by_day:
        rows = rows.withColumn(DAY, F.to_date("timestamp"))
    return append_to_table(rows, path, checkpoint, trigger, DAY if by_day else None)


def set_aside(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store the messages that `ingest` rejects, as they came, with the reason of each."""
    return append_to_table(rejected_messages(messages), path, checkpoint, trigger)


def enrich(
    transactions: DataFrame,
    dimension: str,
    on_batch: BatchFunction,
    checkpoint: str,
    trigger: dict | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    salt_buckets: int = SALT_BUCKETS,
) -> StreamingQuery:
    """Hand every transaction to `on_batch` with its sender's account and customer, where known, and
    the number of the dimension's snapshot that told them.

    The static side is the newest finished one of the `snapshots` at `dimension` when a micro-batch
    begins, so a snapshot that is added while the stream goes on counts from the next micro-batch on.
    Each snapshot is measured once, and broadcast only if it is small; else the micro-batch is joined
    by shuffle. A micro-batch that is run again after a failure takes the snapshot that is newest then.
    """
    spark = transactions.sparkSession
    measured: dict[int, int] = {}

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        version = snapshots.newest(spark, dimension)
        rows = snapshots.read(batch.sparkSession, dimension, version)
        if version not in measured:
            measured.clear()
            measured[version] = measured_bytes(rows)
        found = enrich_transactions(batch, rows, broadcast_limit, salt_buckets, measured[version])
        on_batch(found.withColumn(SNAPSHOT, F.lit(version).cast("long")), batch_id)

    return _start(transactions.writeStream.foreachBatch(hand_on), checkpoint, trigger)


def watch_fraud(
    messages: DataFrame,
    on_batch: BatchFunction,
    checkpoint: str,
    trigger: dict | None,
    lateness: str | None,
    on_alerts: BatchFunction | None = None,
    state: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Hand every change of a sender's daily activity, flagged, to `on_batch`, and those of them that
    are suspicious to `on_alerts`.

    Days close after `lateness`; with `KEEP_ALL` none does, and the state grows with the days. It
    lies on the executors' disks, with a copy of its changes in the checkpoint, or of itself where the
    job takes what has arrived and ends, unless `state` says otherwise.
    """
    if state is None:
        state = RESTARTED_STATE if trigger == AVAILABLE_NOW else LARGE_STATE
    flagged = flag_activity(daily_activity(fraud_rows(parse_messages(messages)), lateness))

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        if on_alerts is None:
            on_batch(batch, batch_id)
            return
        batch.persist()  # else each reader would run the micro-batch's aggregation again
        try:
            on_batch(batch, batch_id)
            on_alerts(fraud_alerts(batch), batch_id)
        finally:
            batch.unpersist()

    writer = flagged.writeStream.outputMode("update").foreachBatch(hand_on)
    with set_for(messages.sparkSession, state):  # a stream takes them along when it starts
        return _start(writer, checkpoint, trigger)


def watch_hours(
    transactions: DataFrame,
    cust_accounts: DataFrame,
    on_batch: BatchFunction,
    checkpoint: str,
    trigger: dict | None = None,
    lateness: str = HOURLY_LATENESS,
    salt_buckets: int = SALT_BUCKETS,
) -> StreamingQuery:
    """Hand every change of the hourly activity to `on_batch`.

    The report reads no attribute of the account, so of the join with the dimension only one thing
    is left: a transaction counts as often as its sender's id occurs there. The ids that occur more
    than once, usually none, are looked up at the start and joined; how large the dimension is
    besides does not matter.
    """
    hourly = hourly_activity(repeat_by_account(transactions, cust_accounts, salt_buckets), lateness)
    writer = hourly.writeStream.outputMode("update").foreachBatch(on_batch)
    return _start(writer, checkpoint, trigger)
