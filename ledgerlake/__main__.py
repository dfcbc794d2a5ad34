"""The jobs from the command line, for `spark-submit` or `python -m ledgerlake`.

Connections are parameters; passwords are read from environment variables named on the command
line. The session and its settings come from the submission.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.dimensions import cached, customer_accounts
from ledgerlake.operators.insights import HOURLY_LATENESS
from ledgerlake.plans import transfer_jobs
from ledgerlake.plans.insight_job import run_insights
from ledgerlake.sinks import changelog, lake, snapshots
from ledgerlake.sinks.files import overwrite_parquet, write_sized
from ledgerlake.sinks.jdbc import overwrite_table
from ledgerlake.sources import files, kafka
from ledgerlake.sources.jdbc import Connection
from ledgerlake.streaming import jobs

Arguments = argparse.Namespace


def _add_database(parser: argparse.ArgumentParser, required: bool = True) -> None:
    parser.add_argument("--url", required=required, help="JDBC address of the database")
    parser.add_argument("--driver", required=required, help="class of the JDBC driver")
    parser.add_argument("--user")
    parser.add_argument("--password-variable", help="environment variable with the password")


def _add_topic(parser: argparse.ArgumentParser, required: bool = True) -> None:
    parser.add_argument("--servers", required=required)
    parser.add_argument("--topic", required=required)
    parser.add_argument("--login-mechanism")
    parser.add_argument("--login-protocol")
    parser.add_argument("--login-module")
    parser.add_argument("--login-user")
    parser.add_argument("--login-password-variable")


def _add_stream(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--every", help="time between micro-batches, such as '1 minute'")
    parser.add_argument("--once", action="store_true", help="take what has arrived and end")


def _add_messages(parser: argparse.ArgumentParser) -> None:
    _add_topic(parser, required=False)
    parser.add_argument("--messages", help="Parquet files with a binary value, not a topic")
    parser.add_argument("--starting-offsets", default=kafka.STARTING_OFFSETS)
    parser.add_argument("--per-batch", type=int, help="records, or files, of a micro-batch")


def _secret(variable: str | None) -> str | None:
    return None if variable is None else os.environ[variable]


def _connection(given: Arguments) -> Connection:
    return Connection(given.url, given.driver, given.user, _secret(given.password_variable))


def _login(given: Arguments) -> dict[str, str] | None:
    if given.login_mechanism is None:
        return None
    return kafka.login_options(
        given.login_mechanism,
        given.login_protocol,
        given.login_module,
        given.login_user,
        _secret(given.login_password_variable),
    )


def _trigger(given: Arguments) -> dict | None:
    if given.once:
        return jobs.AVAILABLE_NOW
    return None if given.every is None else {"processingTime": given.every}


def _messages(spark: SparkSession, given: Arguments) -> DataFrame:
    if given.messages is not None:
        return files.message_stream(spark, given.messages, given.per_batch)
    options = kafka.stream_options(
        given.servers, given.topic, given.starting_offsets, given.per_batch, _login(given)
    )
    return kafka.message_stream(spark, options)


def snapshot(spark: SparkSession, given: Arguments) -> None:
    transfer_jobs.snapshot_dimensions(spark, _connection(given), given.out, given.schema)


def publish(spark: SparkSession, given: Arguments) -> None:
    transfer_jobs.publish_transactions(
        spark, _connection(given), given.servers, given.topic, _login(given), given.table
    )


def insights(spark: SparkSession, given: Arguments) -> None:
    if given.out is not None:

        def write(report: DataFrame, name: str) -> None:
            overwrite_parquet(report, f"{given.out}/{name}")
    else:
        # Pivots may have new columns: their tables are created anew.
        write = partial(_write_table, connection=_connection(given))
    run_insights(
        files.read_parquet(spark, given.transactions),
        files.read_parquet(spark, given.accounts),
        files.read_parquet(spark, given.customers),
        write,
    )


def _write_table(report: DataFrame, name: str, connection: Connection) -> None:
    overwrite_table(report, connection, name, keep_definition=False)


def ingest(spark: SparkSession, given: Arguments) -> None:
    jobs.ingest(
        _messages(spark, given), given.lake, given.checkpoint, _trigger(given), given.by_day
    ).awaitTermination()


def fraud(spark: SparkSession, given: Arguments) -> None:
    jobs.watch_fraud(
        _messages(spark, given),
        changelog.batch_writer(given.log),
        given.checkpoint,
        _trigger(given),
        jobs.KEEP_ALL if given.keep_all_days else given.lateness,
        None if given.alerts is None else changelog.batch_writer(given.alerts),
    ).awaitTermination()


def compact_log(spark: SparkSession, given: Arguments) -> None:
    changelog.compact(spark, given.log, given.keys)
    if given.prune:
        changelog.prune(spark, given.log)


def compact_lake(spark: SparkSession, given: Arguments) -> None:
    rows = files.read_parquet(spark, given.lake)
    write_sized(rows, given.out, given.file_megabytes << 20, "transaction_date" if given.by_day else None)


def gather_lake(spark: SparkSession, given: Arguments) -> None:
    by_day = files.DAY if given.by_day else None
    lake.compact(spark, given.lake, given.place, given.file_megabytes << 20, by_day)


def set_aside(spark: SparkSession, given: Arguments) -> None:
    jobs.set_aside(
        _messages(spark, given), given.out, given.checkpoint, _trigger(given)
    ).awaitTermination()


def add_dimension(spark: SparkSession, given: Arguments) -> None:
    accounts = files.read_parquet(spark, given.accounts)
    customers = files.read_parquet(spark, given.customers)
    snapshots.add(customer_accounts(accounts, customers), given.dimension)
    snapshots.prune(spark, given.dimension, given.keep)


def enrich(spark: SparkSession, given: Arguments) -> None:
    jobs.enrich(
        files.json_stream(spark, given.json, max_files_per_trigger=given.per_batch),
        given.dimension,
        changelog.batch_writer(given.log),
        given.checkpoint,
        _trigger(given),
    ).awaitTermination()


def hourly(spark: SparkSession, given: Arguments) -> None:
    accounts = files.read_parquet(spark, given.accounts)
    customers = files.read_parquet(spark, given.customers)
    with cached(customer_accounts(accounts, customers).select("account_id")) as account_ids:
        jobs.watch_hours(
            files.json_stream(spark, given.json, max_files_per_trigger=given.per_batch),
            account_ids,
            changelog.batch_writer(given.log),
            given.checkpoint,
            _trigger(given),
            given.lateness,
        ).awaitTermination()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerlake")
    commands = parser.add_subparsers(required=True)

    def command(run, text: str) -> argparse.ArgumentParser:
        added = commands.add_parser(run.__name__.replace("_", "-"), help=text)
        added.set_defaults(run=run)
        return added

    job = command(snapshot, "copy customers and accounts from the database")
    _add_database(job)
    job.add_argument("--schema", default="public")
    job.add_argument("--out", required=True)

    job = command(publish, "send the transactions of the database to a topic")
    _add_database(job)
    _add_topic(job)
    job.add_argument("--table", default="public.transactions")

    job = command(insights, "compute the reports, into a folder or the database")
    for name in ("transactions", "accounts", "customers"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--out", help="folder of the result tables, not a database")
    _add_database(job, required=False)

    job = command(ingest, "store a message stream")
    _add_messages(job)
    job.add_argument("--lake", required=True)
    job.add_argument("--by-day", action="store_true")
    _add_stream(job)

    job = command(fraud, "keep daily activity per sender from a message stream")
    _add_messages(job)
    job.add_argument("--log", required=True)
    job.add_argument("--alerts", help="log of the suspicious days among them")
    days = job.add_mutually_exclusive_group(required=True)
    days.add_argument("--lateness", help="close days after this time, such as '2 days'")
    days.add_argument("--keep-all-days", action="store_true", help="never close a day")
    _add_stream(job)

    job = command(compact_log, "gather the log of a stream's results, beside the stream")
    job.add_argument("--log", required=True)
    job.add_argument("--keys", nargs="+", required=True, help="key columns")
    job.add_argument("--prune", action="store_true", help="remove what is not read any more")

    job = command(compact_lake, "write the stored messages again in files of one size")
    job.add_argument("--lake", required=True)
    job.add_argument("--out", required=True, help="folder of the new table")
    job.add_argument("--file-megabytes", type=int, default=128)
    job.add_argument("--by-day", action="store_true", help="the lake has a folder per day")

    job = command(gather_lake, "gather what a stream has stored since the last time, beside the stream")
    job.add_argument("--lake", required=True)
    job.add_argument("--place", required=True, help="folder of the gathered files and what they cover")
    job.add_argument("--file-megabytes", type=int, default=128)
    job.add_argument("--by-day", action="store_true", help="the lake has a folder per day")

    job = command(set_aside, "store the messages that ingest rejects, with the reason")
    _add_messages(job)
    job.add_argument("--out", required=True)
    _add_stream(job)

    job = command(add_dimension, "add a snapshot of the account dimension for running streams")
    for name in ("accounts", "customers", "dimension"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--keep", type=int, default=2, help="snapshots that stay")

    job = command(enrich, "join JSON files with the newest snapshot of the account dimension")
    for name in ("json", "dimension", "log"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--per-batch", type=int, help="files of a micro-batch")
    _add_stream(job)

    job = command(hourly, "keep hourly activity from JSON files")
    for name in ("json", "accounts", "customers", "log"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--per-batch", type=int, help="files of a micro-batch")
    job.add_argument("--lateness", default=HOURLY_LATENESS)
    _add_stream(job)
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    parser = _parser()
    given = parser.parse_args(arguments)
    if given.run is insights and given.out is None and None in (given.url, given.driver):
        parser.error("insights needs --out, or --url and --driver")
    if given.run in (ingest, fraud, set_aside) and given.messages is None:
        if None in (given.servers, given.topic):
            parser.error("a message stream needs --messages, or --servers and --topic")
    given.run(SparkSession.builder.getOrCreate(), given)


if __name__ == "__main__":
    main()
