"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import fraud, insights
from ledgerlake.operators.dimensions import (
    account_ids_repeat,
    cached,
    customer_accounts,
    with_income_category,
)
from ledgerlake.operators.enrichment import counted_transactions, enrich_transactions
from ledgerlake.operators.messages import (
    LAKE_REQUIRED,
    UNREADABLE,
    as_published,
    counted,
    fraud_rows,
    lake_rows,
    parse_messages,
    rejected_messages,
    to_messages,
)
from ledgerlake.plans import insight_job, tables
from ledgerlake.plans.replay import arrive, time_ranges
from ledgerlake.plans.workspace import new_place
from ledgerlake.schemas import ACCOUNT_COLUMNS, CUSTOMER_COLUMNS, MESSAGE
from ledgerlake.sinks import changelog, lake, snapshots
from ledgerlake.sinks.files import overwrite_parquet, snapshot
from ledgerlake.sources import files
from ledgerlake.streaming import jobs, progress, state

Query = Callable[[SparkSession, str], DataFrame]

# The given events arrive at a stream in this many parts.
ARRIVALS = 3

# Events of this type arrive one part late in `hourly_late_data`.
LATE_TYPE = "error"

# Days are closed so long after their end in `fraud_daily_bounded`.
DAYS_LATENESS = "2 days"

# The days of the report over a lake with a directory per day.
FIRST_DAY, LAST_DAY = date(2024, 1, 8), date(2024, 1, 14)

# What is wrong with some messages: every so many, by the remainder of the transaction's number.
FLAWS = {"not_json": (17, 5), "no_id": (29, 3), "no_time": (23, 11), "no_type": (19, 7)}

HOURLY_KEYS = ("hour_start", "hour_end", "transaction_type")
SENDER_AMOUNT = ("sender_account_id", "amount")


def comparable(df: DataFrame) -> DataFrame:
    """Result types that every SQL engine prints alike: no decimals, dates or zoned times."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def _dimension(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    accounts, customers = tables.accounts(spark, sf_dir), tables.customers(spark, sf_dir)
    return customer_accounts(accounts, customers, **options)


def _report_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Joined once per report with per-sender totals: not worth a measurement beforehand.
    return _dimension(spark, sf_dir, broadcast_limit=None)


# Sources and snapshots


def scan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.customers(spark, sf_dir)


def scan_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.accounts(spark, sf_dir)


def scan_transactions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "transactions-csv")
    rows = tables.transactions(spark, sf_dir)
    rows.write.csv(place, header=True, timestampFormat=files.TIMESTAMP_TEXT)
    return files.read_transactions_csv(spark, place)


def snapshot_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "customers")
    snapshot(tables.customers(spark, sf_dir), place, CUSTOMER_COLUMNS)
    return files.read_parquet(spark, place)


def snapshot_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "accounts")
    snapshot(tables.accounts(spark, sf_dir).select(*ACCOUNT_COLUMNS), place)
    return files.load(spark, place)


# Dimension and enrichment


def cust_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir)


def income_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_income_category(_dimension(spark, sf_dir))


def enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = with_income_category(_dimension(spark, sf_dir))
    return enrich_transactions(tables.transactions(spark, sf_dir), dimension)


# Reports


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.transactions(spark, sf_dir, SENDER_AMOUNT)
    ranked = insights.top_customers(rows, _report_dimension(spark, sf_dir))
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def _stored(table: str) -> Query:
    """A report as the batch job, which looks up the columns of its pivots, leaves it in its table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        place = new_place(spark, "insights")
        insight_job.run_insights(
            partial(tables.whole_transactions, spark, sf_dir),
            tables.accounts(spark, sf_dir),
            tables.customers(spark, sf_dir),
            lambda report, name: overwrite_parquet(report, f"{place}/{name}"),
        )
        found = files.read_parquet(spark, f"{place}/{table}")
        return found.withColumns({c: F.col(c).cast("bigint") for c in found.columns if c == "rank"})

    return run


def monthly_type(
    spark: SparkSession, sf_dir: str, types: Sequence[str] | None = None
) -> DataFrame:
    rows = _counted(spark, sf_dir, "timestamp", "transaction_type", "amount")
    return insights.monthly_type(rows, types)


def segmentation(
    spark: SparkSession, sf_dir: str, occupations: Sequence[str] | None = None
) -> DataFrame:
    rows = tables.transactions(spark, sf_dir, SENDER_AMOUNT)
    return insights.segmentation(rows, _report_dimension(spark, sf_dir), occupations)


def geo_product(
    spark: SparkSession, sf_dir: str, products: Sequence[str] | None = None
) -> DataFrame:
    rows = _counted(spark, sf_dir, "location", "product_name", "amount")
    return insights.geo_product(rows, products)


def _counted(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    # The sender, which only the join needs, is looked up only if the join is made.
    dimension = _report_dimension(spark, sf_dir)
    repeat = account_ids_repeat(dimension)
    columns = (*wanted, "sender_account_id") if repeat else wanted
    return counted_transactions(tables.transactions(spark, sf_dir, columns), dimension, repeat)


def hourly_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.hourly_activity(tables.event_transactions(tables.events(spark, sf_dir)))


# Fraud


def fraud_daily_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.event_transactions(tables.events(spark, sf_dir))
    return fraud.flag_activity(fraud.daily_activity(fraud_rows(as_published(rows))))


def fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.fraud_alerts(fraud_daily_batch(spark, sf_dir))


# Messages


def publish_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(tables.event_transactions(tables.events(spark, sf_dir)))
    return messages.select(F.col("value").cast("string").alias("value"))


def parse_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(to_messages(tables.event_transactions(tables.events(spark, sf_dir))))


# Streams


def _event_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = tables.events(spark, sf_dir)
    return [
        tables.event_transactions(rows.where(part)) for part in time_ranges(rows, "ts", ARRIVALS)
    ]


def _late_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = tables.events(spark, sf_dir)
    ranges = time_ranges(rows, "ts", ARRIVALS)
    late = F.col("event_type").eqNullSafe(LATE_TYPE)
    nothing = F.lit(False)
    return [
        tables.event_transactions(rows.where((on_time & ~late) | (delayed & late)))
        for on_time, delayed in zip([*ranges, nothing], [nothing, *ranges], strict=True)
    ]


def ingest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "ingest")
    landing, lake = f"{place}/messages", f"{place}/transactions"
    arrive(
        _event_parts(spark, sf_dir),
        lambda part: to_messages(part).write.mode("append").parquet(landing),
        lambda: jobs.ingest(
            files.message_stream(spark, landing), lake, f"{place}/checkpoint", jobs.AVAILABLE_NOW
        ),
    )
    return files.read_parquet(spark, lake)


def _watched(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    place = new_place(spark, "fraud")
    landing = f"{place}/messages"
    arrive(
        _event_parts(spark, sf_dir),
        lambda part: to_messages(part).write.mode("append").parquet(landing),
        lambda: jobs.watch_fraud(
            files.message_stream(spark, landing),
            changelog.batch_writer(f"{place}/activity"),
            f"{place}/checkpoint",
            jobs.AVAILABLE_NOW,
            jobs.KEEP_ALL,
            changelog.batch_writer(f"{place}/alerts"),
            jobs.RESTARTED_STATE | jobs.UNCOUNTED,
        ),
    )
    return changelog.latest(spark, f"{place}/{table}", (*fraud.DAILY_KEYS, fraud.KEY))


def fraud_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watched(spark, sf_dir, "activity")


def fraud_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watched(spark, sf_dir, "alerts")


def _hourly(spark: SparkSession, sf_dir: str, parts: list[DataFrame], name: str) -> DataFrame:
    place = new_place(spark, name)
    landing, log = f"{place}/json", f"{place}/hours"
    # Kept in memory: every micro-batch joins it again.
    with cached(_dimension(spark, sf_dir).select("account_id")) as account_ids:
        arrive(
            parts,
            lambda part: part.write.mode("append").json(
                landing, timestampFormat=files.TIMESTAMP_TEXT
            ),
            lambda: jobs.watch_hours(
                files.json_stream(spark, landing, max_files_per_trigger=None),
                account_ids,
                changelog.batch_writer(log),
                f"{place}/checkpoint",
                jobs.AVAILABLE_NOW,
            ),
        )
    return changelog.latest(spark, log, HOURLY_KEYS)


def hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir, _event_parts(spark, sf_dir), "hourly")


def hourly_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir, _late_parts(spark, sf_dir), "hourly-late")


def stream_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "json")
    rows = tables.event_transactions(tables.events(spark, sf_dir))
    rows.write.json(f"{place}/json", timestampFormat=files.TIMESTAMP_TEXT)
    stream = files.json_stream(spark, f"{place}/json", max_files_per_trigger=1000)
    jobs.append_to_table(
        lake_rows(stream), f"{place}/transactions", f"{place}/checkpoint", jobs.AVAILABLE_NOW
    ).awaitTermination()
    return files.read_parquet(spark, f"{place}/transactions")


def fraud_daily_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _watch_bounded(spark, sf_dir)
    return changelog.latest(spark, f"{place}/activity", (*fraud.DAILY_KEYS, fraud.KEY))


def fraud_open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left in the state when the stream has ended, read from its checkpoint."""
    return state.open_days(spark, f"{_watch_bounded(spark, sf_dir)}/checkpoint")


def _watch_bounded(spark: SparkSession, sf_dir: str) -> str:
    place = new_place(spark, "fraud-bounded")
    landing = f"{place}/messages"
    arrive(
        _late_parts(spark, sf_dir),
        lambda part: to_messages(part).write.mode("append").parquet(landing),
        lambda: jobs.watch_fraud(
            files.message_stream(spark, landing),
            changelog.batch_writer(f"{place}/activity"),
            f"{place}/checkpoint",
            jobs.AVAILABLE_NOW,
            DAYS_LATENESS,
            state=jobs.RESTARTED_STATE | jobs.UNCOUNTED,
        ),
    )
    return place


def _dimension_snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The dimension before some accounts were opened, and after some customers moved."""
    now = _dimension(spark, sf_dir)
    first = now.where(F.col("account_id") % 5 != 1)
    moved = F.when(F.col("customer_id") % 3 == 0, F.concat(F.lit("moved "), "customer_segment"))
    return [first, now.withColumn("customer_segment", F.coalesce(moved, "customer_segment"))]


def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot of the dimension arrives with the second part of the transactions."""
    place = new_place(spark, "enriched")
    landing, dimension, log = f"{place}/json", f"{place}/dimension", f"{place}/rows"
    waiting = iter(_dimension_snapshots(spark, sf_dir))

    def land(part: DataFrame) -> None:
        snapshot_rows = next(waiting, None)
        if snapshot_rows is not None:
            snapshots.add(snapshot_rows, dimension)
        part.write.mode("append").json(landing, timestampFormat=files.TIMESTAMP_TEXT)

    arrive(
        _event_parts(spark, sf_dir),
        land,
        lambda: jobs.enrich(
            files.json_stream(spark, landing),
            dimension,
            changelog.batch_writer(log),
            f"{place}/checkpoint",
            jobs.AVAILABLE_NOW,
        ),
    )
    return changelog.rows(spark, log)


# Rates, counts, days and files of the lake


def _flawed(messages: DataFrame, number: Column) -> DataFrame:
    """Messages of which some are no JSON and some lack a field that they must have."""
    text = F.col("value").cast("string")

    def every(name: str) -> Column:
        step, rest = FLAWS[name]
        return number % step == rest

    def changed(flaw: str, field: str, value: str) -> None:
        nonlocal text
        replaced = F.regexp_replace(text, f'"{field}":"[^"]*"', f'"{field}":{value}')
        text = F.when(every(flaw), replaced).otherwise(text)

    changed("no_id", "transaction_id", "null")
    changed("no_time", "timestamp", '"yesterday"')
    changed("no_type", "transaction_type", "null")
    text = F.when(every("not_json"), F.concat(F.lit("<"), text)).otherwise(text)
    return messages.select(text.cast("binary").alias("value"))


def _flawed_messages(transactions: DataFrame) -> DataFrame:
    number = F.get_json_object(F.col("value").cast("string"), "$.transaction_id").cast("bigint")
    return _flawed(to_messages(transactions), number)


def _counts(spark: SparkSession, counts: dict[str, int], **also: bool) -> DataFrame:
    """One row of counts."""
    names = ["read", "kept", "rejected", UNREADABLE, *[f"no {name}" for name in LAKE_REQUIRED]]
    row = {name.replace(" ", "_"): counts[name] for name in names} | also
    kinds = ", ".join(f"{c} {'boolean' if isinstance(v, bool) else 'long'}" for c, v in row.items())
    return spark.createDataFrame([tuple(row.values())], kinds)


def message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the complete rows are stored, in one pass."""
    place, seen = new_place(spark, "counted"), Observation()
    messages = _flawed_messages(tables.event_transactions(tables.events(spark, sf_dir)))
    lake_rows(counted(parse_messages(messages), seen)).write.parquet(place)
    return _counts(spark, seen.get)


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _flawed_messages(tables.event_transactions(tables.events(spark, sf_dir)))
    return _as_text(rejected_messages(messages))


def _as_text(messages: DataFrame) -> DataFrame:
    return messages.withColumn("value", F.col("value").cast("string"))


def _land_flawed(spark: SparkSession, sf_dir: str, landing: str) -> None:
    for part in _event_parts(spark, sf_dir):
        _flawed_messages(part).write.mode("append").parquet(landing)


def rejected_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "rejected")
    landing, found = f"{place}/messages", f"{place}/rejected"
    _land_flawed(spark, sf_dir, landing)
    stream = files.message_stream(spark, landing)
    jobs.set_aside(stream, found, f"{place}/checkpoint", jobs.AVAILABLE_NOW).awaitTermination()
    return _as_text(files.read_parquet(spark, found))


def _ingest_limited(spark: SparkSession, sf_dir: str) -> tuple[str, list[progress.Batch]]:
    """All messages are there; a micro-batch takes one of their files."""
    place = new_place(spark, "limited")
    landing, table = f"{place}/messages", f"{place}/transactions"
    _land_flawed(spark, sf_dir, landing)
    stream = files.message_stream(spark, landing, max_files_per_trigger=1)
    query = jobs.ingest(stream, table, f"{place}/checkpoint", jobs.AVAILABLE_NOW)
    query.awaitTermination()
    return table, progress.batches(query, jobs.MESSAGES)


def ingest_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, _ingest_limited(spark, sf_dir)[0])


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the progress of the rate-limited stream tells of its micro-batches."""
    _, batches = _ingest_limited(spark, sf_dir)
    several = len(batches) >= ARRIVALS and sum(b.rows for b in batches) > max(b.rows for b in batches)
    return _counts(spark, progress.totals(batches), several_batches=several)


def _ingest_by_day(spark: SparkSession, sf_dir: str) -> str:
    place = new_place(spark, "by-day")
    landing, table = f"{place}/messages", f"{place}/transactions"
    arrive(
        _event_parts(spark, sf_dir),
        lambda part: to_messages(part).write.mode("append").parquet(landing),
        lambda: jobs.ingest(
            files.message_stream(spark, landing),
            table,
            f"{place}/checkpoint",
            jobs.AVAILABLE_NOW,
            by_day=True,
        ),
    )
    return table


def hourly_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours of some days; the lake's other days are not read."""
    table = _ingest_by_day(spark, sf_dir)
    return insights.hourly_activity(files.read_days(spark, table, FIRST_DAY, LAST_DAY))


def suspicious_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.read_days(spark, _ingest_by_day(spark, sf_dir))
    days = rows.select("sender_account_id", "timestamp", "amount")
    daily = fraud.flag_activity(fraud.daily_activity(days.where("amount is not null")))
    return fraud.suspicious_transactions(rows, daily).select("transaction_id", *fraud.DAILY_KEYS, "amount")


def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted after each part but the last: gathered files and those that came after them."""
    place = new_place(spark, "compacted")
    landing, table, gathered = (f"{place}/{n}" for n in ("messages", "transactions", "compact"))

    def land(number_and_part: tuple[int, DataFrame]) -> None:
        number, part = number_and_part
        if number:
            lake.compact(spark, table, gathered)
        to_messages(part).write.mode("append").parquet(landing)

    arrive(
        enumerate(_event_parts(spark, sf_dir)),
        land,
        lambda: jobs.ingest(
            files.message_stream(spark, landing), table, f"{place}/checkpoint", jobs.AVAILABLE_NOW
        ),
    )
    return lake.read(spark, table, gathered)


def ingest_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that goes on, looking for messages every second while they arrive, until it is stopped."""
    place = new_place(spark, "running")
    landing, table = f"{place}/messages", f"{place}/transactions"
    spark.createDataFrame([], MESSAGE).write.parquet(landing)
    stream = files.message_stream(spark, landing)
    query = jobs.ingest(stream, table, f"{place}/checkpoint", {"processingTime": "1 second"})
    try:
        for part in _event_parts(spark, sf_dir):
            to_messages(part).write.mode("append").parquet(landing)
            query.processAllAvailable()
    finally:
        jobs.drain(query)
    return files.read_parquet(spark, table)


REGISTERED: dict[str, Query] = {
    "scan_customers": scan_customers,
    "scan_accounts": scan_accounts,
    "scan_transactions_csv": scan_transactions_csv,
    "snapshot_customers": snapshot_customers,
    "snapshot_accounts": snapshot_accounts,
    "cust_accounts": cust_accounts,
    "income_category": income_category,
    "enriched_transactions": enriched_transactions,
    "top_customers": top_customers,
    "top_customers_stored": _stored(insight_job.TOP_CUSTOMERS_TABLE),
    "monthly_type": monthly_type,
    "monthly_type_given": partial(monthly_type, types=tables.BATCH_TYPES),
    "monthly_type_stored": _stored(insight_job.MONTHLY_TYPE_TABLE),
    "segmentation": segmentation,
    "segmentation_given": partial(segmentation, occupations=tables.OCCUPATIONS),
    "segmentation_stored": _stored(insight_job.SEGMENTATION_TABLE),
    "geo_product": geo_product,
    "geo_product_given": partial(geo_product, products=tables.PRODUCTS),
    "geo_product_stored": _stored(insight_job.GEO_PRODUCT_TABLE),
    "hourly_batch": hourly_batch,
    "fraud_daily_batch": fraud_daily_batch,
    "fraud_alerts": fraud_alerts,
    "publish_transactions": publish_transactions,
    "parse_messages": parse_published,
    "ingest_transactions": ingest_transactions,
    "fraud_daily": fraud_daily,
    "fraud_alerts_stream": fraud_alerts_stream,
    "hourly_stream": hourly_stream,
    "hourly_late_data": hourly_late_data,
    "stream_json_source": stream_json_source,
    "fraud_daily_bounded": fraud_daily_bounded,
    "fraud_open_days": fraud_open_days,
    "enriched_stream": enriched_stream,
    "message_counts": message_counts,
    "rejected_messages": rejected,
    "rejected_stream": rejected_stream,
    "ingest_limited": ingest_limited,
    "ingest_counts": ingest_counts,
    "hourly_days": hourly_days,
    "suspicious_transactions": suspicious_transactions,
    "lake_compacted": lake_compacted,
    "ingest_running": ingest_running,
}


def queries() -> dict[str, Query]:
    def registered(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: registered(query) for name, query in REGISTERED.items()}
