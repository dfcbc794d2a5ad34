"""The same queries in SQL, over the same tables, for a second engine to answer."""

from __future__ import annotations

from ledgerlake.plans.queries import ARRIVALS, FIRST_DAY, FLAWS, LAST_DAY, LATE_TYPE
from ledgerlake.plans.tables import BATCH_TYPES, OCCUPATIONS, PRODUCTS

CUSTOMERS = """
customers as (
    select c_custkey as id,
           'user' || c_custkey as username,
           c_name as full_name,
           cast(date '1950-01-01' + cast(c_custkey % 20000 as int) as varchar) as date_of_birth,
           case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
           case when c_custkey % 3 = 0 then 'single' when c_custkey % 3 = 1 then 'married' end
               as marital_status,
           n_name as nationality,
           r_name as occupation,
           'level ' || c_custkey % 5 as education_level,
           case when c_custkey % 10 <> 0 then cast(cast(
               (cast(c_acctbal as decimal(10,2)) + 1000) * 10 as decimal(12,2)) as double) end
               as income,
           '555-' || c_custkey as phone_number,
           c_custkey || ' Main Street' as address,
           'user' || c_custkey || '@example.com' as email,
           cast(date '2015-01-01' + cast(c_custkey % 2000 as int) as varchar) as date_joined,
           case when c_custkey % 4 = 0 then 'approved' when c_custkey % 4 = 1 then 'rejected' end
               as loan_approval_status,
           case when c_custkey % 4 = 0
                then cast(cast(c_acctbal as decimal(10,2)) as double) end as loan_amount,
           c_mktsegment as customer_segment,
           c_acctbal > 9000 as is_vip
    from customer join nation on c_nationkey = n_nationkey
                  join region on n_regionkey = r_regionkey
)"""

ACCOUNTS = """
accounts as (
    select case when c_custkey % 25 <> 3 then c_custkey else -c_custkey end as account_id,
           case when c_custkey % 20 <> 7 then c_custkey - c_custkey % 2 end as customer_id,
           c_custkey % 11 <> 0 as is_active,
           cast(cast(c_acctbal as decimal(10,2)) + 100 as double) as initial_balance,
           '2020-01-01' as date_opened,
           case when c_custkey % 11 = 0 then '2024-01-01' end as date_closed,
           cast(cast(c_acctbal as decimal(10,2)) as double) as current_balance
    from customer
)"""

CUST_ACCOUNTS = """
cust_accounts as (
    select account_id, customer_id, full_name, income, customer_segment, occupation, is_active,
           current_balance, date_opened, is_vip
    from accounts left join customers on customer_id = id
), categorized as (
    select *, case when income is null then 'Unknown' when income < 20000 then 'Low'
                   when income < 70000 then 'Medium' else 'High' end as income_category
    from cust_accounts
)"""

TRANSACTIONS = """
transactions as (
    select cast(l_orderkey * 100 + l_linenumber as varchar) as transaction_id,
           l_shipdate as "timestamp",
           l_returnflag as transaction_type,
           cast(o_custkey as varchar) as sender_account_id,
           cast(l_suppkey as varchar) as receiver_account_id,
           cast(l_extendedprice as decimal(10,2)) as amount,
           cast(l_tax * 100 as decimal(10,2)) as transaction_fee,
           l_linestatus as subtype,
           'device ' || l_linenumber as device_type,
           n_name as location,
           p_type as product_name,
           cast(l_quantity as decimal(10,2)) as product_amount,
           cast(null as varchar) as transaction_message
    from lineitem left join orders on l_orderkey = o_orderkey
                  left join part on l_partkey = p_partkey
                  left join supplier on l_suppkey = s_suppkey
                  left join nation on s_nationkey = n_nationkey
)"""

# Transactions as they come back from a message: zero amounts are lost on the way.
EVENT_TRANSACTIONS = """
event_transactions as (
    select cast(event_id as varchar) as transaction_id,
           ts as "timestamp",
           event_type as transaction_type,
           cast(user_id as varchar) as sender_account_id,
           cast(cast(value as decimal(10,2)) * 100 as decimal(10,2)) as amount,
           cast(value as decimal(10,2)) as transaction_fee,
           props as transaction_message
    from events
)"""

ENRICHED = """
enriched as (
    select * from transactions
    left join categorized on try_cast(sender_account_id as bigint) = account_id
)"""

_TYPED = """transaction_id, "timestamp", transaction_type, sender_account_id,
       cast(null as varchar) as receiver_account_id,
       cast({amount} as double) as amount,
       cast({fee} as double) as transaction_fee,
       cast(null as varchar) as subtype, cast(null as varchar) as device_type,
       cast(null as varchar) as location, cast(null as varchar) as product_name,
       cast(null as double) as product_amount, transaction_message"""

STORED = _TYPED.format(amount="amount", fee="transaction_fee")
PUBLISHED = _TYPED.format(amount="nullif(amount, 0)", fee="nullif(transaction_fee, 0)")


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _total(expression: str) -> str:
    return f"cast(cast(sum({expression}) as decimal(20,2)) as double)"


def _sum_columns(column: str, labels: list[str]) -> str:
    return ", ".join(
        f"cast(cast(sum(amount) filter (where coalesce({column}, 'null') = '{label}')"
        f' as decimal(20,2)) as double) as "{label}"'
        for label in labels
    )


def _average_columns(column: str, labels: list[str]) -> str:
    # Averages of cents, rounded half up at six digits in whole numbers: no rounding in binary.
    columns = []
    for label in labels:
        chosen = f"filter (where coalesce({column}, 'null') = '{label}')"
        cents = f"cast(sum(amount) {chosen} * 100 as hugeint)"
        count = f"cast(count(amount) {chosen} as hugeint)"
        columns.append(
            f"cast((2 * {cents} * 10000 + {count}) // nullif(2 * {count}, 0) as double)"
            f' / 1000000 as "{label}"'
        )
    return ", ".join(columns)


_REPORT_PARTS = (CUSTOMERS, ACCOUNTS, CUST_ACCOUNTS, TRANSACTIONS, ENRICHED)

_TOP = f"""{_with(*_REPORT_PARTS)}, totals as (
    select customer_id, full_name, sum(amount) as total from enriched group by all
), ranked as (
    select customer_id, full_name, cast(cast(total as decimal(20,2)) as double) as total_amount,
           row_number() over (order by total desc nulls last, customer_id nulls first,
                                       full_name nulls first) as rank
    from totals
)
select * from ranked where rank <= 10"""


# Rows that count for the fraud job: zero amounts are lost on the way, as are rows without a field.
_COMPLETE = """where amount <> 0 and transaction_id is not null
    and sender_account_id is not null and "timestamp" is not null"""


def _daily(condition: str) -> str:
    return f"""{_with(EVENT_TRANSACTIONS)}, daily as (
    select sender_account_id, cast(cast("timestamp" as date) as varchar) as transaction_date,
           count(*) as daily_transaction_count, sum(amount) as total
    from event_transactions {condition} group by all
)
select sender_account_id, transaction_date, daily_transaction_count,
       cast(cast(total as decimal(20,2)) as double) as daily_transaction_amount,
       daily_transaction_count > 3 or total > 10000 as is_fraud,
       'user_activity:' || sender_account_id || ':' || transaction_date as activity_key
from daily"""


def _hourly(rows: str, extra: str = "") -> str:
    return f"""{_with(EVENT_TRANSACTIONS)}{extra}
select date_trunc('hour', "timestamp") as hour_start,
       date_trunc('hour', "timestamp") + interval 1 hour as hour_end,
       transaction_type, count(*) as tx_count, {_total("amount")} as total_amount
from {rows} group by all"""


# Late rows: the part a row arrives with, and the watermark that holds there, which is the
# greatest time (in milliseconds) of all earlier parts less 30 minutes. A row is dropped when
# its hour had ended by then.
_LATE = f""", bounds as (
    select epoch_us(min("timestamp")) as low, epoch_us(max("timestamp")) as high
    from event_transactions
), placed as (
    select e.*, least((epoch_us("timestamp") - low) * {ARRIVALS} // (high - low), {ARRIVALS} - 1)
           + case when transaction_type = '{LATE_TYPE}' then 1 else 0 end as arrival
    from event_transactions e, bounds
), parts as (
    select arrival, max("timestamp") as last from placed group by all
), marks as (
    select arrival, date_trunc('millisecond',
               max(last) over (order by arrival rows between unbounded preceding and 1 preceding))
               - interval 30 minutes as mark
    from parts
), counted as (
    select placed.* from placed join marks using (arrival)
    where mark is null or date_trunc('hour', "timestamp") + interval 1 hour > mark
)"""


def _json_text(column: str) -> str:
    return f"""coalesce('"' || replace({column}, '"', '\\"') || '"', 'null')"""


_MESSAGE_TEXT = f"""'{{"transaction_id":' || {_json_text("transaction_id")}
    || ',"timestamp":"' || regexp_replace(
           strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')
    || '","transaction_type":' || {_json_text("transaction_type")}
    || ',"sender_account_id":' || {_json_text("sender_account_id")}
    || ',"receiver_account_id":null'
    || ',"amount":' || coalesce(cast(nullif(amount, 0) as varchar), 'null')
    || ',"transaction_fee":' || coalesce(cast(nullif(transaction_fee, 0) as varchar), 'null')
    || ',"subtype":null,"device_type":null,"location":null,"product_name":null'
    || ',"product_amount":null'
    || ',"transaction_message":' || {_json_text("transaction_message")} || '}}'"""

_MESSAGES = f"{_with(EVENT_TRANSACTIONS)} select {_MESSAGE_TEXT} as value from event_transactions"

_TRANSACTION_ROWS = """
       transaction_id, "timestamp", transaction_type, sender_account_id, receiver_account_id,
       cast(amount as double) as amount, cast(transaction_fee as double) as transaction_fee,
       subtype, device_type, location, product_name,
       cast(product_amount as double) as product_amount, transaction_message"""

_SCAN_CUSTOMERS = f"{_with(CUSTOMERS)} select * from customers"
_SCAN_ACCOUNTS = f"{_with(ACCOUNTS)} select * from accounts"
_PUBLISHED_ROWS = f"{_with(EVENT_TRANSACTIONS)} select {PUBLISHED} from event_transactions"


_MONTHLY = (
    f"{_with(*_REPORT_PARTS)} select strftime(\"timestamp\", '%Y-%m') as year_month,"
    f" {_sum_columns('transaction_type', BATCH_TYPES)} from enriched group by 1"
)
_SEGMENTS = (
    f"{_with(*_REPORT_PARTS)} select customer_segment,"
    f" {_average_columns('occupation', OCCUPATIONS)} from enriched group by 1"
)
_PLACES = (
    f"{_with(*_REPORT_PARTS)} select location,"
    f" {_sum_columns('product_name', PRODUCTS)} from enriched group by 1"
)


# A row's part of the arrivals, from 0.
_PART = f"least((epoch_us(\"timestamp\") - low) * {ARRIVALS} // (high - low), {ARRIVALS} - 1)"
_BOUNDS = """bounds as (
    select epoch_us(min("timestamp")) as low, epoch_us(max("timestamp")) as high
    from event_transactions
)"""

# Days are judged like hours, but of complete rows, and they close two days after their end.
_LATE_DAYS = f""", {_BOUNDS}, placed as (
    select e.*, {_PART} + case when transaction_type = '{LATE_TYPE}' then 1 else 0 end as arrival
    from event_transactions e, bounds {_COMPLETE}
), parts as (
    select arrival, max("timestamp") as last from placed group by all
), marks as (
    select arrival, date_trunc('millisecond',
               max(last) over (order by arrival rows between unbounded preceding and 1 preceding))
               - interval 2 days as mark
    from parts
), counted as (
    select placed.* from placed join marks using (arrival)
    where mark is null or date_trunc('day', "timestamp") + interval 1 day > mark
), final as (select date_trunc('millisecond', max(last)) - interval 2 days as mark from parts)"""

_BOUNDED = _daily("").replace("from event_transactions", "from counted").replace(
    f"{EVENT_TRANSACTIONS}", f"{EVENT_TRANSACTIONS}{_LATE_DAYS}"
)

# Not evicted yet: the last run of the stream had a row of every part before it.
_OPEN_DAYS = f"""{_with(EVENT_TRANSACTIONS)}{_LATE_DAYS}
select sender_account_id, cast(cast("timestamp" as date) as varchar) as transaction_date,
       count(*) as daily_transaction_count
from counted, final where date_trunc('day', "timestamp") + interval 1 day > final.mark group by all"""

_ENRICHED_STREAM = f"""{_with(CUSTOMERS, ACCOUNTS, CUST_ACCOUNTS, EVENT_TRANSACTIONS, _BOUNDS)}, dims as (
    select 1 as dimension_snapshot, * from cust_accounts where account_id % 5 <> 1
    union all
    select 2, * replace (case when customer_id % 3 = 0 and customer_segment is not null
                              then 'moved ' || customer_segment else customer_segment end as customer_segment)
    from cust_accounts
), placed as (
    select e.*, case when {_PART} = 0 then 1 else 2 end as snapshot from event_transactions e, bounds
)
select {STORED}, account_id, customer_id, full_name, income, customer_segment, occupation, is_active,
       current_balance, date_opened, is_vip, cast(snapshot as bigint) as dimension_snapshot
from placed left join dims
     on dims.dimension_snapshot = snapshot and try_cast(sender_account_id as bigint) = account_id"""


def _every(flaw: str) -> str:
    step, rest = FLAWS[flaw]
    return f"number % {step} = {rest}"


def _replaced(text: str, flaw: str, field: str, value: str) -> str:
    changed = f"""regexp_replace({text}, '"{field}":"[^"]*"', '"{field}":{value}')"""
    return f"case when {_every(flaw)} then {changed} else {text} end"


_FLAWED = f"""{_with(EVENT_TRANSACTIONS)}, texts as (
    select *, cast(transaction_id as bigint) as number, {_MESSAGE_TEXT} as m0 from event_transactions
), flaw_1 as (select *, {_replaced("m0", "no_id", "transaction_id", "null")} as m1 from texts
), flaw_2 as (select *, {_replaced("m1", "no_time", "timestamp", '"yesterday"')} as m2 from flaw_1
), flaw_3 as (select *, {_replaced("m2", "no_type", "transaction_type", "null")} as m3 from flaw_2
), flawed as (
    select *, case when {_every("not_json")} then '<' || m3 else m3 end as value,
           case when {_every("not_json")} then 'unreadable'
                when {_every("no_id")} then 'no transaction_id'
                when {_every("no_time")} then 'no timestamp'
                when {_every("no_type")} or transaction_type is null then 'no transaction_type' end as reason
    from flaw_3
)"""

_COUNTS = """count(*) as read, count(*) filter (reason is null) as kept,
       count(reason) as rejected, count(*) filter (reason = 'unreadable') as unreadable,
       count(*) filter (reason = 'no transaction_id') as no_transaction_id,
       count(*) filter (reason = 'no timestamp') as no_timestamp,
       count(*) filter (reason = 'no transaction_type') as no_transaction_type"""

_SUSPICIOUS = f"""{_daily("where amount <> 0").replace("select sender_account_id, transaction_date, daily", ", flagged as (select sender_account_id, transaction_date, daily", 1)} )
select transaction_id, sender_account_id, transaction_date, cast(nullif(amount, 0) as double) as amount
from event_transactions join flagged using (sender_account_id)
where is_fraud and transaction_date = cast(cast("timestamp" as date) as varchar)"""


def oracle_sql() -> dict[str, str]:
    return {
        "scan_customers": _SCAN_CUSTOMERS,
        "scan_accounts": _SCAN_ACCOUNTS,
        "scan_transactions_csv": f"{_with(TRANSACTIONS)} select {_TRANSACTION_ROWS} from transactions",
        "snapshot_customers": _SCAN_CUSTOMERS,
        "snapshot_accounts": _SCAN_ACCOUNTS,
        "cust_accounts": f"{_with(CUSTOMERS, ACCOUNTS, CUST_ACCOUNTS)} select * from cust_accounts",
        "income_category": (
            f"{_with(CUSTOMERS, ACCOUNTS, CUST_ACCOUNTS)} select * from categorized"
        ),
        "enriched_transactions": (
            f"{_with(*_REPORT_PARTS)} select {_TRANSACTION_ROWS}, account_id, customer_id,"
            " full_name, income, customer_segment, occupation, is_active, current_balance,"
            " date_opened, is_vip, income_category from enriched"
        ),
        "top_customers": _TOP,
        "top_customers_stored": _TOP,
        **{f"monthly_type{end}": _MONTHLY for end in ("", "_given", "_stored")},
        **{f"segmentation{end}": _SEGMENTS for end in ("", "_given", "_stored")},
        **{f"geo_product{end}": _PLACES for end in ("", "_given", "_stored")},
        "hourly_batch": _hourly("event_transactions"),
        "fraud_daily_batch": _daily(_COMPLETE),
        "fraud_alerts": f"select * from ({_daily(_COMPLETE)}) where is_fraud",
        "fraud_alerts_stream": f"select * from ({_daily(_COMPLETE)}) where is_fraud",
        "publish_transactions": _MESSAGES,
        "parse_messages": _PUBLISHED_ROWS,
        "ingest_transactions": _PUBLISHED_ROWS,
        "fraud_daily": _daily(_COMPLETE),
        "hourly_stream": _hourly("event_transactions"),
        "hourly_late_data": _hourly("counted", _LATE),
        "fraud_daily_bounded": _BOUNDED,
        "fraud_open_days": _OPEN_DAYS,
        "enriched_stream": _ENRICHED_STREAM,
        "message_counts": f"{_FLAWED} select {_COUNTS} from flawed",
        "rejected_messages": f"{_FLAWED} select value, reason from flawed where reason is not null",
        "rejected_stream": f"{_FLAWED} select value, reason from flawed where reason is not null",
        "ingest_limited": f"{_FLAWED} select {PUBLISHED} from flawed where reason is null",
        "ingest_counts": f"{_FLAWED} select {_COUNTS}, true as several_batches from flawed",
        "hourly_days": _hourly("event_transactions").replace(
            "group by all",
            f"where cast(\"timestamp\" as date) between date '{FIRST_DAY}' and date '{LAST_DAY}' group by all",
        ),
        "suspicious_transactions": _SUSPICIOUS,
        "lake_compacted": _PUBLISHED_ROWS,
        "ingest_running": _PUBLISHED_ROWS,
        "stream_json_source": f"{_with(EVENT_TRANSACTIONS)} select {STORED} from event_transactions",
    }
