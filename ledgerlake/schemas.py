"""Column layouts of the data model, as Spark DDL."""

# Column names and types every producer and consumer agrees on.

WIRE_TRANSACTION = """
    `transaction_id` STRING,
    `timestamp` STRING,
    `transaction_type` STRING,
    `sender_account_id` STRING,
    `receiver_account_id` STRING,
    `amount` DECIMAL(10,2),
    `transaction_fee` DECIMAL(10,2),
    `subtype` STRING,
    `device_type` STRING,
    `location` STRING,
    `product_name` STRING,
    `product_amount` DECIMAL(10,2),
    `transaction_message` STRING
"""

# A stored transaction is a wire transaction whose timestamp has been typed.
STORED_TRANSACTION = WIRE_TRANSACTION.replace("`timestamp` STRING", "`timestamp` TIMESTAMP")

TRANSACTION_COLUMNS = [
    "transaction_id",
    "timestamp",
    "transaction_type",
    "sender_account_id",
    "receiver_account_id",
    "amount",
    "transaction_fee",
    "subtype",
    "device_type",
    "location",
    "product_name",
    "product_amount",
    "transaction_message",
]

CUSTOMER_COLUMNS = [
    "id",
    "username",
    "full_name",
    "date_of_birth",
    "gender",
    "marital_status",
    "nationality",
    "occupation",
    "education_level",
    "income",
    "phone_number",
    "address",
    "email",
    "date_joined",
    "loan_approval_status",
    "loan_amount",
    "customer_segment",
    "is_vip",
]

ACCOUNT_COLUMNS = [
    "account_id",
    "customer_id",
    "is_active",
    "initial_balance",
    "date_opened",
    "date_closed",
    "current_balance",
]

CUSTOMER_ACCOUNT_COLUMNS = [
    "account_id",
    "customer_id",
    "full_name",
    "income",
    "customer_segment",
    "occupation",
    "is_active",
    "current_balance",
    "date_opened",
    "is_vip",
]

# One message of the transaction topic: a JSON object in a binary column.
MESSAGE = "`value` BINARY"

MONEY = "decimal(10,2)"
