"""Record shapes as Spark DDL, and the value pools of the synthetic records."""

from __future__ import annotations

# Ids travel as 32-bit integers in the original wire format. WIDE_TRANSACTION reads the
# same messages with 64-bit ids, so a topic with more than 2**31 transactions keeps its
# keys; every id the narrow form accepts comes out the same.
_TRANSACTION_FIELDS = """
    transaction_id {id}, customer_id {id}, merchant_id {id}, transaction_date STRING,
    amount DOUBLE, currency STRING, transaction_country STRING, transaction_city STRING,
    payment_method STRING, status STRING, device_type STRING, description STRING
"""
TRANSACTION = _TRANSACTION_FIELDS.format(id="INT")
WIDE_TRANSACTION = _TRANSACTION_FIELDS.format(id="BIGINT")
TRANSACTION_COLUMNS = (
    "transaction_id", "customer_id", "merchant_id", "transaction_date", "amount", "currency",
    "transaction_country", "transaction_city", "payment_method", "status", "device_type", "description",
)

ENVELOPE = """
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT,
    timestamp TIMESTAMP, timestampType INT
"""

# What one micro-batch of the raw sink stores: one row per transaction, from which the
# Customer, Merchant and Transaction nodes and the MADE and AT edges are all projected.
RAW_LOG = """
    transaction_id BIGINT, customer_id BIGINT, merchant_id BIGINT, amount DOUBLE,
    currency STRING, status STRING, transaction_date TIMESTAMP, merchant_category STRING
"""
STATS_LOG = """
    category STRING, country STRING, window_start TIMESTAMP, window_end TIMESTAMP,
    total_amount DOUBLE, txn_count BIGINT, updated_at TIMESTAMP
"""
# Running totals per merchant, with the category the merchant had when the batch was written.
MERCHANT_STATS_LOG = """
    merchant_id BIGINT, country STRING, window_start TIMESTAMP, window_end TIMESTAMP,
    amount_cents DECIMAL(27,0), amount_rest DOUBLE, txn_count BIGINT, category STRING, updated_at TIMESTAMP
"""
CUSTOMER_SEED = """
    customer_id BIGINT, customer_name STRING, email STRING, customer_country STRING,
    customer_city STRING, age INT, registration_date DATE, set_columns ARRAY<STRING>
"""
MERCHANT_SEED = """
    merchant_id BIGINT, merchant_name STRING, category STRING, merchant_country STRING,
    merchant_city STRING, set_columns ARRAY<STRING>
"""

CUSTOMER_COLUMNS = (
    "customer_name", "email", "customer_country", "customer_city", "age", "registration_date",
)
MERCHANT_COLUMNS = ("merchant_name", "category", "merchant_country", "merchant_city")

# --- Fixed values -------------------------------------------------------------------
# Pools, ranges, templates and defaults that users' data and dashboards depend on.
COUNTRIES = ("Mexico", "USA", "Canada", "Brazil", "Spain")
CITIES = (
    "Guadalajara", "Zapopan", "Monterrey", "CDMX", "Puebla", "Toronto", "Madrid", "Sao Paulo",
)
CATEGORIES = (
    "electronics", "clothing", "groceries", "restaurants",
    "travel", "health", "education", "entertainment",
)
STATUSES = ("approved", "declined", "pending")
PAYMENT_METHODS = ("credit_card", "debit_card", "bank_transfer", "cash", "digital_wallet")
CURRENCIES = ("MXN", "USD", "CAD", "BRL", "EUR")
DEVICE_TYPES = ("mobile", "desktop", "pos_terminal", "atm")

CUSTOMER_SEED_NUMBER = 42
MERCHANT_SEED_NUMBER = 1337
DEFAULT_CUSTOMERS = 1000
DEFAULT_MERCHANTS = 200
AGE_RANGE = (18, 80)
AMOUNT_CENTS_RANGE = (1_000, 5_000_000)
FIRST_REGISTRATION = "2018-01-01"
REGISTRATION_SPAN_DAYS = 365 * 6

CUSTOMER_NAME_PREFIX = "Customer_"
CUSTOMER_EMAIL_PREFIX = "customer_"
CUSTOMER_EMAIL_SUFFIX = "@example.com"
MERCHANT_NAME_PREFIX = "Merchant_"
DESCRIPTION_PREFIX = "synthetic_transaction_description_"
DESCRIPTION_SUFFIX = "_streaming_big_data_project"

BATCH_COMMIT_PATTERN = r"\[([\w_]+)\]\s+batch=(\d+)\s+rows=(\d+)"
PRODUCED_PATTERN = r"produced\s+(\d+)\s+transactions"
PRODUCED_LINE = "produced {sent} transactions (last id={last})"
LOG_FORMAT = "%(asctime)s | %(levelname)s | %(name)s | %(message)s"
LOG_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"
# ------------------------------------------------------------------------------------
