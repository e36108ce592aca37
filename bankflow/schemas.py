"""Table shapes, fixed vocabularies and the declared data-test registry (data only)."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the reference's for results to agree.
# ---------------------------------------------------------------------------
TOPIC_PREFIX = "banking_server.public."
TABLES = ["customers", "accounts", "transactions", "ledger_entries"]
FLUSH_SIZES = {"customers": 10, "accounts": 50, "transactions": 50, "ledger_entries": 50}
DEFAULT_FLUSH_SIZE = 50

CUSTOMER_STATUS = ["ACTIVE", "INACTIVE", "SUSPENDED"]
ACCOUNT_TYPES = ["SAVINGS", "CHECKING", "CREDIT", "LOAN"]
ACCOUNT_STATUS = ["ACTIVE", "CLOSED", "INACTIVE"]
TXN_TYPES = ["DEPOSIT", "WITHDRAWAL", "TRANSFER"]
DIRECTIONS = ["DEBIT", "CREDIT"]
TXN_STATUS = ["PENDING", "COMPLETED", "FAILED", "REVERSED"]
ENTRY_TYPES = ["DEBIT", "CREDIT"]

CURRENCIES = [("USD", "US Dollar"), ("EUR", "Euro"), ("GBP", "British Pound")]
ACCOUNT_NUMBER_START = 1000000000
ACCOUNT_NUMBER_PREFIX = "AC"
DEFAULT_CURRENCY = "USD"

# SCD2 check columns per snapshot.
CUSTOMER_CHECK_COLS = ["first_name", "last_name", "email", "phone", "cust_address", "cust_status"]
ACCOUNT_CHECK_COLS = ["customer_id", "account_type", "account_status", "balance", "interest_rate"]

# Column length limits (VARCHAR(n) / CHAR(n)) of the OLTP tables.
LENGTH_LIMITS = {
    "customers": {"first_name": 100, "last_name": 100, "email": 255, "phone": 20, "status": 20},
    "accounts": {"account_number": 20, "account_type": 20, "status": 20},
    "transactions": {"txn_type": 20, "direction": 10, "status": 20, "reference": 100},
    "ledger_entries": {"entry_type": 10},
    "currencies": {"code": 3, "name": 50},
}

# Declared column tests per model: not_null columns, unique columns, accepted values.
DATA_TESTS = {
    "stg_accounts": {
        "not_null": ["account_id", "customer_id", "balance", "created_at"],
        "unique": ["account_id"],
        "accepted_values": {"account_type": ["CHECKING", "SAVINGS", "CREDIT", "LOAN"],
                            "account_status": ["ACTIVE", "INACTIVE", "CLOSED"]},
    },
    "stg_customers": {
        "not_null": ["customer_id", "first_name", "last_name", "email", "date_of_birth"],
        "unique": ["customer_id"],
        "accepted_values": {"cust_status": ["ACTIVE", "INACTIVE", "SUSPENDED"]},
    },
    "stg_transactions": {
        "not_null": ["transaction_id", "account_id", "txn_type", "direction", "txn_status", "txn_time"],
        "unique": ["transaction_id"],
        "accepted_values": {"txn_type": ["DEPOSIT", "WITHDRAWAL", "TRANSFER"],
                            "direction": ["DEBIT", "CREDIT"],
                            "txn_status": ["PENDING", "COMPLETED", "FAILED", "REVERSED"]},
    },
    "stg_ledger_entries": {
        "not_null": ["id", "transaction_id", "account_id", "entry_type", "txn_time"],
        "unique": ["id"],
        "accepted_values": {"entry_type": ["DEBIT", "CREDIT"]},
    },
    "facts_transactions": {
        "not_null": ["transaction_id", "account_id", "txn_type", "direction", "txn_status", "txn_time"],
        "unique": ["transaction_id"],
        "accepted_values": {"txn_type": ["DEPOSIT", "WITHDRAWAL", "TRANSFER"],
                            "direction": ["DEBIT", "CREDIT"],
                            "txn_status": ["PENDING", "COMPLETED", "FAILED", "REVERSED"]},
    },
    "dim_customers": {
        "not_null": ["customer_id", "first_name", "last_name", "email", "is_current"],
        "unique": ["customer_id"],
        "accepted_values": {"cust_status": ["ACTIVE", "INACTIVE", "SUSPENDED"]},
    },
    "dim_accounts": {
        "not_null": ["account_id", "customer_id", "is_current"],
        "unique": ["account_id"],
        "accepted_values": {"account_type": ["CHECKING", "SAVINGS", "LOAN", "CREDIT"],
                            "account_status": ["ACTIVE", "CLOSED", "CLOSED"]},
    },
}
# Layer of each model, for suite runs.
MODEL_LAYER = {
    "stg_accounts": "staging", "stg_customers": "staging",
    "stg_transactions": "staging", "stg_ledger_entries": "staging",
    "facts_transactions": "analytics", "dim_customers": "analytics", "dim_accounts": "analytics",
}

# ---------------------------------------------------------------------------
# Fixed values, as above: staging flatten specs (output column, JSON path, target type) and column lists.
# ---------------------------------------------------------------------------
STG_CUSTOMERS_SPEC = [
    ("customer_id", "$.id", "string"),
    ("first_name", "$.first_name", "string"),
    ("last_name", "$.last_name", "string"),
    ("email", "$.email", "string"),
    ("phone", "$.phone", "string"),
    ("date_of_birth", "$.date_of_birth", "date"),
    ("cust_address", "$.address", "string"),
    ("cust_status", "$.status", "string"),
    ("created_at", "$.created_at", "timestamp_ntz"),
]
STG_ACCOUNTS_SPEC = [
    ("account_id", "$.id", "string"),
    ("customer_id", "$.customer_id", "string"),
    ("account_type", "$.account_type", "string"),
    ("account_status", "$.status", "string"),
    ("balance", "$.balance", "double"),
    ("interest_rate", "$.interest_rate", "double"),
    ("currency", "$.currency", "string"),
    ("created_at", "$.created_at", "timestamp_ntz"),
]
STG_TRANSACTIONS_SPEC = [
    ("transaction_id", "$.id", "string"),
    ("account_id", "$.account_id", "string"),
    ("related_account_id", "$.related_account_id", "string"),
    ("txn_type", "$.txn_type", "string"),
    ("direction", "$.direction", "string"),
    ("amount", "$.amount", "double"),
    ("balance_after", "$.balance_after", "string"),
    ("txn_status", "$.status", "string"),
    ("reference", "$.reference", "string"),
    ("txn_desc", "$.description", "string"),
    ("txn_time", "$.created_at", "timestamp_ntz"),
]
STG_LEDGER_SPEC = [
    ("id", "$.id", "string"),
    ("transaction_id", "$.transaction_id", "string"),
    ("account_id", "$.account_id", "string"),
    ("entry_type", "$.entry_type", "string"),
    ("amount", "$.amount", "double"),
    ("txn_time", "$.created_at", "timestamp_ntz"),
]

STG_CUSTOMERS_COLS = [c for c, _, _ in STG_CUSTOMERS_SPEC] + ["load_timestamp"]
STG_ACCOUNTS_COLS = [c for c, _, _ in STG_ACCOUNTS_SPEC] + ["load_timestamp"]
STG_TRANSACTIONS_COLS = [c for c, _, _ in STG_TRANSACTIONS_SPEC] + ["load_timestamp"]
STG_LEDGER_COLS = [c for c, _, _ in STG_LEDGER_SPEC] + ["load_timestamp"]

SNAPSHOT_META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]

DIM_CUSTOMERS_COLS = ["customer_id", "first_name", "last_name", "email", "phone", "date_of_birth",
                      "cust_address", "cust_status", "created_at"]
DIM_ACCOUNTS_COLS = ["account_id", "customer_id", "account_type", "account_status", "balance",
                     "currency", "created_at"]
# ---------------------------------------------------------------------------
