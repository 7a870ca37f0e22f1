"""Raw and clean schemas of the customer-transaction table."""

from __future__ import annotations

from pyspark.sql import types as T

# Target columns in the target table's ordinal order, with their final types.
CLEAN_COLUMNS: list[tuple[str, T.DataType]] = [
    ("customer_id", T.StringType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("full_name", T.StringType()),
    ("gender", T.StringType()),
    ("dob", T.DateType()),
    ("age", T.IntegerType()),
    ("email", T.StringType()),
    ("phone", T.StringType()),
    ("address", T.StringType()),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("zip_code", T.StringType()),
    ("credit_score", T.IntegerType()),
    ("annual_income", T.DoubleType()),
    ("employment_status", T.StringType()),
    ("account_open_date", T.DateType()),
    ("account_type", T.StringType()),
    ("account_balance", T.DoubleType()),
    ("transaction_id", T.StringType()),
    ("transaction_date", T.DateType()),
    ("transaction_amount", T.DoubleType()),
    ("transaction_type", T.StringType()),
    ("merchant_name", T.StringType()),
    ("merchant_category", T.StringType()),
    ("payment_method", T.StringType()),
    ("card_last_four", T.StringType()),
    ("card_type", T.StringType()),
    ("is_flagged", T.BooleanType()),
    ("is_fraud", T.BooleanType()),
    ("risk_score", T.DoubleType()),
    ("notes", T.StringType()),
    ("internal_comments", T.StringType()),
    ("legacy_id", T.StringType()),
]

# Input-only columns that the job drops.
DROPPED_COLUMNS = ["unused_field", "temp_data"]

# Raw input: every column is text.  The raw column order follows the target,
# with is_fraud before is_flagged as in the source files, then the dropped ones.
RAW_COLUMNS: list[str] = [
    "customer_id", "first_name", "last_name", "full_name", "gender", "dob", "age",
    "email", "phone", "address", "city", "state", "zip_code", "credit_score",
    "annual_income", "employment_status", "account_open_date", "account_type",
    "account_balance", "transaction_id", "transaction_date", "transaction_amount",
    "transaction_type", "merchant_name", "merchant_category", "payment_method",
    "card_last_four", "card_type", "is_fraud", "is_flagged", "risk_score", "notes",
    "internal_comments", "legacy_id", *DROPPED_COLUMNS,
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

CLEAN_SCHEMA = T.StructType(
    [T.StructField(n, t, n not in ("customer_id", "transaction_id")) for n, t in CLEAN_COLUMNS]
)

# Columns that identify a row; the empty-row filter ignores them.
KEY_COLUMNS = ["transaction_id", "customer_id", "legacy_id"]

# Numeric columns compared before/after cleaning.
NUMERIC_COLUMNS = ["transaction_amount", "age", "credit_score", "annual_income", "account_balance", "risk_score"]

# Columns whose null share is checked mid-pipeline.
CRITICAL_COLUMNS = ["customer_id", "transaction_id", "transaction_amount", "transaction_date"]

# Columns whose value distribution is compared before/after cleaning.
DISTRIBUTION_COLUMNS = ["card_type", "transaction_type", "employment_status"]
