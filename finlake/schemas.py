"""Explicit schemas (never inferred) for raw tables, messages and rates documents."""

from pyspark.sql import types as T

# raw.transactions, in the fixed column order of the reference loader.
RAW_TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("account_name", T.StringType()),
    T.StructField("account_type", T.StringType()),
    T.StructField("bank_name", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("category_type", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("transaction_timestamp", T.TimestampNTZType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_source", T.StringType()),
    T.StructField("signed_amount", T.DoubleType()),
    T.StructField("transaction_year", T.IntegerType()),
    T.StructField("transaction_month", T.IntegerType()),
    T.StructField("transaction_day_of_week", T.IntegerType()),
])
RAW_TRANSACTION_COLUMNS = [f.name for f in RAW_TRANSACTIONS.fields]

# raw.exchange_rates
RAW_EXCHANGE_RATES = T.StructType([
    T.StructField("rate_date", T.TimestampNTZType()),
    T.StructField("base_currency", T.StringType()),
    T.StructField("target_currency", T.StringType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_source", T.StringType()),
    T.StructField("inverse_rate", T.DoubleType()),
])
RAW_EXCHANGE_RATE_COLUMNS = [f.name for f in RAW_EXCHANGE_RATES.fields]

# Rates document: {"base": "GBP", "rates": {"YYYY-MM-DD": {"USD": 1.27, ...}}}
RATES_DOCUMENT = T.StructType([
    T.StructField("base", T.StringType()),
    T.StructField("rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
])

# Stream message (JSON value of a transactions topic).  Every field is read as
# text or number; presence of keys is checked separately (json_object_keys).
MESSAGE = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("account_name", T.StringType()),
    T.StructField("account_type", T.StringType()),
    T.StructField("bank_name", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("transaction_date", T.StringType()),
    T.StructField("transaction_timestamp", T.StringType()),
    T.StructField("event_time", T.StringType()),
])
