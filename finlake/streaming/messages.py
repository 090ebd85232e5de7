"""Stream message -> raw.transactions row (STR1-STR4), shared by batch and stream.

Semantics kept from the reference consumer:

* a key that is *missing* takes its default; a key present with JSON null
  stays null (``json_object_keys`` tells the two apart, ``from_json`` cannot);
* category_type is 'income' iff category = 'income', else 'expense';
* amount = abs(amount); signed_amount = -abs only when the message explicitly
  says 'debit' — a message without a type is stored as 'debit' with a
  *positive* signed amount (a reference defect, kept for parity);
* transaction_date is the date as written in the timestamp's own offset;
  transaction_timestamp is the instant, stored as UTC wall-clock time;
* bad records do not stop the stream: they are routed to a dead-letter output
  with a reason (the reference logs them, or dies on undecodable JSON).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions import columns as C
from finlake.functions.vocab import MESSAGE_DEFAULTS, STREAM_SOURCE_NAME
from finlake.schemas import MESSAGE, RAW_TRANSACTION_COLUMNS

REQUIRED = ["transaction_id", "account_id", "amount", "transaction_timestamp"]
REASON = "_reject_reason"


# ISO 8601 as the message contract has it: full date, optional time and offset.
ISO_TIMESTAMP = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
                 r"(Z|[+-]\d{2}:\d{2})?)?$")


def parse(msgs: DataFrame, value_col: str = "value",
          ingested_at: Column | None = None) -> DataFrame:
    """All raw.transactions columns plus ``_reject_reason`` (null for good rows),
    ``value`` and the other input columns (e.g. the message key) carried through."""
    keys = F.json_object_keys(F.col(value_col))
    m = F.from_json(F.col(value_col), MESSAGE)
    carried = [c for c in msgs.columns if c != value_col]
    df = msgs.select(*carried, F.col(value_col).alias("value"), keys.alias("_keys"), m.alias("_m"))

    def has(k: str) -> Column:
        return F.array_contains(F.col("_keys"), F.lit(k))

    def field(k: str) -> Column:
        if k in MESSAGE_DEFAULTS:
            return F.when(has(k), F.col(f"_m.{k}")).otherwise(F.lit(MESSAGE_DEFAULTS[k]))
        return F.col(f"_m.{k}")

    ts_text = F.col("_m.transaction_timestamp")
    ts = F.when(ts_text.rlike(ISO_TIMESTAMP), ts_text).try_cast("timestamp")
    day = F.substring(ts_text, 1, 10).try_cast("date")
    missing = None
    for k in REQUIRED:
        cond = ~has(k)
        missing = cond if missing is None else (missing | cond)
    reason = (F.when(F.col("_keys").isNull(), F.lit("malformed_json"))
              .when(missing, F.lit("missing_required"))
              .when(F.col("_m.amount").isNull(), F.lit("invalid_amount"))
              .when(ts.isNull() | day.isNull(), F.lit("invalid_timestamp")))
    amount = F.abs(F.col("_m.amount"))
    category = field("category")
    explicit_debit = has("transaction_type") & (F.col("_m.transaction_type") == F.lit("debit"))
    ingested = ingested_at if ingested_at is not None else F.current_timestamp()
    fields = [
        *[F.col(c) for c in carried],
        F.col("value"),
        F.col("_m.transaction_id").alias("transaction_id"),
        F.col("_m.account_id").alias("account_id"),
        field("account_name").alias("account_name"),
        field("account_type").alias("account_type"),
        field("bank_name").alias("bank_name"),
        field("currency").alias("currency"),
        amount.alias("amount"),
        field("transaction_type").alias("transaction_type"),
        category.alias("category"),
        F.when(category == F.lit("income"), F.lit("income")).otherwise(F.lit("expense"))
        .alias("category_type"),
        field("merchant").alias("merchant"),
        field("description").alias("description"),
        day.alias("transaction_date"),
        ts.cast("timestamp_ntz").alias("transaction_timestamp"),
        ingested.cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(STREAM_SOURCE_NAME).alias("_source"),
        F.when(F.coalesce(explicit_debit, F.lit(False)), -amount).otherwise(amount)
        .alias("signed_amount"),
        *[v.alias(k) for k, v in C.date_parts(day).items()],
        reason.alias(REASON),
    ]
    # The parsed row leaves through a one-element generator: a later filter on
    # the reason (good / dead-letter split) then applies to parsed rows and is
    # not pushed below the JSON parse, which would re-parse every message for
    # the predicate.
    return df.select(F.inline(F.array(F.struct(*fields))))


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REASON).isNull()).select(*RAW_TRANSACTION_COLUMNS)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """Dead letters: the untouched message (key when present), the reason and the time."""
    key = [F.col("key")] if "key" in parsed.columns else []
    return parsed.filter(F.col(REASON).isNotNull()).select(
        *key, "value", F.col(REASON).alias("reason"), F.col("_ingested_at").alias("rejected_at"))


def to_raw(msgs: DataFrame, value_col: str = "value",
           ingested_at: Column | None = None) -> DataFrame:
    """Good messages as raw.transactions rows (bad ones dropped)."""
    return valid_rows(parse(msgs, value_col, ingested_at))
