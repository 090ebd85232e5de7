"""The 65 declared data-quality checks of the warehouse, as data."""

from __future__ import annotations

from finlake.functions import vocab as V
from finlake.operators.quality import Check, TableChecks


def _u(c):
    return Check(c, "unique")


def _n(c):
    return Check(c, "not_null")


def _a(c, values):
    return Check(c, "accepted_values", tuple(values))


def _r(c, to, field):
    return Check(c, "relationships", to=to, field=field)


DECLARED: list[TableChecks] = [
    TableChecks("raw_transactions", [
        _u("transaction_id"), _n("transaction_id"), _n("account_id"), _n("amount"),
        _a("transaction_type", V.TRANSACTION_TYPES), _n("transaction_date")]),
    TableChecks("raw_exchange_rates", [
        _n("rate_date"), _n("base_currency"), _n("target_currency"), _n("rate")]),
    TableChecks("stg_transactions", [
        _u("transaction_id"), _n("transaction_id"), _n("account_id"), _n("amount"),
        _n("signed_amount"), _n("category"), _n("transaction_date"),
        _a("transaction_type", V.TRANSACTION_TYPES)]),
    TableChecks("stg_exchange_rates", [
        _n("rate_date"), _n("base_currency"), _n("target_currency"), _n("rate")]),
    TableChecks("int_transactions_with_gbp", [
        _u("transaction_id"), _n("transaction_id"), _n("amount"), _n("amount_gbp"),
        _n("signed_amount_gbp"), _n("was_converted")]),
    TableChecks("dim_dates", [
        _u("date_key"), _n("date_key"), _u("full_date"), _n("full_date")]),
    TableChecks("dim_accounts", [
        _u("account_key"), _n("account_key"), _u("account_id"), _n("account_id"),
        _n("account_type"), _a("account_type", V.ACCOUNT_TYPES), _n("currency")]),
    TableChecks("dim_categories", [
        _u("category_key"), _n("category_key"), _u("category_id"), _n("category_id"),
        _n("category_type"), _a("category_type", V.CATEGORY_TYPES), _n("parent_category"),
        _n("budget_category"), _a("budget_category", V.BUDGET_CATEGORIES)]),
    TableChecks("fact_transactions", [
        _u("transaction_key"), _n("transaction_key"), _u("transaction_id"), _n("transaction_id"),
        _n("date_key"), _r("date_key", "dim_dates", "date_key"),
        _n("account_key"), _r("account_key", "dim_accounts", "account_key"),
        _n("category_key"), _r("category_key", "dim_categories", "category_key"),
        _n("amount"), _n("signed_amount"), _n("amount_gbp"), _n("signed_amount_gbp"),
        _n("was_converted"), _n("transaction_type"),
        _a("transaction_type", V.TRANSACTION_TYPES)]),
]


def of(table: str) -> list[Check]:
    return next(t.checks for t in DECLARED if t.table == table)


def count_checks() -> int:
    return sum(len(t.checks) for t in DECLARED)
