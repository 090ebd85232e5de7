"""Column expressions shared by batch and streaming plans (all JVM built-ins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: str | Column, mapping: dict, default) -> Column:
    """Simple CASE ``key WHEN k THEN v ... ELSE default`` (codegen'd, no join)."""
    key = col_(key)
    items = list(mapping.items())
    first_k, first_v = items[0]
    expr = F.when(key == F.lit(first_k), F.lit(first_v))
    expr = reduce(lambda e, kv: e.when(key == F.lit(kv[0]), F.lit(kv[1])), items[1:], expr)
    return expr.otherwise(F.lit(default))


def signed_amount(amount: str | Column = "amount", txn_type: str | Column = "transaction_type") -> Column:
    """+amount when the type is exactly 'credit', otherwise -amount (null type -> negative)."""
    amount, txn_type = col_(amount), col_(txn_type)
    return F.when(txn_type == F.lit("credit"), amount).otherwise(-amount)


def weekday_mon0(d: str | Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(d))


def date_parts(d: str | Column = "transaction_date") -> dict[str, Column]:
    d = col_(d)
    return {
        "transaction_year": F.year(d),
        "transaction_month": F.month(d),
        "transaction_day_of_week": weekday_mon0(d),
    }


def round_half_away(x: str | Column, digits: int) -> Column:
    """Round a DOUBLE the way the reference engine does: ``x * 10^d`` rounded
    half away from zero, then divided back.  ``F.round(x, d)`` instead rounds
    the shortest decimal spelling of ``x``: 320783.72499999998 (the double of
    384940.47 / 1.2) would become .73 there and is .72 here."""
    m = F.lit(float(10 ** digits))
    return F.round(col_(x) * m, 0) / m


def round_half_even(x: str | Column, digits: int) -> Column:
    """Round a DOUBLE as pandas / numpy do: ``rint(x * 10^d) / 10^d``."""
    m = F.lit(float(10 ** digits))
    return F.bround(col_(x) * m, 0) / m


def inverse_rate(rate: str | Column = "rate") -> Column:
    """1 / rate on the unrounded rate, half-even to 6 places; 0 or null -> null."""
    return round_half_even(F.try_divide(F.lit(1.0), col_(rate)), 6)


def money(x: str | Column, sign: str | Column = "") -> Column:
    """Display money as ``<sign>£1,234.50``."""
    sign_col = F.lit(sign) if isinstance(sign, str) else sign
    return F.concat(sign_col, F.lit("£"), F.format_number(col_(x), 2))


def signed_money(x: str | Column, txn_type: str | Column) -> Column:
    """``+£x`` for credits, ``-£x`` otherwise."""
    sign = F.when(col_(txn_type) == F.lit("credit"), F.lit("+")).otherwise(F.lit("-"))
    return money(x, sign)


def title_case(c: str | Column) -> Column:
    """Python ``str.title()``: upper-case every letter that follows a non-letter
    (or starts the text), lower-case the others — ``'rent/mortgage'`` ->
    ``'Rent/Mortgage'`` (``initcap`` only splits on spaces).  The text is cut
    into runs of letters and of other characters, and each run capitalised."""
    s = col_(c)
    runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|\P{L}+)"))
    title = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                                 F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(title, "")
