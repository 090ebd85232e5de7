"""Fixed values that must equal the reference's for identical results.

FIXED VALUES — kept verbatim, in their natural order.
"""

# Category vocabulary of the transaction feed (income first, then expenses).
INCOME_CATEGORIES = ["Salary", "Freelance", "Bonus", "Other Income"]
EXPENSE_CATEGORIES = [
    "Rent/Mortgage", "Council Tax", "Utilities", "Insurance", "Groceries",
    "TfL/Oyster", "Transport", "Petrol", "Mobile Phone", "Internet",
    "Subscriptions", "Eating Out", "Entertainment", "Shopping",
    "Health & Fitness", "Personal Care", "Travel", "Other Expense",
]

# category -> parent_category; anything else is 'Other'.
PARENT_CATEGORY = {
    "Rent/Mortgage": "Housing",
    "Council Tax": "Housing",
    "Utilities": "Housing",
    "Insurance": "Housing",
    "Groceries": "Essential",
    "TfL/Oyster": "Transport",
    "Transport": "Transport",
    "Petrol": "Transport",
    "Mobile Phone": "Bills & Services",
    "Internet": "Bills & Services",
    "Subscriptions": "Bills & Services",
    "Eating Out": "Lifestyle",
    "Entertainment": "Lifestyle",
    "Shopping": "Lifestyle",
    "Health & Fitness": "Lifestyle",
    "Personal Care": "Lifestyle",
    "Travel": "Lifestyle",
    "Salary": "Employment Income",
    "Freelance": "Self-Employment",
    "Bonus": "Employment Income",
    "Other Income": "Other Income",
}
PARENT_DEFAULT = "Other"

# category -> budget_category; anything else is 'Discretionary'.
BUDGET_CATEGORY = {
    "Rent/Mortgage": "Essential",
    "Council Tax": "Essential",
    "Utilities": "Essential",
    "Insurance": "Essential",
    "Groceries": "Essential",
    "TfL/Oyster": "Essential",
    "Transport": "Semi-Essential",
    "Mobile Phone": "Essential",
    "Internet": "Essential",
}
BUDGET_DEFAULT = "Discretionary"

# parent_category -> reporting sort order; anything else is 9.
PARENT_SORT_ORDER = {
    "Employment Income": 1,
    "Self-Employment": 2,
    "Other Income": 3,
    "Housing": 4,
    "Essential": 5,
    "Transport": 6,
    "Bills & Services": 7,
    "Lifestyle": 8,
}
SORT_ORDER_DEFAULT = 9

# Date dimension span.
DATE_SPINE_START = "2020-01-01"
DATE_SPINE_END = "2027-12-31"

# Day order of the day-of-week report.
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Stream message defaults for missing keys.
MESSAGE_DEFAULTS = {
    "account_name": "Streaming Account",
    "account_type": "current",
    "bank_name": "Digital Bank",
    "currency": "GBP",
    "transaction_type": "debit",
    "category": "other",
    "merchant": "Unknown",
    "description": "",
}
STREAM_SOURCE_NAME = "KafkaConsumer"

# Exchange-rate extract defaults.
RATES_BASE_CURRENCY = "GBP"
RATES_TARGET_CURRENCIES = ["USD", "EUR"]
RATES_DEFAULT_DAYS_BACK = 30

# Accepted values of the declared data-quality checks.
TRANSACTION_TYPES = ["credit", "debit"]
ACCOUNT_TYPES = ["current", "savings", "credit"]
CATEGORY_TYPES = ["income", "expense"]
BUDGET_CATEGORIES = ["Essential", "Semi-Essential", "Discretionary"]
