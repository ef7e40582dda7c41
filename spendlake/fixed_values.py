"""Fixed values.

Everything in this module is a value that must equal the behaviour being
re-implemented for results to agree: the export header names, the default
rule table, the category dimension rows and the calendar names.  They are
stated plainly and in their natural order; the code elsewhere treats them as
parameters with these defaults.
"""

from __future__ import annotations

# --- fixed values: export header -> field name -------------------------------
HEADER_TO_FIELD = {
    "Bogføringsdato": "posting_date",
    "Beløb": "amount",
    "Afsender": "sender",
    "Modtager": "recipient",
    "Navn": "name",
    "Beskrivelse": "description",
    "Saldo": "balance",
    "Valuta": "currency",
    "Afstemt": "reconciled",
}

# --- fixed values: load parameters -------------------------------------------
PENDING_MARKER = "Reserveret"
DEFAULT_CURRENCY = "DKK"
ACCOUNT_FILE_PREFIX = "Konto "
ACCOUNT_FILE_SEPARATOR = " - "
BANK_NAME = "Nordea"
CHECKING_PREFIX = "07"
UNCATEGORISED_KEY = "CAT999"
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# --- fixed values: default category rules (pattern_type, pattern_value,
# category_key, priority), in seed order ---------------------------------------
DEFAULT_RULES = [
    ("description", "netto", "CAT001", 100),
    ("description", "rema", "CAT001", 100),
    ("description", "føtex", "CAT001", 100),
    ("description", "aldi", "CAT001", 100),
    ("description", "lidl", "CAT001", 100),
    ("description", "coop", "CAT001", 100),
    ("description", "restaurant", "CAT002", 90),
    ("description", "bistro", "CAT002", 90),
    ("description", "pizza", "CAT002", 90),
    ("description", "cafe", "CAT003", 90),
    ("description", "coffee", "CAT003", 90),
    ("description", "bar", "CAT003", 90),
    ("name", "netto", "CAT001", 80),
    ("name", "rema", "CAT001", 80),
    ("name", "føtex", "CAT001", 80),
    ("name", "aldi", "CAT001", 80),
    ("name", "lidl", "CAT001", 80),
    ("name", "coop", "CAT001", 80),
    ("description", "leje", "CAT004", 100),
    ("description", "husleje", "CAT004", 100),
    ("description", "rent", "CAT004", 100),
    ("description", "el og vand", "CAT005", 100),
    ("description", "fjernvarme", "CAT005", 100),
    ("description", "internet", "CAT005", 100),
    ("description", "elektricitet", "CAT005", 100),
    ("description", "gas", "CAT005", 100),
    ("description", "vand", "CAT005", 100),
    ("description", "dsb", "CAT007", 100),
    ("description", "metro", "CAT007", 100),
    ("description", "rejsekort", "CAT007", 100),
    ("description", "benzin", "CAT008", 100),
    ("description", "diesel", "CAT008", 100),
    ("description", "q8", "CAT008", 100),
    ("description", "shell", "CAT008", 100),
    ("description", "parkering", "CAT009", 100),
    ("description", "cinema", "CAT010", 90),
    ("description", "biograf", "CAT010", 90),
    ("description", "netflix", "CAT020", 100),
    ("description", "spotify", "CAT020", 100),
    ("description", "youtube", "CAT020", 100),
    ("description", "apotek", "CAT014", 100),
    ("description", "matas", "CAT011", 80),
    ("description", "forsikring", "CAT015", 100),
    ("description", "insurance", "CAT015", 100),
    ("description", "løn", "CAT016", 100),
    ("description", "salary", "CAT016", 100),
    ("description", "rente", "CAT017", 100),
    ("description", "interest", "CAT017", 100),
    ("description", "refusion", "CAT018", 100),
    ("description", "tilbagebet", "CAT018", 100),
    ("description", "refund", "CAT018", 100),
    ("description", "gebyr", "CAT019", 100),
    ("description", "fee", "CAT019", 100),
    ("description", "overførsel", "CAT021", 100),
    ("description", "transfer", "CAT021", 100),
    ("transaction_type", "income", "CAT016", 50),
]

# --- fixed values: category dimension rows (category_key, category_name,
# category_group, category_type, sort_order) ------------------------------------
CATEGORY_ROWS = [
    ("CAT001", "Groceries", "Food & Dining", "Essential", 1),
    ("CAT002", "Restaurants", "Food & Dining", "Discretionary", 2),
    ("CAT003", "Cafes & Bars", "Food & Dining", "Discretionary", 3),
    ("CAT004", "Rent", "Housing", "Essential", 4),
    ("CAT005", "Utilities", "Housing", "Essential", 5),
    ("CAT006", "Home Maintenance", "Housing", "Essential", 6),
    ("CAT007", "Public Transport", "Transportation", "Essential", 7),
    ("CAT008", "Fuel", "Transportation", "Essential", 8),
    ("CAT009", "Parking", "Transportation", "Discretionary", 9),
    ("CAT010", "Entertainment", "Leisure", "Discretionary", 10),
    ("CAT011", "Shopping", "Leisure", "Discretionary", 11),
    ("CAT012", "Sports & Fitness", "Leisure", "Discretionary", 12),
    ("CAT013", "Healthcare", "Health", "Essential", 13),
    ("CAT014", "Pharmacy", "Health", "Essential", 14),
    ("CAT015", "Insurance", "Health", "Essential", 15),
    ("CAT016", "Salary", "Income", "Income", 16),
    ("CAT017", "Interest", "Income", "Income", 17),
    ("CAT018", "Refund", "Income", "Income", 18),
    ("CAT019", "Bank Fees", "Financial", "Essential", 19),
    ("CAT020", "Subscriptions", "Financial", "Discretionary", 20),
    ("CAT021", "Transfers", "Financial", "Transfer", 21),
    ("CAT999", "Uncategorized", "Other", "Unknown", 999),
]

# --- fixed values: category type -> classification (anything else:
# "Expense - Unknown") ---------------------------------------------------------
CLASSIFICATION_BY_TYPE = {
    "Income": "Income",
    "Transfer": "Transfer",
    "Essential": "Expense - Essential",
    "Discretionary": "Expense - Discretionary",
}
OTHER_CLASSIFICATION = "Expense - Unknown"

# --- fixed values: calendar names (ISO day 1 = Monday; month 1 = January) ----
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# --- fixed values: columns offered by the transaction list --------------------
TRANSACTION_LIST_COLUMNS = [
    "date_day", "amount", "category_name", "counterparty_name",
    "transaction_description", "transaction_type", "account_number",
    "categorization_status",
]
TRANSACTION_LIST_DEFAULT = [
    "date_day", "amount", "category_name", "counterparty_name", "transaction_description",
]
