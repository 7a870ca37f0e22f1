"""Lookup tables used by the column cleaners.

FIXED VALUES: everything in this module must equal the values of the cleaning
rules we reproduce (word lists, mappings, date patterns), so they are stated
plainly and in their natural order.  Do not edit them to tune results.
"""

from __future__ import annotations

# --- FIXED VALUES -----------------------------------------------------------

# Placeholder words that are not accepted as a first or last name.  Compared
# case-sensitively against the raw value (C3) and against lower-cased tokens (C4).
EXCLUDE_FIRST = ["firstname", "fname", "first_name", "null", "Firstname", "FName"]
EXCLUDE_LAST = ["lastname", "lname", "last_name", "null", "Lastname", "LName"]

# Tokens appended to the last name when rebuilding a full name (C4).
NAME_SUFFIXES = ["jr", "sr"]

# US states: abbreviation -> name (C9).  DC and territories are not included.
US_STATES = [
    ("AL", "Alabama"),
    ("AK", "Alaska"),
    ("AZ", "Arizona"),
    ("AR", "Arkansas"),
    ("CA", "California"),
    ("CO", "Colorado"),
    ("CT", "Connecticut"),
    ("DE", "Delaware"),
    ("FL", "Florida"),
    ("GA", "Georgia"),
    ("HI", "Hawaii"),
    ("ID", "Idaho"),
    ("IL", "Illinois"),
    ("IN", "Indiana"),
    ("IA", "Iowa"),
    ("KS", "Kansas"),
    ("KY", "Kentucky"),
    ("LA", "Louisiana"),
    ("ME", "Maine"),
    ("MD", "Maryland"),
    ("MA", "Massachusetts"),
    ("MI", "Michigan"),
    ("MN", "Minnesota"),
    ("MS", "Mississippi"),
    ("MO", "Missouri"),
    ("MT", "Montana"),
    ("NE", "Nebraska"),
    ("NV", "Nevada"),
    ("NH", "New Hampshire"),
    ("NJ", "New Jersey"),
    ("NM", "New Mexico"),
    ("NY", "New York"),
    ("NC", "North Carolina"),
    ("ND", "North Dakota"),
    ("OH", "Ohio"),
    ("OK", "Oklahoma"),
    ("OR", "Oregon"),
    ("PA", "Pennsylvania"),
    ("RI", "Rhode Island"),
    ("SC", "South Carolina"),
    ("SD", "South Dakota"),
    ("TN", "Tennessee"),
    ("TX", "Texas"),
    ("UT", "Utah"),
    ("VT", "Vermont"),
    ("VA", "Virginia"),
    ("WA", "Washington"),
    ("WV", "West Virginia"),
    ("WI", "Wisconsin"),
    ("WY", "Wyoming"),
]

# Gender words (C2), compared after strip + lower.
GENDER_MALE = ["m", "male"]
GENDER_FEMALE = ["f", "female"]
GENDER_NON_BINARY = ["o", "unknown", "non-binary", "nonbinary", "nb", "other"]

# Account types (C14); the intended rule matches any of them case-insensitively.
ACCOUNT_TYPES = ["Checking", "CHK", "Student", "Business", "SVG", "Savings", "Joint", "Premium"]

# Employment statuses (C15), compared after strip + lower.
EMPLOYMENT_STATUSES = [
    "employed",
    "unemployed",
    "student",
    "retired",
    "self-employed",
    "homemaker",
    "part-time",
    "full-time",
    "unknown",
]

# Transaction type codes (C16), compared case-sensitively after strip.
TRANSACTION_TYPES = [
    ("W/D", "Withdrawal"),
    ("DEP", "Deposit"),
    ("PUR", "Purchase"),
    ("XFR", "Transfer"),
    ("Purchase", "Purchase"),
    ("Payment", "Payment"),
    ("Deposit", "Deposit"),
    ("Withdrawal", "Withdrawal"),
    ("Transfer", "Transfer"),
    ("W", "Withdrawal"),
]

# Company-form words removed from merchant names (C17), any case.
MERCHANT_SUFFIXES = ["inc", "corp", "ltd", "llc", "plc", "co", "company", "group"]

# Merchant categories (C18), compared after strip + upper + letters only.
MERCHANT_CATEGORIES = [
    "TRAVEL", "ENTERTAINMENT", "GROCERIES", "RETAIL",
    "ONLINE", "GAS", "DINING", "OTHER", "UNKNOWN",
]

# Payment methods (C19), compared after strip + upper + letters only.  The two
# entries with a space can never match (spaces are removed first); the
# intended rule adds their space-free forms.
PAYMENT_METHODS = [
    ("CC", "Credit Card"),
    ("CREDIT CARD", "Credit Card"),
    ("DC", "Debit Card"),
    ("DEBIT CARD", "Debit Card"),
    ("CHK", "Check"),
    ("CHECK", "Check"),
    ("ACH", "ACH"),
    ("NULL", "Unknown"),
]
PAYMENT_METHODS_INTENDED_EXTRA = [("CREDITCARD", "Credit Card"), ("DEBITCARD", "Debit Card")]

# Card types (C21), compared case-sensitively after strip.
CARD_TYPES = [
    ("AMEX", "American Express"),
    ("Amex", "American Express"),
    ("amex", "American Express"),
    ("AE", "American Express"),
    ("American Express", "American Express"),
    ("VISA", "Visa"),
    ("Visa", "Visa"),
    ("visa", "Visa"),
    ("V", "Visa"),
    ("MC", "Mastercard"),
    ("Mastercard", "Mastercard"),
    ("MASTERCARD", "Mastercard"),
    ("mastercard", "Mastercard"),
    ("Master Card", "Mastercard"),
    ("MasterCard", "Mastercard"),
    ("MASTER", "Mastercard"),
    ("Master", "Mastercard"),
    ("DISC", "Discover"),
    ("Discover", "Discover"),
    ("DISCOVER", "Discover"),
    ("discover", "Discover"),
    ("DIS", "Discover"),
    ("D", "Discover"),
    ("NULL", "Unknown"),
    ("null", "Unknown"),
    ("N/A", "Unknown"),
    ("NA", "Unknown"),
]

# Boolean words (C22), compared after lower-casing only (no trim).
TRUE_WORDS = ["y", "yes", "true", "t"]
FALSE_WORDS = ["n", "no", "f", "false"]

# Date formats (C5), tried in this order; each is gated by its own regex.
# (gate regex, Python strptime format, Spark datetime pattern)
DATE_FORMATS = [
    (r"^\d{14}$", "%Y%m%d%H%M%S", "yyyyMMddHHmmss"),
    (r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d", "yyyy-MM-dd"),
    (r"^\d{4}/\d{2}/\d{2}$", "%Y/%m/%d", "yyyy/MM/dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "%m/%d/%Y", "MM/dd/yyyy"),
    (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$", "%m/%d/%Y %H:%M", "MM/dd/yyyy HH:mm"),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}$", "%Y/%m/%d %H:%M", "yyyy/MM/dd HH:mm"),
    (r"^\d{2}-[A-Za-z]{3}-\d{2}$", "%d-%b-%y", "dd-MMM-yy"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4}$", "%d-%b-%Y", "dd-MMM-yyyy"),
    (r"^[A-Za-z]{3}-\d{2}-\d{4}$", "%b-%d-%Y", "MMM-dd-yyyy"),
    (r"^[A-Za-z]{3} \d{2} \d{4}$", "%b %d %Y", "MMM dd yyyy"),
    (r"^\d{4}$", "%Y", "yyyy"),
    (r"^\d{1,2} [A-Za-z]+ \d{4}$", "%d %B %Y", "d MMMM yyyy"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "%B %d, %Y", "MMMM d, yyyy"),
]
# Short month names, compared after lower-casing.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Two-digit years 69-99 belong to the 1900s, 00-68 to the 2000s.
TWO_DIGIT_YEAR_PIVOT = 69

# Identifier patterns: the row filter (R3) and the per-column check (C1).
ROW_ID_PATTERN = r"^ID-\d{8}$"
COLUMN_ID_PATTERN = r"^(ID|L)-\d{8}$"

# E-mail pattern (C7); the last class lists "-" and "." as plain characters.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.\-]+$"

# --- end of fixed values ----------------------------------------------------


def state_pairs() -> list[tuple[str, str]]:
    """Keys for the state lookup: each abbreviation and each upper-cased name."""
    pairs = [(abbr, name) for abbr, name in US_STATES]
    pairs += [(name.upper(), name) for _, name in US_STATES]
    return pairs


def employment_pairs() -> list[tuple[str, str]]:
    """Lower-case status -> display form: title case, or capitalized if hyphenated."""
    return [(s, s.capitalize() if "-" in s else s.title()) for s in EMPLOYMENT_STATUSES]
