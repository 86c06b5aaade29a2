"""Column names, types and fixed values of the transaction-line data model.

A raw transaction line has eight columns.  ``clean_lines`` adds the derived
"fact line" columns.  Money is carried as an exact DECIMAL so that sums and
the rankings built on them do not depend on the order Spark adds rows in.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw input columns (names are part of the public contract).
INVOICE = "InvoiceNo"
STOCK = "StockCode"
DESCRIPTION = "Description"
QUANTITY = "Quantity"
INVOICE_DATE = "InvoiceDate"
UNIT_PRICE = "UnitPrice"
CUSTOMER = "CustomerID"
COUNTRY = "Country"

RAW_COLUMNS = [INVOICE, STOCK, DESCRIPTION, QUANTITY, INVOICE_DATE, UNIT_PRICE, CUSTOMER, COUNTRY]

RAW_SCHEMA = T.StructType(
    [
        T.StructField(INVOICE, T.StringType(), True),
        T.StructField(STOCK, T.StringType(), True),
        T.StructField(DESCRIPTION, T.StringType(), True),
        T.StructField(QUANTITY, T.LongType(), True),
        T.StructField(INVOICE_DATE, T.TimestampNTZType(), True),
        T.StructField(UNIT_PRICE, T.DoubleType(), True),
        T.StructField(CUSTOMER, T.LongType(), True),
        T.StructField(COUNTRY, T.StringType(), True),
    ]
)

# Columns a line must have to survive cleaning.
REQUIRED_COLUMNS = [INVOICE, STOCK, UNIT_PRICE, QUANTITY]

# Derived fact-line columns.
TYPE = "type"
MONTH = "month"
ORDER_DATE = "order_date"

# Exact money: unit prices are held with this many decimals (18 digits in
# all); ``clean_lines`` takes another scale, which every later step reads from
# the fact lines' own type.
MONEY_SCALE = 8

# --- fixed values -----------------------------------------------------------
# Transaction types, in the order the classification rules are tried.
TYPE_FEE = "FEE"
TYPE_BANK_CHARGE = "BANK_CHARGE"
TYPE_MANUAL = "MANUAL"
TYPE_DISCOUNT = "DISCOUNT"
TYPE_POSTAGE = "POSTAGE"
TYPE_SAMPLES = "SAMPLES"
TYPE_RETURN = "RETURN"
TYPE_PRODUCT = "PRODUCT"

# Types counted as non-merchandise adjustments.
NON_MERCH_TYPES = ["FEE", "BANK_CHARGE", "MANUAL", "DISCOUNT", "POSTAGE", "SAMPLES"]

# Classification rules, tried in this order; the first that matches wins.
# Each rule: (type, stock codes that match exactly, description substrings).
# Stock codes and invoices are compared after upper-casing and stripping white
# space; descriptions after upper-casing.
CLASSIFY_RULES = [
    ("FEE", ["AMAZONFEE"], ["AMAZON FEE"]),
    ("FEE", ["CRUK"], ["CRUK COMMISSION"]),
    ("BANK_CHARGE", ["BANK CHARGES"], ["BANK CHARGES"]),
    ("MANUAL", ["M"], ["MANUAL"]),
    ("DISCOUNT", ["D"], ["DISCOUNT"]),
    ("POSTAGE", [], ["POSTAGE"]),
    ("SAMPLES", [], ["SAMPLES"]),
]
# An invoice starting with this letter (after upper/strip) marks a return.
RETURN_INVOICE_PREFIX = "C"

# Text tokens that a CSV reader must read as missing (the pandas defaults).
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Characters Python's str.strip() removes (str.isspace is true for these),
# as code points.
PY_WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
PY_WHITESPACE = "".join(chr(c) for c in PY_WHITESPACE_CODEPOINTS)
# ---------------------------------------------------------------------------
