from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character, so that tabs and no-break spaces go too.
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())

# CSV field texts that mean "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that count as a missing invoice once stripped.
MISSING_TEXTS = ("", "nan", "None")


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends; plain `trim` only removes spaces.

    The cost grows with the set of characters, so all-ASCII text takes the short one.
    """
    is_ascii = F.octet_length(c) == F.char_length(c)
    return F.when(is_ascii, F.trim(c, F.lit(ASCII_WHITESPACE))).otherwise(F.trim(c, F.lit(WHITESPACE)))


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def is_missing_text(c: Column) -> Column:
    return c.isNull() | strip(c).isin(*MISSING_TEXTS)


def is_blank(c: Column) -> Column:
    """The SQL rule: NULL, or nothing left after trimming spaces."""
    return c.isNull() | (F.trim(c) == "")
