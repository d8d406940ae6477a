"""Column functions that clean contact data. All are built-in expressions, so they stay in generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and formats that decide which values count as clean.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^(\d{3})(\d{3})(\d{4})$"
PHONE_FORMAT = "($1) $2-$3"
NAME_SYMBOLS = r"[^\w\s'-]"


def clean_email(email: Column) -> Column:
    """Lower-cased address without surrounding spaces, NULL when it is no address.

    Only spaces are trimmed. A final newline passes the pattern and is kept.
    """
    address = F.trim(email)
    return F.when(address.rlike(EMAIL_PATTERN), F.lower(address))


def standardize_phone(phone: Column) -> Column:
    """Ten-digit numbers as `(XXX) XXX-XXXX`; any other value comes back as it was."""
    digits = F.regexp_replace(phone, r"\D", "")
    formatted = F.regexp_replace(digits, PHONE_PATTERN, PHONE_FORMAT)
    return F.when(F.length(digits) == 10, formatted).otherwise(phone)


def standardize_name(name: Column) -> Column:
    """Name with single spaces and without symbols, NULL when nothing is left.

    Spaces are collapsed before symbols go, so "a & b" becomes "a  b"; letters outside ASCII go too.
    """
    spaced = F.regexp_replace(name, r"\s+", " ")
    return F.nullif(F.trim(F.regexp_replace(spaced, NAME_SYMBOLS, "")), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """`first last`, or `first` alone; NULL without a first name."""
    return F.coalesce(F.concat(first, F.lit(" "), last), first)
