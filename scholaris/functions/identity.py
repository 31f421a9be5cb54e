"""Identifiers: formatting, pseudonyms, e-mail form and removal of personal columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaris.functions.numeric import _col
from scholaris.settings import PII_FIELDS

# Fixed value: what counts as an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def padded_id(prefix: str, number, width: int) -> Column:
    """Prefix and zero-padded number; a number wider than `width` is kept whole."""
    digits = _col(number).cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(digits) > width, digits).otherwise(F.lpad(digits, width, "0"))
    )


def pseudonym(value, salt: str, length: int = 16) -> Column:
    """First hex digits of SHA-256 over value and salt; null stays null.

    16 digits are 64 bits: ask for more where billions of ids must not collide.
    """
    return F.substring(F.sha2(F.concat(_col(value).cast("string"), F.lit(salt)), 256), 1, length)


def valid_email(c) -> Column:
    return F.coalesce(_col(c).rlike(EMAIL_PATTERN), F.lit(False))


def without_pii(df: DataFrame, names=PII_FIELDS) -> DataFrame:
    listed = {name.lower() for name in names}
    return df.drop(*[c for c in df.columns if c.lower() in listed])
