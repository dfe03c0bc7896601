"""Id columns: hashed review ids and page fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A hashed id is yyyyMMddHHmm followed by 1 to 4 digits.
STAMP_DATE_FORMAT = "yyyyMMdd"
STAMP_TIME_FORMAT = "HHmm"
STAMP_LENGTH = 12
MIN_HASHED_ID_LENGTH = 13
MAX_HASHED_ID_LENGTH = 16


def sha256_digits(text: Column, digits: int) -> Column:
    """SHA-256 of a text as a 256-bit integer modulo ``10**digits``, left-padded with zeros.

    The hex digest is taken in words of 48 bits; the running remainder stays below 10**4 * 2**48,
    so 64-bit arithmetic is exact and everything is generated code.
    """
    if not 1 <= digits <= 4:
        raise ValueError(f"1 to 4 digits, got {digits}")
    digest = F.sha2(text, 256)
    modulus = F.lit(10**digits).cast("bigint")
    rest = F.lit(0).cast("bigint")
    for start in range(0, 64, 12):
        width = min(12, 64 - start)
        word = F.conv(F.substring(digest, start + 1, width), 16, 10).cast("bigint")
        rest = (rest * F.lit(16**width).cast("bigint") + word) % modulus
    return F.lpad(rest.cast("string"), digits, "0")


def hashed_review_id(review_id: Column, date: Column, time: Column, length: int) -> Column:
    """``date`` and ``time`` are parsed columns; the result has ``length`` digits."""
    if not MIN_HASHED_ID_LENGTH <= length <= MAX_HASHED_ID_LENGTH:
        raise ValueError(
            f"hashed id length must be between {MIN_HASHED_ID_LENGTH} and {MAX_HASHED_ID_LENGTH}, got {length}"
        )
    return F.concat(
        F.date_format(date, STAMP_DATE_FORMAT),
        F.date_format(time, STAMP_TIME_FORMAT),
        sha256_digits(review_id.cast("string"), length - STAMP_LENGTH),
    )


def page_fingerprint(ids: Column) -> Column:
    """Hash of the sorted distinct ids of one page; ``ids`` is an array of one page's ids."""
    return F.sha2(F.concat_ws(",", F.array_sort(F.array_distinct(ids)).cast("array<string>")), 256)
