"""Date and time columns. Times of day are ``HH:mm:ss`` text, moments are zone-free."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epochs above the first are milliseconds; above the second they are divided by
# 1000 and read as seconds; all others are seconds.
EPOCH_MILLIS_ABOVE = 1e12
EPOCH_SCALED_ABOVE = 1e10
# Default formats, and the day that serial number 0 stands for.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH:mm:ss"
SERIAL_EPOCH = "1899-12-30"


def parse_timestamp(col: Column, data_type: T.DataType) -> Column:
    """Epoch number, text, date or timestamp to a zone-free timestamp; null where it is none."""
    if isinstance(data_type, T.IntegralType):
        n = col.cast("bigint")
        moment = (
            F.when(n > EPOCH_MILLIS_ABOVE, F.timestamp_millis(n))
            .when(n > EPOCH_SCALED_ABOVE, F.timestamp_seconds(F.floor(n / 1000)))
            .otherwise(F.timestamp_seconds(n))
        )
    elif isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        x = col.cast("double")
        moment = (
            F.when(F.isnan(x), F.lit(None).cast("timestamp"))
            .when(x > EPOCH_MILLIS_ABOVE, F.timestamp_micros(F.round(x * 1000).cast("bigint")))
            .when(x > EPOCH_SCALED_ABOVE, F.timestamp_seconds(F.floor(x / 1000)))
            .otherwise(F.timestamp_micros(F.round(x * 1000000).cast("bigint")))
        )
    elif isinstance(data_type, T.StringType):
        moment = col.try_cast("timestamp")
    else:
        moment = col
    return moment.cast("timestamp_ntz")


def date_part(moment: Column) -> Column:
    return F.to_date(moment)


def time_part(moment: Column) -> Column:
    return F.date_format(moment, TIME_FORMAT)


def parse_time_of_day(col: Column) -> Column:
    """``HH:mm:ss`` text (or a full timestamp text) to a timestamp; null where it is none."""
    text = col.cast("string")
    return F.coalesce(F.try_to_timestamp(text, F.lit(TIME_FORMAT)), text.try_cast("timestamp"))


def _or_error(parsed: Column, raw: Column, what: str) -> Column:
    return F.when(
        raw.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"invalid {what}: "), raw.cast("string"))),
    ).otherwise(parsed)


def strict_date(col: Column) -> Column:
    """Text to date; a value that is no date is an error, null stays null."""
    return _or_error(col.try_cast("date"), col, "date")


def strict_time(col: Column) -> Column:
    """Text to ``HH:mm:ss``; a value that is no time is an error, null stays null."""
    return _or_error(time_part(parse_time_of_day(col)), col, "time")


def date_to_text(col: Column) -> Column:
    return F.date_format(col, DATE_FORMAT)


def day_fraction_to_text(serial: Column) -> Column:
    """Spreadsheet serial number (days since 1899-12-30, fraction = time of day) to ``HH:mm:ss``."""
    seconds = F.round(serial.cast("double") * 86400).cast("bigint")
    return F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(f"{SERIAL_EPOCH} 00:00:00")) + seconds), TIME_FORMAT)


def join_date_and_time(date: Column, time: Column, delimiter: str = " ") -> Column:
    """Both texts joined, after checking that each has its format."""
    date_ok = F.try_to_timestamp(date, F.lit(DATE_FORMAT))
    time_ok = F.try_to_timestamp(time, F.lit(TIME_FORMAT))
    return F.when(
        date_ok.isNull() | time_ok.isNull(),
        F.raise_error(F.concat(F.lit("invalid date or time: "), F.coalesce(date, F.lit("null")), F.lit(delimiter), F.coalesce(time, F.lit("null")))),
    ).otherwise(F.concat(date, F.lit(delimiter), time))


# What a directive of a format stands for. Numbers may lack a leading zero.
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_DIRECTIVES = {
    "Y": r"\d{4}",
    "y": r"\d{2}",
    "m": r"1[0-2]|0?[1-9]",
    "d": r"3[01]|[12]\d|0?[1-9]",
    "j": r"36[0-6]|3[0-5]\d|[12]\d{2}|0?[1-9]\d|0{0,2}[1-9]",
    "H": r"2[0-3]|[01]?\d",
    "I": r"1[0-2]|0?[1-9]",
    "M": r"[0-5]?\d",
    "S": r"[0-5]?\d",
    "f": r"\d{1,6}",
    "p": "am|pm",
    "B": "|".join(_MONTHS),
    "b": "|".join(m[:3] for m in _MONTHS),
    "A": "|".join(_DAYS),
    "a": "|".join(d[:3] for d in _DAYS),
}
ISO_DATE, ISO_TIME = "%Y-%m-%d", "%H:%M:%S"


def _compiled(fmt: str) -> tuple[str, list[str]]:
    """The pattern of a format and the directive of each of its groups. White space stands for any amount of it."""
    pattern, groups, rest = "", [], fmt
    while rest:
        if rest[0] == "%":
            directive, rest = rest[1:2], rest[2:]
            if directive == "%":
                pattern += "%"
            elif directive not in _DIRECTIVES:
                raise ValueError(f"unknown directive %{directive} in {fmt!r}")
            elif directive in groups:
                raise ValueError(f"%{directive} stands twice in {fmt!r}")
            else:
                groups.append(directive)
                pattern += f"({_DIRECTIVES[directive]})"
        elif rest[0].isspace():
            rest = rest.lstrip()
            pattern += r"\s+"
        else:
            pattern, rest = pattern + re.escape(rest[0]), rest[1:]
    return f"(?i)^(?:{pattern})$", groups


def _fields(col: Column, fmt: str) -> tuple[Column, dict[str, Column]]:
    """Whether a text has the format, and its fields by directive."""
    pattern, groups = _compiled(fmt)
    return col.rlike(pattern), {g: F.regexp_extract(col, pattern, i) for i, g in enumerate(groups, 1)}


def parse_date_by_format(col: Column, fmt: str = ISO_DATE) -> Column:
    """Text to date by a format of ``%`` directives; a text without it, or a day that does not exist, is an error, and null stays null.

    Parts that the format lacks are those of 1900-01-01. Two digits of a year from 69 on are of the last century.
    """
    fits, found = _fields(col, fmt)
    number = {d: found[d].try_cast("int") for d in "Yymdj" if d in found}
    year = number.get("Y", F.lit(1900))
    if "Y" not in found and "y" in found:
        year = number["y"] + F.when(number["y"] < 69, F.lit(2000)).otherwise(F.lit(1900))
    month = number.get("m", F.lit(1))
    for directive, width in (("B", None), ("b", 3)):
        if directive in found and "m" not in found:
            month = F.array_position(F.array(*[F.lit(m[:width]) for m in _MONTHS]), F.lower(found[directive])).cast("int")
    text = F.format_string("%04d-%02d-%02d", year, month, number.get("d", F.lit(1)))
    day = text.try_cast("date")
    if "j" in found and not {"m", "d", "B", "b"} & set(found):
        day = F.date_add(F.format_string("%04d-01-01", year).try_cast("date"), number["j"] - 1)
    return _or_error(F.when(fits, day), col, "date")


def parse_time_by_format(col: Column, fmt: str = ISO_TIME) -> Column:
    """Text to ``HH:mm:ss`` by a format of ``%`` directives, with six more digits if the format has ``%f``; errors as for dates."""
    fits, found = _fields(col, fmt)
    number = {d: found[d].try_cast("int") for d in "HIMS" if d in found}
    hour = number.get("H", F.lit(0))
    if "H" not in found and "I" in found:
        afternoon = F.lower(found["p"]) == "pm" if "p" in found else F.lit(False)
        hour = number["I"] % 12 + F.when(afternoon, F.lit(12)).otherwise(F.lit(0))
    text = F.format_string("%02d:%02d:%02d", hour, number.get("M", F.lit(0)), number.get("S", F.lit(0)))
    if "f" in found:
        text = F.concat(text, F.lit("."), F.rpad(found["f"], 6, "0"))
    return _or_error(F.when(fits, text), col, "time")
