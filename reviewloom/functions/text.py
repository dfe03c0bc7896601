"""Text columns: blank tests, cleaning, default values, integer ids, token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Unicode white space that counts as blank at either end of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: control characters that a cleaned text must not contain.
CONTROL_CHARACTERS = r"[\x00-\x1F\x7F]"
# Fixed value: star rating of a review that has none.
DEFAULT_STAR_RATING = 5


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone removes spaces only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_valid(col: Column, data_type: T.DataType) -> Column:
    """True where a value is neither null nor blank."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return F.coalesce(strip(col) != "", F.lit(False))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def clean_text(col: Column) -> Column:
    """Line feeds become spaces, every other control character goes."""
    return F.regexp_replace(F.replace(col, F.lit("\n"), F.lit(" ")), CONTROL_CHARACTERS, "")


def title_contents(title: Column, contents: Column) -> Column:
    """Merge a title into the contents unless the contents already start with it."""
    t = F.coalesce(strip(title), F.lit(""))
    c = F.coalesce(strip(contents), F.lit(""))
    return (
        F.when(title.isNull() & contents.isNull(), F.lit(None).cast("string"))
        .when((t != "") & c.startswith(t), c)
        .otherwise(F.concat_ws(" ", F.nullif(t, F.lit("")), F.nullif(c, F.lit(""))))
    )


def star_default(col: Column, data_type: T.DataType) -> Column:
    """Empty or missing ratings become the default."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(F.nullif(col, F.lit("")), F.lit(str(DEFAULT_STAR_RATING)))
    return F.coalesce(col, F.lit(DEFAULT_STAR_RATING).cast(data_type))


# Numbers as text: whole ones, also with an empty fraction, of any length; any number without exponent; any number.
_WHOLE = r"^[+-]?\d+(\.0*)?$"
_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Beyond it a double doesn't tell neighbouring integers apart.
_EXACT_DOUBLE = float(1 << 53)


def is_number(col: Column, data_type: T.DataType) -> Column:
    """True where :func:`int_string_id` finds a number, or raises because it is no exact integer."""
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return col.isNotNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    source = strip(col.cast("string"))
    # plain digits, which is nearly every id, need no pattern
    return F.when(source.try_cast("bigint").isNotNull(), True).otherwise(F.coalesce(source.rlike(_NUMBER), F.lit(False)))


def int_string_id(col: Column, data_type: T.DataType) -> Column:
    """Numeric text to integer text, of any length; null where it is no number.

    A fraction, at any place, is an error, and so is a double (or a text with an exponent) that is not an exact integer.
    """
    if isinstance(data_type, T.IntegralType):
        return col.cast("string")
    error = F.raise_error(F.concat(F.lit("id is not an integer: "), col.cast("string"))).cast("string")
    if isinstance(data_type, T.DecimalType):
        return F.when(col != F.floor(col), error).otherwise(F.floor(col).cast("decimal(38,0)").cast("string"))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(col.isNotNull() & ~F.isnan(col), _exact(col.cast("double"), error))
    source = strip(col.cast("string"))
    # the digits are taken as they stand: sign and leading zeros are all that changes
    digits = F.regexp_replace(F.regexp_replace(source, r"\.0*$", ""), r"^([+-]?)0+(?=\d)", "$1")
    whole = F.when(digits.isin("-0", "+0"), "0").otherwise(F.regexp_replace(digits, r"^\+", ""))
    other = F.when(source.rlike(_PLAIN), F.when(source.rlike(r"^[+-]?\.0+$"), "0").otherwise(error)).otherwise(_exact(source.try_cast("double"), error))
    # Plain digits, which is nearly every id, need no pattern.
    return F.coalesce(source.try_cast("bigint").cast("string"), F.when(source.rlike(_WHOLE), whole).when(source.rlike(_NUMBER), other))


def _exact(number: Column, error: Column) -> Column:
    exact = (F.abs(number) <= _EXACT_DOUBLE) & (number == F.floor(number))
    return F.when(exact, number.cast("bigint").cast("string")).otherwise(error)


def whitespace_tokens(col: Column, cap: int | None = None) -> Column:
    """Number of whitespace-separated tokens, at most ``cap``; 0 for a null or blank text."""
    stripped = F.coalesce(strip(col), F.lit(""))
    count = F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, r"(?U)\s+")))
    return count if cap is None else F.least(count, F.lit(cap))
