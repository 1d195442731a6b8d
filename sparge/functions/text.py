"""Text rendering and masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The characters that Unicode counts as white space.
BLANKS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_text(value: Column, dtype: T.DataType | None = None) -> Column:
    """Plain text of a value: null is '', doubles have no exponent, lists join by comma."""
    if isinstance(dtype, T.ArrayType):
        text = F.array_join(value, ",")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = _decimal_text(value)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def _decimal_text(value: Column) -> Column:
    """The shortest digits that give the value back, written out without an exponent however small or large it is."""
    shortest = value.cast("string")
    sign = F.when(F.startswith(shortest, F.lit("-")), "-").otherwise("")
    mantissa = F.split_part(F.ltrim(shortest, F.lit("-")), F.lit("E"), F.lit(1))
    exponent = F.coalesce(F.nullif(F.split_part(shortest, F.lit("E"), F.lit(2)), F.lit("")).cast("int"), F.lit(0))
    whole = F.split_part(mantissa, F.lit("."), F.lit(1))
    # All digits, and how many of them stand before the point; that may be none or more than there are.
    digits = F.concat(whole, F.rtrim(F.split_part(mantissa, F.lit("."), F.lit(2)), F.lit("0")))
    point, size = F.length(whole) + exponent, F.length(digits)
    text = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size)))
        .otherwise(F.concat(F.left(digits, point), F.lit("."), F.substr(digits, point + 1)))
    )
    return F.when(value == 0, "0").when(shortest.rlike("^-?[0-9]"), F.concat(sign, text)).otherwise(shortest)


def mask_value(value: Column, dtype: T.DataType | None = None) -> Column:
    """Mask all but the first and last character; up to four characters are masked whole."""
    text = as_text(value, dtype)
    size = F.length(text)
    stars = F.lit("*")
    return F.when(size <= 4, F.repeat(stars, size)).otherwise(
        F.concat(F.left(text, F.lit(1)), F.repeat(stars, size - 2), F.right(text, F.lit(1)))
    )


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.btrim(value, F.lit(BLANKS)), F.lit(""))
