"""Column expressions for lenient cleaning. Nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that mean "missing" in a delimited file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Every character that counts as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NUMBER_PATTERN = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of every kind (`trim` drops blanks only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def na_tokens_to_null(col: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the column is a floating-point number."""
    col = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def to_number(col: Column, data_type: T.DataType) -> Column:
    """Double, or null when the cell is no number. Texts must match a plain number.

    The pattern keeps Java's own suffixes (`1d`, `2f`) from being read as numbers.
    """
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = col.cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(data_type, T.StringType):
        text = strip(col)
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    return F.lit(None).cast("double")


def finite(col: Column) -> Column:
    return F.when(~F.isnan(col) & (F.abs(col) != F.lit(float("inf"))), col)


def in_bounds(col: Column, bounds: tuple[float, float] | None) -> Column:
    """Keep finite values inside the closed interval; everything else becomes null."""
    if bounds is None:
        return finite(col)
    low, high = bounds
    return F.when(col.between(F.lit(float(low)), F.lit(float(high))), col)


def alias_value(col: Column, aliases: Mapping[str, str] | None) -> Column:
    """Whole-value, case-sensitive replacement. One literal map, one probe per row."""
    if not aliases:
        return col
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[col], col)


def canonical_text(col: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Strip, map aliases, then turn blanks into null."""
    return F.nullif(alias_value(strip(col.cast("string")), aliases), F.lit(""))


def right_closed_group(col: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Group of a value in right-closed intervals; the first includes its lower edge."""
    if len(edges) != len(names) + 1:
        raise ValueError("Need exactly one more edge than group names")
    value = F.when(~F.isnan(col.cast("double")), col.cast("double"))
    chain = F.when(value < F.lit(float(edges[0])), F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], names):
        chain = chain.when(value <= F.lit(float(upper)), F.lit(name))
    return chain


def short_number(col: Column) -> Column:
    """A double as text with six significant digits and no trailing zeros.

    4.5 -> "4.5", 250.0 -> "250", 1234567.0 -> "1.23457e+06". Halves are rounded up.
    """
    value = col.cast("double")
    scale = F.pow(F.lit(10.0), F.lit(5.0) - F.floor(F.log10(F.abs(value))))
    # six digits are an exact whole number, and its quotient prints as just those digits
    short = F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale

    def no_trailing_zeros(text: Column) -> Column:
        return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))

    scientific = F.format_string("%.5e", value)
    return (
        F.when(value == 0, F.lit("0"))
        .when(
            F.abs(short).between(0.001, 999999.5),
            F.regexp_replace(short.cast("string"), r"\.0$", ""),
        )
        .when(F.abs(short).between(0.0001, 0.001), no_trailing_zeros(F.format_string("%.9f", short)))
        .otherwise(
            F.concat(
                no_trailing_zeros(F.substring_index(scientific, "e", 1)), F.lit("e"),
                F.substring_index(scientific, "e", -1),
            )
        )
    )
