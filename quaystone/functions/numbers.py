"""Money, ratio and rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaystone.functions.text import _col, strip_all

MONEY = "decimal(18,2)"
UNITS = "decimal(18,0)"
RATE = "decimal(18,6)"


def parse_number(c) -> Column:
    """Money / percent text -> DOUBLE.

    Thousands separators ',' and '，' are removed, trailing '%' divides by 100,
    a whole cell '/' or unparsable text gives 0.0 (so does an overflowing literal)."""
    text = F.coalesce(strip_all(c), F.lit(""))
    return number_value(number_digits(text), text)


def number_digits(text: Column) -> Column:
    """The literal of a stripped money / percent text."""
    bare = F.replace(F.replace(text, F.lit(","), F.lit("")), F.lit("，"), F.lit(""))
    return strip_all(F.rtrim(bare, F.lit("%")))


def number_value(digits: Column, text: Column) -> Column:
    """:func:`parse_number` of a stripped text and its :func:`number_digits`, which are looked at several times: with many
    columns they belong into projections of their own."""
    value = F.coalesce(plain_number(digits), F.lit(0.0))
    value = F.when(F.abs(value) != F.lit(float("inf")), value).otherwise(F.lit(0.0))
    # one reference to the value: the percent case divides by 100, others by 1 (exact)
    return value / F.when(text.endswith("%"), F.lit(100.0)).otherwise(F.lit(1.0))


def plain_number(text: Column) -> Column:
    """DOUBLE of a stripped plain decimal literal with optional exponent, NULL for any other text.

    Texts compare by their bytes, so two comparisons read the first character (a sign, point or digit) and two the last (a point
    or digit). With both and without an x nothing but a decimal literal is left that the cast takes: suffixes, NaN, Infinity and
    hexadecimals are gone, and few of the texts that it refuses, at the price of an exception each, reach it."""
    last = F.right(text, F.lit(1))
    literal = ((text >= F.lit("+")) & (text < F.lit(":")) & (last >= F.lit(".")) & (last < F.lit(":"))
               & ~text.contains("x") & ~text.contains("X"))
    return F.when(literal, text.try_cast("double"))


def stripped_int(text: Column) -> Column:
    """:func:`parse_int_text` of a stripped text."""
    return plain_number(text).try_cast("int")


def without_commas(c) -> Column:
    return strip_all(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))


def parse_decimal_text(c) -> Column:
    """Importer number: commas removed, unparsable -> NULL (no percent rule)."""
    return plain_number(without_commas(c))


def parse_int_text(c) -> Column:
    """Importer integer: int(float(text)), commas are NOT removed."""
    return stripped_int(strip_all(c))


def to_money(c) -> Column:
    return _col(c).cast(MONEY)


def round_units(c) -> Column:
    """Whole currency units, HALF_UP (ties away from zero)."""
    return F.round(_col(c).cast("decimal(38,6)"), 0).cast(UNITS)


def rate(numerator, denominator) -> Column:
    """numerator / denominator to 6 places HALF_UP; NULL when the denominator is 0."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d != 0, F.round(n.cast("decimal(28,6)") / d.cast("decimal(28,6)"), 6).cast(RATE))


def growth_rate(current, prior) -> Column:
    """current / prior - 1 to 6 places HALF_UP; NULL when prior is 0."""
    n, d = _col(current), _col(prior)
    return F.when(d != 0, F.round(n.cast("decimal(28,6)") / d.cast("decimal(28,6)") - F.lit(1), 6).cast(RATE))
