from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rare import rarely

_NUMBER = r"^\s*([+-]?)(?:([0-9]+)\.?([0-9]*)|\.([0-9]+))(?:[eE]([+-]?[0-9]+))?\s*\z"
_PARTS = "$1;$2;$3$4;$5"
# Integers that a cast takes, with blanks and control characters around them: those that surely fit, and all. A cast that fails
# makes an exception with its message, which costs far more than the pattern.
_SHORT = r"^[\x00-\x20\x7f]*[+-]?[0-9]{1,18}[\x00-\x20\x7f]*\z"
_PLAIN = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*\z"
# Digits of the largest 64-bit integer.
_DIGITS = 19


def _whole(parts: Column) -> Column:
    """64-bit value of a number that is whole, by its digits and the place of its point: exact at any length. ``parts`` are
    sign, digits before and after the point, and exponent; NULL for fractions and numbers out of range."""
    sign, before, after, exponent = (F.get(parts, F.lit(i)) for i in range(4))
    digits = F.concat(before, after)
    leading = F.length(digits) - F.length(F.ltrim(digits, F.lit("0")))
    significant = F.trim(digits, F.lit("0"))
    power = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))
    point = F.length(before).cast("long") + power - leading
    fits = (F.length(significant) <= point) & (point <= _DIGITS)
    size = F.least(point, F.lit(_DIGITS)).cast("int")
    value = F.concat(F.when(sign == "-", sign).otherwise(""), F.rpad(significant, size, "0"))
    return F.when(significant == "", F.lit(0).cast("bigint")).when(fits, value.try_cast("bigint"))


def _judged(value: Column, unusable: Column) -> Column:
    return F.struct(value.alias("value"), unusable.alias("unusable"))


def _judge(text: Column) -> Column:
    """The same of a text that is no short integer."""
    plain = F.when(text.rlike(_PLAIN), text.try_cast("bigint"))
    parts = F.split(F.regexp_replace(text, _NUMBER, _PARTS), ";")
    number = rarely(rarely(parts, _whole), lambda value: _judged(value, value.isNull()))
    other = _judged(F.lit(None).cast("bigint"), text.rlike(_INFINITE))
    return F.when(plain.isNotNull(), _judged(plain, F.lit(False))).when(text.rlike(_NUMBER), number).otherwise(other)


def judge_number(text: Column) -> Column:
    """Struct of the value of a lenient 64-bit integer and whether the text is a number that no such integer holds."""
    settled = _judged(text.try_cast("bigint"), F.lit(False))
    return F.when(text.isNull() | text.rlike(_SHORT), settled).otherwise(rarely(text, _judge))


def to_bigint(text: Column) -> Column:
    """Lenient 64-bit integer: ``' 200 '``, ``'200.0'`` and ``'1e3'`` count, anything else is NULL."""
    short = F.when(text.rlike(_SHORT), text.try_cast("bigint"))
    return short.when(text.isNotNull(), rarely(text, _judge)["value"])


def is_unusable_number(text: Column) -> Column:
    """True for text that is a number but no 64-bit integer: a fraction, infinity, or out of range."""
    return F.when(text.isNull() | text.rlike(_SHORT), False).otherwise(rarely(text, _judge)["unusable"])
