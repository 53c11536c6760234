"""Lenient readings of text: what cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and the control characters that scripting languages strip as well.
_SPACE = r"[\s\x1c-\x1f]"
_EDGE_SPACE = rf"(?U)^{_SPACE}+|{_SPACE}+$"
_DIGITS = "[0-9]+(?:_[0-9]+)*"
# Decimal notation as scripting languages read it, single underscores between digits included.
_CODE = rf"(?iU)^{_SPACE}*([+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?){_SPACE}*$"
_PLAIN_DECIMAL = r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"
_WHOLE = r"^[+-]?[0-9]+(\.0*)?$"


def squish(c: str | Column) -> Column:
    """Without white space of any kind at both ends."""
    column = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(column, _EDGE_SPACE, "")


def same_text(c: str | Column) -> Column:
    """Trimmed and lower-cased, for comparison."""
    return F.lower(squish(c))


def number(c: str) -> Column:
    """Double from text. Spark's own cast would also take ``1d`` or ``1f``; those are not numbers here."""
    text = squish(c)
    return F.when(text.rlike(_PLAIN_DECIMAL) | text.rlike(_INFINITY), text.try_cast("double"))


def whole_number(c: str, strict: bool = True) -> Column:
    """Long from text, ``3`` and ``3.0`` alike. Other text fails if ``strict``, else becomes NULL."""
    text = squish(c)
    digits = F.regexp_replace(text, r"\.0*$", "")
    if strict:
        return F.when(text.rlike(_WHOLE), digits).otherwise(text).cast("bigint")
    return F.when(text.rlike(_WHOLE), digits.try_cast("bigint"))


def payment_method(c: str) -> Column:
    """Credit, Cash or Other from free text or a code.

    Words come before codes, and card words before cash words. A code is cut to its whole part:
    1 is Credit, 2 is Cash. NULL, blank and everything unread is Other.
    """
    raw = F.col(c).cast("string")
    text = F.lower(raw)
    digits = F.replace(F.regexp_extract(raw, _CODE, 1), F.lit("_"), F.lit(""))
    code = F.when(raw.rlike(_CODE), digits.try_cast("double"))
    return (
        F.when(text.contains("credit") | text.contains("card"), "Credit")
        .when(text.contains("cash"), "Cash")
        .when((code >= 1) & (code < 2), "Credit")
        .when((code >= 2) & (code < 3), "Cash")
        .otherwise("Other")
    )
