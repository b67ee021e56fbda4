"""Scalar column builders of the mart (NUM-1, NUM-2, CASE-2/3, PRD-2/3, STR-2/3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_TEXT = r"\A[+-]?[0-9]+\z"
_DECIMAL_TEXT = r"\A\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)\s*\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_int(c, what: str = "value") -> Column:
    """NUM-1 / UDF-1.  Text to INT the way a strict integer parse does it: optional sign and
    digits only, within INT range; anything else (NULL, blank, '12.5',
    ' 5', overflow) fails the query.  Not registered as a UDF: the built-in
    ``to_number`` has another meaning and must not be shadowed."""
    c = _col(c)
    parsed = c.try_cast("int")
    return F.when(c.rlike(_INT_TEXT) & parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit(f"not an integer {what}: "),
                               F.coalesce(c, F.lit("NULL")))))


def to_double(c) -> Column:
    """Lenient text to DOUBLE: malformed gives NULL (text + text arithmetic)."""
    return _col(c).try_cast("double")


def tail_from(c, pos: int = 2) -> Column:
    """substr(x, pos): the text from position ``pos`` on (PRJ-5 / STR-2)."""
    return F.substr(_col(c), F.lit(pos))


def last_chars(c, n: int = 4) -> Column:
    """The last ``n`` characters; a shorter text comes back whole (STR-3)."""
    return F.substr(_col(c), F.lit(-n))


def signed_fee(fee_text, base, letter: str) -> Column:
    """CASE-2 / CASE-3 (NUM-2).  If the fee text starts with ``letter`` the
    printed fee is added to the base fee, otherwise the base fee alone
    (strictly parsed); DOUBLE."""
    fee_text, base = _col(fee_text), _col(base)
    return (F.when(F.substr(fee_text, F.lit(1), F.lit(1)) == letter,
                   to_double(tail_from(fee_text, 2)) + to_double(base))
            .otherwise(strict_int(base, "fee").cast("double")))


def null_flag(c) -> Column:
    """'0' when NULL, else '1'."""
    return F.when(_col(c).isNull(), "0").otherwise("1")


def equals_flag(c, value: str) -> Column:
    """'1' when equal, else '0' (NULL gives '0')."""
    return F.when(_col(c) == value, "1").otherwise("0")


def status_is_not(c, value: int) -> Column:
    """Numeric inequality on a status held as text, decimals cut off ('1.0' is 1); malformed or
    NULL -> NULL (the row drops in a filter)."""
    c = _col(c)
    whole = F.when(c.cast("string").rlike(_DECIMAL_TEXT), c.try_cast("double").try_cast("int"))
    return F.coalesce(c.try_cast("int"), whole) != value
