"""Column expressions used by the marts and by the file checks."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.schema import MANDATORY, MONEY

# Fixed value: what the best seller of a store and month is paid, as a share of the month's total.
INCENTIVE_RATE = Decimal("0.01")


def sales_month(date: str | Column) -> Column:
    """``yyyy-MM`` of a date: the first seven characters of its text form."""
    text = (F.col(date) if isinstance(date, str) else date).cast("string")
    return F.substring(text, 1, 7)


def full_name(first: str | Column, last: str | Column) -> Column:
    """First and last name with a space between; null when either is null."""
    return F.concat(first, F.lit(" "), last)


def incentive(total: str | Column, is_best: Column) -> Column:
    """One per cent of the total for the best seller, rounded half up to cents; 0 for the rest.

    A best seller whose total is null gets a null incentive.
    """
    total = F.col(total) if isinstance(total, str) else total
    paid = F.when(is_best, total * F.lit(INCENTIVE_RATE)).otherwise(F.lit(Decimal(0)))
    return F.round(paid, 2).cast(MONEY)


def _names(columns: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns])


def missing_columns(header: str | Column, mandatory: Sequence[str] = MANDATORY) -> Column:
    """Mandatory names a header lacks (order of the mandatory list, case-sensitive)."""
    return F.array_except(_names(mandatory), header)


def extra_columns(header: str | Column, mandatory: Sequence[str] = MANDATORY) -> Column:
    """Names in a header that are not mandatory, in header order."""
    return F.array_except(header, _names(mandatory))


def pack_extras(extras: Sequence[str | Column]) -> Column:
    """Values of the extra columns joined by commas.

    Null values are skipped, so all null gives the empty string; no extra column at all gives null.
    """
    if not extras:
        return F.lit(None).cast("string")
    return F.concat_ws(",", *[F.col(_quoted(c)) if isinstance(c, str) else c for c in extras])


def pack_extras_json(extras: Sequence[str]) -> Column:
    """Like ``pack_extras`` but keeps which column a value came from, as a JSON object."""
    if not extras:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*[F.col(_quoted(c)) for c in extras]))


def _quoted(name: str) -> str:
    """A column name Spark takes literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def plain_path(encoded: str | Column) -> Column:
    """The file path behind the percent-encoded form that ``_metadata.file_path`` holds."""
    encoded = F.col(encoded) if isinstance(encoded, str) else encoded
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def base_name(path: str | Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
