"""Column functions with fixed arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

VARCHAR_MAX = 65535


def part_price_cents(part_key: Column) -> Column:
    """Retail price of a part in cents, from its key."""
    return F.lit(90000) + F.floor(part_key / 10) % 20001 + (part_key % 1000) * 100


def sparse_order_key(index: Column) -> Column:
    """Keep the low 3 bits of an order number and move the rest 2 bits up."""
    return F.shiftleft(F.shiftright(index, 3), 5) + index.bitwiseAND(F.lit(7))


def clerk_label(number: Column) -> Column:
    return F.format_string("Clerk#%09d", number)


def varchar(value: Column, length: int) -> Column:
    """Strings longer than ``length`` characters are cut, not refused."""
    if not 1 <= length <= VARCHAR_MAX:
        raise ValueError(f"varchar length must be 1..{VARCHAR_MAX}")
    return F.substring(value, 1, length)


def decimal_or_null(value: Column, precision: int, scale: int) -> Column:
    """The value as decimal(precision, scale), null where it does not fit."""
    if not 1 <= precision <= 38 or not 0 <= scale <= precision:
        raise ValueError("precision must be 1..38 and scale 0..precision")
    return value.try_cast(f"decimal({precision},{scale})")


def us_timestamp(text: Column) -> Column:
    """``MM/dd/yyyy HH:mm:ss`` to a timestamp, null where malformed."""
    return F.try_to_timestamp(text, F.lit("MM/dd/yyyy HH:mm:ss"))


def iso_date(text: Column) -> Column:
    return text.try_cast("date")
