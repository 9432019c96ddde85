"""Typed parsing, filters and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Supplier ids that mark a missing identity, and the prefix for foreign suppliers.
SENTINEL_IDS = ["-11", "-2"]
SENTINEL_PREFIX = "ESTRANG"

# Fixed value: a quantity times unit value above this is a data-entry error, not a purchase.
PLAUSIBILITY_CUT = 1_000_000_000


def br_decimal(c: Column) -> Column:
    """Decimal with a comma, no thousands separator; anything else is null."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(18,4)")


def br_date(c: Column) -> Column:
    """dd/MM/yyyy; empty or impossible dates are null."""
    return F.try_to_date(c, "d/M/yyyy")


def lenient_int(c: Column) -> Column:
    return c.try_cast("int")


def yes_flag(c: Column) -> Column:
    return F.trim(c) == F.lit("SIM")


def is_identity(c: Column) -> Column:
    """True for a supplier id that names somebody; null ids give null, so a filter drops them."""
    return ~c.isin(SENTINEL_IDS) & ~c.startswith(SENTINEL_PREFIX)


def non_empty(c: Column) -> Column:
    return c.isNotNull() & (F.length(c) > 0)


def is_plausible(quantity: Column, unit_value: Column, cut: float = PLAUSIBILITY_CUT) -> Column:
    """Null products are plausible; the cut itself is included."""
    product = quantity * unit_value
    return product.isNull() | (product <= F.lit(cut))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, null unless den is positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def at_least_zero(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


def series_key(grouping: str, code: Column | None = None) -> Column:
    return F.lit(grouping) if code is None else F.concat_ws(":", F.lit(grouping), code)


def null_string() -> Column:
    return F.lit(None).cast("string")


def uniform(*parts: Column) -> Column:
    """Reproducible number in [0, 1) from the text of ``parts``: 52 bits of their MD5."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)
