"""Sums of integers beyond 38 digits, exact and without Python: five limbs of 18 digits, summed as decimals, then carried."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMBS, DIGITS = 5, 18
_BASE = 10**DIGITS


def limb(value: Column, k: int) -> Column:
    """The k-th limb from the right of a non-negative decimal string. Text that is no integer of up to 78 digits raises."""
    checked = F.when(value.rlike("^[0-9]{1,78}$"), value).otherwise(F.raise_error(F.concat(F.lit("not an unsigned integer of up to 78 digits: "), value)).cast("string"))
    padded = F.lpad(checked, LIMBS * DIGITS, "0")
    return F.when(value.isNotNull(), F.substring(padded, 1 + DIGITS * (LIMBS - 1 - k), DIGITS).cast(f"decimal({DIGITS},0)"))


def render(limbs: list[Column]) -> Column:
    """Limb sums, least first, as one decimal string; null if the least is."""
    out, carry = [], F.lit(0).cast("decimal(38,0)")
    for total in limbs[:-1]:
        value = (total.cast("decimal(38,0)") + carry).cast("decimal(38,0)")
        rest = (value % F.lit(_BASE).cast("decimal(19,0)")).cast("decimal(18,0)")
        out.append(F.lpad(rest.cast("string"), DIGITS, "0"))
        carry = ((value - rest).cast("decimal(38,0)") / F.lit(_BASE).cast("decimal(19,0)")).cast("decimal(38,0)")  # leaves no rest, so nothing is rounded
    top = (limbs[-1].cast("decimal(38,0)") + carry).cast("string")
    return F.regexp_replace(F.concat(top, *out[::-1]), "^0+(?=.)", "")


def wide_sum(value: str | Column) -> Column:
    """Aggregate: the exact sum of decimal strings, as a string. Nulls are skipped; nothing but nulls gives null."""
    c = F.col(value) if isinstance(value, str) else value
    return render([F.sum(limb(c, k)) for k in range(LIMBS)])
