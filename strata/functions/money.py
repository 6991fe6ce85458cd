"""Exact money and ratio arithmetic in integer cents.

Money is carried as ``bigint`` cents through joins and sums and turned into a
double only at the output (``cents / 100``), so per-line rounding never drifts
and every engine produces the same bits.  Half-up rounding of a quotient of
non-negative integers is done with integral division (SQL ``div``):

    round_half_up(a / b, d) = (2 * a * 10^d + b) div (2 * b) / 10^d

Arguments are SQL expression strings (usually column names) because ``div``
has no Column-method spelling in PySpark; the result is a normal Column that
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: str) -> Column:
    """Double currency amount to bigint cents (half-up at the cent)."""
    return F.expr(f"cast(round(({amount}) * 100, 0) as bigint)")


def cents_to_double(cents: str) -> Column:
    """Cents to a double currency amount: ``cents / 100`` (correctly rounded)."""
    return F.expr(f"cast(({cents}) as double) / 100")


def allocate_pro_rata(part_cents: str, whole_cents: str, amount_cents: str) -> Column:
    """Share of ``amount`` carried by ``part`` of ``whole``, half-up in cents.

    Returns 0 when the whole is not positive; a NULL amount counts as zero.
    Inputs are non-negative; ``2 * part * amount`` must stay below 9.2e18.
    """
    amount = f"coalesce(cast(({amount_cents}) as bigint), 0)"
    return F.expr(
        f"case when ({whole_cents}) > 0 then "
        f"(2 * cast(({part_cents}) as bigint) * {amount} + ({whole_cents})) "
        f"div (2 * ({whole_cents})) else cast(0 as bigint) end")


def ratio_half_up(numer: str, denom: str, digits: int) -> Column:
    """``round(numer / denom, digits)`` half-up, exact; 0.0 when denom <= 0."""
    scale = 10 ** digits
    return F.expr(
        f"case when ({denom}) > 0 then "
        f"cast((2 * cast(({numer}) as bigint) * {scale} + ({denom})) div (2 * ({denom})) as double)"
        f" / {scale} else 0.0 end")
