"""Price rules: overrides from the most specific level down, spend and mark-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_cpi(sub_publisher_cpi: Column, publisher_cpi: Column, cpi: Column) -> Column:
    """Cost per install of the most specific level that has one."""
    return F.coalesce(sub_publisher_cpi, publisher_cpi, cpi)


def effective_markup(custom: Column, default: Column) -> Column:
    """Network-specific mark-up percentage, else the user's default, else NULL."""
    return F.coalesce(custom, default)


def install_spend(installs: Column, cpi: Column) -> Column:
    """Installs times cost per install; 0 when no price is known."""
    return F.coalesce(installs * cpi, F.lit(0)).cast("double")


def marked_up(spend: Column, markup_percent: Column) -> Column:
    """Spend plus mark-up; NULL when there is no mark-up, so a sum skips the spend."""
    return spend * (F.lit(1) + markup_percent / F.lit(100)).cast("double")


def money(amount: Column) -> Column:
    """Floating amount as money, two decimals, half away from zero.

    The amount is taken at 15 significant digits and rounded once: 7.205, which is stored as
    7.20499999999999918, rounds up, 7.2049996 does not.
    """
    digits = F.format_string("%.14e", amount).cast("decimal(38,12)")
    return F.when(amount.isNotNull(), F.round(digits, 2))
