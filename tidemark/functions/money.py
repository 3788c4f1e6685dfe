"""Loan and card arithmetic, and exact decimal means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K


def money(amount: Column) -> Column:
    return amount.cast("decimal(18,2)")


def monthly_rate(annual_percent: Column) -> Column:
    return annual_percent.cast("double") / F.lit(1200.0)


def growth(annual_percent: Column, months: Column) -> Column:
    return F.pow(F.lit(1.0) + monthly_rate(annual_percent), months.cast("double"))


def emi_amount(principal: Column, annual_percent: Column, tenure: Column) -> Column:
    """Monthly instalment of an annuity loan, rounded to cents; straight-line when the rate is 0."""
    p, g = principal.cast("double"), growth(annual_percent, tenure)
    annuity = p * monthly_rate(annual_percent) * g / F.nullif(g - 1.0, F.lit(0.0))
    flat = p / tenure.cast("double")
    return F.round(F.when(annual_percent == 0, flat).otherwise(annuity), 2)


def max_principal(max_emi: Column, annual_percent: Column, tenure: Column) -> Column:
    """Largest principal whose instalment does not exceed max_emi."""
    g, r = growth(annual_percent, tenure), monthly_rate(annual_percent)
    annuity = max_emi * (g - 1.0) / F.nullif(r * g, F.lit(0.0))
    return F.when(annual_percent == 0, max_emi * tenure.cast("double")).otherwise(annuity)


def outstanding_after(
    principal: Column, annual_percent: Column, emi: Column, instalments: Column
) -> Column:
    """Balance left after a number of paid instalments, never below zero (closed form)."""
    p, e = principal.cast("double"), emi.cast("double")
    g, r = growth(annual_percent, instalments), monthly_rate(annual_percent)
    annuity = p * g - e * (g - 1.0) / F.nullif(r, F.lit(0.0))
    flat = p - e * instalments.cast("double")
    left = F.when(annual_percent == 0, flat).otherwise(annuity)
    return F.greatest(F.lit(0.0), left)


def credit_limit(annual_income: Column) -> Column:
    raw = annual_income.cast("double") / 12.0 * K.CREDIT_LIMIT_MULTIPLIER
    return money(F.greatest(F.lit(K.CREDIT_LIMIT_FLOOR), F.bround(raw, -3)))


def exact_mean(total: Column, n: Column, scale: int) -> Column:
    """total / n in decimal arithmetic, rounded half up once."""
    quotient = total.cast("decimal(28,4)") / n.cast("decimal(10,0)")
    return F.round(quotient, scale)
