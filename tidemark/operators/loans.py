"""Loans: opening balance, schedule, days past due and monthly snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.calendar import maturity_date, month_index
from tidemark.functions.money import (
    emi_amount, max_principal, money, monthly_rate, outstanding_after,
)
from tidemark.session import inline_table


def loan_opening_balance(loans: DataFrame, as_of: dt.date) -> DataFrame:
    """Outstanding balance at the start of a month, after the instalments due before it."""
    elapsed = F.greatest(
        F.lit(0), month_index(F.lit(as_of)) - month_index(F.col("disbursement_date"))
    )
    left = outstanding_after(
        F.col("sanctioned_amount"), F.col("interest_rate"), F.col("emi_amount"), elapsed
    )
    return loans.select(
        "loan_id", elapsed.cast("int").alias("elapsed_months"), left.alias("opening")
    )


def loan_schedule(loans: DataFrame) -> DataFrame:
    """Amortization rows of every loan: interest, principal and closing balance per instalment."""
    terms = loans.select(
        "loan_id", "sanctioned_amount", "interest_rate", "emi_amount",
        F.explode(F.sequence(F.lit(1), F.col("tenure_months"))).alias("instalment"),
    )
    opening = outstanding_after(
        F.col("sanctioned_amount"), F.col("interest_rate"), F.col("emi_amount"),
        F.col("instalment") - 1,
    )
    rows = terms.withColumn("opening", opening).withColumn(
        "interest", F.col("opening") * monthly_rate(F.col("interest_rate"))
    )
    emi = F.col("emi_amount").cast("double")
    rows = rows.withColumn("principal", F.least(emi - F.col("interest"), F.col("opening")))
    return rows.select(
        "loan_id", "instalment",
        F.round("interest", 2).alias("interest"),
        F.round("principal", 2).alias("principal"),
        F.round(F.greatest(F.lit(0.0), F.col("opening") - F.col("principal")), 2).alias("closing"),
    )


def _next_state(state: Column, month: Column, rate: Column, emi: Column) -> Column:
    """One month of a loan: pay and amortize, or miss and age; ended loans stay as they are."""
    open_ = state["loan_status"] == "Active"
    paid, missed = open_ & month["paid"], open_ & ~month["paid"]
    interest = state["outstanding"] * rate
    after = F.greatest(
        F.lit(0.0),
        state["outstanding"] - F.least(emi - interest, state["outstanding"]),
    )
    outstanding = F.when(paid, after).otherwise(state["outstanding"])
    aged = state["dpd_days"] + K.DPD_STEP
    dpd = (
        F.when(paid, 0)
        .when(missed, F.least(aged, F.lit(K.DPD_TERMINAL)))
        .otherwise(state["dpd_days"])
    )
    status = (
        F.when(paid & (after <= 0), "Closed")
        .when(missed & (aged >= K.DPD_TERMINAL), "Delinquent")
        .otherwise(state["loan_status"])
    )
    return F.struct(
        month["snapshot_month"].alias("snapshot_month"),
        outstanding.alias("outstanding"),
        dpd.cast("int").alias("dpd_days"),
        status.alias("loan_status"),
    )


def loan_dpd(loans: DataFrame, payments: DataFrame, start: dt.date) -> DataFrame:
    """Outstanding balance, days past due and status of each loan after each month.

    A missed month adds 30 days; at 90 the loan is delinquent for good. Months of one loan are
    bounded by its term, so the fold runs over a short sorted array inside one row.
    """
    months = payments.groupBy("loan_id").agg(
        F.array_sort(F.collect_list(F.struct("snapshot_month", "paid"))).alias("months")
    )
    terms = loans.join(loan_opening_balance(loans, start), "loan_id").select(
        "loan_id", "customer_id", "opening",
        monthly_rate(F.col("interest_rate")).alias("rate"),
        F.col("emi_amount").cast("double").alias("emi"),
    )
    first_state = F.struct(
        F.lit(None).cast("date").alias("snapshot_month"),
        F.col("opening").alias("outstanding"),
        F.lit(0).alias("dpd_days"),
        F.when(F.col("opening") > 0, "Active").otherwise("Closed").alias("loan_status"),
    )
    history = F.aggregate(
        "months",
        F.array(first_state),
        lambda states, month: F.concat(
            states,
            F.array(_next_state(F.element_at(states, -1), month, F.col("rate"), F.col("emi"))),
        ),
    )
    folded = terms.join(months, "loan_id").select(
        "loan_id", "customer_id", "rate", "emi",
        F.explode(F.slice(history, F.lit(2), F.size("months"))).alias("s"),
    )
    return folded.select("loan_id", "customer_id", "rate", "emi", "s.*")


def loan_snapshot(dpd: DataFrame) -> DataFrame:
    """Monthly loan table from the state after payment; nothing counts as paid while overdue."""
    overdue = F.col("dpd_days") > 0
    interest = F.col("outstanding") * F.col("rate")
    principal = F.least(F.col("emi") - interest, F.col("outstanding"))

    def unless_overdue(value: Column) -> Column:
        return money(F.round(F.when(overdue, 0.0).otherwise(value), 2))

    emi = F.col("emi")
    return dpd.select(
        "loan_id", "snapshot_month",
        money(F.round("outstanding", 2)).alias("outstanding_balance"),
        money(emi).alias("emi_amount"),
        "dpd_days",
        money(F.when(overdue, emi).otherwise(0.0)).alias("overdue_amount"),
        unless_overdue(principal).alias("principal_paid_amount"),
        unless_overdue(interest).alias("interest_paid_amount"),
        money(emi).alias("installment_due_amount"),
        unless_overdue(emi).alias("installment_paid_amount"),
        "loan_status",
        F.lit(False).alias("restructuring_flag"),
    )


def loan_affordability(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Largest instalment and principal an income allows, and the amount that can be granted."""
    limits = F.broadcast(
        inline_table(loans.sparkSession, ("loan_type", "share", "floor", "step"), K.LOAN_TYPES)
    )
    rows = (
        loans.join(customers.select("customer_id", "annual_income"), "customer_id")
        .join(limits, "loan_type")
        .withColumn("max_emi", F.col("annual_income").cast("double") / 12.0 * F.col("share"))
    )
    rows = rows.withColumn(
        "max_principal",
        max_principal(F.col("max_emi"), F.col("interest_rate"), F.col("tenure_months")),
    )
    accepted = F.col("max_principal") >= F.col("floor")
    granted = F.least(F.col("sanctioned_amount").cast("double"), F.col("max_principal"))
    stepped = F.floor(granted / F.col("step")).cast("double") * F.col("step")
    return rows.select(
        "loan_id",
        F.round("max_emi", 2).alias("max_emi"),
        F.round("max_principal", 2).alias("max_principal"),
        accepted.alias("accepted"),
        F.when(accepted, stepped).alias("granted_amount"),
    )


def loan_terms(loans: DataFrame) -> DataFrame:
    """Instalment and maturity recomputed from the terms of each loan."""
    return loans.select(
        "loan_id",
        emi_amount(F.col("sanctioned_amount"), F.col("interest_rate"), F.col("tenure_months"))
        .alias("emi_amount"),
        maturity_date(F.col("disbursement_date"), F.col("tenure_months")).alias("maturity_date"),
    )
