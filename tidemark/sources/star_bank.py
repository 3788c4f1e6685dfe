"""A bank derived from an order-history star schema.

Orders and line items become a transaction log folded onto the observation window; customers,
nations and regions become the masters. Every derivation is a lazy DataFrame over the given
tables, and snapshots come from the same operators a real bank would run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import calendar as C
from tidemark.functions import money as M
from tidemark.operators import aggregates, cards, ledger, loans
from tidemark.operators.slices import dealt
from tidemark.plans import features, labels
from tidemark.session import scratch_path, write_parquet
from tidemark.sources.bank import Bank


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def fold(day: Column) -> Column:
    """Position of a date's month inside the observation window."""
    return ((F.year(day) * 12 + F.month(day) - 1) % K.N_MONTHS).cast("int")


def month_at(idx: Column) -> Column:
    return F.add_months(F.lit(K.FIRST_MONTH), idx.cast("int"))


def day_of(month: Column, day: Column) -> Column:
    return F.date_add(month, F.least(F.dayofmonth(day), F.lit(28)) - 1)


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


class StarBank(Bank):
    stored = frozenset({"txns", "churn_simulation_state"})

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark)
        self._root = root

    def build(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def derived(self, name: str, written: dict[str, DataFrame]) -> DataFrame:
        other = StarBank(self.spark, self._root)
        other._tables.update(written)
        other.build = lambda n: self.table(n) if n in self.stored else StarBank.build(other, n)
        return other.build(name)

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._root}/{name}.parquet")

    # -- masters ---------------------------------------------------------------------------

    def _customers(self) -> DataFrame:
        """Customers with the columns every master derives from."""
        # One row per nation. Without the hint the pruned customer file is estimated to be smaller
        # and is sent instead, which leaves the customers to the single task of the nations.
        nation = F.broadcast(self._raw("nation").join(
            self._raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ))
        c = F.col("c_custkey")
        balance = F.col("c_acctbal").cast("decimal(18,2)")
        rows = (
            self._raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                c.alias("customer_id"),
                pick(K.PERSONA_NAMES, c % 6).alias("persona"),
                (F.lit(300000) + (balance + 1000) * 100).cast("decimal(18,2)")
                .alias("annual_income"),
                F.make_date(
                    (2014 + c % 10).cast("int"), (c % 12 + 1).cast("int"), F.lit(1)
                ).alias("customer_since"),
                F.concat("r_name", F.lit(" "), (F.col("n_nationkey") % 2).cast("string"))
                .alias("city"),
                F.col("r_name").alias("state"),
                F.format_string("B%03d", "c_nationkey").alias("branch_code"),
                (F.lit(200) * (balance + 1000)).cast("decimal(18,2)").alias("wealth"),
                "c_name", "c_mktsegment",
            )
        )
        return self._dealt(rows)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """A row per customer, dealt out for its months and horizons."""
        n = self._raw("customer").count()
        return dealt(rows, "customer_id", n, self.n_months * len(K.HORIZONS))

    def _dealt_by(self, key: str, rows: DataFrame) -> DataFrame:
        """Up to two rows per customer, dealt out for their months as their joins will need them."""
        n, shuffled = self._raw("customer").count(), self.spark.conf.get("spark.sql.shuffle.partitions")
        return dealt(rows, key, 2 * n, self.n_months, int(shuffled))

    def _branch_master(self) -> DataFrame:
        key = F.col("n_nationkey")
        return (
            self._raw("nation")
            .join(self._raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.format_string("B%03d", key).alias("branch_code"),
                F.col("n_name").alias("branch_name"),
                F.concat("r_name", F.lit(" "), (key % 2).cast("string")).alias("city"),
                F.col("r_name").alias("state"),
                F.col("r_name").alias("region"),
                F.when(key % 3 == 0, "Metro").otherwise("Urban").alias("branch_type"),
                F.lit("2010-01-01").cast("date").alias("open_date"),
                F.lit(None).cast("date").alias("closure_date"),
                (1 + key % 18).cast("int").alias("customer_weight"),
            )
        )

    def _customer_master(self) -> DataFrame:
        c = F.col("customer_id")
        born = F.make_date(
            (1950 + c % 50).cast("int"), (c % 12 + 1).cast("int"), (c % 28 + 1).cast("int")
        )
        return self.customers.select(
            "customer_id",
            F.concat(F.lit("CIF"), c.cast("string")).alias("cif_number"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            born.alias("date_of_birth"),
            F.when(c % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.when(c % 3 == 0, "Single").otherwise("Married").alias("marital_status"),
            F.col("c_mktsegment").alias("occupation"),
            F.when(c % 6 == 0, "Salaried").otherwise("Self-Employed").alias("employment_type"),
            "annual_income", "customer_since", "city", "state",
            F.lit("India").alias("country"),
            F.when(c % 97 == 0, "Failed").when(c % 17 == 0, "Pending").otherwise("Verified")
            .alias("kyc_status"),
            F.lit(True).alias("is_active"),
            "branch_code",
        )

    def _account_master(self) -> DataFrame:
        c = F.col("customer_id")
        leap = F.make_date((2012 + 4 * (c % 3)).cast("int"), F.lit(2), F.lit(29))
        opened = F.when(c % 7 == 0, leap).otherwise(F.col("customer_since"))
        savings = F.struct(
            (c + K.ACCOUNT_ID_START).alias("account_id"),
            F.lit("Savings").alias("account_type"),
            opened.alias("open_date"),
            F.when(c % 20 == 0, "Dormant").otherwise("Active").alias("account_status"),
            F.col("persona").isin("salary_core", "complaint_prone_churner")
            .alias("salary_account_flag"),
            M.money(F.lit(0)).alias("overdraft_limit"),
        )
        current = F.struct(
            (c + 15_000_000).alias("account_id"),
            F.lit("Current").alias("account_type"),
            F.add_months("customer_since", 6).alias("open_date"),
            F.lit("Active").alias("account_status"),
            F.lit(False).alias("salary_account_flag"),
            M.money(F.when(c % 2 == 0, 25000).otherwise(50000)).alias("overdraft_limit"),
        )
        accounts = F.when(c % 5 == 0, F.array(savings, current)).otherwise(F.array(savings))
        rows = self.customers.select(
            "customer_id", "branch_code", F.explode(accounts).alias("a")
        )
        return self._dealt_by("account_id", rows.select(
            "a.account_id", "customer_id", "branch_code", "a.account_type", "a.open_date",
            "a.account_status", F.lit("INR").alias("account_currency"),
            "a.salary_account_flag", "a.overdraft_limit",
            F.lit(None).cast("date").alias("account_close_date"),
        ))

    def _account_openings(self) -> DataFrame:
        c = F.col("customer_id")
        savings = F.struct(
            (c + K.ACCOUNT_ID_START).alias("account_id"), F.col("wealth").alias("opening_balance")
        )
        current = F.struct(
            (c + 15_000_000).alias("account_id"),
            (F.col("wealth") / 2).cast("decimal(18,2)").alias("opening_balance"),
        )
        openings = F.when(c % 5 == 0, F.array(savings, current)).otherwise(F.array(savings))
        return self._dealt_by("account_id", self.customers.select(F.inline(openings)))

    def _card_portfolio(self) -> DataFrame:
        c = F.col("customer_id")
        debit = F.struct(
            (c + K.CARD_ID_START).alias("card_id"),
            F.lit("Debit").alias("card_type"),
            F.col("open_date").alias("issue_date"),
            F.lit("Active").alias("card_status"),
            M.money(F.lit(0)).alias("credit_limit"),
            F.lit("Standard Cashback").alias("rewards_program"),
            F.lit("Classic").alias("reward_tier"),
        )
        personas = [dict(zip(K.PERSONA_FIELDS, p)) for p in K.PERSONAS]

        def by_persona(field: str) -> Column:
            return F.element_at(
                F.create_map(*[F.lit(p[name]) for p in personas for name in ("persona", field)]),
                F.col("persona"),
            )

        credit = F.struct(
            (c + 25_000_000).alias("card_id"),
            F.lit("Credit").alias("card_type"),
            F.col("customer_since").alias("issue_date"),
            F.when(c % 33 == 0, "Blocked").otherwise("Active").alias("card_status"),
            M.credit_limit(F.col("annual_income")).alias("credit_limit"),
            by_persona("programme").alias("rewards_program"),
            by_persona("tier").alias("reward_tier"),
        )
        leap = F.make_date((2012 + 4 * (c % 3)).cast("int"), F.lit(2), F.lit(29))
        held = F.filter(
            F.array(F.when(c % 10 != 0, debit), F.when(c % 3 == 0, credit)),
            lambda card: card.isNotNull(),
        )
        rows = self.customers.withColumn(
            "open_date", F.when(c % 7 == 0, leap).otherwise(F.col("customer_since"))
        ).select("customer_id", F.explode(held).alias("k"))
        return self._dealt_by("card_id", rows.select(
            "k.card_id", "customer_id", "k.card_type",
            F.when(c % 2 == 0, "Visa").otherwise("RuPay").alias("network"),
            "k.issue_date",
            C.plus_years_leap(F.col("k.issue_date"), 5).alias("expiry_date"),
            "k.card_status", F.lit(True).alias("primary_card_flag"), "k.credit_limit",
            "k.rewards_program", "k.reward_tier",
        ))

    def _loan_master(self) -> DataFrame:
        c = F.col("customer_id")
        personal = c % 8 == 1
        rows = self.customers.filter(c % 4 == 1).select(
            (c + K.LOAN_ID_START).alias("loan_id"), "customer_id", "branch_code",
            F.when(personal, "Personal Loan").otherwise("Home Loan").alias("loan_type"),
            M.money(
                F.when(personal, 50000 + (c % 50) * 1000).otherwise(2000000 + (c % 20) * 50000)
            ).alias("sanctioned_amount"),
            F.make_date(F.lit(2023), (c % 12 + 1).cast("int"), F.lit(1))
            .alias("disbursement_date"),
            ((c % 13) * 0.5 + 8.5).cast("decimal(6,3)").alias("interest_rate"),
            F.when(personal, 12 * (1 + c % 5)).otherwise(120).cast("int").alias("tenure_months"),
        )
        terms = (F.col("sanctioned_amount"), F.col("interest_rate"), F.col("tenure_months"))
        return self._dealt_by("loan_id", rows.select(
            *rows.columns,
            M.money(M.emi_amount(*terms)).alias("emi_amount"),
            F.when(F.col("loan_type") == "Home Loan", "Property Purchase").otherwise("General")
            .alias("loan_purpose"),
            F.lit("Branch").alias("origination_channel"),
            F.lit("Active").alias("loan_status"),
            C.maturity_date(F.col("disbursement_date"), F.col("tenure_months"))
            .alias("maturity_date"),
        ))

    # -- facts -----------------------------------------------------------------------------

    def _txns(self) -> DataFrame:
        """The transaction log, written to the shared folder once and read from there.

        Nearly every table derives from it with other columns; each would repeat the grouping and
        join of the raw files, while a stored log is scanned with exactly the columns needed.
        """
        return self._stored(self._derived_txns(), "transaction-log")

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return write_parquet(df, scratch_path(self.spark, name))

    def _derived_txns(self) -> DataFrame:
        """Transactions from order lines, without balances.

        Line items are summed per order line before the join, so partial sums combine map-side
        and an order with very many copies of a line stays small.
        """
        lines = self._raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_shipdate").alias("shipped"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)")
            .alias("amount"),
        )
        orders = self._raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        line, owner = F.col("l_linenumber"), F.col("o_custkey")
        credit = F.col("o_orderstatus") == "F"
        second = (owner % 5 == 0) & (line % 4 == 0)
        rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            (F.col("l_orderkey") * 10 + line).alias("transaction_id"),
            (owner + F.when(second, 15_000_000).otherwise(K.ACCOUNT_ID_START))
            .alias("account_id"),
            owner.alias("customer_id"),
            month_at(fold(F.col("shipped"))).alias("txn_month"),
            "shipped", line.alias("line"), F.col("l_orderkey").alias("order_key"), "amount",
            F.when(credit, "Credit").otherwise("Debit").alias("direction"),
            pick(K.TXN_CHANNELS, line - 1).alias("channel"),
            F.concat(F.lit("M"), (F.col("l_orderkey") % 37).cast("string"))
            .alias("merchant_name"),
            (credit & (line == 1)).alias("is_salary_credit"),
            (~credit & (line == 7)).alias("is_fee"),
        )
        date = day_of(F.col("txn_month"), F.col("shipped"))
        return rows.select(
            "transaction_id", "account_id", "customer_id",
            F.make_timestamp(
                F.year(date), F.month(date), F.dayofmonth(date), F.col("line"), F.lit(0),
                F.lit(0), F.lit("UTC"),
            ).alias("txn_timestamp"),
            date.alias("txn_date"), "txn_month",
            F.when(F.col("is_salary_credit"), "Salary Credit")
            .when(F.col("is_fee"), "Service Charge").otherwise("Transfer").alias("txn_type"),
            "direction", "channel", "amount",
            F.lit("INR").alias("currency"),
            F.lit("General").alias("merchant_category"),
            "merchant_name",
            F.lit("Merchant").alias("counterparty_type"),
            F.lit("Online").alias("city"), F.lit("Online").alias("state"),
            "is_salary_credit", "is_fee", F.lit(False).alias("is_reversal"),
            "order_key", "line",
        )

    def _transaction_fact(self) -> DataFrame:
        return ledger.running_balance(
            self.txns.drop("order_key", "line"), self.account_openings
        )

    def _urgent_and_low_orders(self) -> DataFrame:
        month = month_at(fold(F.col("o_orderdate")))
        return self._raw("orders").select(
            F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("customer_id"),
            month.alias("month"), day_of(month, F.col("o_orderdate")).alias("date"),
            (F.col("o_orderstatus") == "F").alias("done"),
            F.col("o_orderpriority").alias("priority"),
        )

    def _customer_complaints(self) -> DataFrame:
        key, done = F.col("key"), F.col("done")
        rows = self._urgent_and_low_orders().filter(F.col("priority") == "1-URGENT")
        return rows.select(
            key.alias("complaint_id"), "customer_id", F.col("date").alias("complaint_date"),
            F.col("month").alias("complaint_month"),
            pick(K.COMPLAINT_CHANNELS, key % 4).alias("channel"),
            pick(K.COMPLAINT_CATEGORIES, key % 5).alias("category"),
            pick(tuple(s[0] for s in K.RESOLUTION_DAYS), key % 3).alias("severity"),
            F.when(done, 7 + key % 69).cast("int").alias("resolution_days"),
            done.alias("resolved_flag"), (key % 10 == 0).alias("escalated_flag"),
            F.when(done, 1 + key % 5).cast("int").alias("csat_score"),
            pick(K.COMPLAINT_ROOT_CAUSES, key % 5).alias("root_cause"),
            F.when(done, "Resolved").otherwise("Open").alias("status"),
        )

    def _customer_feedback(self) -> DataFrame:
        key = F.col("key")
        rows = self._urgent_and_low_orders().filter(F.col("priority") == "5-LOW")
        return rows.select(
            key.alias("feedback_id"), "customer_id", F.col("date").alias("feedback_date"),
            F.col("month").alias("feedback_month"),
            pick(("SMS", "Email", "In-App Push"), key % 3).alias("survey_channel"),
            pick(("General", "Digital Experience", "Complaint Resolution"), key % 3)
            .alias("survey_topic"),
            F.when(key % 10 != 0, key % 11).cast("int").alias("nps_score"),
            (1 + key % 5).cast("int").alias("csat_score"),
        )

    def _hidden_events(self) -> DataFrame:
        """Distinct (customer, month, event)."""
        t = self.txns.filter(F.col("line").isin(2, 3))
        event = pick(K.EVENTS, (F.col("order_key") + 5 * F.col("line")) % 12)
        return t.select(
            "customer_id", F.col("txn_month").alias("event_month"), event.alias("event_type")
        ).distinct()

    def _loan_payments(self) -> DataFrame:
        """A loan counts as paid in every month its owner has any transaction."""
        active = self.txns.select("customer_id", F.col("txn_month").alias("snapshot_month"))
        due = self.loan_master.select(
            "loan_id", "customer_id",
            F.explode(C.month_sequence(self.first_month, self.n_months)).alias("snapshot_month"),
        )
        seen = active.distinct().withColumn("seen", F.lit(True))
        return due.join(seen, ["customer_id", "snapshot_month"], "left").select(
            "loan_id", "snapshot_month", flag(F.col("seen")).alias("paid")
        )

    def _active_months(self) -> DataFrame:
        """Months in which a customer is with the bank: up to and including the churn month."""
        month = F.col("snapshot_month")
        return self.churn_simulation_state.select(
            "customer_id", "churn_month",
            F.explode(C.month_sequence(self.first_month, self.n_months)).alias("snapshot_month"),
        ).filter(F.col("churn_month").isNull() | (month <= F.col("churn_month"))).drop("churn_month")

    def _card_months(self) -> DataFrame:
        """Spend and how much of the bill the holder can pay, for every month a card is held.

        A month without any transaction pays nothing.
        """
        spend = F.sum(
            F.when((F.col("channel") == "POS") & (F.col("direction") == "Debit"), F.col("amount"))
        )
        facts = self.txns.select(
            "customer_id", F.col("txn_month").alias("snapshot_month"), "channel", "direction",
            "amount",
        ).unionByName(self.active_months.withColumn("active", F.lit(True)), allowMissingColumns=True)
        months = facts.groupBy("customer_id", "snapshot_month").agg(
            F.coalesce(spend, F.lit(0)).cast("double").alias("spend"),
            F.count_if(F.col("direction") == "Credit").alias("credits"),
            F.count("amount").alias("n"), F.bool_or("active").alias("active"),
            F.count_if((F.col("channel") == "POS") & (F.col("direction") == "Debit"))
            .alias("purchases"),
        )
        capacity = (
            F.when(F.col("credits") > 0, "full")
            .when((F.col("n") > 0) & (F.col("n") % 2 == 0), "min")
            .otherwise("none")
        )
        credit = self.card_portfolio.filter(F.col("card_type") == "Credit")
        held = credit.select("card_id", "customer_id", "issue_date")
        rows = months.filter("active").join(held, "customer_id")
        return rows.filter(F.col("snapshot_month") >= F.trunc("issue_date", "month")).select(
            "card_id", "snapshot_month", "spend", capacity.alias("capacity"),
            F.col("purchases").alias("txn_count"),
        )

    def _product_acquisitions(self) -> DataFrame:
        """First month each product is held, for products never given up again."""
        c = F.col("customer_id")
        products = F.array(*[
            F.struct(
                F.lit(name).alias("product"),
                F.greatest(F.lit(0), (c * 7 + 5 * k) % 30 - k % 3).cast("int").alias("idx"),
            )
            for k, name in enumerate(K.PRODUCT_FLAGS[:9])
        ])
        rows = self.customers.select("customer_id", F.inline(products))
        return rows.filter(F.col("idx") < self.n_months).select(
            "customer_id", "product", month_at(F.col("idx")).alias("acquired_month")
        )

    # -- monthly tables --------------------------------------------------------------------

    def _product_holdings_monthly(self) -> DataFrame:
        c = F.col("customer_id")
        idx = C.month_index(F.col("snapshot_month")) - F.lit(
            self.first_month.year * 12 + self.first_month.month
        )
        flags = [
            ((c * 7 + 5 * k) % 30 <= idx + k % 3).alias(name)
            for k, name in enumerate(K.PRODUCT_FLAGS[:9])
        ]
        flags.append(((c + idx) % 11 == 0).alias(K.PRODUCT_FLAGS[9]))
        rows = self.customers.select(
            "customer_id",
            F.explode(C.month_sequence(self.first_month, self.n_months)).alias("snapshot_month"),
        ).select("customer_id", "snapshot_month", *flags)
        return rows.withColumn("products_count", aggregates.products_count())

    def _customer_monthly_activity(self) -> DataFrame:
        return aggregates.activity_table(self.txns, self.active_months)

    def _digital_engagement_monthly(self) -> DataFrame:
        return aggregates.digital_table(self.txns, self.active_months)

    def _account_monthly_snapshot(self) -> DataFrame:
        return ledger.account_snapshot(
            self.transaction_fact, self.account_master, self.account_openings,
            self.first_month, self.n_months,
        )

    def _loan_states(self) -> DataFrame:
        return loans.loan_dpd(self.loan_master, self.loan_payments, self.first_month)

    def _loan_monthly_snapshot(self) -> DataFrame:
        return loans.loan_snapshot(self.loan_states)

    def _card_balances(self) -> DataFrame:
        return cards.card_revolve(self.card_months)

    def _card_monthly_snapshot(self) -> DataFrame:
        return cards.card_snapshot(
            self.card_balances, self.card_portfolio, self.customer_monthly_activity
        )

    def _churn_simulation_state(self) -> DataFrame:
        """A customer is gone in the month after the last transaction, if the window covers it.

        Written once: it starts the calendar of nearly every monthly table, each of which would
        look for the last transactions again.
        """
        last = self.txns.groupBy("customer_id").agg(F.max("txn_month").alias("last_month"))
        c = F.col("customer_id")
        end = F.lit(K.FIRST_MONTH)
        gone = F.add_months("last_month", 1)
        churn = F.when(gone < F.add_months(end, self.n_months), gone)
        active = C.month_index(F.col("churn_month")) - C.month_index(F.lit(K.FIRST_MONTH)) + 1
        rows = self.customers.join(last, "customer_id", "left").select(
            "customer_id", "persona", (c % 8 == 0).alias("low_sensitivity_segment"),
            churn.alias("churn_month"),
        )
        return self._dealt(self._stored(rows.select(
            "customer_id", "persona", "low_sensitivity_segment", "churn_month",
            F.col("churn_month").isNotNull().alias("churned_flag"),
            F.when(F.col("churn_month").isNotNull(), pick(K.CHURN_REASONS, c % 7))
            .alias("churn_reason"),
            F.coalesce(active, F.lit(self.n_months)).cast("int")
            .alias("active_months_generated"),
        ), "churn-state"))

    def _customer_churn_label(self) -> DataFrame:
        return labels.churn_label(
            self.churn_simulation_state, self.first_month, self.n_months
        )

    def _churn_feature_snapshot(self) -> DataFrame:
        return features.feature_snapshot(self)
